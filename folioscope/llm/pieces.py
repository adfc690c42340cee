"""Sampled segmentations of text into the pieces of a public vocabulary, and their decoding.

A text is cut into words that begin with their blanks, as the pieces do, so that no piece
crosses a cut.  Over the lattice of pieces of a word, forward filtering sums the weights of
all segmentations of each prefix; backward sampling then draws one segmentation, piece by
piece from the end, with the probability that the weights give it.  The draws are numbers
computed from the row key, so a row gets the same segmentation in every run, task and batch.

Characters without a piece become byte pieces, as does a literal U+2581, which decoding
could not tell from a blank; so decoding the ids always gives back the text.
"""

from __future__ import annotations

from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm import words

BLANK = "▁"
# Text whose lattices are held at once, in bytes.
PIECE_BYTES = 1 << 19
# A longer run without a blank is cut, so that a lattice stays small.
MAX_WORD = 64

_STEP = np.uint64(0x9E3779B97F4A7C15)
_NO_PIECE, _BYTES = -1, -2
_LITERAL = 0x110000  # no code point, and so part of no piece


class Trie(NamedTuple):
    """The beginnings of all pieces as numbered nodes; 0 stands for none.

    The steps from a node to a longer one are a hash table with linear probing, at most a
    quarter full.
    """

    classes: np.ndarray  # a small number for each code point, 0 for those of no piece
    firsts: np.ndarray  # node of each class alone
    steps: np.ndarray  # keys of the table, node * number of classes + class, 0 where free
    nexts: np.ndarray  # node behind each step
    ids: np.ndarray  # piece of each node, or _NO_PIECE
    weights: np.ndarray


class Vocabulary(NamedTuple):
    """Pieces by their length in code points: sorted hashes with ids and weights."""

    by_length: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    byte_ids: np.ndarray
    byte_weight: float
    texts: list[bytes]  # what each id stands for
    trie: Trie


def _slots(keys: np.ndarray, size: int) -> np.ndarray:
    """Where keys are looked for first in a table with a power of two as size."""
    shift = np.uint64(65 - size.bit_length())
    return ((keys.view(np.uint64) * _STEP) >> shift).view(np.int64)


def build_trie(spelled: list[tuple[np.ndarray, int, float]]) -> Trie:
    """``spelled`` holds the code points, id and weight of each piece."""
    used = np.unique(np.concatenate([points for points, _, _ in spelled]))
    classes = np.zeros(_LITERAL + 1, np.int32)
    classes[used] = np.arange(1, len(used) + 1)
    many = len(used) + 1
    children: dict[int, int] = {}  # from the root the key is the class
    held: dict[int, tuple[int, float]] = {}
    for points, i, weight in spelled:
        node = 0
        for one in classes[points].tolist():
            node = children.setdefault(node * many + one, len(children) + 1)
        held[node] = (i, weight)
    ids = np.full(len(children) + 1, _NO_PIECE, np.int32)
    weights = np.full(len(children) + 1, -np.inf)
    places = np.array(list(held))
    ids[places], weights[places] = zip(*held.values())
    keys = np.array(list(children), np.int64)
    nodes = np.array(list(children.values()), np.int32)
    firsts = np.zeros(many, np.int32)
    firsts[keys[keys < many]] = nodes[keys < many]
    keys, nodes = keys[keys >= many], nodes[keys >= many]
    size = 1 << (4 * len(keys) + 1).bit_length()
    steps, nexts = np.zeros(size, np.int64), np.zeros(size, np.int32)
    slots = _slots(keys, size)
    while len(keys):
        free = steps[slots] == 0
        _, one = np.unique(slots, return_index=True)
        put = one[free[one]]
        steps[slots[put]], nexts[slots[put]] = keys[put], nodes[put]
        keys, nodes, slots = (np.delete(a, put) for a in (keys, nodes, slots))
        slots = (slots + (steps[slots] != 0)) & (size - 1)
    return Trie(classes, firsts, steps, nexts, ids, weights)


def step(trie: Trie, nodes: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """The nodes that are one code point longer, 0 where no piece begins like that."""
    keys = nodes * np.int64(len(trie.firsts)) + classes
    slots = _slots(keys, len(trie.steps))
    seen = trie.steps[slots]
    out = np.where(seen == keys, trie.nexts[slots], 0)
    open_ = np.flatnonzero((seen != keys) & (seen != 0))
    while len(open_):
        slots[open_] = (slots[open_] + 1) & (len(trie.steps) - 1)
        seen = trie.steps[slots[open_]]
        same = seen == keys[open_]
        out[open_[same]] = trie.nexts[slots[open_[same]]]
        open_ = open_[~same & (seen != 0)]
    return out


def _text_of(model, i: int) -> bytes:
    piece = model.id_to_piece(i)
    if model.is_byte(i):
        return bytes([int(piece[1:-1], 16)])
    if model.is_control(i) or model.is_unknown(i):
        return b""
    return piece.replace(BLANK, " ").encode("utf-8")


@lru_cache(maxsize=2)
def load(path: str, theta: float = 1.0) -> Vocabulary:
    """Read a vocabulary.  The scores of a merge vocabulary are negative ranks; the weight of
    a piece falls with its rank as frequencies do: ``(1 + rank) ** -theta``."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    grouped: dict[int, list[tuple[int, int, float]]] = {}
    spelled = []
    for i in range(size):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i):
            continue
        points = np.frombuffer(model.id_to_piece(i).encode("utf-32-le"), np.uint32)
        total = np.zeros(1, np.uint64)
        for point in points:
            total = total * _STEP + np.uint64(point + 1)
        weight = -theta * float(np.log1p(max(-model.get_score(i), 0.0)))
        grouped.setdefault(len(points), []).append((int(total[0]), i, weight))
        spelled.append((points, i, weight))
    by_length = []
    for length in range(1, max(grouped) + 1):
        rows = sorted(grouped.get(length, []))
        by_length.append(
            (
                np.array([r[0] for r in rows], np.uint64),
                np.array([r[1] for r in rows], np.int32),
                np.array([r[2] for r in rows], np.float64),
            )
        )
    bytes_ = np.array([model.piece_to_id(f"<0x{byte:02X}>") for byte in range(256)], np.int32)
    texts = [_text_of(model, i) for i in range(size)]
    byte_weight = -theta * float(np.log1p(size))
    return Vocabulary(by_length, bytes_, byte_weight, texts, build_trie(spelled))


class Words(NamedTuple):
    """Words of a column, as ranges of code points."""

    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray  # index of the first word of each row, and the number of words


def split_words(data: np.ndarray, heads: np.ndarray, offsets: np.ndarray) -> Words:
    """Cut rows where a blank follows another character, and words that are too long.

    ``heads`` are the bytes at which code points begin.
    """
    blank = data[heads] == 0x20
    first = np.searchsorted(heads, offsets)  # code point at which each row begins
    cut = blank.copy()
    cut[1:] &= ~blank[:-1]
    cut[first[:-1][first[:-1] < len(heads)]] = True
    starts = np.flatnonzero(cut)
    ends = np.append(starts[1:], len(heads))
    parts = -(-(ends - starts) // MAX_WORD)
    if (parts > 1).any():
        within = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        limits = np.repeat(ends, parts)
        starts = np.repeat(starts, parts) + within * MAX_WORD
        ends = np.minimum(starts + MAX_WORD, limits)
    return Words(starts, ends, np.searchsorted(starts, first))


class Layers(NamedTuple):
    """The characters of the distinct words, longest word first: the first characters of all
    words, then the second ones of those that have one, and so on."""

    offsets: np.ndarray  # first character of each layer, and the number of characters
    word: np.ndarray  # of each character
    depth: np.ndarray
    before: np.ndarray  # the character in front, or the number of characters

    def last(self, sizes: np.ndarray) -> np.ndarray:
        return self.offsets[sizes - 1] + np.arange(len(sizes))


def build_layers(sizes: np.ndarray) -> Layers:
    """``sizes`` are the lengths of the words and do not grow."""
    longest = int(sizes[0])
    many = len(sizes) - np.searchsorted(sizes[::-1], np.arange(longest), "right")
    offsets = np.concatenate([[0], np.cumsum(many)])
    depth = np.repeat(np.arange(longest), many)
    word = np.arange(offsets[-1]) - offsets[depth]
    before = np.where(depth > 0, offsets[depth - 1] + word, offsets[-1])
    return Layers(offsets, word, depth, before)


class Lattice(NamedTuple):
    """For each character of the distinct words, the pieces that may end there, by length."""

    first: np.ndarray  # first piece of each character, and the number of pieces
    ids: np.ndarray
    shares: np.ndarray  # running probabilities of a character's pieces
    before: np.ndarray  # the character in front of each piece, or the number of characters


def find_pieces(vocabulary: Vocabulary, points: np.ndarray, layers: Layers):
    """For each length the last characters of the pieces in the words, their nodes and the
    characters in front."""
    trie = vocabulary.trie
    classes = trie.classes[points]
    many = np.append(np.diff(layers.offsets), np.zeros(len(vocabulary.by_length), np.int64))
    word, depth, before = layers.word, layers.depth, layers.before
    node, at = trie.firsts[classes], np.arange(len(points))
    for _ in vocabulary.by_length:
        found = np.flatnonzero(trie.ids[node] != _NO_PIECE)
        yield at[found], node[found], before[found]
        more = np.flatnonzero((node > 0) & (word < many[depth + 1]))
        word, depth, before = word[more], depth[more] + 1, before[more]
        at = layers.offsets[depth] + word
        node = step(trie, node[more], classes[at])


def build_lattice(
    vocabulary: Vocabulary, points: np.ndarray, widths: np.ndarray, layers: Layers
) -> Lattice:
    """Forward filtering over all words at once.

    ``points`` are the code points of the characters, ``widths`` their bytes.
    """
    size = len(points)
    found = list(find_pieces(vocabulary, points, layers))
    # Every character has a piece of its own: those without spell their bytes.
    alone = np.ones(size, bool)
    alone[found[0][0]] = False
    alone = np.flatnonzero(alone)
    many = np.bincount(np.concatenate([at for at, _, _ in found]), minlength=size)
    many[alone] += 1
    first = np.concatenate([[0], np.cumsum(many)])
    ids = np.empty(first[-1], np.int32)
    weights = np.empty(first[-1])
    before = np.empty(first[-1], np.int64)
    place = first[:-1].copy()
    ids[place[alone]] = _BYTES
    weights[place[alone]] = vocabulary.byte_weight * widths[alone]
    before[place[alone]] = layers.before[alone]
    place[alone] += 1
    for at, node, front in found:
        to = place[at]
        ids[to] = vocabulary.trie.ids[node]
        weights[to] = vocabulary.trie.weights[node]
        before[to] = front
        place[at] += 1

    # Each weight is read once; the running probabilities take its place.
    summed = np.zeros(size + 1)
    shares = weights
    for begin, end in zip(layers.offsets[:-1], layers.offsets[1:]):
        low, high = first[begin], first[end]
        heads = first[begin:end] - low
        score = weights[low:high] + summed[before[low:high]]
        top = np.maximum.reduceat(score, heads)
        score = np.exp(score - np.repeat(top, many[begin:end]))
        summed[begin:end] = top + np.log(np.add.reduceat(score, heads))
        shares[low:high] = score
    rest = np.flatnonzero(many > 1)
    rank = 1
    while len(rest):
        at = first[rest] + rank
        shares[at] += shares[at - 1]
        rank += 1
        rest = rest[many[rest] > rank]
    shares /= np.repeat(shares[first[1:] - 1], many)
    return Lattice(first, ids, shares, before)


def draws(seeds: np.ndarray, places: np.ndarray, step: int) -> np.ndarray:
    """Numbers in [0, 1) that depend on the row, the word's place in it and the step only."""
    at = places.astype(np.uint64) * _STEP + np.uint64(step)
    return (words.mix(seeds ^ words.mix(at)) >> np.uint64(11)) * (1.0 / (1 << 53))


def sample(
    lattice: Lattice, last: np.ndarray, seeds: np.ndarray, places: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Backward sampling from the last character of each word: word, last character and
    number in the lattice of each drawn piece, in order."""
    none = len(lattice.first) - 1
    at = last.copy()
    many = np.zeros(len(last), np.int64)
    live = np.arange(len(last))
    taken = []
    while len(live):
        node = at[live]
        share = draws(seeds[live], places[live], len(taken))
        piece = lattice.first[node]
        left = np.flatnonzero(lattice.shares[piece] <= share)
        while len(left):
            piece[left] += 1
            left = left[lattice.shares[piece[left]] <= share[left]]
        taken.append((live, node, piece))
        many[live] += 1
        at[live] = lattice.before[piece]
        live = live[at[live] != none]
    ends = np.cumsum(many)
    nodes, pieces = np.empty((2, many.sum()), np.int64)
    for number, (live, node, piece) in enumerate(taken, 1):
        to = ends[live] - number
        nodes[to], pieces[to] = node, piece
    return np.repeat(np.arange(len(last)), many), nodes, pieces


def encode_column(
    vocabulary: Vocabulary, data: np.ndarray, offsets: np.ndarray, seeds: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rows one after the other, and where each row's begin."""
    heads = np.flatnonzero((data & 0xC0) != 0x80)
    if not len(heads):
        return np.empty(0, np.int32), np.zeros(len(offsets), np.int64)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    tails = np.append(heads[1:], len(data))
    found = split_words(data, heads, offsets)
    hashes = words.run_hashes(data, heads[found.starts], tails[found.ends - 1])
    _, example, numbers = np.unique(hashes, return_index=True, return_inverse=True)

    sizes = (found.ends - found.starts)[example]
    order = np.argsort(-sizes, kind="stable")
    sizes, example = sizes[order], example[order]
    layers = build_layers(sizes)
    source = found.starts[example][layers.word] + layers.depth
    own = points[source]
    own[own == ord(BLANK)] = _LITERAL
    own[own == 0x20] = ord(BLANK)
    widths = (tails - heads)[source]
    lattice = build_lattice(vocabulary, own, widths, layers)
    last = np.empty(len(order), np.int64)
    last[order] = layers.last(sizes)

    counts = np.diff(found.rows)
    places = np.arange(len(numbers)) - np.repeat(found.rows[:-1], counts)
    word, node, piece = sample(lattice, last[numbers], np.repeat(seeds, counts), places)
    ids = lattice.ids[piece]
    many = np.where(ids == _BYTES, widths[node], 1)
    begin = np.cumsum(many) - many
    out = np.repeat(ids, many)
    spelled = np.repeat(ids == _BYTES, many)
    byte = np.repeat(heads[source[node]] - begin, many) + np.arange(len(out))
    out[spelled] = vocabulary.byte_ids[data[byte[spelled]]]
    per_word = np.bincount(word, many, minlength=len(numbers)).astype(np.int64)
    return out, np.concatenate([[0], np.cumsum(per_word)])[found.rows]


def encode_sampled(
    docs: DataFrame,
    model: str,
    key: str = "doc_id",
    text: str = "text",
    theta: float = 1.0,
    out: str = "ids",
) -> DataFrame:
    """``key`` and ``out``, the ids of a sampled segmentation of each text.

    ``model`` is the path of a piece vocabulary that every executor has.  Larger ``theta``
    prefers frequent pieces more.  The draws depend on ``key`` alone: repeated rows with one
    key get one segmentation, null is a key like any other.  A null text gives null, an
    empty one no ids.  Other columns are ignored.
    """
    chosen = docs.select(
        docs[key].alias("key"),
        F.xxhash64(docs[key].cast("string")).alias("seed"),
        docs[text].alias("text"),
    )

    def run(batches):
        vocabulary = load(model, theta)
        for batch in batches:
            for piece in words.pieces(batch, "text", PIECE_BYTES):
                column = piece.column(2)
                seeds = piece.column(1).to_numpy().view(np.uint64)
                ids, ends = encode_column(vocabulary, *words.buffers(column), seeds)
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))
                if column.null_count:
                    none = pa.scalar(None, lists.type)
                    lists = pa.compute.if_else(column.is_null(), none, lists)
                yield pa.RecordBatch.from_arrays([piece.column(0), lists], names=["key", "ids"])

    kind = chosen.schema["key"].dataType.simpleString()
    encoded = chosen.mapInArrow(run, f"key {kind}, ids array<int>")
    return encoded.withColumnsRenamed({"key": key, "ids": out})


def decode_lists(vocabulary: Vocabulary, lists: pa.Array) -> pa.Array:
    """The texts of lists of ids; a null list has a null text."""
    table = np.frombuffer(b"".join(vocabulary.texts), np.uint8)
    widths = np.array([len(t) for t in vocabulary.texts], np.int64)
    begins = np.cumsum(widths) - widths
    ids = lists.flatten().to_numpy(zero_copy_only=False)
    counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    many = widths[ids]
    ends = np.concatenate([[0], np.cumsum(many)])
    source = np.repeat(begins[ids] - ends[:-1], many) + np.arange(ends[-1])
    rows = np.concatenate([[0], np.cumsum(counts)])
    offsets = pa.py_buffer(ends[rows].astype(np.int32).tobytes())
    held = pa.py_buffer(table[source].tobytes())
    texts = pa.Array.from_buffers(pa.string(), len(lists), [None, offsets, held])
    none = pa.scalar(None, pa.string())
    return pa.compute.if_else(lists.is_null(), none, texts) if lists.null_count else texts


def decode(encoded: DataFrame, model: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """All columns and ``out``, the text that the ids stand for; null ids give null.

    A column with the name of ``out`` gives way to it.
    """
    encoded = encoded.select(*(encoded[name] for name in encoded.columns if name != out))
    fields = encoded.columns
    at = fields.index(ids)
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema]

    def run(batches):
        vocabulary = load(model)
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                columns = [*part.columns, decode_lists(vocabulary, part.column(at))]
                yield pa.RecordBatch.from_arrays(columns, names=[*fields, out])

    return encoded.mapInArrow(run, ", ".join([*kinds, f"`{out}` string"]))
