"""Near copies of paragraphs: MinHash bands, exact verification, removal by components.

What is judged are pieces: a line is cut behind its sentences, and a long sentence at places
that its own words choose, so that a passage is cut alike wherever it stands.  A piece that
does not fill a shingle has its whole sequence as one, as short documents have.  Its 5-word
shingles are sketched by the least values of several hash functions, and the bands of the
sketch are the keys under which pieces meet; what meets is compared exactly, as whole
documents are.  Equal sets are one set by their id, and a set too small to be similar to any
other has no bands.  Of each component one piece stays.  Repeated pieces side by side make a
passage, which tells a copied paragraph from a stock sentence.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope import workspace
from folioscope.llm import links, setjoin, words

# By default a piece fills one shingle; the registered query judges every piece with a word.
MIN_WORDS = links.SHINGLE_WORDS
# Sentences of more words are cut further, where a word has the least hash of so many words
# on both sides.
LONG_SENTENCE, CUT_REACH = 24, 5
# Repeated words side by side that make a passage: of 50 copied words, those in the two pieces
# that reach over the ends of the copy may count for nothing, and pieces have 9 words or so.
PASSAGE_WORDS = 40
# A pair of similarity 0.8 shares a band with probability 1 - (1 - 0.8^2)^8 > 0.9997.
BANDS, BAND_ROWS = 8, 2
# Pieces of classes with so many members, or of the largest this many, whichever are fewer,
# are looked up in a broadcast table; the others meet their class in a join.
HOT_CLASS, HOT_SETS = 256, 100_000
# Sets of which a task remembers that it has given their bands, a power of two; 8 bytes each.
RECENT_SETS = 1 << 20

_FACTORS = words.mix(np.arange(1, BANDS * BAND_ROWS + 1, dtype=np.uint64)) | np.uint64(1)
_SHIFTS = words.mix(np.arange(1001, BANDS * BAND_ROWS + 1001, dtype=np.uint64))
_STOPS = np.isin(np.arange(256), [0x21, 0x2E, 0x3F])  # ! . ?
_CLOSERS = np.isin(np.arange(256), [0x22, 0x27, 0x29, 0x5D])  # " ' ) ]


class Pieces(NamedTuple):
    """Sentences and parts of long ones, in the order of the text."""

    hashes: np.ndarray  # of all words
    words: np.ndarray  # index of the first word of each piece, and the number of words
    begins: np.ndarray  # first byte of each piece; the pieces of a line fill it
    ends: np.ndarray  # byte behind it
    rows: np.ndarray  # index of the first piece of each row, and the number of pieces

    def sizes(self) -> np.ndarray:
        return np.diff(self.words)


def _chosen_cuts(hashes: np.ndarray, sentence: np.ndarray) -> np.ndarray:
    """Words with the least hash among ``CUT_REACH`` neighbours on both sides, the first of
    equals; neighbours are words of the same sentence."""
    least = np.ones(len(hashes), bool)
    for step in range(1, min(CUT_REACH, len(hashes) - 1) + 1):
        near = sentence[step:] == sentence[:-step]
        left, right = hashes[:-step], hashes[step:]
        least[step:] &= ~near | (right < left)
        least[:-step] &= ~near | (left <= right)
    return least


def text_pieces(data: np.ndarray, offsets: np.ndarray) -> Pieces:
    """The pieces of all rows.  A sentence ends behind a word that ends in ``.``, ``!`` or
    ``?``, perhaps with a closing quote or bracket, and at the end of its line."""
    lines = words.find_runs(data, offsets, words.NOT_NEWLINE)
    found = words.find_runs(data, offsets, words.NOT_SPACE)
    hashes = words.run_hashes(data, found.starts, found.ends, words.LOWER)
    if not len(hashes):
        none = np.empty(0, np.int64)
        return Pieces(hashes, np.zeros(1, np.int64), none, none, np.zeros(len(offsets), np.int64))
    line = np.searchsorted(lines.starts, found.starts, "right") - 1
    final = found.ends - 1
    final = np.where(_CLOSERS[data[final]] & (final > found.starts), final - 1, final)
    line_end = np.append(line[1:] != line[:-1], True)
    stop = _STOPS[data[final]] | line_end
    sentence = np.cumsum(stop) - stop
    long = np.bincount(sentence)[sentence] > LONG_SENTENCE
    last = stop | (long & _chosen_cuts(hashes, sentence))
    first = np.append(0, np.flatnonzero(last)[:-1] + 1)
    opens = np.append(True, line_end[:-1])[first]
    begins = np.where(opens, lines.starts[line[first]], found.starts[first])
    ends = np.append(begins[1:], 0)
    closing = np.append(opens[1:], True)
    ends[closing] = lines.ends[line[first[closing]]]
    return Pieces(
        hashes, np.append(first, len(hashes)), begins, ends, np.searchsorted(begins, offsets)
    )


def _judged(pieces: Pieces, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pieces with enough words, the words of those, and where the words of each begin."""
    sizes = pieces.sizes()
    long = sizes >= min_words
    rows = np.concatenate([[0], np.cumsum(sizes[long])])
    return np.flatnonzero(long), pieces.hashes[np.repeat(long, sizes)], rows


def paragraph_sets(column: pa.Array, shingle: int, min_words: int):
    """The sets of all pieces of a column, as ``setjoin.Texts`` wants them."""
    pieces = text_pieces(*words.buffers(column))
    long, hashes, rows = _judged(pieces, min_words)
    keys, places = links.row_sets(hashes, rows, shingle)
    return keys, places, words.owners(pieces.rows)[long]


def bands(keys: np.ndarray, places: np.ndarray) -> np.ndarray:
    """One row of band hashes for each set; sets are not empty."""
    count = len(places) - 1
    out = np.empty((count, BANDS), np.uint64)
    if not count:
        return out
    for band in range(BANDS):
        total = np.full(count, band + 1, np.uint64)
        for row in range(band * BAND_ROWS, (band + 1) * BAND_ROWS):
            least = np.minimum.reduceat(keys * _FACTORS[row] + _SHIFTS[row], places[:-1])
            total = words.mix(total ^ least)
        out[:, band] = total
    return out


def may_link(sizes: np.ndarray, percent: int) -> np.ndarray:
    """Whether a set of so many members can be similar to any other than its equals.

    The most similar one has a single member more.
    """
    return 100 * sizes >= percent * (sizes + 1)


class Recent:
    """The ids that came last, one for each place of a table of bounded size.

    An id whose place another has taken counts as new again, so frequent ones stay known and
    an id costs the same however many came before.
    """

    def __init__(self, size: int = RECENT_SETS) -> None:
        self.held = np.zeros(size, np.int64)
        self.held[0] = 1  # no id of this place

    def fresh(self, ids: np.ndarray) -> np.ndarray:
        """Which ids are new, the first of equal ones only."""
        at = ids & (len(self.held) - 1)
        new = np.flatnonzero(self.held[at] != ids)
        _, first = np.unique(ids[new], return_index=True)
        self.held[at[new]] = ids[new]
        out = np.zeros(len(ids), bool)
        out[new[first]] = True
        return out


def mark(
    docs: DataFrame, key: str, text: str, shingle: int, percent: int, min_words: int
) -> DataFrame:
    """``key``, ``other_key``, ``number`` of the piece in its text, ``set``, ``n``, ``prefix``
    (the bands).

    A task gives the bands of a set that comes often once or a few times, so copies are
    merged before anything is shuffled.
    """
    chosen = setjoin.keyed(docs, key, text)

    def run(batches):
        recent = Recent()
        for batch in batches:
            for piece in words.pieces(batch, "text"):
                cut = text_pieces(*words.buffers(piece.column(2)))
                long, hashes, rows = _judged(cut, min_words)
                keys, places = links.row_sets(hashes, rows, shingle)
                own = words.owners(cut.rows)[long]
                ids = links.set_ids(keys, places)
                sizes = np.diff(places).astype(np.int64)
                banded = may_link(sizes, percent)
                banded[banded] = recent.fresh(ids[banded])
                inside = np.concatenate([[0], np.cumsum(sizes[banded])])
                flat = bands(keys[np.repeat(banded, sizes)], inside).reshape(-1)
                ends = np.concatenate([[0], np.cumsum(BANDS * banded)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))
                none = pa.scalar(None, lists.type)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column(0).take(pa.array(own)),
                        piece.column(1).take(pa.array(own)),
                        pa.array(long - cut.rows[own]),
                        pa.array(ids),
                        pa.array(sizes),
                        pa.compute.if_else(pa.array(banded), lists, none),
                    ],
                    names=["key", "other_key", "number", "set", "n", "prefix"],
                )

    kind = chosen.schema["key"].dataType.simpleString()
    marks = chosen.mapInArrow(
        run,
        f"key {kind}, other_key bigint, number bigint, set bigint, n bigint, "
        "prefix array<bigint>",
    )
    return workspace.materialize(marks, "paragraphs")


def paragraph_classes(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = links.SHINGLE_WORDS,
    percent: int = links.PERCENT,
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """The repeated pieces: ``key``, ``other_key`` (a hash of the text of rows without a key),
    ``number`` of the piece in its text, and of its class its name (``class``), the key of its
    first row (``class_key``, ``class_other``) and its size, two or more.

    A class is a component of links.  Null and empty texts have no pieces.  Repeated rows
    repeat all of their pieces; rows without a key come last in their class.  An empty table
    gives an empty result.
    """
    marks = mark(docs, key, text, shingle, percent, min_words)
    texts = setjoin.Texts(
        docs, key, text, lambda column: paragraph_sets(column, shingle, min_words)
    )
    labels, holders = setjoin.link_sets(marks, texts, percent)
    known = workspace.materialize(
        holders.join(labels.withColumnRenamed("node", "set"), "set", "left")
        .where("size > 1 OR label IS NOT NULL")
        .withColumn("label", F.coalesce("label", "set")),
        "paragraph-sets",
    )
    whole = known.groupBy("label").agg(
        F.min("key").alias("class_key"),
        F.min("other_key").alias("class_other"),
        F.sum("size").alias("class_size"),
    )
    repeated = workspace.materialize(
        known.select("set", "label", "size")
        .join(whole.where("class_size > 1"), "label")
        .withColumn("class_other", F.expr("if(class_key IS NULL, class_other, NULL)"))
        .withColumnRenamed("label", "class"),
        "paragraph-classes",
    )
    # The members of a hot set would meet in one task: such sets go to the members instead.
    hot = repeated.where(F.col("size") >= HOT_CLASS).orderBy(F.desc("size"), "set").limit(HOT_SETS)
    hot = workspace.materialize(hot.drop("size"), "paragraph-hot")
    members = marks.select("key", "other_key", "number", "set")
    rest = members.join(F.broadcast(hot.select("set")), "set", "left_anti")
    cold = repeated.drop("size").join(F.broadcast(hot.select("set")), "set", "left_anti")
    both = members.join(F.broadcast(hot), "set").unionByName(rest.join(cold, "set"))
    return both.drop("set")


def _sums(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many flags are set before each place, for places up to the number of flags."""
    return np.concatenate([[0], np.cumsum(flags)])[at]


def passages(cut: Pieces, again: np.ndarray, least: int = PASSAGE_WORDS) -> np.ndarray:
    """For each row its maximal runs of repeated pieces with ``least`` words or more."""
    own = words.owners(cut.rows)
    heads = again.copy()
    heads[1:] &= ~again[:-1] | (own[1:] != own[:-1])
    starts = np.flatnonzero(heads)
    run = np.cumsum(heads)[again] - 1
    total = np.bincount(run, cut.sizes()[again], len(starts))
    return np.bincount(own[starts[total >= least]], minlength=len(cut.rows) - 1)


def without_pieces(
    data: np.ndarray, offsets: np.ndarray, cut: Pieces, gone: np.ndarray
) -> list[bytes]:
    """The texts without some pieces.

    A line of which nothing is left goes with the newline behind it; at the end of a text,
    with the one that then is the last.
    """
    keep = np.ones(len(data) + 1, np.int64)
    np.add.at(keep, cut.begins[gone], -1)
    np.add.at(keep, cut.ends[gone], 1)
    keep = np.cumsum(keep - 1)[:-1] == 0
    lines = words.find_runs(data, offsets, words.NOT_NEWLINE)
    first = np.searchsorted(cut.begins, lines.starts)
    last = np.searchsorted(cut.begins, lines.ends)
    lost = (last > first) & (_sums(gone, last) - _sums(gone, first) == last - first)
    ends = lines.ends[lost]
    row_end = offsets[1:][words.owners(lines.rows)[lost]]
    keep[ends[ends < row_end]] = False
    newlines = np.flatnonzero(keep & (data == 0x0A))
    final = ends[ends == row_end]
    row = np.searchsorted(offsets, final, "left") - 1  # a line is not empty: its row has bytes
    newlines = np.append(newlines, -1)  # found where a text has none in front
    before = newlines[np.searchsorted(newlines[:-1], final) - 1]
    keep[before[before >= offsets[row]]] = False
    sums = _sums(keep, offsets)
    raw = data[keep].tobytes()
    return [raw[a:b] for a, b in zip(sums[:-1], sums[1:])]


def remove_near_copies(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = links.SHINGLE_WORDS,
    percent: int = links.PERCENT,
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """``key``, ``text`` without the pieces that repeat another, and counts of each row.

    Of the pieces of a class that with the smallest key and number stays.  ``_n_paragraphs``
    counts the judged pieces, ``_n_repeated`` the passages (runs of pieces in classes of two
    or more, ``PASSAGE_WORDS`` words or more in all), ``_n_pieces`` the pieces in such
    classes and ``_n_removed`` those of them that go; ``_classes`` lists the class keys.
    Null texts stay null.  Rows that share a key share their removals; rows with a null key
    are cleaned of what repeats a piece of another row or of a text with a smaller hash.  An
    empty table gives an empty result; other columns are ignored.
    """
    classes = paragraph_classes(docs, key, text, shingle, percent, min_words)
    mine = F.expr("class_key <=> key AND class_other <=> other_key")
    lists = classes.groupBy("key", "other_key").agg(
        F.sort_array(F.collect_set(F.struct("class", "number", mine.alias("mine")))).alias("held"),
        F.sort_array(F.collect_set("class_key")).alias("classes"),
    )
    chosen = setjoin.keyed(docs, key, text).withColumnsRenamed({"key": "own", "other_key": "its"})
    same = chosen["own"].eqNullSafe(lists["key"]) & chosen["its"].eqNullSafe(lists["other_key"])
    joined = chosen.join(lists, same, "left").select(
        "own", "text", "held.class", "held.number", "held.mine", "classes"
    )

    def flags(piece: pa.RecordBatch, cut: Pieces) -> tuple[np.ndarray, np.ndarray]:
        """Which pieces are repeated, and which of them go: all but the first of a class."""
        sizes = piece.column(3).value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(sizes)), sizes)
        classed, number, mine = (
            piece.column(k).flatten().to_numpy(zero_copy_only=False) for k in (2, 3, 4)
        )
        # Sorted by class and number within a row.
        first = np.ones(len(row), bool)
        first[1:] = (classed[1:] != classed[:-1]) | (row[1:] != row[:-1])
        again, gone = np.zeros((2, len(cut.begins)), bool)
        again[cut.rows[row] + number] = True
        leaves = ~(first & mine.astype(bool))
        gone[cut.rows[row[leaves]] + number[leaves]] = True
        return again, gone

    def run(batches):
        for batch in batches:
            for piece in words.pieces(batch, "text"):
                column = piece.column(1)
                data, offsets = words.buffers(column)
                cut = text_pieces(data, offsets)
                again, gone = flags(piece, cut)
                null = column.is_null().to_numpy(zero_copy_only=False)
                texts = column
                if gone.any():
                    texts = without_pieces(data, offsets, cut, gone)
                    texts = pa.array(texts, pa.binary(), mask=null)
                judged = cut.sizes() >= min_words
                counts = [words.by_row(judged, cut.rows), passages(cut, again)]
                counts += [words.by_row(f, cut.rows) for f in (again, gone)]
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column(0),
                        texts.cast(pa.string()),
                        *(pa.array(c.astype(np.int64)) for c in counts),
                        piece.column(5),
                    ],
                    names=["key", "text", "n", "m", "p", "r", "classes"],
                )

    kind = joined.schema["own"].dataType.simpleString()
    cleaned = joined.mapInArrow(
        run,
        f"key {kind}, text string, n bigint, m bigint, p bigint, r bigint, classes array<{kind}>",
    )
    names = {"n": "_n_paragraphs", "m": "_n_repeated", "p": "_n_pieces", "r": "_n_removed"}
    return cleaned.withColumnsRenamed(names | {"classes": "_classes", "key": key, "text": text})


def digest(cleaned: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: counts, the documents whose pieces it repeats or opens, and the
    SHA-256 of the text that is left."""
    return cleaned.select(
        key,
        F.col("_n_paragraphs").alias("n_paragraphs"),
        F.col("_n_repeated").alias("n_repeated"),
        F.col("_n_pieces").alias("n_repeated_pieces"),
        F.col("_n_removed").alias("n_removed"),
        F.array_join(F.coalesce("_classes", F.array()), ",").alias("class_ids"),
        F.sha2(F.coalesce(text, F.lit("")), 256).alias("kept_sha256"),
    )
