"""Removal of benchmark passages from training texts.

The normalised words of the benchmark items form a generalised suffix automaton.  Training
words stream through it; where the longest match reaches the window length, the words
inside are hits.  The automaton is built from shards of bounded size: a larger benchmark is
matched shard by shard, each pass adding to the spans that the passes before have found.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope import workspace
from folioscope.llm import words
from folioscope.llm.automaton import SuffixAutomaton, Vocabulary

WINDOW = 10
# Benchmark text of one automaton, in bytes; it is held by every task.
SHARD_BYTES = 4 << 20
# Percent of a document's words that may be hits before the whole document goes.
MAX_HIT_SHARE = 50
# What is added to marked rows.
ADDED = {"_n_words": "bigint", "_hits": "array<bigint>", "_items": "array<string>"}


class Matcher(NamedTuple):
    vocabulary: Vocabulary
    automaton: SuffixAutomaton
    items: list[str | None]
    short: dict[int, list[tuple[int, int]]]  # state: (item, its length) of short items
    least: int
    window: int


def normalised(data: np.ndarray, offsets: np.ndarray) -> tuple[words.Runs, np.ndarray]:
    """Runs of letters and digits, A-Z in lower case, and their hashes."""
    found = words.find_runs(data, offsets, words.ALPHANUMERIC)
    return found, words.run_hashes(data, found.starts, found.ends, words.LOWER)


def build_matcher(items: list[tuple[str | None, str]], window: int = WINDOW) -> Matcher:
    """The automaton of (item id, text) pairs; items without words take no part."""
    column = pa.array([text for _, text in items], pa.string())
    found, hashes = normalised(*words.buffers(column))
    names, sequences = [], []
    for row, (name, _) in enumerate(items):
        own = hashes[found.rows[row] : found.rows[row + 1]]
        if len(own):
            names.append(name)
            sequences.append(own)
    vocabulary = Vocabulary(sequences)
    coded = [s.tolist() for s in vocabulary.sequences]
    automaton = SuffixAutomaton(coded, window)
    short: dict[int, list[tuple[int, int]]] = {}
    for number, sequence in enumerate(coded):
        if len(sequence) < window:
            state = 0
            for symbol in sequence:
                state = automaton.next[state][symbol]
            short.setdefault(state, []).append((number, len(sequence)))
    least = min([window, *map(len, coded)])
    return Matcher(vocabulary, automaton, names, short, least, window)


def match_rows(
    matcher: Matcher, hashes: np.ndarray, rows: np.ndarray
) -> tuple[np.ndarray, dict[int, set[str]]]:
    """Which words are hits, and the items found in each row that has any."""
    hit = np.zeros(len(hashes), bool)
    items: dict[int, set[str]] = {}
    codes = matcher.vocabulary.encode(hashes)
    automaton, window = matcher.automaton, matcher.window
    for begin, end in matcher.vocabulary.candidates(codes, rows, matcher.least):
        found: set[int] = set()
        seen: set[int] = set()
        for at, (matched, state) in enumerate(
            automaton.statistics(codes[begin:end].tolist()), begin + 1
        ):
            if matched >= window:
                hit[at - window : at] = True
                seen.add(automaton.cut(state, window))
            if matcher.short and matched >= matcher.least:
                # A short item ends here if its state lies on the way to the root.
                below = automaton.cut(state, matched) if matched else 0
                while below > 0:
                    for number, size in matcher.short.get(below, ()):
                        if size <= matched:
                            hit[at - size : at] = True
                            found.add(number)
                    below = automaton.link[below]
        for state in seen:
            found.update(automaton.where[state])
        if found:
            row = int(np.searchsorted(rows, begin, "right")) - 1
            items.setdefault(row, set()).update(matcher.items[n] for n in found)
    return hit, items


def _shards(benchmark: DataFrame, item: str, text: str, limit: int):
    """Lists of (item id, text) with about ``limit`` bytes, at least one; True with the last."""
    pairs = benchmark.select(
        F.col(item).cast("string").alias("item"), F.col(text).alias("text")
    ).where("text is not null")
    size = pairs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first().n
    count = max(1, -(-size // limit))
    shard = F.pmod(F.xxhash64("item", "text"), F.lit(count))
    for number in range(count):
        rows = pairs.where(shard == number).distinct().collect()
        yield [(r.item, r.text) for r in rows], number == count - 1


def mark_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """All columns, and ``_n_words``, ``_hits`` (pairs of first word and the one behind the
    last, flattened) and ``_items`` (distinct item ids, sorted as strings, null last).

    A window is ``window`` consecutive words of an item; an item with fewer words, but not
    none, is one window.  Null and empty texts have no words.  Repeated rows, of documents
    or items, count like single ones for what they contain; all items without an id count as
    one, whose id is null.  An empty benchmark gives no hits.  Columns of ``docs`` with the
    names of the added ones give way to them.
    """
    fields = [name for name in docs.columns if name not in ADDED]
    marked = _streamed(
        docs.select(*fields).toDF(*_places(fields)),
        benchmark,
        f"c{fields.index(text)}",
        item,
        item_text,
        window,
        shard_bytes,
    )
    return marked.toDF(*fields, *ADDED)


def _places(fields: list[str]) -> list[str]:
    """Names that no added column has, so that any table can be marked."""
    return [f"c{i}" for i in range(len(fields))]


def _streamed(docs, benchmark, text, item, item_text, window, shard_bytes, finish=None):
    """``mark_hits``; ``finish`` turns a marked batch of the last pass into rows like ``docs``."""
    fields = docs.columns
    at = fields.index(text)
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
        + [f"{name} {kind}" for name, kind in ADDED.items()]
    )

    def passing(matcher_of, merge, finish):
        def run(batches):
            matcher = matcher_of()
            for batch in batches:
                for piece in words.pieces(batch, text):
                    found, hashes = normalised(*words.buffers(piece.column(at)))
                    hit, items = match_rows(matcher, hashes, found.rows)
                    before = None
                    if merge:
                        before = piece.column(len(fields) + 2)
                        _add_spans(hit, found.rows, piece.column(len(fields) + 1))
                    columns = [*piece.columns[: len(fields)], pa.array(np.diff(found.rows))]
                    columns += [_spans(hit, found.rows), _item_lists(items, before, len(piece))]
                    rows = pa.RecordBatch.from_arrays(columns, names=[*fields, *ADDED])
                    yield finish(rows) if finish else rows

        return run

    marked = None
    context = docs.sparkSession.sparkContext
    for shard, last in _shards(benchmark, item, item_text, shard_bytes):
        held = context.broadcast(shard)
        source = docs if marked is None else workspace.materialize(marked, "hits")
        end = finish if last else None
        run = passing(lambda held=held: build_matcher(held.value, window), marked is not None, end)
        marked = source.mapInArrow(run, docs.schema if end else schema)
    return marked


def _spans(hit: np.ndarray, rows: np.ndarray) -> pa.Array:
    """Maximal runs of hits of each row, by word numbers from 0 within the row."""
    own = words.owners(rows)
    first = hit.copy()
    first[1:] &= ~(hit[:-1] & (own[1:] == own[:-1]))
    last = hit.copy()
    last[:-1] &= ~(hit[1:] & (own[1:] == own[:-1]))
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    counts = np.searchsorted(starts, rows)
    base = rows[own[starts]] if len(starts) else starts
    flat = np.stack([starts - base, ends - base], 1).reshape(-1)
    return pa.ListArray.from_arrays(
        pa.array((2 * counts).astype(np.int32)), pa.array(flat.astype(np.int64))
    )


def _add_spans(hit: np.ndarray, rows: np.ndarray, spans: pa.Array) -> None:
    for row, flat in enumerate(spans.to_pylist()):
        for begin, end in zip(flat[::2], flat[1::2]):
            hit[rows[row] + begin : rows[row] + end] = True


def _item_lists(items: dict[int, set[str]], before: pa.Array | None, size: int) -> pa.Array:
    lists = before.to_pylist() if before is not None else [[] for _ in range(size)]
    for row, names in items.items():
        lists[row] = sorted(names.union(lists[row]), key=lambda name: (name is None, name))
    return pa.array(lists, pa.list_(pa.string()))


def hit_report(marked: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key``, counts of words, hits and items, a digest of the item ids, ``contaminated``.

    Null, the id of items without one, counts as an item and is left out of the digest.
    """
    rows = marked.select(marked[key].alias("key"), "_n_words", "_hits", "_items")

    def run(batches):
        for batch in batches:
            table = batch.to_pydict()
            hits = [sum(h[1::2]) - sum(h[::2]) for h in table["_hits"]]
            digests = [
                hashlib.sha256(",".join(n for n in names if n is not None).encode()).hexdigest()
                for names in table["_items"]
            ]
            columns = [
                batch.column(0),
                batch.column(1),
                pa.array(hits, pa.int64()),
                pa.array([len(names) for names in table["_items"]], pa.int64()),
                pa.array(digests),
                pa.array([n > 0 for n in hits]),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names_out)

    kind = rows.schema["key"].dataType.simpleString()
    names_out = ["key", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    report = rows.mapInArrow(
        run,
        f"key {kind}, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, "
        "contaminated boolean",
    )
    return report.withColumnRenamed("key", key)


def remove_hits(
    marked: DataFrame, text: str = "text", max_share: int = MAX_HIT_SHARE
) -> DataFrame:
    """Texts without the hit spans; rows whose hits exceed ``max_share`` percent go.

    A span reaches from its first to its last word, bytes between them included.  Rows
    without hits are unchanged, null texts included.
    """
    fields = [name for name in marked.columns if name not in ADDED]

    def run(batches):
        for batch in batches:
            for piece in words.pieces(batch, text):
                yield _without_hits(piece, fields, text, max_share)

    return marked.mapInArrow(run, marked.select(*fields).schema)


def remove_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shard_bytes: int = SHARD_BYTES,
    max_share: int = MAX_HIT_SHARE,
) -> DataFrame:
    """``mark_hits`` and ``remove_hits`` with one pass over the texts for each shard.

    All columns of ``docs`` come back, whatever their names.
    """
    fields = _places(docs.columns)
    own = fields[docs.columns.index(text)]

    def finish(piece):
        return _without_hits(piece, fields, own, max_share)

    plain = docs.toDF(*fields)
    cleaned = _streamed(plain, benchmark, own, item, item_text, window, shard_bytes, finish)
    return cleaned.toDF(*docs.columns)


def _without_hits(
    piece: pa.RecordBatch, fields: list[str], text: str, max_share: int
) -> pa.RecordBatch:
    """The marked rows that stay, without their hits."""
    at = piece.schema.get_field_index(text)
    column = piece.column(at)
    spans = piece.column(piece.schema.get_field_index("_hits"))
    if not spans.value_lengths().to_numpy(zero_copy_only=False).any():
        return piece.select(fields)
    data, offsets = words.buffers(column)
    found = words.find_runs(data, offsets, words.ALPHANUMERIC)
    raw = data.tobytes()
    texts, keep = [], []
    null = column.is_null().to_numpy(zero_copy_only=False)
    for row, flat in enumerate(spans.to_pylist()):
        first, count = found.rows[row], found.rows[row + 1] - found.rows[row]
        gone = sum(flat[1::2]) - sum(flat[::2])
        keep.append(100 * gone <= max_share * count)
        place, parts = int(offsets[row]), []
        for begin, end in zip(flat[::2], flat[1::2]):
            parts.append(raw[place : found.starts[first + begin]])
            place = int(found.ends[first + end - 1])
        parts.append(raw[place : offsets[row + 1]])
        texts.append(b"".join(parts))
    fresh = pa.array(texts, pa.binary(), mask=null).cast(column.type)
    cleaned = piece.set_column(at, piece.schema.field(at), fresh)
    return cleaned.select(fields).filter(pa.array(keep, pa.bool_()))
