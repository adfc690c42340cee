"""Removal of long repeated byte strings, found with suffix arrays over shared anchors.

Every string of ``length`` bytes holds the smallest of its ``ANCHOR``-byte hashes, the same
one wherever the string stands.  Only suffixes that begin at such anchors are dealt out, by
their hash, so suffixes that can share a long prefix meet.  Around an anchor only the bytes
matter that a string of ``length`` through the anchor can reach: its context.

Equal contexts are one class and repeat each other wholly.  Where one anchor has several
contexts, they form an enhanced suffix array: sorted right parts with their common prefix
lengths.  A stack scan gives the tree of common-prefix intervals; for each interval the left
parts of its members are compared, and members whose common extension to the left and the
common prefix together reach ``length`` are a repeat group, reported with all occurrences.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope import workspace
from folioscope.llm import words

LENGTH = 200
ANCHOR = 64
# Texts are read in parts of so many bytes, with the overlap that contexts need.
PART_BYTES = 1 << 20
# Up to so many contexts of one anchor are compared in one task; the windows of more are
# dealt out one by one.
LARGE_GROUP = 256
STRIDE = 16

_WHOLE = (1 << 31) - 1


def anchors(data: np.ndarray, length: int, size: int = ANCHOR) -> np.ndarray:
    """Places of the smallest ``size``-byte hash of each ``length``-byte window; of equal
    hashes the last one."""
    if len(data) < length:
        return np.empty(0, np.int64)
    total = words.prefix_hash(data)
    begin = np.arange(len(data) - size + 1)
    mixed = words.slice_hash(total, begin, begin + size)
    place = np.uint64((1 << 24) - 1)
    packed = (mixed & ~place) | (place - begin.astype(np.uint64))
    width, reach = length - size + 1, 1
    low = packed
    while 2 * reach <= width:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    rest = width - reach
    if rest:
        low = np.minimum(low[:-rest], low[rest:])
    chosen = np.zeros(len(begin), bool)
    chosen[(place - (low & place)).astype(np.int64)] = True
    return np.flatnonzero(chosen)


def _parts(texts: pa.Array, length: int):
    """Row, first byte, bytes, and the range in which this part reports anchors."""
    data, offsets = words.buffers(texts)
    for row in range(len(offsets) - 1):
        low, high = int(offsets[row]), int(offsets[row + 1])
        if high - low < length:
            continue
        for begin in range(0, high - low, PART_BYTES):
            first = max(0, begin - 2 * length)
            last = min(high - low, begin + PART_BYTES + 2 * length)
            part = data[low + first : low + last]
            yield row, first, part, begin - first, min(begin + PART_BYTES, high - low) - first
            if begin + PART_BYTES >= high - low:
                break


def anchor_table(rows: DataFrame, length: int) -> DataFrame:
    """``anchor`` and ``context`` (hashes), ``row`` and ``place`` of the anchors, and what a
    piece of text covers by itself as rows with ``last``.

    A text that a task has met before gives none again: copies are covered whole.
    """
    back, ahead = length - ANCHOR, length

    def run(batches):
        seen: set[bytes] = set()
        for batch in batches:
            for piece in words.pieces(batch, "text"):
                ids = piece.column(0).to_numpy()
                found = []
                fresh = {}
                for row, first, part, low, high in _parts(piece.column(1), length):
                    if row not in fresh:
                        digest = hashlib.blake2b(piece.column(1)[row].as_py(), digest_size=16)
                        fresh[row] = digest.digest() not in seen
                        seen.add(digest.digest())
                    if not fresh[row]:
                        continue
                    at = anchors(part, length)
                    at = at[(at >= low) & (at < high)]
                    total = words.prefix_hash(part)
                    left = np.maximum(at - back, 0)
                    right = np.minimum(at + ahead, len(part))
                    around = words.slice_hash(total, left, right) + (at - left).astype(np.uint64)
                    key = words.slice_hash(total, at, at + ANCHOR)
                    found.append((key, words.mix(around), np.full(len(at), ids[row]), at + first))
                if found:
                    key, around, own, place = (
                        np.concatenate([f[k] for f in found]) for k in range(4)
                    )
                    yield _merged(key, around, own, place, back, ahead)

    binary = rows.select("row", F.col("text").cast("binary").alias("text"))
    return binary.mapInArrow(
        run, "anchor bigint, context bigint, row bigint, place bigint, last bigint"
    )


def _merged(key, around, own, place, back: int, ahead: int) -> pa.RecordBatch:
    """One place of each context of a piece, and what its repeated contexts cover.

    Contexts that repeat within the piece are covered whatever stands elsewhere; their
    places, many in texts with a short period, shrink to the spans that they cover.
    """
    many, later = words.repeated(words.mix(words.mix(key) + around))
    order = np.lexsort((place[many], own[many]))
    row, at = own[many][order], place[many][order]
    first, last = np.maximum(at - back, 0), at + ahead
    head = np.append(True, (row[1:] != row[:-1]) | (first[1:] > last[:-1]))[: len(row)]
    ends = np.append(np.flatnonzero(head)[1:], len(row)) - 1 if len(row) else np.empty(0, int)
    spans = row[head], first[head], last[ends]
    single = ~later
    none = np.zeros(int(single.sum()), np.int64)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.append(key[single], words.mix(spans[0].view(np.uint64))).view(np.int64)),
            pa.array(np.append(around[single], np.zeros(len(spans[0]), np.uint64)).view(np.int64)),
            pa.array(np.append(own[single], spans[0])),
            pa.array(np.append(place[single], spans[1]).astype(np.int64)),
            pa.array(np.append(none, spans[2]).astype(np.int64)),
        ],
        names=["anchor", "context", "row", "place", "last"],
    )


def meet(table: DataFrame, length: int) -> DataFrame:
    """What the anchors show: ``kind``, ``anchor``, ``row``, ``place``, ``last``.

    Kind 0 are spans, from ``place`` to ``last``, that repeat.  Kind 1 and 2 are one place of
    each context of an anchor with several of them, 2 where there are many.
    """
    columns = ["anchor", "context", "row", "place", "last"]
    dealt = table.repartition("anchor").sortWithinPartitions("anchor", "context")

    def run(batches):
        for rows in words.runs(batches, columns):
            done = rows["last"] > 0
            spans = {c: rows[c][done] for c in columns}
            rows = {c: rows[c][~done] for c in columns}
            key, context = rows["anchor"], rows["context"]
            head = np.append(True, key[1:] != key[:-1])[: len(key)]
            first = head | np.append(True, context[1:] != context[:-1])[: len(key)]
            alike = np.diff(np.append(np.flatnonzero(first), len(key)))
            several = np.repeat(alike > 1, alike)
            number = np.cumsum(head) - 1
            contexts = np.bincount(number, first).astype(np.int64)[number]
            probe = first & (contexts > 1)
            kind = np.where(contexts > LARGE_GROUP, 2, 1)[probe]
            place = rows["place"]
            parts = {
                "kind": [np.zeros(done.sum() + several.sum(), np.int64), kind],
                "anchor": [spans["anchor"], key[several], key[probe]],
                "row": [spans["row"], rows["row"][several], rows["row"][probe]],
                "place": [
                    spans["place"],
                    np.maximum(place[several] - (length - ANCHOR), 0),
                    place[probe],
                ],
                "last": [spans["last"], place[several] + length, np.zeros(len(kind), np.int64)],
            }
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(p)) for p in parts.values()], names=list(parts)
            )

    return dealt.mapInArrow(
        run, "kind bigint, anchor bigint, row bigint, place bigint, last bigint"
    )


def contexts(rows: DataFrame, probes: DataFrame, length: int) -> DataFrame:
    """The probes with ``before``, the number of bytes in front of the anchor, and ``bytes``."""
    lists = probes.groupBy("row").agg(
        F.collect_list(F.struct("kind", "anchor", "place")).alias("probes")
    )
    texts = rows.join(lists, "row").select(
        "row", F.col("text").cast("binary").alias("text"), "probes"
    )
    back = length - ANCHOR

    def run(batches):
        for batch in batches:
            for piece in words.pieces(batch, "text"):
                data, offsets = words.buffers(piece.column(1))
                lists = piece.column(2)
                flat = lists.flatten()
                kind, key, place = (flat.field(k).to_numpy() for k in range(3))
                counts = lists.value_lengths().to_numpy()
                own = np.repeat(np.arange(piece.num_rows), counts)
                left = np.maximum(place - back, 0)
                begin, end = offsets[own] + left, np.minimum(
                    offsets[own] + place + length, offsets[own + 1]
                )
                raw = data.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(kind),
                        pa.array(key),
                        pa.array(piece.column(0).to_numpy()[own]),
                        pa.array(place),
                        pa.array(place - left),
                        pa.array([raw[a:b] for a, b in zip(begin, end)], pa.binary()),
                    ],
                    names=["kind", "anchor", "row", "place", "before", "bytes"],
                )

    # A row that stands twice has its probes once.
    one = texts.dropDuplicates(["row"])
    return one.mapInArrow(
        run, "kind bigint, anchor bigint, row bigint, place bigint, before bigint, bytes binary"
    )


def common_prefixes(rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Common prefix length of each row of a byte matrix with the next, within both sizes."""
    differ = rows[1:] != rows[:-1]
    first = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
    return np.minimum(first, np.minimum(sizes[1:], sizes[:-1]))


def intervals(prefix: list[int]):
    """The tree of common-prefix intervals of a suffix array, from the leaves up.

    ``prefix[i]`` belongs to the suffixes i and i + 1; yields (length, first, last)."""
    stack: list[tuple[int, int]] = []  # length, first suffix
    for at, value in enumerate([*prefix, 0]):
        first = at
        while stack and stack[-1][0] > value:
            size, first = stack.pop()
            yield size, first, at
        if value and (not stack or stack[-1][0] < value):
            stack.append((value, first))


def repeat_groups(before: np.ndarray, raw: list[bytes], length: int):
    """Repeat groups among the contexts of one anchor: (bytes to the left, length, members).

    ``before`` counts the bytes in front of the anchor.  Members are indices into ``raw``.
    """
    count = len(raw)
    after = np.array([len(b) for b in raw]) - before
    right = np.zeros((count, length), np.uint8)
    left = np.zeros((count, length - ANCHOR), np.uint8)
    for i, own in enumerate(raw):
        cells = np.frombuffer(own, np.uint8)
        right[i, : after[i]] = cells[before[i] :]
        left[i, : before[i]] = cells[: before[i]][::-1]
    # Shorter first among equals: the end of a text is smaller than any byte.
    suffix = np.lexsort((after, *right.T[::-1]))
    prefix = common_prefixes(right[suffix], after[suffix])
    rank = np.empty(count, np.int64)
    backward = np.lexsort((before, *left.T[::-1]))
    rank[backward] = np.arange(count)
    for size, first, last in intervals(prefix.tolist()):
        if size < ANCHOR:
            continue
        members = suffix[first : last + 1]
        members = members[np.argsort(rank[members])]
        shared = common_prefixes(left[members], before[members])
        # Left-extension diversity: where neighbours agree on too little, groups end.
        far = np.flatnonzero(shared + size < length)
        edges = [0, *(far + 1).tolist(), len(members)]
        for low, high in zip(edges[:-1], edges[1:]):
            if high - low < 2:
                continue
            # All members of a longer match on the left are groups of their own.
            for reach, a, b in intervals(shared[low : high - 1].tolist()):
                if reach + size >= length:
                    yield reach, size, members[low + a : low + b + 1]
            if size >= length:
                yield 0, size, members[low:high]


def small_groups(probes: DataFrame, length: int) -> DataFrame:
    """``group``, ``row``, ``first`` and ``last`` (behind it) of all occurrences."""
    columns = ["anchor", "row", "place", "before", "bytes"]
    chosen = probes.where("kind = 1").select(*columns)
    dealt = chosen.repartition("anchor").sortWithinPartitions("anchor", "row", "place")

    def flush(held):
        place = np.array([h[2] for h in held], np.int64)
        owner = np.array([h[1] for h in held], np.int64)
        before = np.array([h[3] for h in held], np.int64)
        raw = [h[4] for h in held]
        out = []
        for left, size, members in repeat_groups(before, raw, length):
            own = raw[members[0]]
            text = own[before[members[0]] - left : before[members[0]] + size]
            name = int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "big", signed=True)
            out.append((name, owner[members], place[members] - left, place[members] + size))
        return out

    def run(batches):
        held = []
        for batch in batches:
            found = []
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if held and held[-1][0] != row[0]:
                    found.extend(flush(held))
                    held = []
                held.append(row)
            yield _groups(found)
        if held:
            yield _groups(flush(held))

    return dealt.mapInArrow(run, '`group` bigint, row bigint, `first` bigint, `last` bigint')


def _groups(found) -> pa.RecordBatch:
    names = [np.full(len(f[1]), f[0], np.int64) for f in found]
    columns = [names, *([f[k] for f in found] for k in (1, 2, 3))]
    arrays = [pa.array(np.concatenate([np.empty(0, np.int64), *c])) for c in columns]
    return pa.RecordBatch.from_arrays(arrays, names=["group", "row", "first", "last"])


def large_groups(probes: DataFrame, length: int) -> DataFrame:
    """The same for anchors with many contexts: their windows are dealt out by their bytes.

    ``STRIDE`` windows that begin next to each other share all bytes but the outer ones.
    Contexts meet by the hash of these shared bytes, so only those meet that repeat them,
    and then compare the hashes of the single windows.
    """
    chosen = probes.where("kind = 2").select("row", "place", "before", "bytes")
    windows = [f"w{j}" for j in range(STRIDE)]
    columns = ["group", "row", "place", *windows]
    shape = ", ".join(["`group` bigint, row bigint, place bigint", *(f"{w} bigint" for w in windows)])

    def split(batches):
        for batch in batches:
            found = []
            for row, place, before, own in zip(*(c.to_pylist() for c in batch.columns)):
                total = words.prefix_hash(np.frombuffer(own, np.uint8))
                # The windows of block b begin b * STRIDE to (b + 1) * STRIDE - 1 bytes
                # in front of the anchor.
                near = np.arange(0, before + 1, STRIDE)
                near = near[before - near - STRIDE + 1 + length <= len(own)]
                if not len(near):
                    continue
                core = words.slice_hash(total, before - near, before - near - STRIDE + 1 + length)
                begin = before - near[:, None] - np.arange(STRIDE)
                valid = (begin >= 0) & (begin + length <= len(own))
                safe = np.where(valid, begin, 0)
                hashes = words.slice_hash(total, safe, safe + length) | np.uint64(1)
                hashes[~valid] = 0
                name = words.mix(core + near.astype(np.uint64))
                found.append((name, np.full(len(near), row), place - near, hashes))
            if found:
                name, row, place, hashes = (np.concatenate([f[k] for f in found]) for k in range(4))
                arrays = [name.view(np.int64), row, place.astype(np.int64)]
                arrays += [np.ascontiguousarray(hashes[:, j]).view(np.int64) for j in range(STRIDE)]
                yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=columns)

    def pick(batches):
        for rows in words.runs(batches, columns):
            name, row, place = (rows[c] for c in columns[:3])
            fresh = np.append(True, (name[1:] != name[:-1]) | (row[1:] != row[:-1])
                              | (place[1:] != place[:-1]))
            name, row, place = name[fresh], row[fresh], place[fresh]
            first = np.full(len(name), _WHOLE, np.int64)
            last = np.zeros(len(name), np.int64)
            for j, window in enumerate(windows):
                own = rows[window][fresh].view(np.uint64)
                many, _ = words.repeated(words.mix(words.mix(name.view(np.uint64)) + own))
                many &= own != 0
                first[many] = np.minimum(first[many], place[many] - j)
                last[many] = np.maximum(last[many], place[many] - j + length)
            # Windows of one block overlap, so what repeats of them is one span.
            many = last > 0
            arrays = [name[many], row[many], first[many], last[many]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(a) for a in arrays], names=["group", "row", "first", "last"]
            )

    dealt = chosen.mapInArrow(split, shape).repartition("group")
    dealt = dealt.sortWithinPartitions("group", "row", "place")
    return dealt.mapInArrow(pick, "`group` bigint, row bigint, `first` bigint, `last` bigint")


def find_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH
) -> tuple[DataFrame, DataFrame]:
    """The texts by row id, and the places of strings of ``length`` bytes or more that stand
    elsewhere too: ``row``, ``first``, ``last``.

    The row id is a hash of key and text; rows equal in both are copies of each other, and so
    repeat all of their strings.  A null key is a key like any other.  Null texts are empty;
    texts shorter than ``length`` have no places.  An empty table gives empty tables.
    """
    rows = docs.select(
        docs[key].alias("key"),
        F.xxhash64(docs[key].cast("string"), F.length(text), docs[text]).alias("row"),
        F.coalesce(docs[text], F.lit("")).alias("text"),
    )
    found = workspace.materialize(meet(anchor_table(rows.select("row", "text"), length), length), "anchors")
    probes = contexts(rows.select("row", "text"), found.where("kind > 0"), length)
    probes = workspace.materialize(probes, "contexts")
    whole = rows.where(F.octet_length("text") >= length).select(
        "row", F.sha2("text", 256).alias("digest")
    )
    copied = whole.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    places = [
        found.where("kind = 0").select("row", F.col("place").alias("first"), "last"),
        small_groups(probes, length).select("row", "first", "last"),
        large_groups(probes, length).select("row", "first", "last"),
        whole.join(copied, "digest", "left_semi").select(
            "row", F.lit(0).cast("bigint").alias("first"), F.lit(_WHOLE).alias("last")
        ),
    ]
    spans = places[0]
    for more in places[1:]:
        spans = spans.unionByName(more)
    return rows, spans


def merge(first: np.ndarray, last: np.ndarray, size: int, length: int) -> list[tuple[int, int]]:
    """Maximal runs of the bytes that the spans of ``length`` or more cover."""
    last = np.minimum(last, size)
    keep = last - first >= length
    order = np.argsort(first[keep])
    first, last = first[keep][order], np.maximum.accumulate(last[keep][order])
    if not len(first):
        return []
    head = np.flatnonzero(np.append(True, first[1:] > last[:-1]))
    tail = np.append(head[1:], len(first)) - 1
    return list(zip(first[head].tolist(), last[tail].tolist()))


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH
) -> DataFrame:
    """``key``, ``n_bytes``, ``spans`` (pairs of first byte and the one behind the last,
    flattened) and ``kept``, the bytes that no repeated string covers, of every row.

    Texts are UTF-8 bytes, so ``kept`` may begin or end inside a character.  Null counts as
    an empty text.  Repeated rows repeat each other.  Matches within one text count, also
    overlapping ones.  Other columns are ignored.
    """
    rows, spans = find_repeats(docs, key, text, length)
    lists = spans.groupBy("row").agg(
        F.collect_list("first").alias("firsts"), F.collect_list("last").alias("lasts")
    )
    joined = rows.join(lists, "row", "left").select(
        "key", F.col("text").cast("binary").alias("text"), "firsts", "lasts"
    )

    def run(batches):
        for batch in batches:
            for piece in words.pieces(batch, "text"):
                out = []
                for own, firsts, lasts in zip(
                    piece.column(1).to_pylist(), piece.column(2), piece.column(3)
                ):
                    if not firsts.is_valid:
                        out.append(([], own))
                        continue
                    runs = merge(
                        firsts.values.to_numpy(), lasts.values.to_numpy(), len(own), length
                    )
                    edges = [0, *(e for r in runs for e in r), len(own)]
                    kept = b"".join(own[a:b] for a, b in zip(edges[::2], edges[1::2]))
                    out.append((edges[1:-1], kept))
                _, offsets = words.buffers(piece.column(1))
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column(0),
                        pa.array(np.diff(offsets)),
                        pa.array([spans for spans, _ in out], pa.list_(pa.int64())),
                        pa.array([kept for _, kept in out], pa.binary()),
                    ],
                    names=["key", "n_bytes", "spans", "kept"],
                )

    kind = joined.schema["key"].dataType.simpleString()
    cleaned = joined.mapInArrow(
        run, f"key {kind}, n_bytes bigint, spans array<bigint>, kept binary"
    )
    return cleaned.withColumnRenamed("key", key)


def digest(cleaned: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts and the SHA-256 of the bytes that are left."""
    return cleaned.select(
        key,
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.expr("cast(size(spans) / 2 AS bigint)").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
