"""Exact Jaccard self-join of documents on word shingles, and the classes it forms.

Two sets with a Jaccard similarity of t share one of their first shingles under any common
order: those beyond the first ``n - ceil(t * n) + 1`` of a set of n are too few.  Sets that
share such a shingle form a tile.  The order is by hash, but shingles that many documents
have come last, which keeps tiles small; it decides how much is compared, never the result.

Only classes are wanted, so members of one class need not be compared.  A first round tests
all pairs of small tiles, and in larger ones each set with a leader and a neighbour; a
second tests neighbours that are still of different classes.  What the larger tiles then
still hold of different classes is cut into blocks of sets of like size and compared block
by block.  In all rounds hashed bitmaps bound the overlap from above, and the sorted arrays
of the pairs that pass decide.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope import workspace
from folioscope.llm import links, words

# Shingles that may be put last; 8 bytes each are sent to all tasks.
COMMON_SHINGLES = 50_000
# A shingle is reported as common from so many documents of a piece of text on.
COMMON_IN_PIECE = 3
COMMON_TOTAL = 32
# All pairs of a tile of so many sets are tested at once.
SMALL_TILE = 6
# So many members of a class that holds most of a larger tile are tested with each other set
# before whole tiles are compared.
NEIGHBOURS = 32
# Sets in a block of a larger tile.
BLOCK = 512
# Ids of documents whose sets are compared: up to here they go to all tasks (8 bytes each),
# beyond it the texts are joined by a shuffle.
BROADCAST_IDS = 500_000
MIN_BITS, MAX_BITS = 64, 1 << 15
# The label of all sets with a link where classes are not wanted; others have their own id.
LINKED = -(1 << 63)
# The least similarity that may be asked for; blocks whose sizes rule it out do not meet.
PERCENT_FLOOR = 50


def text_sets(column: pa.Array, shingle: int):
    """The sets of whole texts: shingles, where each set's begin, the row of each set."""
    data, offsets = words.buffers(column)
    found = words.find_runs(data, offsets, words.NOT_SPACE)
    hashes = words.run_hashes(data, found.starts, found.ends, words.LOWER)
    keys, places = links.row_sets(hashes, found.rows, shingle)
    return keys, places, np.arange(len(column))


def common_shingles(texts: DataFrame, shingle: int) -> np.ndarray:
    """Hashes of frequent shingles, sorted; counts come from all texts."""
    return _common(texts, lambda column: text_sets(column, shingle)[0])


def _common(rows: DataFrame, cut) -> np.ndarray:
    """The same for a column of texts or packed sets, whose shingles ``cut`` gives.

    A task reports the shingles that several documents of a piece of text have.
    """
    name = rows.columns[0]

    def run(batches):
        for batch in batches:
            for piece in words.pieces(batch, name):
                keys = np.sort(cut(piece.column(0)))
                heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else []
                counts = np.diff(np.append(heads, len(keys))).astype(np.int64)
                many = counts >= COMMON_IN_PIECE
                if many.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys[heads[many]].view(np.int64)), pa.array(counts[many])],
                        names=["key", "n"],
                    )

    counted = rows.mapInArrow(run, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))
    top = counted.where(F.col("n") >= COMMON_TOTAL).orderBy(F.desc("n"), "key")
    rows = top.limit(COMMON_SHINGLES).select("key").collect()
    return np.sort(np.array([r.key for r in rows], np.int64).view(np.uint64))


def prefixes(
    keys: np.ndarray, places: np.ndarray, common: np.ndarray, percent: int
) -> tuple[np.ndarray, np.ndarray]:
    """The first shingles of each set under the common order, and where each row's begin."""
    sizes = np.diff(places)
    own = np.repeat(np.arange(len(sizes)), sizes)
    last = np.isin(keys, common) if len(common) else np.zeros(len(keys), bool)
    order = np.lexsort((keys, last, own))
    length = np.where(sizes > 0, sizes - (percent * sizes + 99) // 100 + 1, 0)
    rank = np.arange(len(keys)) - np.repeat(places[:-1], sizes)
    chosen = order[rank < np.repeat(length, sizes)]
    return keys[chosen], np.concatenate([[0], np.cumsum(length)])


def keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``key``, ``other_key`` and ``text``: a row without a key is known by a hash of its text."""
    other = F.when(docs[key].isNull(), F.xxhash64(docs[text]))
    return docs.select(docs[key].alias("key"), other.alias("other_key"), docs[text].alias("text"))


def mark(docs: DataFrame, key: str, text: str, shingle: int, percent: int) -> DataFrame:
    """``key``, ``other_key``, ``set``, ``n`` and ``prefix`` of every document.

    A task gives the prefix of a set once, so copies are merged before anything is shuffled.
    """
    chosen = keyed(docs, key, text)
    common = common_shingles(chosen.select("text"), shingle)
    held = docs.sparkSession.sparkContext.broadcast(common)

    def run(batches):
        seen = np.empty(0, np.int64)
        for batch in batches:
            for piece in words.pieces(batch, "text"):
                keys, places, _ = text_sets(piece.column(2), shingle)
                ids = links.set_ids(keys, places)
                _, first = np.unique(ids, return_index=True)
                fresh = np.zeros(len(ids), bool)
                fresh[first] = True
                fresh &= ~np.isin(ids, seen)
                seen = np.union1d(seen, ids)
                front, begins = prefixes(keys, places, held.value, percent)
                lists = pa.ListArray.from_arrays(
                    pa.array(begins.astype(np.int32)), pa.array(front.view(np.int64))
                )
                none = pa.scalar(None, lists.type)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column(0),
                        piece.column(1),
                        pa.array(ids),
                        pa.array(np.diff(places).astype(np.int64)),
                        pa.compute.if_else(pa.array(fresh), lists, none),
                    ],
                    names=["key", "other_key", "set", "n", "prefix"],
                )

    kind = chosen.schema["key"].dataType.simpleString()
    schema = f"key {kind}, other_key bigint, set bigint, n bigint, prefix array<bigint>"
    marks = chosen.mapInArrow(run, schema)
    return workspace.materialize(marks, "marks")


def _heads(key: np.ndarray) -> np.ndarray:
    """For each row the index of the first row with its key; keys are sorted."""
    first = np.append(True, key[1:] != key[:-1])
    return np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))


def leaders(key: np.ndarray, n: np.ndarray, percent: int) -> np.ndarray:
    """For each row the first row of its key whose set is large enough to be similar.

    Rows are sorted by key and size.  Where the leader is too small, the first such row
    leads from there on.
    """
    lead = _heads(key)
    while True:
        small = 100 * n[lead] < percent * n
        if not small.any():
            return lead
        at = np.flatnonzero(small)
        group = lead[at]
        starts = np.append(True, group[1:] != group[:-1])
        lead[at] = at[np.maximum.accumulate(np.where(starts, np.arange(len(at)), 0))]


def share(marks: DataFrame, percent: int) -> DataFrame:
    """What sets that begin with one shingle give: pairs to test, and the entries of tiles.

    Rows with ``other`` are pairs (``set``, ``other``): all of a tile of up to ``SMALL_TILE``
    sets, else each set with its leader and with the set in front of it.  Rows without are
    the entries (``key``, ``n``, ``set``) of the larger tiles.
    """
    entries = marks.where("n > 0").select(F.explode("prefix").alias("key"), "n", "set")
    dealt = entries.repartition("key").sortWithinPartitions("key", "n", "set")
    columns = ["key", "n", "set"]

    def run(batches):
        for rows in words.runs(batches, columns):
            key, n, ids = (rows[c] for c in columns)
            fresh = np.append(True, (key[1:] != key[:-1]) | (ids[1:] != ids[:-1]))
            key, n, ids = key[fresh], n[fresh], ids[fresh]
            head = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            size = np.diff(np.append(head, len(key)))
            several = np.repeat(size > 1, size)
            large = np.repeat(size > SMALL_TILE, size)[several]
            key, n, ids = key[several], n[several], ids[several]
            found = []
            for step in range(1, SMALL_TILE):
                near = (key[step:] == key[:-step]) & (large[step:] <= (step == 1))
                at = np.flatnonzero(near)
                found.append((at, at + step))
            found.append((leaders(key, n, percent)[large], np.flatnonzero(large)))
            one, two = (np.concatenate([f[k] for f in found]) for k in range(2))
            fits = (100 * n[one] >= percent * n[two]) & (one != two)
            pairs = np.stack([ids[one[fits]], ids[two[fits]]], 1)
            pairs.sort(1)
            pairs = np.unique(pairs, axis=0)
            none = np.zeros(len(pairs), np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.append(none, key[large])),
                    pa.array(np.append(none, n[large])),
                    pa.array(np.append(pairs[:, 0], ids[large])),
                    pa.array(
                        np.append(pairs[:, 1], ids[large]),
                        mask=np.arange(len(pairs) + large.sum()) >= len(pairs),
                    ),
                ],
                names=[*columns, "other"],
            )

    schema = "key bigint, n bigint, set bigint, other bigint"
    return workspace.materialize(dealt.mapInArrow(run, schema), "shared")


def bitmap_bits(n: int) -> int:
    """Width of the bitmap of a set: the power of two at or above twice its size."""
    return min(max(MIN_BITS, 1 << (2 * n - 1).bit_length()), MAX_BITS)


def bitmap(members: np.ndarray) -> np.ndarray:
    """Parities of the numbers of members that fall on each bit, as 64-bit words."""
    bits = bitmap_bits(len(members))
    counts = np.bincount((members & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").view(np.uint64)


def fold(own: np.ndarray, width: int) -> np.ndarray:
    """A bitmap folded onto fewer words; parities of the shorter bitmap come out."""
    return np.bitwise_xor.reduce(own.reshape(-1, width), 0)


def may_be_similar(apart: np.ndarray, both: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of ``both`` members together can be similar if ``apart`` bits differ.

    Every differing bit stands for a member that only one of the sets has.
    """
    most = (both - apart) // 2  # the overlap is at most this
    return 100 * most >= percent * (both - most)


def set_holders(marks: DataFrame, asked: DataFrame) -> DataFrame:
    """The sets of several rows and those of ``asked``: the smallest ``key``, or the smallest
    ``other_key`` where no row with a key has the set, how many rows have it (``size``), ``n``.

    Rows of one set shrink to one per task before they are shuffled.
    """
    least = marks.where("n > 0").groupBy("set").agg(
        F.min("key").alias("key"),
        F.min("other_key").alias("other"),
        F.count(F.lit(1)).alias("size"),
        F.max("n").alias("n"),
    )
    other = F.when(F.col("key").isNull(), F.col("other"))
    wanted = asked.select("set").distinct().withColumn("asked", F.lit(True))
    kept = least.join(wanted, "set", "left").where("size > 1 OR asked")
    return workspace.materialize(
        kept.select("set", "key", other.alias("other_key"), "size", "n"), "set-holders"
    )


class Texts:
    """Finds sets again in the texts that they came from.

    ``cut`` gives for a string column the shingles of its sets, where each set's begin, and
    the row of each set.
    """

    def __init__(self, docs: DataFrame, key: str, text: str, cut) -> None:
        self.chosen = keyed(docs, key, text)
        self.cut = cut

    def fetch(self, wanted: DataFrame, holders: DataFrame, column: str, pack) -> DataFrame:
        """``set`` and ``column`` of the wanted sets; ``pack`` makes binary values of sets."""
        holder = (
            holders.join(wanted.select("set").distinct(), "set", "left_semi")
            .groupBy(F.col("key").alias("_key"), F.col("other_key").alias("_other"))
            .agg(F.collect_list("set").alias("sets"))
        )
        holder = workspace.materialize(holder, "holders")
        size = holder.agg(F.coalesce(F.sum(F.size("sets")), F.lit(0)).alias("n")).first().n
        if size <= BROADCAST_IDS:
            holder = F.broadcast(holder)
        cut = self.cut

        def run(batches):
            for batch in batches:
                for piece in words.pieces(batch, "text"):
                    keys, places, owner = cut(piece.column(0))
                    ids = links.set_ids(keys, places)
                    lists = piece.column(1)
                    own = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
                    asked = _pair_key(lists.flatten().to_numpy(zero_copy_only=False), own)
                    right = np.isin(_pair_key(ids, owner), asked)
                    sizes = np.diff(places)
                    inside = np.concatenate([[0], np.cumsum(sizes[right])])
                    packed = pack(keys[np.repeat(right, sizes)], inside)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[right]), packed], names=["set", column]
                    )

        chosen = self.chosen
        same = chosen["key"].eqNullSafe(holder["_key"])
        same &= chosen["other_key"].eqNullSafe(holder["_other"])
        texts = chosen.join(holder, same).select("text", "sets")
        found = texts.mapInArrow(run, f"set bigint, {column} binary")
        return workspace.materialize(found.dropDuplicates(["set"]), column)


def _pair_key(ids: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return words.mix(words.mix(ids.view(np.uint64)) + rows.astype(np.uint64))


def _bitmaps(keys: np.ndarray, places: np.ndarray) -> pa.Array:
    maps = [bitmap(keys[a:b]).tobytes() if b > a else b"" for a, b in zip(places, places[1:])]
    return pa.array(maps, pa.binary())


def bounded(pairs: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) that their bitmaps allow; ``sizes`` has set, n and bits."""
    one = sizes.select(F.col("set").alias("a"), F.col("n").alias("n"), F.col("bits").alias("x"))
    two = sizes.select(F.col("set").alias("b"), F.col("n").alias("m"), F.col("bits").alias("y"))
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "n", "m", "x", "y")

    def run(batches):
        for batch in batches:
            apart = []
            for x, y in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                width = min(len(x), len(y))
                apart.append(int(np.bitwise_count(fold(x, width) ^ fold(y, width)).sum()))
            n, m = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            keep = may_be_similar(np.array(apart, np.int64), n + m, percent)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return both.mapInArrow(run, "a bigint, b bigint")


def _mixed(batches, columns):
    """The tiles that hold several classes, one after the other."""
    for rows in words.runs(batches, columns):
        key, label = rows["key"], rows["label"]
        head = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        low = np.minimum.reduceat(label, head)
        high = np.maximum.reduceat(label, head)
        ends = np.append(head[1:], len(key))
        for begin, end in zip(head[low != high], ends[low != high]):
            yield {c: rows[c][begin:end] for c in columns}


def neighbours(entries: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs of sets of different classes that stand near each other in tiles.

    Each set meets the next one of its tile.  Where one class holds most of a tile, every
    other set meets ``NEIGHBOURS`` members of that class of like size, others in each tile;
    so a set that belongs to the class soon meets one that it is similar to.
    """
    columns = ["key", "n", "set", "label"]
    steps = np.arange(NEIGHBOURS, dtype=np.uint64)
    dealt = entries.repartition("key").sortWithinPartitions("key", "n", "set")

    def run(batches):
        for tile in _mixed(batches, columns):
            ids, label = tile["set"], tile["label"]
            at = np.flatnonzero(label[1:] != label[:-1])
            found = [np.stack([ids[at], ids[at + 1]], 1)]
            middle = np.sort(label)[len(label) // 2]  # the label of a majority, if there is one
            inside, outside = np.flatnonzero(label == middle), np.flatnonzero(label != middle)
            if len(inside) > len(outside):
                n, own = tile["n"][inside], tile["n"][outside]
                low = np.searchsorted(n, -(-percent * own // 100), "left")[:, None]
                high = np.searchsorted(n, 100 * own // percent, "right")[:, None]
                draw = words.mix(tile["key"][:1].view(np.uint64) + steps) >> np.uint64(11)
                draw = draw[None, :] % np.maximum(high - low, 1).astype(np.uint64)
                near = inside[np.minimum(low + draw.astype(np.int64), len(inside) - 1)]
                pairs = np.stack([np.broadcast_to(outside[:, None], near.shape), near], 2)
                found.append(ids[pairs.reshape(-1, 2)])
            pairs = np.unique(np.sort(np.concatenate(found), 1), axis=0)
            arrays = [pa.array(np.ascontiguousarray(pairs[:, k])) for k in range(2)]
            yield pa.RecordBatch.from_arrays(arrays, names=["a", "b"])

    return dealt.mapInArrow(run, "a bigint, b bigint").distinct()


def _cells(entries: DataFrame) -> DataFrame:
    """Blocks of the tiles that hold several classes, paired where sizes allow similarity.

    A tile's rows are in order of size.  Rows of block i and of block j meet in one cell;
    a cell holds two blocks at most, and the cells of a large tile go to many tasks.
    """
    columns = ["key", "n", "set", "label"]
    dealt = entries.repartition("key").sortWithinPartitions("key", "n", "set")

    def pair_blocks(tile):
        n = tile["n"]
        blocks = -(-len(n) // BLOCK)
        for i in range(blocks):
            for j in range(i, blocks):
                if 100 * n[min((i + 1) * BLOCK, len(n)) - 1] < PERCENT_FLOOR * n[j * BLOCK]:
                    break
                cell = words.mix(tile["key"][:1].view(np.uint64) + np.uint64((i << 32) + j))
                for side, block in enumerate({i: 0, j: 1}):
                    part = slice(block * BLOCK, (block + 1) * BLOCK)
                    size = len(n[part])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.repeat(cell.view(np.int64), size)),
                            pa.array(np.full(size, side, np.int64)),
                            *(pa.array(tile[c][part]) for c in ("n", "set", "label")),
                        ],
                        names=["cell", "side", "n", "set", "label"],
                    )

    def run(batches):
        for tile in _mixed(batches, columns):
            yield from pair_blocks(tile)

    return dealt.mapInArrow(run, "cell bigint, side bigint, n bigint, set bigint, label bigint")


def candidates(n, label, side, maps: list[np.ndarray], percent: int) -> np.ndarray:
    """Index pairs of a cell whose classes differ and whose bitmaps allow similarity.

    Similar sets differ in size by less than a factor of two, so their bitmaps are of one
    width or the larger one's is folded once.
    """
    widths = np.array([len(m) for m in maps])
    second = side == 1 if side.any() else np.ones(len(n), bool)
    found = [np.empty((0, 2), np.int64)]
    for width in np.unique(widths):
        near = np.flatnonzero((widths >= width) & (widths <= 2 * width))
        folded = np.stack([fold(maps[i], width) for i in near])
        for place, at in enumerate(near):
            if widths[at] != width or side[at] == 1:
                continue
            fits = second[near] & (label[near] != label[at]) & (near > at)
            fits &= 100 * np.minimum(n[near], n[at]) >= percent * np.maximum(n[near], n[at])
            rest = np.flatnonzero(fits)
            if len(rest):
                apart = np.bitwise_count(folded[rest] ^ folded[place]).sum(1, dtype=np.int64)
                rest = near[rest[may_be_similar(apart, n[near[rest]] + n[at], percent)]]
                found.append(np.stack([np.full(len(rest), at), rest], 1))
    return np.concatenate(found)


def compare_cells(cells: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (``a``, ``b``) that the bitmaps of a cell leave over."""
    columns = ["cell", "side", "n", "set", "label", "bits"]
    carried = cells.join(bits, "set").select(*columns)
    dealt = carried.repartition("cell").sortWithinPartitions("cell", "side", "n", "set")

    def flush(rows):
        side, n, ids, label = (np.array([r[k] for r in rows], np.int64) for k in (1, 2, 3, 4))
        maps = [np.frombuffer(r[5], np.uint64) for r in rows]
        pairs = np.sort(ids[candidates(n, label, side, maps, percent)], 1)
        columns = [pa.array(np.ascontiguousarray(pairs[:, k])) for k in range(2)]
        return pa.RecordBatch.from_arrays(columns, names=["a", "b"])

    def run(batches):
        rows = []
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if rows and rows[-1][0] != row[0]:
                    yield flush(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield flush(rows)

    return dealt.mapInArrow(run, "a bigint, b bigint").distinct()


def link_sets(marks: DataFrame, texts: Texts, percent: int) -> tuple[DataFrame, DataFrame]:
    """``node`` and ``label`` of the sets that are similar to another one, and the holders of
    these and of all sets of several rows.

    ``marks`` has ``key``, ``other_key``, ``set``, ``n`` and ``prefix``, the keys under which
    sets meet.
    """
    shared = share(marks, percent)
    pairs = shared.where("other is not null").select(
        F.col("set").alias("a"), F.col("other").alias("b")
    )
    pairs = workspace.materialize(pairs.distinct(), "pairs")
    tiles = shared.where("other is null").select("key", "n", "set")
    met = pairs.select(F.col("a").alias("set")).union(pairs.select("b"))
    holders = set_holders(marks, met.union(tiles.select("set")))
    bits = texts.fetch(met.union(tiles.select("set")), holders, "bits", _bitmaps)

    def verify(some: DataFrame) -> DataFrame:
        some = workspace.materialize(some, "pairs")
        sets = some.select(F.col("a").alias("set")).union(some.select("b"))
        members = texts.fetch(sets, holders, "members", links.blobs)
        return workspace.materialize(links.verified(some, members, percent), "links")

    sizes = holders.select("set", "n").join(bits, "set")
    edges = verify(bounded(pairs, sizes, percent))
    labels = links.components(edges)

    def classed() -> DataFrame:
        """The entries of large tiles with the class of their set."""
        known = labels.withColumnRenamed("node", "set")
        return tiles.join(known, "set", "left").select(
            "key", "n", "set", F.coalesce("label", "set").alias("label")
        )

    near = verify(bounded(neighbours(classed(), percent), sizes, percent))
    if near.limit(1).count():
        edges = edges.union(near)
        labels = links.components(edges)
    rest = verify(compare_cells(_cells(classed()), bits, percent))
    if rest.limit(1).count():
        labels = links.components(edges.union(rest))
    return labels, holders


def _unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of packed sets, and where each set's begin."""
    data, offsets = words.buffers(column)
    return data.view(np.uint64), offsets // 8


def _mark_sets(sets: DataFrame, percent: int) -> DataFrame:
    """``set``, ``n``, ``prefix`` and ``bits`` of sets that are given with their ``members``."""
    held = sets.sparkSession.sparkContext.broadcast(
        _common(sets.select("members"), lambda column: _unpacked(column)[0])
    )

    def run(batches):
        for batch in batches:
            for piece in words.pieces(batch, "members"):
                keys, places = _unpacked(piece.column(1))
                front, begins = prefixes(keys, places, held.value, percent)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column(0),
                        pa.array(np.diff(places)),
                        pa.ListArray.from_arrays(
                            pa.array(begins.astype(np.int32)), pa.array(front.view(np.int64))
                        ),
                        _bitmaps(keys, places),
                    ],
                    names=["set", "n", "prefix", "bits"],
                )

    schema = "set bigint, n bigint, prefix array<bigint>, bits binary"
    return workspace.materialize(sets.select("set", "members").mapInArrow(run, schema), "marks")


def linked_sets(sets: DataFrame, percent: int = links.PERCENT) -> DataFrame:
    """``set`` of the sets that are similar to another one or that several rows have.

    ``sets`` is a stored table of ``set`` (each once), ``members`` and ``size``, the number of
    rows that have it.  Classes are not wanted: once a set has a link, only sets without one
    are compared with it, and no components are formed.
    """
    marks = _mark_sets(sets, percent)
    shared = share(marks, percent)
    tiles = shared.where("other is null").select("key", "n", "set")
    pairs = shared.where("other is not null").select(
        F.col("set").alias("a"), F.col("other").alias("b")
    )
    sizes = marks.select("set", "n", "bits")

    def grown(linked: DataFrame, pairs: DataFrame) -> DataFrame:
        near = links.verified(pairs, sets, percent).select(F.explode(F.array("a", "b")).alias("set"))
        return workspace.materialize(linked.union(near).distinct(), "linked")

    linked = sets.where("size > 1").select("set")
    linked = grown(linked, bounded(pairs.distinct(), sizes, percent))
    for compare in (
        lambda left: bounded(neighbours(left, percent), sizes, percent),
        lambda left: compare_cells(_cells(left), sizes.select("set", "bits"), percent),
    ):
        known = linked.withColumn("label", F.lit(LINKED))
        left = tiles.join(known, "set", "left").select(
            "key", "n", "set", F.coalesce("label", "set").alias("label")
        )
        if not left.where(F.col("label") != LINKED).limit(1).count():
            break
        linked = grown(linked, compare(left))
    return linked


def jaccard_classes(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = links.SHINGLE_WORDS,
    percent: int = links.PERCENT,
) -> DataFrame:
    """``key``, ``n_shingles`` and ``component_id`` of every row.

    Words are runs without ASCII white space, A-Z in lower case.  Two documents link when
    100 * intersection >= ``percent`` * union of their shingle sets (``percent`` of 50 or
    more); ``component_id`` is the smallest key reachable by links.  Null and texts without
    words are empty and linked with nothing.  Repeated rows stay; a row with a null key links
    like any other, but null is never the smallest key, and a class of null keys only has
    none.  Other columns are ignored.
    """
    if not PERCENT_FLOOR <= percent <= 100:
        raise ValueError(f"percent must lie between {PERCENT_FLOOR} and 100")
    classes = _classes(docs, key, text, shingle, percent)
    return classes.select(
        F.col("key").alias(key),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("lowest.key")).otherwise(F.col("key")).alias("component_id"),
    )


def _classes(docs: DataFrame, key: str, text: str, shingle: int, percent: int) -> DataFrame:
    """``key``, ``other_key``, ``n`` and, of rows with a set, ``lowest``: the smallest key of
    the class, or the smallest hash of its texts if all rows of the class lack a key."""
    marks = mark(docs, key, text, shingle, percent)
    texts = Texts(docs, key, text, lambda column: text_sets(column, shingle))
    labels, every = link_sets(marks, texts, percent)
    place = F.struct(F.col("key").isNull().alias("none"), "key", "other_key")
    holders = every.select("set", place.alias("own"))
    classes = labels.join(holders, labels["node"] == holders["set"]).select("node", "label", "own")
    lowest = classes.groupBy("label").agg(F.min("own").alias("lowest"))
    reach = classes.join(lowest, "label").select(F.col("node").alias("set"), "lowest")
    named_sets = holders.join(reach, "set", "left").select(
        "set", F.coalesce("lowest", "own").alias("lowest")
    )
    # A set of one row that is like no other has no holder: the row is its own class.
    return marks.join(named_sets, "set", "left").select(
        "key", "other_key", "n", F.coalesce("lowest", place).alias("lowest")
    )


def keep_one(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = links.SHINGLE_WORDS,
    percent: int = links.PERCENT,
) -> DataFrame:
    """The rows whose key is the smallest of their class, with all columns unchanged.

    Keys are expected to be unique; rows that share one stay or go together.  Rows with a
    null key stay only where their class has no key, and of those only rows with one text.
    Null and empty texts stay.  An empty table gives an empty result.
    """
    classes = _classes(docs, key, text, shingle, percent)
    first = F.expr("lowest.key <=> key AND lowest.other_key <=> other_key")
    gone = classes.where(F.col("n") > 0).where(~first).select("key", "other_key").distinct()
    gone = workspace.materialize(gone, "gone")
    other = F.when(docs[key].isNull(), F.xxhash64(docs[text]))
    same = docs[key].eqNullSafe(gone["key"]) & other.eqNullSafe(gone["other_key"])
    return docs.join(gone, same, "left_anti")
