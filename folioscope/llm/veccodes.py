"""Vector codes: a product quantiser whose nearest entries are found in memoised grid cells.

A vector of integers is cut into parts, and each part gets the index of the nearest entry of
its position's codebook.  A part's coarse grid cell is hashed; for every cell met, a cache
holds the entries that some point of the cell's box could have as its nearest one.  An entry
is left out only if its least distance to the box is above another entry's greatest distance
to it, so the exact evaluation of those left finds what a full search finds, ties included.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope import workspace

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
# Width of a grid cell, in units of a scaled component.
CELL = 16
# Cells a task remembers at once; beyond that it forgets all and goes on.
CELLS_HELD = 300_000
# Rows evaluated at once.
BLOCK = 4096
# Scaled components must be smaller, so that squared distances fit 64 bits.
LARGEST = 1 << 27
# Labels whose sums are broadcast; more are joined.
LABELS_BROADCAST = 1_000_000
# Copies of the sums a label gets in that join, so that a hot one meets many tasks.
SALTS = 32


def usable(vector: Column) -> Column:
    """True for vectors that are not null and hold finite numbers only."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite, F.lit(False))


def scaled(column: pa.Array) -> np.ndarray:
    """The vectors of a list column as rows of integers, ``floor(SCALE * x)``."""
    if not len(column):
        return np.empty((0, 0), np.int64)
    flat = np.asarray(column.flatten(), np.float64)
    lengths = np.asarray(pa.compute.list_value_length(column))
    if lengths.min() != lengths.max():
        raise ValueError(f"vectors of {lengths.min()} and {lengths.max()} components")
    out = np.floor(flat * SCALE)
    if len(out) and np.abs(out).max() >= LARGEST:
        raise ValueError(f"components must be below {LARGEST // SCALE}")
    return out.astype(np.int64).reshape(len(column), -1)


class Grid:
    """Nearest entries of one codebook set, ``books[part, entry, position]``."""

    def __init__(self, books: np.ndarray, cell: int = CELL, held: int = CELLS_HELD):
        self.books, self.cell, self.held = books, cell, held
        self.met = self.evaluated = 0
        self._forget()

    def _forget(self) -> None:
        self._known: list[dict[bytes, int]] = [{} for _ in self.books]
        self._starts: list[list[int]] = [[] for _ in self.books]
        self._counts: list[list[int]] = [[] for _ in self.books]
        self._entries: list[list[np.ndarray]] = [[] for _ in self.books]
        self._size = [0] * len(self.books)

    def _learn(self, part: int, cells: np.ndarray) -> None:
        """Cache the entries that are not dominated across the boxes of new cells."""
        book = self.books[part]
        for at in range(0, len(cells), BLOCK):
            low = (cells[at : at + BLOCK] * self.cell)[:, None, :]
            high = low + (self.cell - 1)
            below, above = low - book[None], book[None] - high
            least = np.square(np.maximum(np.maximum(below, above), 0)).sum(2)
            most = np.square(np.maximum(np.abs(below), np.abs(above))).sum(2)
            rows, entries = np.nonzero(least <= most.min(1)[:, None])
            counts = np.bincount(rows, minlength=len(low))
            starts = np.cumsum(counts) - counts + self._size[part]
            self._starts[part].extend(starts.tolist())
            self._counts[part].extend(counts.tolist())
            self._entries[part].append(entries)
            self._size[part] += len(entries)

    def _nearest(self, part: int, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cells, cell_of = np.unique(values // self.cell, axis=0, return_inverse=True)
        known = self._known[part]
        keys = [row.tobytes() for row in cells]
        new = [i for i, key in enumerate(keys) if key not in known]
        self._learn(part, cells[new])
        for i in new:
            known[keys[i]] = len(known)
        slots = np.fromiter((known[key] for key in keys), np.int64, len(keys))[cell_of.ravel()]
        if len(self._entries[part]) > 1:
            self._entries[part] = [np.concatenate(self._entries[part])]
        counts = np.asarray(self._counts[part])[slots]
        starts = np.asarray(self._starts[part])[slots]
        # One row per part and candidate, candidates of a part side by side.
        first = np.cumsum(counts) - counts
        owner = np.repeat(np.arange(len(values)), counts)
        place = np.arange(counts.sum()) - np.repeat(first - starts, counts)
        entry = self._entries[part][0][place]
        distance = np.square(values[owner] - self.books[part][entry]).sum(1)
        self.met += len(values) * len(self.books[part])
        self.evaluated += len(entry)
        least = np.minimum.reduceat(distance, first)
        # Candidates ascend, so the first with the least distance has the lowest index.
        hit = np.nonzero(distance == least[owner])[0]
        _, at = np.unique(owner[hit], return_index=True)
        return entry[hit[at]], least

    def codes(self, vectors: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        """Blocks of rows with the codes and the squared distances of all their parts."""
        parts, _, width = self.books.shape
        for at in range(0, len(vectors), BLOCK):
            rows = slice(at, min(at + BLOCK, len(vectors)))
            block = vectors[rows].reshape(-1, parts, width)
            pairs = [self._nearest(p, block[:, p]) for p in range(parts)]
            if sum(map(len, self._known)) > self.held:
                self._forget()
            yield rows, np.stack([c for c, _ in pairs], 1), np.stack([d for _, d in pairs], 1)


def first_books(vectors: DataFrame, parts: int, entries: int) -> np.ndarray | None:
    """The parts of the vectors with the smallest ids, ``entries`` at most; ties go by vector,
    null ids come last."""
    order = [F.col("id").asc_nulls_last(), F.col("vector")]
    rows = vectors.orderBy(*order).limit(entries).select("vector").toArrow()
    if not rows.num_rows:
        return None
    chosen = scaled(rows.column(0).combine_chunks())
    if chosen.shape[1] % parts:
        raise ValueError(f"{chosen.shape[1]} components cannot be cut into {parts} parts")
    return chosen.reshape(len(chosen), parts, -1).transpose(1, 0, 2).copy()


def next_books(vectors: DataFrame, books: np.ndarray, cell: int = CELL) -> np.ndarray:
    """Every entry replaced by the floored mean of its parts; unused ones stay.

    Each task sums its own rows; what is shuffled and fetched has the size of the codebooks.
    """
    parts, entries, width = books.shape

    def sums(batches):
        grid = Grid(books, cell)
        total = np.zeros(books.shape, np.int64)
        count = np.zeros((parts, entries), np.int64)
        for batch in batches:
            values = scaled(batch.column(0))
            for rows, codes, _ in grid.codes(values):
                block = values[rows].reshape(-1, parts, width)
                for p in range(parts):
                    np.add.at(total[p], codes[:, p], block[:, p])
                    count[p] += np.bincount(codes[:, p], minlength=entries)
        part, entry = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(part * entries + entry, width)),
                pa.array(np.tile(np.arange(width), len(part))),
                pa.array(total[part, entry].ravel()),
                pa.array(np.repeat(count[part, entry], width)),
            ],
            names=["entry", "position", "total", "n"],
        )

    partial = vectors.select("vector").mapInArrow(
        sums, "entry bigint, position bigint, total bigint, n bigint"
    )
    means = (
        partial.groupBy("entry", "position")
        .agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        .selectExpr("entry", "position", "total", "n")
        .toArrow()
    )
    out = books.copy()
    entry, position, total, n = (np.asarray(means.column(i)) for i in range(4))
    out[entry // entries, entry % entries, position] = total // n
    return out


def books_digest(books: np.ndarray) -> str:
    """Of all components by part, entry and position, decimal, comma-joined."""
    text = ",".join(map(str, books.ravel().tolist()))
    return hashlib.sha256(text.encode()).hexdigest()


def _with_label_sums(coded: DataFrame) -> DataFrame:
    """``label_error``: the error summed over rows of one label, null being one of them."""
    sums = workspace.materialize(
        coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors"
    )
    sums = sums.withColumnRenamed("label", "of")
    if sums.count() <= LABELS_BROADCAST:
        return coded.join(F.broadcast(sums), coded["label"].eqNullSafe(sums["of"])).drop("of")
    salts = F.sequence(F.lit(0), F.lit(SALTS - 1))
    spread = sums.withColumn("salt2", F.explode(salts))
    salted = coded.withColumn("salt", F.pmod(F.xxhash64("id", "code"), F.lit(SALTS)).cast("int"))
    same = salted["label"].eqNullSafe(spread["of"]) & (salted["salt"] == spread["salt2"])
    return salted.join(spread, same).drop("of", "salt", "salt2")


def encode_vectors(
    table: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    cell: int = CELL,
) -> tuple[DataFrame, np.ndarray | None]:
    """Codes of all usable vectors, and the final codebooks (none for an empty table).

    The codes have ``vec_id``, ``code`` (two hex digits per part), ``error`` (squared distance
    to the chosen entries) and ``label_error``.  Vectors that are null or hold a null or a
    number that is not finite are left out.  Rows that repeat an id are all coded; with null
    ids they come last in the choice of the first codebooks.  Fewer vectors than entries make
    smaller codebooks.  All vectors must have one length, a multiple of ``parts``, and
    components below ``LARGEST / SCALE``; else the job fails.  Other columns are ignored.
    """
    chosen = table.select(
        table[vec_id].alias("id"), table[label].alias("label"), table[vector].alias("vector")
    ).where(usable(F.col("vector")) & (F.size("vector") > 0))
    books = first_books(chosen, parts, entries)
    if books is None:
        nothing = chosen.selectExpr(
            f"id AS `{vec_id}`", "'' AS code", "0L AS error", "0L AS label_error"
        )
        return nothing, None
    for _ in range(rounds):
        books = next_books(chosen, books, cell)
    final = books

    def encode(batches):
        grid = Grid(final, cell)
        digits = np.array([f"{i:02x}" for i in range(final.shape[1])])
        for batch in batches:
            codes, errors = [], []
            for _, code, distance in grid.codes(scaled(batch.column(2))):
                codes.extend("".join(row) for row in digits[code])
                errors.append(distance.sum(1))
            error = np.concatenate(errors) if errors else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(codes, pa.string()), pa.array(error)],
                names=["id", "label", "code", "error"],
            )

    schema = chosen.select("id", "label").schema
    schema = schema.add("code", T.StringType()).add("error", T.LongType())
    coded = workspace.materialize(chosen.mapInArrow(encode, schema), "vector-codes")
    out = _with_label_sums(coded).select(
        F.col("id").alias(vec_id), "code", "error", F.col("label_error").cast("bigint")
    )
    return out, books


def decode_vectors(codes: DataFrame, books: np.ndarray, code: str = "code") -> DataFrame:
    """``codes`` with ``approximation``, the chosen entries as one vector of components."""
    flat = [[int(v) for v in entry] for part in books for entry in part]
    table = F.lit([v for entry in flat for v in entry])
    entries, width = books.shape[1:]
    digit = "cast(conv(substring({c}, 2 * p + 1, 2), 16, 10) as int)".format(c=f"`{code}`")
    places = F.expr(
        f"flatten(transform(sequence(0, {books.shape[0] - 1}), p -> "
        f"transform(sequence(0, {width - 1}), i -> (p * {entries} + {digit}) * {width} + i)))"
    )
    values = F.transform(places, lambda at: (F.get(table, at) + F.lit(0.5)) / SCALE)
    return codes.withColumn("approximation", values)
