"""Exact cosine top-k for one question or a whole table of them.

Scores are cosine + 1.0 in double precision, rounded to ``SCORE_DIGITS`` so that equal
vectors tie whatever block of a matrix product they were in; ties go to the smaller id.

Every pair is scored inside a matrix product and never becomes a row.  One side is held
in memory by all tasks, in blocks whose size is checked:

* few questions: they are the block, each task scans its part of the vectors and emits at
  most k rows per question;
* few vectors: they are the block, each task answers its own questions, nothing is shuffled;
* neither: both sides are cut into blocks of bounded size, and the pairs of blocks are the
  cells of a grid that Spark deals out to tasks, all in one stage and without the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope import workspace
from folioscope.functions.text import collapse_newlines, default_empty

DOC_LIMIT = 5
SCORE_DIGITS = 9
BLOCK_BYTES = 128 << 20
# Cells of a grid, while their blocks are not larger than a task may hold, nor small.
GRID_CELLS = 64
CELL_BYTES = 64 << 20
CELL_ROWS = 4096
# Ids of hits, some 50 MB, that are broadcast to the scan of the texts.
HIT_IDS = 1_000_000
# Scores held at once while a block is compared with a batch, so that they stay in a core's
# cache, and the questions that they are of.
TILE_CELLS = 1 << 19
TILE_ROWS = 1 << 10
# Vectors among which questions without a hit so far get their first floor.
SEED_VECTORS = 1 << 9
# Pairs scored again at once.
RESCORE_PAIRS = 1 << 16
# Tasks whose candidates are merged first, so that no merge sees one row set per task.
TASKS_PER_MERGE = 1024

_MARGIN = 10.0**-SCORE_DIGITS


class Vectors(NamedTuple):
    """Vectors as they are stored, one per row, with their lengths in double precision."""

    rows: np.ndarray
    norms: np.ndarray

    def screen(self, last: float, part: slice | np.ndarray = slice(None)) -> np.ndarray:
        """Unit vectors in single precision, with one more number behind them."""
        rows, norms = self.rows[part], self.norms[part, None]
        out = np.full((len(rows), rows.shape[1] + 1), last, np.float32)
        np.divide(rows, norms, out=out[:, :-1], casting="same_kind")
        return out


def usable_vectors(column, dims: int) -> tuple[np.ndarray, Vectors]:
    """The entries that have a direction in ``dims`` numbers, and their positions."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sized = pc.fill_null(pc.equal(pc.list_value_length(column), dims), False)
    positions = np.flatnonzero(sized.to_numpy(zero_copy_only=False))
    # Blocks are large: nothing is copied when all of it is usable.
    if len(positions) < len(column):
        column = column.filter(sized)
    rows = column.flatten().to_numpy(zero_copy_only=False).reshape(len(positions), dims)
    norms = np.sqrt(np.einsum("ij,ij->i", rows, rows, dtype=np.float64))
    good = np.isfinite(norms) & (norms > 0)
    if good.all():
        return positions, Vectors(rows, norms)
    return positions[good], Vectors(rows[good], norms[good])


class Best:
    """The k best vectors of each of n questions so far.

    Pairs are screened in single precision.  Whatever its rounding error could put among
    the k best is scored again in double precision, so the screening changes no result.
    """

    def __init__(self, n: int, k: int, n_ids: int):
        self.k = k
        self.scores = np.full((n, k), -np.inf)
        self.least = np.full(n, -np.inf)  # scores that a search before this one found k times
        self.ids = [np.zeros((n, k), dtype=np.int64) for _ in range(n_ids)]

    def _floor(self, held: slice | np.ndarray) -> np.ndarray:
        """What a pair must reach to count: the k-th best so far."""
        return np.maximum(self.scores[held, -1], self.least[held])

    def _offer(self, row: np.ndarray, scores: np.ndarray, ids: Sequence[np.ndarray]) -> None:
        """Merge scored pairs; ``row`` is the question of each."""
        worst = self.scores[row, -1]
        better = scores > worst
        better |= (scores == worst) & (ids[0] <= self.ids[0][row, -1])
        row, scores = row[better], scores[better]
        if not len(row):
            return
        held, group = np.unique(row, return_inverse=True)
        groups = np.concatenate([np.repeat(np.arange(len(held)), self.k), group])
        scores = np.concatenate([self.scores[held].ravel(), scores])
        keys = [
            np.concatenate([old[held].ravel(), new[better]])
            for old, new in zip(self.ids, ids, strict=True)
        ]
        order = np.lexsort((*reversed(keys), -scores, groups))
        starts = np.searchsorted(groups[order], np.arange(len(held)))
        chosen = order[starts[:, None] + np.arange(self.k)]
        self.scores[held] = scores[chosen]
        for old, new in zip(self.ids, keys, strict=True):
            old[held] = new[chosen]

    def compare(self, questions: Vectors, vectors: Vectors, ids, among=None) -> None:
        """All questions, or those at the ascending places ``among``, against vectors with
        these ids.

        Questions carry what they must reach below zero as one more number and vectors a one,
        so a product says by its sign whether a pair counts.  Products are formed in tiles that
        stay in the cache.  A floor rises after each doubling of the vectors seen.
        """
        n = len(questions.norms) if among is None else len(among)
        m, dims = len(vectors.norms), questions.rows.shape[1]
        if not m or not n:
            return
        # Rounding of two unit vectors, of a floor, which is 1 at most, and of the sum of all.
        error = 2 * (dims + 8) * 2.0**-23 + _MARGIN
        wide = vectors.screen(1.0)
        step = min(n, TILE_ROWS)
        columns = min(m, max(1, TILE_CELLS // step))
        cells = np.empty(step * columns, np.float32)
        flags = np.zeros(-(-len(cells) // 8) * 8, bool)
        for first in range(0, n, step):
            held = slice(first, first + step) if among is None else among[first : first + step]
            asked = questions.screen(0.0, held)
            floor = self._floor(held)
            stop, seen = 0, m
            if np.isneginf(floor).any():
                seed = wide[: max(SEED_VECTORS, 2 * self.k)]
                seen = len(seed)
                if seen > self.k:
                    at = seen - self.k
                    best = np.partition(asked @ seed.T, at, axis=1)[:, at]
                    floor = np.maximum(floor, best + (1.0 - error))
            while stop < m:
                start, stop = stop, min(m, max(seen, 2 * stop))
                self._lift(asked, floor, error)
                pairs, n_pairs = [], 0
                for at in range(start, stop, columns):
                    row, column = _reached(asked, wide[at : min(at + columns, stop)], cells, flags)
                    pairs.append((row, column + at))
                    n_pairs += len(row)
                    if n_pairs >= RESCORE_PAIRS or at + columns >= stop:
                        own = first if among is None else held
                        self._rescore(questions, vectors, ids, pairs, own)
                        floor = np.maximum(floor, self._floor(held))
                        self._lift(asked, floor, error)
                        pairs, n_pairs = [], 0

    @staticmethod
    def _lift(asked: np.ndarray, floor: np.ndarray, error: float) -> None:
        """Take what pairs must reach, in cosines, from the products to come."""
        least = np.maximum(floor - 1.0 - error, -4.0).astype(np.float32)
        asked[:, -1] = -np.nextafter(least, np.float32(-np.inf))

    def _rescore(self, questions: Vectors, vectors: Vectors, ids, pairs: list, held) -> None:
        """Score pairs in double precision and merge them; ``held`` are the places of the
        questions or the first of them."""
        row, column = (np.concatenate(side) for side in zip(*pairs, strict=True))
        question = held + row if isinstance(held, int) else held[row]
        for at in range(0, len(question), RESCORE_PAIRS):
            q, c = question[at : at + RESCORE_PAIRS], column[at : at + RESCORE_PAIRS]
            dots = np.einsum("ij,ij->i", questions.rows[q], vectors.rows[c], dtype=np.float64)
            exact = dots / (questions.norms[q] * vectors.norms[c]) + 1.0
            self._offer(q, np.round(exact, SCORE_DIGITS), [i[c] for i in ids])

    def rows(self) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]:
        """Question positions, places from 1, ids and scores of all that was found."""
        question, place = np.nonzero(np.isfinite(self.scores))
        ids = [column[question, place] for column in self.ids]
        return question, place + 1, ids, self.scores[question, place]


def _reached(
    asked: np.ndarray, wide: np.ndarray, cells: np.ndarray, flags: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the products that are not below zero; ``cells`` and ``flags`` have
    room for a tile."""
    size = len(asked) * len(wide)
    np.matmul(asked, wide.T, out=cells[:size].reshape(len(asked), len(wide)))
    np.greater_equal(cells[:size], np.float32(0), out=flags[:size])
    used = -(-size // 8) * 8
    flags[size:used] = False
    # Eight flags are one number, and nearly all of these are zero.
    some = np.flatnonzero(flags[:used].view(np.uint64) != 0)
    near = (some[:, None] * 8 + np.arange(8)).ravel()
    return np.divmod(near[flags[near]], len(wide))


def _id_arrays(batch, n_ids: int, rows: np.ndarray) -> list[np.ndarray]:
    taken = batch.select(range(n_ids)).take(pa.array(rows))
    return [np.asarray(column.cast(pa.int64())) for column in taken.columns]


class _Shape:
    """Column names and types shared by the steps of one search."""

    def __init__(self, questions, vectors, k, qid, ids, vector, question_vector, dims):
        if k < 1:
            raise ValueError("k must be at least 1")
        for name in ids:
            if not isinstance(vectors.schema[name].dataType, T.IntegralType):
                raise TypeError(f"vector id {name} must be an integer")
        self.k, self.dims, self.qid, self.ids = k, dims, qid, list(ids)
        self.questions = questions.select(qid, F.col(question_vector).alias("_vector"))
        self.vectors = vectors.select(*ids, F.col(vector).alias("_vector"))
        self.id_fields = [T.StructField(i, T.LongType()) for i in ids]
        self.qid_field = T.StructField(qid, self.questions.schema[qid].dataType)
        self.score = T.StructField("score", T.DoubleType())

    def row_bytes(self) -> int:
        """What one row of a block occupies, with the k best of a question beside it."""
        kinds = [side.schema["_vector"].dataType for side in (self.questions, self.vectors)]
        number = 8 if any(kind != T.ArrayType(T.FloatType()) for kind in kinds) else 4
        return number * self.dims + 8 + 8 * self.k * (1 + len(self.ids))


def _scan_vectors(shape: _Shape, block) -> DataFrame:
    """Question block in memory, vectors streamed: at most k rows per question and task."""
    k, dims, n_ids = shape.k, shape.dims, len(shape.ids)
    schema = T.StructType(
        [T.StructField("_merge", T.IntegerType()), shape.qid_field, *shape.id_fields, shape.score]
    )
    names = schema.names

    def run(batches):
        qids, *parts = block.value
        questions = Vectors(*parts)
        best = Best(len(qids), k, n_ids)
        for batch in batches:
            positions, vectors = usable_vectors(batch.column(n_ids), dims)
            best.compare(questions, vectors, _id_arrays(batch, n_ids, positions))
        question, _, ids, scores = best.rows()
        merge = np.full(len(question), TaskContext.get().partitionId() // TASKS_PER_MERGE)
        columns = [pa.array(merge, pa.int32()), qids.take(pa.array(question))]
        columns += [pa.array(column, pa.int64()) for column in ids]
        columns.append(pa.array(scores, pa.float64()))
        whole = pa.RecordBatch.from_arrays(columns, names=names)
        for start in range(0, len(question), 1 << 16):
            yield whole.slice(start, 1 << 16)

    return shape.vectors.mapInArrow(run, schema)


def _scan_questions(shape: _Shape, block) -> DataFrame:
    """Vector block in memory, questions streamed: each task ranks its own questions."""
    k, dims, n_ids = shape.k, shape.dims, len(shape.ids)
    schema = T.StructType(
        [
            shape.qid_field,
            T.StructField("rank", T.IntegerType()),
            *shape.id_fields,
            shape.score,
        ]
    )
    names = schema.names

    def run(batches):
        ids, *parts = block.value
        vectors = Vectors(*parts)
        for batch in batches:
            positions, questions = usable_vectors(batch.column(1), dims)
            best = Best(len(positions), k, n_ids)
            best.compare(questions, vectors, ids)
            question, place, found, scores = best.rows()
            columns = [batch.column(0).take(pa.array(positions[question]))]
            columns.append(pa.array(place, pa.int32()))
            columns += [pa.array(column, pa.int64()) for column in found]
            columns.append(pa.array(scores, pa.float64()))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return shape.questions.mapInArrow(run, schema)


def _collect(rows: DataFrame, n_rows: int, limit: int) -> pa.Table | None:
    """A side of at most ``limit`` rows, None when it has more: rows move only if they fit."""
    return rows.toArrow() if n_rows <= limit else None


def _question_block(shape: _Shape, table: pa.Table):
    """Hand a block of questions to all executors, as plain arrays.

    Broadcasts are pickled by reference, and executors need not have this package.
    """
    positions, questions = usable_vectors(table.column(1), shape.dims)
    qids = table.column(0).combine_chunks().take(pa.array(positions))
    return shape.questions.sparkSession.sparkContext.broadcast((qids, *questions))


def _vector_block(shape: _Shape, table: pa.Table):
    """Hand a block of vectors to all executors."""
    positions, vectors = usable_vectors(table.column(len(shape.ids)), shape.dims)
    ids = _id_arrays(table.combine_chunks(), len(shape.ids), positions)
    return shape.vectors.sparkSession.sparkContext.broadcast((ids, *vectors))


def best_k(candidates: DataFrame, k: int, qid: str, ids: Sequence[str]) -> DataFrame:
    """The k best candidates of every question with their ``rank``.

    Both windows limit each group before their shuffle as well as after it.
    """
    order = [F.col("score").desc(), *(F.col(i) for i in ids)]
    if "_merge" in candidates.columns:
        part = Window.partitionBy(qid, "_merge").orderBy(*order)
        candidates = candidates.withColumn("rank", F.row_number().over(part))
        candidates = candidates.where(F.col("rank") <= k).drop("rank")
    whole = Window.partitionBy(qid).orderBy(*order)
    ranked = candidates.withColumn("rank", F.row_number().over(whole))
    return ranked.where(F.col("rank") <= k).select(qid, "rank", *ids, "score")


def _grid(shape: _Shape, n_questions: int, n_vectors: int, limit: int) -> DataFrame:
    """Both sides in blocks, and every pair of blocks a cell that one task compares.

    A question is sent to the cells of its row of the grid and a vector to those of its
    column.  Square cells move the fewest rows for what a task may hold, so both sides have
    blocks of the same size: a limit far below what a task can hold must not send every row
    to a number of cells that grows with the tables, and one far above must not leave cores
    idle.  Ids are unique, so their hashes deal blocks out evenly; blocks are planned a tenth
    smaller than the limit to leave room for the difference.
    """
    own = max(1, limit * 9 // 10)
    even = math.isqrt(n_questions * n_vectors // GRID_CELLS)
    room = min(max(own, CELL_BYTES // shape.row_bytes()), max(even, min(own, CELL_ROWS)))
    down, across = -(-n_questions // room), -(-n_vectors // room)
    k, dims, n_ids = shape.k, shape.dims, len(shape.ids)
    every = (F.sequence(F.lit(0), F.lit(n - 1)) for n in (across, down))
    row = F.pmod(F.xxhash64(shape.qid), F.lit(down)).cast("int")
    column = F.pmod(F.xxhash64(*shape.ids), F.lit(across)).cast("int")
    asked = shape.questions.select(
        row.alias("_row"), F.explode(next(every)).alias("_column"), shape.qid, "_vector"
    )
    held = shape.vectors.select(
        F.explode(next(every)).alias("_row"), column.alias("_column"), *shape.ids, "_vector"
    )
    merge = T.StructField("_merge", T.IntegerType())
    schema = T.StructType([merge, shape.qid_field, *shape.id_fields, shape.score])

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        positions, questions = usable_vectors(left.column(3), dims)
        found, vectors = usable_vectors(right.column(2 + n_ids), dims)
        best = Best(len(positions), k, n_ids)
        ids = [
            np.asarray(right.column(2 + i).combine_chunks().cast(pa.int64()))[found]
            for i in range(n_ids)
        ]
        best.compare(questions, vectors, ids)
        question, _, near, scores = best.rows()
        qids = left.column(2).combine_chunks().take(pa.array(positions[question]))
        # Cells of neighbouring columns are merged first; a block may be empty.
        group = right.column(1)[0].as_py() // TASKS_PER_MERGE if right.num_rows else 0
        columns = [pa.array(np.full(len(question), group), pa.int32()), qids]
        columns += [pa.array(i, pa.int64()) for i in near]
        return pa.Table.from_arrays([*columns, pa.array(scores)], names=schema.names)

    cell = ["_row", "_column"]
    pairs = asked.groupBy(*cell).cogroup(held.groupBy(*cell))
    return best_k(pairs.applyInArrow(compare, schema), k, shape.qid, shape.ids)


def topk_batch(
    questions: DataFrame,
    vectors: DataFrame,
    dims: int,
    k: int = DOC_LIMIT,
    qid: str = "qid",
    ids: Sequence[str] = ("vec_id",),
    vector: str = "embedding",
    question_vector: str = "embedding",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The k nearest vectors of every question: qid, rank, ids, score.

    ``qid`` must be unique among questions and ``ids`` among vectors.  Missing, zero and
    wrongly sized vectors neither ask nor answer.  A side may be read more than once, so
    hand in stored tables and not the plan that computes them.
    """
    shape = _Shape(questions, vectors, k, qid, ids, vector, question_vector, dims)
    limit = max(1, block_bytes // shape.row_bytes())
    n_questions = shape.questions.count()
    few = _collect(shape.questions, n_questions, limit)
    if few is not None:
        return best_k(_scan_vectors(shape, _question_block(shape, few)), k, qid, shape.ids)
    n_vectors = shape.vectors.count()
    few = _collect(shape.vectors, n_vectors, limit)
    if few is not None:
        return _scan_questions(shape, _vector_block(shape, few))
    return _grid(shape, n_questions, n_vectors, limit)


def topk_single(
    vectors: DataFrame,
    question: Sequence[float],
    k: int = DOC_LIMIT,
    ids: Sequence[str] = ("vec_id",),
    vector: str = "embedding",
) -> DataFrame:
    """The k vectors nearest to one question vector, best first: rank, ids, score."""
    spark = vectors.sparkSession
    asked = spark.createDataFrame(
        [(0, [float(x) for x in question])], "qid int, embedding array<double>"
    )
    shape = _Shape(asked, vectors, k, "qid", ids, vector, "embedding", len(question))
    found = _scan_vectors(shape, _question_block(shape, shape.questions.toArrow()))
    top = found.orderBy(F.col("score").desc(), *ids).limit(k)
    place = Window.orderBy(F.col("score").desc(), *ids)
    return top.select(F.row_number().over(place).alias("rank"), *ids, "score")


def hit_projection(
    hits: DataFrame, chunks: DataFrame, ids: Sequence[str] = ("vec_id",), content: str = "content"
) -> DataFrame:
    """Add the cleaned text of every hit; a hit without text gives ''.

    The hits are stored and their distinct ids counted: up to ``HIT_IDS`` of them are
    broadcast to the scan of the texts, and only texts that were hit travel to the join.
    Beyond that the join of ids and texts is left to Spark.
    """
    stored = workspace.materialize(hits, "hits")
    texts = chunks.select(*ids, F.col(content).alias("_text"))
    found = workspace.materialize(stored.select(*ids).distinct(), "hit-ids")
    if found.count() <= HIT_IDS:
        found = F.broadcast(found)
    wanted = texts.join(found, list(ids), "left_semi")
    joined = stored.join(wanted, list(ids), "left")
    cleaned = collapse_newlines(default_empty("_text"))
    return joined.select(*hits.columns, cleaned.alias("document"))


def no_hits(questions: DataFrame, hits: DataFrame, qid: str = "qid") -> DataFrame:
    """Questions with ``status``: ``found``, or ``no_documents`` for those not to answer."""
    found = hits.where(F.col("rank") == 1).select(qid, F.lit("found").alias("_found"))
    status = F.coalesce("_found", F.lit("no_documents"))
    return questions.join(found, qid, "left").withColumn("status", status).drop("_found")
