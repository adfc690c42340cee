"""Exact top-k over an index that tells which vectors need not be compared.

Every vector is kept with its nearest pivot and its angle to it, in blocks of vectors with
one pivot and like angles.  By the triangle inequality the angle between a question and a
vector is at least the difference of their angles to the pivot, so the angles at the two
ends of a block bound the score of all that is in it.  A question first asks its most
promising block; the k-th best score found there rules out every block with a lower bound.
What is left is compared as in a search without an index, so the results are the same.  A
question goes to bundles of blocks with a bit for each block that it wants, so pairs of
questions and blocks never become rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope import workspace
from folioscope.operators.ordering import number_rows
from folioscope.operators.retrieve import (
    DOC_LIMIT,
    TASKS_PER_MERGE,
    Best,
    Vectors,
    _id_arrays,
    _Shape,
    best_k,
    usable_vectors,
)

# Vectors that serve as pivots, taken by the hash of their id; all tasks hold them.
PIVOTS = 64
BLOCK_ROWS = 4096
# Blocks whose angles are held by all tasks, 32 bytes each; a larger table gets larger blocks.
BLOCKS_HELD = 1_000_000
# Blocks next to each other are bundles that a task compares with questions: so many of them
# that a question is sent to, unless they get larger than this.
BUNDLES = 32
BUNDLE_BYTES = 32 << 20
# Questions compared with a bundle at once.
CELL_QUESTIONS = 32_768
# Pairs of a question and a block that are judged at once.
CHOSEN_CELLS = 1 << 20
# Far above the rounding errors of angles, in radians, and of scores.
_SLACK = 1e-6


class PivotIndex(NamedTuple):
    """Stored vectors and what is known of their blocks."""

    rows: DataFrame  # ids, _vector, _block; a folder per pivot
    blocks: DataFrame  # _block, pivot, lo, hi (angles), n
    pivots: np.ndarray  # unit vectors
    dims: int
    ids: tuple[str, ...]


def _unit(vectors: Vectors) -> np.ndarray:
    return vectors.rows.astype(np.float64) / vectors.norms[:, None]


def _angles(units: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(units @ pivots.T, -1.0, 1.0))


def pivot_index(
    vectors: DataFrame,
    dims: int,
    ids: Sequence[str] = ("vec_id",),
    vector: str = "embedding",
    n_pivots: int = PIVOTS,
    block_rows: int = BLOCK_ROWS,
) -> PivotIndex:
    """Sort all vectors that have a direction into blocks.  ``ids`` are unique integers.

    The pivots are a sample of bounded size; they decide what is skipped, never the result.
    Any number of vectors can share a pivot or be equal: blocks are cut by a global order.
    """
    held = vectors.select(*ids, F.col(vector).alias("_vector"))
    chosen = held.orderBy(F.xxhash64(*ids), *ids).limit(n_pivots).select("_vector").toArrow()
    _, sample = usable_vectors(chosen.column(0), dims)
    if len(sample.norms):
        pivots = np.unique(_unit(sample), axis=0)
    else:
        pivots = np.eye(1, dims)
    n_ids = len(ids)
    schema = T.StructType(
        [*held.schema.fields, T.StructField("pivot", T.IntegerType()),
         T.StructField("angle", T.DoubleType())]
    )

    def assign(batches):
        for batch in batches:
            positions, usable = usable_vectors(batch.column(n_ids), dims)
            angles = _angles(_unit(usable), pivots)
            nearest = angles.argmin(1)
            part = batch.take(pa.array(positions))
            columns = [*part.columns, pa.array(nearest.astype(np.int32))]
            columns.append(pa.array(angles[np.arange(len(nearest)), nearest]))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    placed = number_rows(held.mapInArrow(assign, schema), ["pivot", "angle", *ids], "_at")
    total = vectors.count()
    size = max(block_rows, -(-total // BLOCKS_HELD))
    # A block has one pivot: the numbers of rows restart at none, so a block may be short.
    number = F.floor(F.col("_at") / F.lit(size)) * F.lit(len(pivots)) + F.col("pivot")
    folder = workspace.new_folder(vectors.sparkSession, "pivot-index")
    blocked = placed.withColumn("_block", number).drop("_at")
    blocked.write.partitionBy("pivot").parquet(folder)
    kept = T.StructType([f for f in blocked.schema.fields if f.name != "pivot"])
    rows = vectors.sparkSession.read.schema(kept.add("pivot", "integer")).parquet(folder)
    blocks = rows.groupBy("_block", "pivot").agg(
        F.min("angle").alias("lo"), F.max("angle").alias("hi"), F.count(F.lit(1)).alias("n")
    )
    return PivotIndex(
        rows.select(*ids, "_vector", "_block", "pivot"),
        workspace.materialize(blocks, "pivot-blocks"),
        pivots,
        dims,
        tuple(ids),
    )


class _Bundles(NamedTuple):
    """Neighbouring blocks that meet questions in one task, by the places of blocks in order."""

    number: np.ndarray  # of each block
    pivot: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    n: np.ndarray
    starts: np.ndarray  # places of the first blocks of bundles

    def places(self, spark) -> DataFrame:
        """``_block``, ``pivot``, ``_bundle`` and ``_at``, the place of a block in its bundle."""
        bundle = np.searchsorted(self.starts, np.arange(len(self.n)), "right") - 1
        at = np.arange(len(self.n)) - self.starts[bundle] if len(self.n) else bundle
        columns = [self.number, self.pivot.astype(np.int32), bundle.astype(np.int32), at]
        arrays = [pa.array(c) for c in columns]
        return spark.createDataFrame(
            pa.Table.from_arrays(arrays, names=["_block", "pivot", "_bundle", "_at"])
        )


def _bundles(index: PivotIndex) -> _Bundles:
    blocks = index.blocks.orderBy("_block").toArrow()  # BLOCKS_HELD rows and a few at most
    held = [np.asarray(blocks.column(i)) for i in range(5)]
    n = held[4]
    size = min(max(BLOCK_ROWS, -(-int(n.sum()) // BUNDLES)), max(1, BUNDLE_BYTES // (8 * index.dims)))
    bundle = (np.cumsum(n) - n) // size
    return _Bundles(*held, np.flatnonzero(np.diff(bundle, prepend=-1)))


def _compared(pairs: DataFrame, index: PivotIndex, places: DataFrame, shape: _Shape) -> DataFrame:
    """Candidates of questions (``_vector``) in bundles of blocks (``_wanted`` as bits), at best
    only those that reach ``_floor``.

    Vectors of a bundle meet its questions in one task, or in several if there are many, and
    a question is compared with the blocks that it wants.  A pivot that nobody asks is not
    read.
    """
    k, dims, n_ids = shape.k, index.dims, len(index.ids)
    asked = pairs.groupBy("_bundle").agg(F.count(F.lit(1)).alias("many"))
    asked = workspace.materialize(
        asked.select("_bundle", F.ceil(F.col("many") / F.lit(CELL_QUESTIONS)).alias("_cells")),
        "asked-bundles",
    )
    few = F.broadcast(asked)  # one row per bundle at most
    cell = F.pmod(F.xxhash64(shape.qid), F.col("_cells")).alias("_cell")
    left = pairs.join(few, "_bundle").select(
        "_bundle", cell, shape.qid, "_vector", "_wanted", "_floor"
    )
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_cells") - 1)).alias("_cell")
    where = F.broadcast(places.join(few, "_bundle"))  # one row per block at most
    right = index.rows.join(where, ["pivot", "_block"]).select(
        "_bundle", every, "_at", *index.ids, "_vector"
    )
    merge = T.StructField("_merge", T.IntegerType())
    schema = T.StructType([merge, shape.qid_field, *shape.id_fields, shape.score])

    def compare(questions: pa.Table, vectors: pa.Table) -> pa.Table:
        at, own = usable_vectors(questions.column(3), dims)
        found, held = usable_vectors(vectors.column(3 + n_ids), dims)
        block = np.asarray(vectors.column(2))[found]
        order = np.argsort(block, kind="stable")
        block, held = block[order], Vectors(held.rows[order], held.norms[order])
        ids = [i[order] for i in _id_arrays(vectors.select(range(3, 3 + n_ids)), n_ids, found)]
        best = Best(len(at), k, n_ids)
        if len(at):
            least = questions.column(5).fill_null(-np.inf)
            best.least = np.asarray(least)[at]
            bits = b"".join(questions.column(4).take(pa.array(at)).to_pylist())
            bits = np.frombuffer(bits, np.uint8).reshape(len(at), -1)
            wanted = np.unpackbits(bits, axis=1).astype(bool)
            # Neighbouring blocks that the same questions want are compared at once.
            turn = np.flatnonzero((wanted[:, 1:] != wanted[:, :-1]).any(0)) + 1
            for first, last in zip([0, *turn], [*turn, wanted.shape[1]], strict=True):
                among = np.flatnonzero(wanted[:, first])
                part = slice(*np.searchsorted(block, [first, last]))
                if len(among) and part.start < part.stop:
                    near = Vectors(held.rows[part], held.norms[part])
                    best.compare(own, near, [i[part] for i in ids], among)
        question, _, near, scores = best.rows()
        group = questions.column(0)[0].as_py() // TASKS_PER_MERGE if questions.num_rows else 0
        columns = [pa.array(np.full(len(question), group % (1 << 31)), pa.int32())]
        columns.append(questions.column(2).combine_chunks().take(pa.array(at[question])))
        columns += [pa.array(i, pa.int64()) for i in near]
        return pa.Table.from_arrays([*columns, pa.array(scores)], names=schema.names)

    key = ["_bundle", "_cell"]
    cells = left.groupBy(*key).cogroup(right.groupBy(*key))
    return workspace.materialize(cells.applyInArrow(compare, schema), "pivot-candidates")


def topk_pivots(
    questions: DataFrame,
    index: PivotIndex,
    k: int = DOC_LIMIT,
    qid: str = "qid",
    question_vector: str = "embedding",
) -> tuple[DataFrame, DataFrame]:
    """The k nearest vectors of every question as ``topk_batch`` finds them, and per question
    ``n_compared`` and ``n_vectors``: how many vectors it was compared with, of how many.

    Missing, zero and wrongly sized questions ask nothing and have no row in either table.
    """
    spark = questions.sparkSession
    stored = index.rows.withColumnRenamed("_vector", "_held")
    shape = _Shape(
        questions, stored, k, qid, index.ids, "_held", question_vector, index.dims
    )
    bundles = _bundles(index)
    places = workspace.materialize(bundles.places(spark), "pivot-places")
    held = spark.sparkContext.broadcast((tuple(bundles), index.pivots))
    dims = index.dims
    fields = [
        shape.qid_field,
        shape.questions.schema["_vector"],
        T.StructField("_floor", T.DoubleType()),
        T.StructField("_bundle", T.IntegerType()),
        T.StructField("_wanted", T.BinaryType()),
        T.StructField("_n", T.LongType()),
    ]

    def choose(source: DataFrame, floors: bool) -> DataFrame:
        """Questions with the blocks that they want of each bundle: the most promising ones
        until k vectors are together, or, with the ``_floor`` that these gave, all others
        that reach it."""

        def wanted_blocks(theta, floor, pivot, lo, hi, n):
            own = theta[:, pivot]
            apart = np.maximum(np.maximum(own - hi, lo - own), 0.0)
            if floors:
                best = np.cos(np.maximum(apart - _SLACK, 0.0)) + 1.0 + _SLACK
                wanted = best >= floor[:, None]
            else:
                wanted = np.zeros(apart.shape, bool)
            # A block has a vector at least, so k blocks have k.
            reach = np.full(len(own), np.inf)
            if k < len(n):
                reach = np.partition(apart, k - 1, axis=1)[:, k - 1]
            for row in range(len(own)):
                near = np.flatnonzero(apart[row] <= reach[row])
                # Most promising first; of equals, where the question lies most central.
                off = np.abs(own[row, near] - (lo[near] + hi[near]) / 2)
                near = near[np.lexsort((off, apart[row, near]))]
                first = int(np.searchsorted(np.cumsum(n[near]), k)) + 1
                wanted[row, near[:first]] = not floors
            return wanted

        def run(batches):
            (_, pivot, lo, hi, n, starts), pivots = held.value
            step = max(1, CHOSEN_CELLS // max(1, len(n)))
            for batch in batches if len(n) else ():
                at, usable = usable_vectors(batch.column(1), dims)
                angles = _angles(_unit(usable), pivots)
                known = np.asarray(batch.column(2).fill_null(-np.inf))[at]
                for row in range(0, len(at), step):
                    part = slice(row, row + step)
                    wanted = wanted_blocks(angles[part], known[part], pivot, lo, hi, n)
                    some = np.logical_or.reduceat(wanted, starts, axis=1)
                    for bundle, (first, last) in enumerate(zip(starts, [*starts[1:], len(n)])):
                        rows = np.flatnonzero(some[:, bundle])
                        if not len(rows):
                            continue
                        mine = wanted[rows, first:last]
                        bits = [r.tobytes() for r in np.packbits(mine, axis=1)]
                        columns = batch.select([0, 1, 2]).take(pa.array(at[part][rows])).columns
                        columns.append(pa.array(np.full(len(rows), bundle), pa.int32()))
                        columns += [pa.array(bits, pa.binary()), pa.array(mine @ n[first:last])]
                        yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

        return workspace.materialize(source.mapInArrow(run, T.StructType(fields)), "pivot-pairs")

    nothing = F.lit(None).cast("double").alias("_floor")
    asked = choose(shape.questions.select(qid, "_vector", nothing), False)
    near = _compared(asked, index, places, shape)
    floors = (
        best_k(near, k, qid, index.ids).where(F.col("rank") == k)
        .select(F.col(qid).alias("_qid"), F.col("score").alias("_floor"))
    )
    known = shape.questions.join(floors, F.col(qid).eqNullSafe(F.col("_qid")), "left")
    more = choose(known.select(qid, "_vector", "_floor"), True)
    rest = _compared(more, index, places, shape)
    hits = best_k(near.unionByName(rest), k, qid, index.ids)
    share = (
        asked.select(qid, "_n").unionByName(more.select(qid, "_n"))
        .groupBy(qid).agg(F.sum("_n").alias("n_compared"))
        .withColumn("n_vectors", F.lit(int(bundles.n.sum())).cast("bigint"))
    )
    return hits, share
