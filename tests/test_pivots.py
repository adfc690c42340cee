"""The search that skips blocks against brute force and against the search without an index."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_vectors import DIMS, VECTORS, brute_force, found, make

from folioscope.operators import pivots as P


@pytest.mark.parametrize("k,block_rows,cell", [(1, 16, 8192), (5, 16, 7), (300, 50, 8192)])
def test_same_rows(spark, monkeypatch, k, block_rows, cell):
    """Ties, equal vectors, vectors without a direction, and more hits asked than there are."""
    monkeypatch.setattr(P, "CELL_QUESTIONS", cell)
    questions, vectors = make(30, 1), make(150, 2, copies=75)
    vectors += [(900, None), (901, [0.0] * DIMS), (902, [1.0])]
    questions += [(800, None), (801, [0.0] * DIMS), (802, [1.0])]
    asked = spark.createDataFrame(questions, "qid long, embedding array<float>")
    held = spark.createDataFrame(vectors, VECTORS)
    index = P.pivot_index(held, DIMS, n_pivots=9, block_rows=block_rows)
    hits, share = P.topk_pivots(asked, index, k)
    assert found(hits) == brute_force(questions, vectors, k)
    rows = share.collect()
    assert len(rows) == 30 and all(r.n_compared <= r.n_vectors == 225 for r in rows)


def test_blocks_are_skipped(spark):
    """Vectors in clusters: a question is compared with a small part of them."""
    draw = np.random.default_rng(5)
    centres = draw.normal(size=(20, DIMS))
    rows = [
        (i, [float(x) for x in centres[i % 20] + 0.05 * draw.normal(size=DIMS)]) for i in range(2000)
    ]
    held = spark.createDataFrame(rows, VECTORS)
    index = P.pivot_index(held, DIMS, block_rows=40)
    asked = held.where("vec_id % 50 = 0").withColumnRenamed("vec_id", "qid")
    hits, share = P.topk_pivots(asked, index, 3)
    assert found(hits) == brute_force([r for r in rows if r[0] % 50 == 0], rows, 3)
    total = share.agg(F.sum("n_compared"), F.sum("n_vectors")).first()
    assert total[0] < total[1] / 4


def test_nothing_there(spark):
    held = spark.createDataFrame([], VECTORS)
    asked = spark.createDataFrame([(1, [1.0] * DIMS)], "qid long, embedding array<float>")
    hits, share = P.topk_pivots(asked, P.pivot_index(held, DIMS))
    assert hits.count() == 0 and share.count() == 0


def test_pairs_with_blocks_are_not_rows(spark, monkeypatch):
    """A question and the blocks that it wants are a row per bundle, however many blocks there are."""
    stored = {}
    keep = P.workspace.materialize

    def counted(df, purpose):
        out = keep(df, purpose)
        stored[purpose] = stored.get(purpose, 0) + out.count()
        return out

    questions, vectors = make(40, 5), make(900, 6)
    asked = spark.createDataFrame(questions, "qid long, embedding array<float>")
    held = spark.createDataFrame(vectors, VECTORS)
    index = P.pivot_index(held, DIMS, n_pivots=3, block_rows=4)
    monkeypatch.setattr(P.workspace, "materialize", counted)
    hits, share = P.topk_pivots(asked, index, 5)
    assert found(hits) == brute_force(questions, vectors, 5)
    assert index.blocks.count() > 200 and stored["pivot-pairs"] <= 2 * 40


@pytest.mark.parametrize("bundle", [1, 30])
def test_many_bundles(spark, monkeypatch, bundle):
    monkeypatch.setattr(P, "BLOCK_ROWS", 1)
    monkeypatch.setattr(P, "BUNDLE_BYTES", bundle * 8 * DIMS)
    monkeypatch.setattr(P, "CHOSEN_CELLS", 50)
    questions, vectors = make(25, 7), make(200, 8, copies=40)
    asked = spark.createDataFrame(questions, "qid long, embedding array<float>")
    held = spark.createDataFrame(vectors, VECTORS)
    hits, _ = P.topk_pivots(asked, P.pivot_index(held, DIMS, n_pivots=5, block_rows=6), 4)
    assert found(hits) == brute_force(questions, vectors, 4)
