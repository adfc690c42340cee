"""Vector codes: grid cells against a full search, and edge cases (the query has SQL)."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from folioscope.llm import veccodes


@pytest.mark.parametrize("cell", [1, 7, 16, 64])
@pytest.mark.parametrize("spread", [2, 60])
def test_cells_lose_no_entry(cell, spread):
    """Small spreads have many ties, which go to the lower index."""
    draw = np.random.default_rng(cell)
    values = draw.integers(-spread, spread + 1, (700, 12))
    books = draw.integers(-spread, spread + 1, (4, 20, 3))
    grid = veccodes.Grid(books, cell, held=50)
    for rows, codes, distances in grid.codes(values):
        parts = values[rows].reshape(-1, 4, 3)
        for p in range(4):
            full = np.square(parts[:, p, None] - books[p][None]).sum(2)
            assert (full.argmin(1) == codes[:, p]).all()
            assert (full.min(1) == distances[:, p]).all()


def test_cells_save_work():
    draw = np.random.default_rng(1)
    values = draw.normal(0, 40, (4000, 16)).astype(np.int64)
    grid = veccodes.Grid(draw.normal(0, 40, (4, 64, 4)).astype(np.int64))
    list(grid.codes(values))
    assert grid.evaluated < grid.met / 4


def test_scaled_goes_down():
    column = pa.array([[-0.001, 0.001, 1.0, -1.0]], pa.list_(pa.float32()))
    assert veccodes.scaled(column).tolist() == [[-1, 0, 256, -256]]


ROWS = [
    (1, [0.5] * 32, None),
    (1, [0.5] * 32, 1),
    (2, [0.25] * 32, None),
    (None, [-0.25] * 32, 1),
    (3, None, 1),
    (4, [], 1),
    (5, [0.1] * 31 + [None], 1),
    (6, [0.1] * 31 + [float("nan")], 2),
    (7, [0.1] * 31 + [float("inf")], 2),
]


@pytest.fixture
def vectors(spark):
    rows = spark.createDataFrame(ROWS, "vec_id bigint, embedding array<float>, label int")
    for name in ("id", "vector", "code", "error", "of", "salt"):
        rows = rows.withColumn(name, F.lit("own"))
    return rows


@pytest.mark.parametrize("broadcast", [True, False])
def test_edges(vectors, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(veccodes, "LABELS_BROADCAST", 0)
    codes, books = veccodes.encode_vectors(vectors, entries=2, rounds=1)
    got = sorted((r.vec_id or 0, r.code, r.error, r.label_error) for r in codes.collect())
    # Both first entries are the vector 128; entry 1 stays, entry 0 becomes the mean of all.
    assert books.shape == (16, 2, 2) and books[0].tolist() == [[64, 64], [128, 128]]
    far = 32 * (-64 - 64) ** 2
    assert got == [
        (0, "00" * 16, far, far),
        (1, "01" * 16, 0, 0),
        (1, "01" * 16, 0, far),
        (2, "00" * 16, 0, 0),
    ]
    back = veccodes.decode_vectors(codes, books).where("vec_id = 2").first().approximation
    assert back == [64.5 / 256] * 32


def test_empty_and_wrong(spark, vectors):
    codes, books = veccodes.encode_vectors(vectors.where("vec_id > 2"))
    assert books is None and codes.count() == 0
    assert codes.columns == ["vec_id", "code", "error", "label_error"]
    uneven = spark.createDataFrame([(1, [1.0] * 16, 0), (2, [1.0] * 32, 0)], vectors.schema[:3])
    with pytest.raises(Exception, match="components"):
        veccodes.encode_vectors(uneven)[0].count()
