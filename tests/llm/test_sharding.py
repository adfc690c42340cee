"""k-d sharding against a plain tree, and its edge cases."""

import zlib

import pytest
from pyspark.sql import functions as F

from folioscope.llm import kdshards, queries


def plain_tree(rows, shards):
    """``rows`` maps a row to (size, places by dimension, tie); the same cuts, row by row."""
    out = {}

    def cut(members, first, n):
        if n == 1 or not members:
            out.update((m, first) for m in members)
            return
        widths = []
        for d in range(len(rows[members[0]][1])):
            values = [rows[m][1][d] >> kdshards.BITS for m in members]
            widths.append(max(values) - min(values))
        d = widths.index(max(widths))
        total = sum(rows[m][0] for m in members)
        wanted = total * (n // 2) // n
        places = {}
        for m in members:
            places.setdefault((rows[m][1][d], rows[m][2]), []).append(m)
        before, low, high = 0, [], []
        for place in sorted(places):
            weight = sum(rows[m][0] for m in places[place])
            (low if 2 * before + weight <= 2 * wanted else high).extend(places[place])
            before += weight
        cut(low, first, n // 2)
        cut(high, first + n // 2, n - n // 2)

    cut(list(rows), 0, shards)
    return out


def test_query_against_plain_tree(spark, sample):
    docs = spark.read.parquet(f"{sample}/documents.parquet")
    placed = kdshards._rows(docs, kdshards.DIMENSIONS, "doc_id", "text", ["doc_id"]).collect()
    expected = plain_tree({r.key: (r.size, r.a, r.b) for r in placed}, 24)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    got = queries.QUERIES["op11_kd_shards"](spark, sample).collect()
    assert {r.doc_id: r.shard for r in got} == expected
    assert all(r["size"] == len(texts[r.doc_id].encode()) + 8 for r in got)
    assert all(r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in got)
    assert {(r.law, r.grown_shard) for r in got} == {("bytes", None)}
    by_shard = {}
    for r in sorted(got, key=lambda r: r.doc_id):
        by_shard.setdefault(r.shard, []).append(r.slot)
    assert all(slots == list(range(len(slots))) for slots in by_shard.values())


def test_bytes_are_near_equal(spark):
    """A hot value of every dimension, and copies of one text."""
    docs = spark.range(6000).selectExpr(
        "id AS doc_id",
        "CASE WHEN id % 3 = 0 THEN 'copy' ELSE repeat('x', cast(id % 97 AS int)) END AS text",
        "CASE WHEN id % 2 = 0 THEN 'hot' ELSE concat('s', id % 40) END AS source",
        "'en' AS lang",
        "id % 97 AS n_chars",
    )
    sharded = kdshards.kd_shards(docs, shards=7).cache()
    sizes = [r[0] for r in sharded.groupBy("shard").agg(F.sum("size")).select("sum(size)").collect()]
    assert len(sizes) == 7 and max(sizes) - min(sizes) <= 3 * 105
    assert sharded.columns[:5] == docs.columns
    boxes = kdshards.shard_catalogue(sharded).collect()
    assert sum(r.n_rows for r in boxes) == 6000 and sum(r.n_bytes for r in boxes) == sum(sizes)


def test_target_bytes(spark):
    docs = spark.range(100).selectExpr("id AS doc_id", "repeat('y', 92) AS text", "id % 5 AS part")
    sharded = kdshards.kd_shards(docs, target_bytes=2000, dimensions=["part"])
    counts = {r.shard: r["count"] for r in sharded.groupBy("shard").count().collect()}
    assert counts == dict.fromkeys(range(5), 20)
    with pytest.raises(ValueError):
        kdshards.kd_shards(docs)


ROWS = [
    (1, None, None, None, None),
    (1, None, None, None, None),
    (2, "", "a", "en", 0.0),
    (None, "one", "a", None, float("nan")),
    (3, "z" * 100_000, None, "en", float("inf")),
    (4, "ä😀", "b", "de", -5.0),
]


def test_edges(spark, tmp_path):
    docs = spark.createDataFrame(
        ROWS, "doc_id bigint, text string, source string, lang string, n_chars double"
    )
    for name in ("size", "shard", "key", "a", "b", "first", "n", "doc", "low", "dim"):
        docs = docs.withColumn(name, F.lit("own"))
    sharded = kdshards.kd_shards(docs, shards=4)
    got = sharded.collect()
    assert len(got) == len(ROWS) and {r.key for r in got} == {"own"}
    assert sorted(r["size"] for r in got) == [8, 8, 8, 11, 14, 100_008]
    assert {r.text_crc32 for r in got if r.doc_id == 1} == {0}
    assert len({r.shard for r in got if r.doc_id == 1}) == 1  # equal rows share a shard
    empty = kdshards.kd_shards(docs.where("false"), shards=4)
    assert empty.columns == sharded.columns and empty.count() == 0
    assert {r.shard for r in kdshards.kd_shards(docs, shards=1).collect()} == {0}
    kdshards.write_shards(sharded, str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == len(ROWS)
