"""Embedding and exact top-k against brute force."""

import pickle
import re
import sys
import uuid
from pathlib import Path

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from folioscope.functions import vectors as V
from folioscope.operators import embed as E
from folioscope.operators import retrieve as R
from folioscope.plugins import HashingEncoder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DIMS = 8
VECTORS = "vec_id long, embedding array<float>"


def brute_force(questions, vectors, k):
    """(qid, rank, vec_id, score), ties to the smaller id."""

    def usable(v):
        return v is not None and len(v) == DIMS and None not in v and any(v)

    def cosine(a, b):
        a, b = np.asarray(a, float), np.asarray(b, float)
        return round(float(a @ b / np.sqrt((a @ a) * (b @ b)) + 1.0), 9)

    rows = set()
    for qid, q in questions:
        if usable(q):
            scored = [(-cosine(q, v), i) for i, v in vectors if usable(v)]
            for rank, (score, i) in enumerate(sorted(scored)[:k], 1):
                rows.add((qid, rank, i, round(-score, 6)))
    return rows


def make(n, seed, copies=0):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, DIMS)]) for i in range(n)]
    hot = rows[0][1]
    return rows + [(n + i, hot) for i in range(copies)]


def found(hits):
    return {(r.qid, r["rank"], r.vec_id, round(r.score, 6)) for r in hits.collect()}


@pytest.fixture(scope="module")
def sides(spark):
    questions, vectors = make(70, 1), make(150, 2, copies=75)
    vectors += [(900, None), (901, [0.0] * DIMS), (902, [1.0]), (903, [1.0] * (DIMS - 1) + [None])]
    questions += [(800, None), (801, [0.0] * DIMS), (802, [1.0])]
    asked = spark.createDataFrame(questions, "qid long, embedding array<float>").repartition(3)
    held = spark.createDataFrame(vectors, VECTORS).repartition(5)
    return questions, vectors, asked, held


@pytest.mark.parametrize("k", [1, 5, 300])
def test_question_block(sides, k):
    questions, vectors, asked, held = sides
    assert found(R.topk_batch(asked, held, DIMS, k)) == brute_force(questions, vectors, k)


def limit_bytes(rows, k):
    return rows * (4 * DIMS + 8 + 16 * k)


@pytest.mark.parametrize("k", [1, 5])
def test_vector_block(spark, k):
    """More questions than fit, few vectors."""
    questions, vectors = make(300, 3), make(20, 4, copies=10)
    asked = spark.createDataFrame(questions, "qid long, embedding array<float>")
    held = spark.createDataFrame(vectors, VECTORS)
    hits = R.topk_batch(asked, held, DIMS, k, block_bytes=limit_bytes(40, k))
    assert found(hits) == brute_force(questions, vectors, k)


@pytest.mark.parametrize("swap", [False, True])
def test_neither_side_fits(sides, swap):
    questions, vectors, asked, held = sides
    if swap:
        questions, vectors = vectors, questions
        asked, held = (
            held.withColumnRenamed("vec_id", "qid"),
            asked.withColumnRenamed("qid", "vec_id"),
        )
    hits = R.topk_batch(asked, held, DIMS, 4, block_bytes=limit_bytes(30, 4))
    assert found(hits) == brute_force(questions, vectors, 4)


def test_small_blocks_copy_rows_to_few_cells(spark):
    questions, vectors = make(700, 11), make(900, 12)
    asked = spark.createDataFrame(questions, "qid long, embedding array<float>")
    held = spark.createDataFrame(vectors, VECTORS)
    hits = R.topk_batch(asked, held, DIMS, 2, block_bytes=limit_bytes(4, 2))
    plan = hits._jdf.queryExecution().analyzed().toString()
    assert max(int(n) for n in re.findall(r"sequence\(0, (\d+)", plan)) < 16
    assert found(hits) == brute_force(questions, vectors, 2)


def test_tiles(sides, monkeypatch):
    questions, vectors, asked, held = sides
    best = R.Best(3, 2, 1)
    q = R.Vectors(np.eye(3), np.ones(3))
    v = np.array([[1.0, 0, 0], [1.0, 0, 0], [0, 1.0, 0], [0.6, 0.8, 0]])
    monkeypatch.setattr(R, "TILE_CELLS", 4)
    for start in range(0, 4, 2):
        part = R.Vectors(v[start : start + 2], np.ones(2))
        best.compare(q, part, [np.arange(start, start + 2)])
    question, place, (ids,), scores = best.rows()
    assert list(zip(question, place, ids, scores, strict=True)) == [
        (0, 1, 0, 2.0),
        (0, 2, 1, 2.0),
        (1, 1, 2, 2.0),
        (1, 2, 3, 1.8),
        (2, 1, 0, 1.0),
        (2, 2, 1, 1.0),
    ]


def test_blocks_need_no_package_on_executors(sides):
    *_, asked, held = sides
    shape = R._Shape(asked, held, 1, "qid", ["vec_id"], "embedding", "embedding", DIMS)
    blocks = [
        R._question_block(shape, shape.questions.toArrow()),
        R._vector_block(shape, shape.vectors.toArrow()),
    ]
    assert not any(b"folioscope" in pickle.dumps(block.value) for block in blocks)


def test_single_question(sides):
    questions, vectors, _, held = sides
    top = R.topk_single(held, questions[5][1], 4)
    rows = {(5, r["rank"], r.vec_id, round(r.score, 6)) for r in top.collect()}
    assert rows == brute_force([questions[5]], vectors, 4)


def test_ids_must_be_whole_numbers(spark, sides):
    *_, asked, held = sides
    with pytest.raises(TypeError):
        R.topk_batch(asked, held.withColumn("vec_id", F.col("vec_id").cast("string")), DIMS)
    with pytest.raises(ValueError):
        R.topk_batch(asked, held, DIMS, 0)


def test_cosine_expression(spark):
    rows = spark.createDataFrame(
        [([1.0, 0.0], [2.0, 0.0]), ([1.0, 0.0], [0.0, 1.0]), ([1.0], [0.0]), (None, [1.0])],
        "a array<float>, b array<float>",
    )
    scores = [r[0] for r in rows.select(V.cosine_score("a", "b")).collect()]
    assert scores == [2.0, 1.0, None, None]


def test_no_hits_and_projection(spark):
    questions = spark.createDataFrame([(1,), (2,)], "qid long")
    hits = spark.createDataFrame([(1, 1, 7), (1, 2, 8)], "qid long, rank int, vec_id long")
    status = {r.qid: r.status for r in R.no_hits(questions, hits).collect()}
    assert status == {1: "found", 2: "no_documents"}
    texts = spark.createDataFrame([(7, "a\n\n\nb")], "vec_id long, content string")
    shown = {r.vec_id: r.document for r in R.hit_projection(hits, texts).collect()}
    assert shown == {7: "a\n\nb", 8: ""}


def test_embedding_rows(spark):
    rows = spark.createDataFrame(
        [(1, "a b a"), (2, None), (3, ""), (4, "b")], "id long, content string"
    ).coalesce(1)
    by_id = {r.id: r for r in E.embed_table(rows, HashingEncoder(4, 8)).collect()}
    assert by_id[2].embedding is None and by_id[2].norm is None
    assert by_id[3].embedding == [0.0] * 4 and by_id[3].norm == 0.0
    assert len(by_id[1].embedding) == 4 and by_id[4].norm == pytest.approx(1 / 8)


def test_masked_mean():
    whole, masked = HashingEncoder(4, 8), HashingEncoder(4, 8, mask=True)
    texts = ["a b c", "a", ""]
    counts = np.array([[3], [1], [1]])
    assert np.allclose(whole.encode(texts) * 8 / counts, masked.encode(texts))


def test_encoder_equals_expressions(spark):
    texts = ["x y z x", "ä  ö", "one two three four five six"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    sparse = E.pool_positions(E.encode_tokens(rows, ["id"], "t", 16, 4), ["id"], 4)
    dense = HashingEncoder(16, 4).encode(texts)
    wanted = {(i, d): v for (i, d), v in np.ndenumerate(dense) if v}
    assert {(r.id, r.dim): r.value for r in sparse.collect()} == wanted


def test_long_texts_are_read_whole(spark):
    """3,000 words: the last one counts, and every token has one position."""
    words = [f"w{i % 97}" for i in range(2999)]
    texts = [" ".join([*words, "x"]), " ".join([*words, "y"])]
    encoder = HashingEncoder(64)
    first, second = encoder.encode(texts) * 512 * 6
    last = [int(np.flatnonzero(encoder.encode([t])[0])[0]) for t in "xy"]
    assert last[0] != last[1]
    assert sorted(np.flatnonzero(np.round(first - second))) == sorted(last)
    questions = spark.createDataFrame(list(enumerate(texts)), "qid long, question string")
    embedded = {r.qid: r.embedding for r in E.embed_questions(questions, encoder).collect()}
    assert np.allclose(np.array(embedded[1]) * 512 * 6, second, atol=1e-3)
    placed = E.encode_tokens(questions, ["qid"], "question", 64).where("qid = 0").collect()
    assert {r.windows for r in placed} == {6}
    assert sorted(r.window * 512 + r.position for r in placed) == list(range(3000))


def test_hit_texts_are_not_shuffled(spark, tmp_path):
    """Ids of a checked size are broadcast to the scan of the texts, whatever Spark's threshold."""
    path = str(tmp_path / "texts")
    spark.range(20000).selectExpr("id AS vec_id", "concat('t', id) AS content").write.parquet(path)
    hits = spark.range(0, 20000, 7).selectExpr("id AS qid", "1 AS rank", "id AS vec_id")
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "2000")
    try:
        shown = R.hit_projection(hits, spark.read.parquet(path))
        plan = shown._jdf.queryExecution().executedPlan().toString()
        rows = shown.collect()
    finally:
        spark.conf.set(key, before)
    assert "BroadcastHashJoin" in plan and "LeftSemi, BuildRight" in plan
    assert sorted(r.document for r in rows) == sorted(f"t{i}" for i in range(0, 20000, 7))


class Counting(HashingEncoder):
    """Fails unless it was started."""

    started = False

    def start(self):
        self.started = True
        self.batch_size = 2

    def encode(self, texts):
        assert self.started and len(texts) <= 2
        return super().encode(texts)


def test_encoder_is_started_and_batched(spark):
    rows = spark.createDataFrame([(i, f"w{i}") for i in range(9)], "id long, content string")
    assert E.embed_table(rows, Counting(4)).where("norm > 0").count() == 9


def test_dimension_check(spark):
    rows = spark.createDataFrame(
        [(1, [1.0, 2.0]), (2, [1.0]), (3, None), (4, [1.0, None]), (5, [1.0, float("nan")])], VECTORS
    )
    good, bad = E.check_dims(rows, 2)
    assert [r.vec_id for r in good.collect()] == [1]
    assert sorted(r.vec_id for r in bad.collect()) == [2, 3, 4, 5]


def test_mean_pool(spark):
    rows = spark.createDataFrame(
        [("a", [1.0, 2.0]), ("a", [3.0, 4.0]), ("b", [5.0, 6.0])], "k string, v array<float>"
    )
    means = {r.k: r["mean"] for r in E.mean_pool(rows, "k", "v", 2).collect()}
    assert means == {"a": [2.0, 3.0], "b": [5.0, 6.0]}


class StartLog(HashingEncoder):
    """Leaves a file for each start."""

    def __init__(self, folder):
        super().__init__(4)
        self.folder = folder

    def start(self):
        (Path(self.folder) / uuid.uuid4().hex).touch()


def test_encoder_starts_once_per_process(spark, tmp_path):
    rows = spark.range(0, 400, numPartitions=40).selectExpr("id", "concat('w', id) AS content")
    embedded = E.embed_table(rows, StartLog(str(tmp_path)))
    assert embedded.agg({"norm": "sum"}).first()[0] > 0
    assert 1 <= len(list(tmp_path.iterdir())) <= 8


def test_only_the_text_goes_to_python(spark):
    rows = spark.range(20).selectExpr("id", "concat('t', id) AS content", "repeat('x', 99) AS big")
    told = E.embed_table(rows, HashingEncoder(DIMS)).where("norm > 0")
    plan = told._jdf.queryExecution().optimizedPlan().toString()
    calls = [line for line in plan.splitlines() if "EvalPython" in line]
    assert len(calls) == 1 and "big" not in calls[0]
    assert told.count() == 20 and told.columns == ["id", "content", "big", "embedding", "norm"]


def test_hits_of_a_tile_are_found_in_one_dimension(monkeypatch):
    """Places in two dimensions take numpy as long as the matrix product."""
    seen = []
    plain = np.nonzero
    monkeypatch.setattr(R.np, "nonzero", lambda a: seen.append(a.shape) or plain(a))
    draw = np.random.default_rng(3)
    q, v = (R.Vectors(m, np.linalg.norm(m, axis=1)) for m in draw.normal(size=(2, 70, DIMS)))
    best = R.Best(70, 3, 1)
    for start in (0, 35):
        part = R.Vectors(v.rows[start : start + 35], v.norms[start : start + 35])
        best.compare(q, part, [np.arange(start, start + 35)], np.arange(0, 70, 2))
    assert (70, 35) not in seen and (35, 35) not in seen
    question, _, (ids,), _ = best.rows()
    cosines = (q.rows / q.norms[:, None]) @ (v.rows / v.norms[:, None]).T
    expected = np.argsort(-cosines[::2], axis=1)[:, :3]
    assert question.tolist() == np.repeat(np.arange(0, 70, 2), 3).tolist()
    assert ids.tolist() == expected.ravel().tolist()


@pytest.mark.parametrize("hot", [0, 700])
def test_tiles_hold_little_and_floors_rise(monkeypatch, hot):
    """A block of many vectors is compared in tiles of bounded size, and no question looks for
    the k best of all of them to get its first floor."""
    monkeypatch.setattr(R, "TILE_CELLS", 600)
    monkeypatch.setattr(R, "TILE_ROWS", 20)
    monkeypatch.setattr(R, "SEED_VECTORS", 16)
    monkeypatch.setattr(R, "RESCORE_PAIRS", 64)
    sizes, cut = [], []
    product, partition = np.matmul, np.partition
    monkeypatch.setattr(
        R.np, "matmul", lambda a, b, out: sizes.append(out.size) or product(a, b, out=out)
    )
    monkeypatch.setattr(
        R.np, "partition", lambda a, *rest, **named: cut.append(a.shape[1]) or partition(a, *rest, **named)
    )
    draw = np.random.default_rng(5)
    rows = draw.integers(-3, 4, (1500, DIMS)).astype(np.float32)
    rows[:hot] = rows[0]
    rows = rows[np.abs(rows).sum(1) > 0]
    asked = rows[draw.permutation(len(rows))[:45]]
    q, v = (R.Vectors(m, np.sqrt((m.astype(float) ** 2).sum(1))) for m in (asked, rows))
    names = draw.permutation(len(rows))
    best = R.Best(len(asked), 5, 1)
    best.compare(q, v, [names])
    cosines = (q.rows.astype(float) @ v.rows.astype(float).T) / np.outer(q.norms, v.norms) + 1.0
    expected = [np.lexsort((names, -row))[:5] for row in np.round(cosines, R.SCORE_DIGITS)]
    _, _, (ids,), scores = best.rows()
    assert ids.tolist() == [names[i] for row in expected for i in row]
    assert np.allclose(scores, [cosines[n, i] for n, row in enumerate(expected) for i in row])
    assert max(sizes) <= 600 and sum(sizes) == len(asked) * len(rows)
    assert cut and max(cut) <= 16
