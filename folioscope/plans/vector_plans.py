"""Retrieval over whole tables: every vector asks, every vector answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioscope.functions import vectors as V
from folioscope.operators import catalogue as G
from folioscope.operators import embed as E
from folioscope.operators import infer as N
from folioscope.operators import pivots as P
from folioscope.operators import retrieve as R
from folioscope.plans.base import query, sql_collapse, sql_vectors, table
from folioscope.plans.document_plans import DIMS, SQL_CHUNK_VECTORS, chunk_index
from folioscope.plugins import HashingEncoder

SQL_QUESTIONS = """q AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'user')"""
SQL_HITS = f"""{SQL_CHUNK_VECTORS}, {SQL_QUESTIONS},
    {sql_vectors("q", "conv_id, turn", "text", "q_vec", DIMS)},
    scored AS (
      SELECT q.conv_id, q.turn, c.doc_id, c.chunk_number,
             round(list_cosine_similarity(CAST(q.vec AS DOUBLE[]), CAST(c.vec AS DOUBLE[])) + 1.0, 9)
               AS score
      FROM q_vec q, chunk_vec c
      WHERE list_sum(list_transform(q.vec, lambda x: x * x)) > 0
        AND list_sum(list_transform(c.vec, lambda x: x * x)) > 0),
    hits AS (
      SELECT *, row_number() OVER (
               PARTITION BY conv_id, turn ORDER BY score DESC, doc_id, chunk_number) AS rank
      FROM scored QUALIFY rank <= 5)"""


@query(
    "cosine_score",
    """WITH x AS (SELECT label, unnest(embedding) AS v, unnest(range(0, 64)) AS dim
                  FROM embeddings),
       m AS (SELECT label, dim, avg(CAST(v AS DOUBLE)) AS mean FROM x GROUP BY ALL),
       c AS (SELECT label, list(mean ORDER BY dim) AS mean FROM m GROUP BY label)
       SELECT vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), mean) + 1.0, 6)
              AS score
       FROM embeddings JOIN c USING (label)""",
)
def cosine_score(spark, folder):
    vectors = table(spark, folder, "embeddings")
    means = E.mean_pool(vectors, "label", "embedding", DIMS)
    scored = vectors.join(means, "label")
    return scored.select("vec_id", F.round(V.cosine_score("embedding", "mean"), 6).alias("score"))


@query(
    "topk_single",
    """WITH x AS (SELECT unnest(embedding) AS v, unnest(range(0, 64)) AS dim FROM embeddings),
       m AS (SELECT dim, avg(CAST(v AS DOUBLE)) AS mean FROM x GROUP BY ALL),
       c AS (SELECT list(mean ORDER BY dim) AS mean FROM m),
       s AS (SELECT vec_id,
                    round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), mean) + 1.0, 9) AS score
             FROM embeddings, c)
       SELECT row_number() OVER (ORDER BY score DESC, vec_id) AS rank, vec_id,
              round(score, 6) AS score
       FROM s QUALIFY rank <= 5""",
)
def topk_single(spark, folder):
    vectors = table(spark, folder, "embeddings", "vec_id", "embedding")
    whole = vectors.withColumn("_all", F.lit(0))
    centre = E.mean_pool(whole, "_all", "embedding", DIMS).first()["mean"]
    top = R.topk_single(vectors, centre)
    return top.select(
        F.col("rank").cast("bigint").alias("rank"), "vec_id", F.round("score", 6).alias("score")
    )


SQL_ALL_NEIGHBOURS = """
    scored AS (
      SELECT q.vec_id AS qid, v.vec_id,
             round(list_cosine_similarity(CAST(q.embedding AS DOUBLE[]),
                                          CAST(v.embedding AS DOUBLE[])) + 1.0, 9) AS score
      FROM embeddings q, embeddings v),
    hits AS (
      SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, vec_id) AS rank
      FROM scored QUALIFY rank <= 5)"""


def neighbours(spark, folder, **options):
    vectors = table(spark, folder, "embeddings", "vec_id", "embedding")
    asked = vectors.select(F.col("vec_id").alias("qid"), "embedding")
    return R.topk_batch(asked, vectors, DIMS, **options)


@query(
    "topk_batch",
    f"""WITH {SQL_ALL_NEIGHBOURS}
        SELECT qid, rank, vec_id, round(score, 6) AS score FROM hits""",
)
def topk_batch(spark, folder):
    return neighbours(spark, folder).select(
        "qid", F.col("rank").cast("bigint").alias("rank"), "vec_id", F.round("score", 6).alias("score")
    )


@query(
    "topk_batch_blocks",
    f"""WITH {SQL_ALL_NEIGHBOURS}
        SELECT qid, rank, vec_id, round(score, 6) AS score FROM hits""",
)
def topk_batch_blocks(spark, folder):
    """The same search when neither side fits into one block."""
    hits = neighbours(spark, folder, block_bytes=100_000)
    return hits.select(
        "qid", F.col("rank").cast("bigint").alias("rank"), "vec_id", F.round("score", 6).alias("score")
    )


@query(
    "hit_projection",
    f"""WITH {SQL_HITS}
        SELECT h.conv_id, h.turn, h.rank, h.doc_id, h.chunk_number,
               {sql_collapse("coalesce(c.content, '')")} AS document
        FROM hits h LEFT JOIN chunks c USING (doc_id, chunk_number)""",
)
def hit_projection(spark, folder):
    chunks = chunk_index(spark, folder)
    turns = table(spark, folder, "conversations")
    hits = N.question_hits(turns, chunks, HashingEncoder(DIMS))
    shown = R.hit_projection(hits, chunks, ("doc_id", "chunk_number"))
    return shown.select(
        "conv_id",
        "turn",
        F.col("rank").cast("bigint").alias("rank"),
        "doc_id",
        F.col("chunk_number").cast("bigint").alias("chunk_number"),
        "document",
    )


@query(
    "unanswered",
    f"""WITH {SQL_HITS},
        best AS (SELECT conv_id, turn, max(score) AS score FROM hits GROUP BY ALL)
        SELECT conv_id, turn, text, round(score, 6) AS best_score,
               CASE WHEN score IS NULL THEN 'no_documents' ELSE 'low_score' END AS reason
        FROM q LEFT JOIN best USING (conv_id, turn) WHERE score IS NULL OR score < 1.5""",
)
def unanswered(spark, folder):
    """Questions of the conversations whose best chunk is not near."""
    turns = table(spark, folder, "conversations")
    hits = N.question_hits(turns, chunk_index(spark, folder), HashingEncoder(DIMS))
    asked = turns.where(F.col("role") == "user").select("conv_id", "turn", "text")
    log = G.unanswered(asked, hits, ["conv_id", "turn"])
    return log.withColumn("best_score", F.round("best_score", 6))


@query(
    "no_hits",
    """SELECT d.doc_id AS qid,
              CASE WHEN l.doc_id IS NULL THEN 'no_documents' ELSE 'found' END AS status
       FROM documents d LEFT JOIN labels l USING (doc_id)""",
)
def no_hits(spark, folder):
    """Labels stand in for hits: about half of the documents have one."""
    asked = table(spark, folder, "documents", "doc_id").withColumnRenamed("doc_id", "qid")
    labels = table(spark, folder, "labels", "doc_id")
    hits = labels.select(F.col("doc_id").alias("qid"), F.lit(1).alias("rank"))
    return R.no_hits(asked, hits)


@query(
    "topk_pivots",
    f"""WITH {SQL_ALL_NEIGHBOURS}
        SELECT qid, rank, vec_id, round(score, 6) AS score FROM hits""",
)
def topk_pivots(spark, folder):
    """The same search with an index that skips blocks of vectors."""
    vectors = table(spark, folder, "embeddings")
    index = P.pivot_index(vectors, DIMS, block_rows=64)
    hits, _ = P.topk_pivots(vectors.withColumnRenamed("vec_id", "qid"), index)
    return hits.select(
        "qid", F.col("rank").cast("bigint").alias("rank"), "vec_id", F.round("score", 6).alias("score")
    )
