"""Ingest, chunking and embedding over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioscope import workspace
from folioscope.functions import tokens as K
from folioscope.operators import chunk as CH
from folioscope.operators import embed as E
from folioscope.operators import ingest as I
from folioscope.plans.base import (
    SQL_VECTOR_TEXT,
    documents,
    query,
    sql_detokenize,
    sql_runs,
    sql_strip,
    sql_tokens,
    sql_vectors,
    spread_table,
    table,
    vector_text,
)
from folioscope.plugins import HashingEncoder
from folioscope.sources.pages import saved_files

DIMS = 64

# --- ingest ----------------------------------------------------------------------------


def sql_entities(text: str) -> str:
    for name, char in (("quot", "'\"'"), ("copy", "chr(169)"), ("middot", "chr(183)"), ("amp", "'&'")):
        text = f"replace({text}, '&{name};', {char})"
    return text


_HIDDEN = r"<!--.*?-->|<script.*?</script\s*>|<style.*?</style\s*>"
_BLOCKS = (
    r"</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figcaption|figure|"
    r"footer|form|h[1-6]|header|hr|html|li|main|nav|ol|option|p|pre|section|table|tbody|td|"
    r"tfoot|th|thead|title|tr|ul)\b[^>]*>"
)
_BODY = f"regexp_replace(regexp_replace(html, '{_HIDDEN}', '', 'gis'), '<head.*?</head>', '', 'gis')"
_PLAIN = f"regexp_replace(regexp_replace({_BODY}, '{_BLOCKS}', chr(10), 'gi'), '<[^>]*>', '', 'g')"
SQL_HTML_TEXT = sql_strip(sql_entities(_PLAIN))
SQL_TITLE = sql_strip(sql_entities("regexp_extract(html, '<title>(.*?)</title>', 1)"))
SQL_LANG = "regexp_extract(html, '<html lang=\"([^\"]*)\"', 1)"
SQL_PATH = "trim(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/')"
SQL_LOCAL = f"""CASE WHEN {SQL_PATH} = '' THEN 'index.html' WHEN {SQL_PATH} LIKE '%.html'
    THEN {SQL_PATH} ELSE {SQL_PATH} || '.html' END"""
SQL_HOST = "regexp_extract(url, '://([^/?#]*)', 1)"


def page_files(spark, folder):
    """Saved pages as files: page_id, path, html."""
    saved = saved_files(spread_table(spark, folder, "pages", "page_id", "url", "html"))
    return saved.select(
        "page_id", F.concat_ws("/", F.lit("crawl"), "host", "local_path").alias("path"), "html"
    )


@query("extract_text", f"SELECT page_id, {SQL_HTML_TEXT} AS content FROM pages")
def extract_text(spark, folder):
    pages = spread_table(spark, folder, "pages", "page_id", "html")
    return I.extract_text(pages, "html").select("page_id", "content")


@query(
    "extract_metadata",
    f"""SELECT page_id, {SQL_TITLE} AS title,
               regexp_extract(html, '<meta name="author" content="([^"]*)"', 1) AS author,
               regexp_extract(html, '<meta name="keywords" content="([^"]*)"', 1) AS keywords,
               'text/html' AS content_type, {SQL_LANG} AS language
        FROM pages""",
)
def extract_metadata(spark, folder):
    pages = spread_table(spark, folder, "pages", "page_id", "html")
    return I.extract_metadata(pages, "html").drop("html")


@query(
    "build_documents",
    f"""WITH f AS (SELECT *, 'crawl/' || {SQL_HOST} || '/' || {SQL_LOCAL} AS path FROM pages)
        SELECT page_id AS doc_id, regexp_extract(path, '([^/]*)$', 1) AS file_name,
               regexp_extract(path, '^(.*)/[^/]*$', 1) AS directory_path,
               {SQL_HTML_TEXT} AS content, length({SQL_HTML_TEXT}) AS content_length,
               {SQL_TITLE} AS title, 'text/html' AS content_type, {SQL_LANG} AS language
        FROM f""",
)
def build_documents(spark, folder):
    files = page_files(spark, folder)
    extracted = I.extract_metadata(I.extract_text(files, "html"), "html")
    return I.build_documents(extracted, doc_id="page_id").select(
        "doc_id",
        "file_name",
        "directory_path",
        "content",
        "content_length",
        "title",
        "content_type",
        "language",
    )


def partly_labelled(spark, folder):
    """Documents whose text is missing where the label is."""
    docs = table(spark, folder, "documents", "doc_id", "text")
    labels = table(spark, folder, "labels", "doc_id", "quality")
    content = F.when(F.col("quality").isNotNull(), F.col("text"))
    return docs.join(labels, "doc_id", "left").select("doc_id", content.alias("content"))


SQL_PARTLY = """partly AS (
    SELECT d.doc_id, CASE WHEN l.quality IS NOT NULL THEN d.text END AS content
    FROM documents d LEFT JOIN labels l USING (doc_id))"""


@query(
    "filter_no_content",
    f"WITH {SQL_PARTLY} SELECT doc_id, content FROM partly WHERE content IS NOT NULL",
)
def filter_no_content(spark, folder):
    return I.filter_no_content(partly_labelled(spark, folder))


@query(
    "ingest_report",
    f"""WITH {SQL_PARTLY} SELECT CASE WHEN content IS NULL THEN 'no_content' ELSE 'indexed' END
        AS status, count(*) AS n_files FROM partly GROUP BY 1""",
)
def ingest_report(spark, folder):
    rows = partly_labelled(spark, folder)
    return I.ingest_report(rows.withColumn("status", I.ingest_status("content")))


# --- chunks ----------------------------------------------------------------------------


@query(
    "tokenize",
    f"""WITH t AS (SELECT doc_id, {sql_tokens("text")} AS tok FROM documents)
        SELECT doc_id, len(tok) AS n_tokens, md5(array_to_string(tok, '|')) AS digest FROM t""",
)
def tokenize(spark, folder):
    docs = spread_table(spark, folder, "documents", "doc_id", "text")
    tokens = docs.select("doc_id", K.tokenize("text").alias("tok"))
    return tokens.select(
        "doc_id",
        F.size("tok").cast("bigint").alias("n_tokens"),
        F.md5(F.array_join("tok", "|")).alias("digest"),
    )


@query(
    "fixed_chunks",
    f"""WITH {sql_runs(64)} SELECT doc_id, chunk_number, len(tokens) AS n_tokens,
        tokens[1] AS first_token, tokens[len(tokens)] AS last_token FROM runs""",
)
def fixed_chunks(spark, folder):
    runs = CH.token_runs(spread_table(spark, folder, "documents", "doc_id", "text"), 64, "text")
    return runs.select(
        "doc_id",
        F.col("chunk_number").cast("bigint").alias("chunk_number"),
        F.size("tokens").cast("bigint").alias("n_tokens"),
        F.element_at("tokens", 1).alias("first_token"),
        F.element_at("tokens", -1).alias("last_token"),
    )


@query(
    "detokenize",
    f"""WITH {sql_runs(64)} SELECT doc_id, chunk_number, {sql_detokenize("tokens")} AS content
        FROM runs""",
)
def detokenize(spark, folder):
    runs = CH.token_runs(spread_table(spark, folder, "documents", "doc_id", "text"), 64, "text")
    return runs.select(
        "doc_id",
        F.col("chunk_number").cast("bigint").alias("chunk_number"),
        K.detokenize("tokens").alias("content"),
    )


@query(
    "number_chunks",
    f"""WITH {sql_runs(64)} SELECT doc_id, min(chunk_number) AS first_number,
        max(chunk_number) AS last_number, count(DISTINCT chunk_number) AS n_numbers
        FROM runs GROUP BY doc_id""",
)
def number_chunks(spark, folder):
    chunks = CH.chunk_documents(documents(spark, folder).select("doc_id", "content"), 64)
    number = F.col("chunk_number").cast("bigint")
    return chunks.groupBy("doc_id").agg(
        F.min(number).alias("first_number"),
        F.max(number).alias("last_number"),
        F.count_distinct(number).alias("n_numbers"),
    )


@query(
    "carry_metadata",
    f"""WITH {sql_runs(64)} SELECT r.doc_id, r.chunk_number, 'doc' || r.doc_id || '.txt' AS file_name,
        d.source AS directory_path, '' AS title, '' AS author, '' AS keywords,
        'text/plain' AS content_type, d.lang AS language, d.source AS tag
        FROM runs r JOIN documents d USING (doc_id)""",
)
def carry_metadata(spark, folder):
    chunks = CH.chunk_documents(documents(spark, folder), 64)
    return chunks.select(
        "doc_id",
        F.col("chunk_number").cast("bigint").alias("chunk_number"),
        "file_name",
        "directory_path",
        "title",
        "author",
        "keywords",
        "content_type",
        "language",
        F.element_at("tags", 1).alias("tag"),
    )


@query(
    "skip_empty_docs",
    f"""WITH {SQL_PARTLY} SELECT doc_id FROM partly
        WHERE content IS NOT NULL AND content <> ''""",
)
def skip_empty_docs(spark, folder):
    return CH.skip_empty_docs(partly_labelled(spark, folder)).select("doc_id")


@query(
    "chunk_counts",
    f"WITH {sql_runs(64)} SELECT doc_id, count(*) AS n_chunks FROM runs GROUP BY doc_id",
)
def chunk_counts(spark, folder):
    docs = documents(spark, folder).select("doc_id", "content")
    return CH.chunk_counts(CH.chunk_documents(docs, 64))


@query(
    "chunk_documents",
    f"""WITH {sql_runs(512)} SELECT r.doc_id, r.chunk_number, {sql_detokenize("r.tokens")} AS content,
        length({sql_detokenize("r.tokens")}) AS content_length, d.lang AS language
        FROM runs r JOIN documents d USING (doc_id)""",
)
def chunk_documents(spark, folder):
    return CH.chunk_documents(documents(spark, folder)).select(
        "doc_id",
        F.col("chunk_number").cast("bigint").alias("chunk_number"),
        "content",
        "content_length",
        "language",
    )


# --- embeddings ------------------------------------------------------------------------


def chunk_vectors(spark, folder):
    """Chunks of all documents with hashed vectors."""
    chunks = CH.chunk_documents(documents(spark, folder).select("doc_id", "content"))
    return E.embed_table(chunks, HashingEncoder(DIMS))


def chunk_index(spark, folder):
    """The stored index that questions search: vectors and texts are read separately."""
    return workspace.materialize(chunk_vectors(spark, folder), "chunks")


SQL_CHUNKS = f"""{sql_runs(512)},
      chunks AS (SELECT doc_id, chunk_number, {sql_detokenize("tokens")} AS content FROM runs)"""
SQL_CHUNK_VECTORS = (
    f"{SQL_CHUNKS},{sql_vectors('chunks', 'doc_id, chunk_number', 'content', 'chunk_vec', DIMS)}"
)


@query(
    "pad_truncate",
    f"""WITH t AS (SELECT doc_id, {sql_tokens("text")} AS tok FROM documents)
        SELECT doc_id, least(len(tok), 512) + greatest(512 - len(tok), 0) AS n_positions,
               greatest(512 - len(tok), 0) AS n_padding,
               md5(array_to_string(tok[1:512], '|')
                   || repeat('|<pad>', greatest(512 - len(tok), 0))) AS digest
        FROM t""",
)
def pad_truncate(spark, folder):
    docs = spread_table(spark, folder, "documents", "doc_id", "text")
    padded = E.pad_tokens(docs, "text").select("doc_id", "tokens")
    return padded.select(
        "doc_id",
        F.size("tokens").cast("bigint").alias("n_positions"),
        F.size(F.filter("tokens", lambda t: t == "<pad>")).cast("bigint").alias("n_padding"),
        F.md5(F.array_join("tokens", "|")).alias("digest"),
    )


@query(
    "encode_tokens",
    f"""WITH t AS (SELECT doc_id, {sql_tokens("text")} AS tok FROM documents),
        placed AS (SELECT doc_id, unnest(tok) AS tok, unnest(range(0, len(tok))) AS i FROM t),
        coded AS (SELECT doc_id, i, CAST('0x' || substr(md5(tok), 1, 8) AS BIGINT) AS h FROM placed)
        SELECT doc_id, i // 512 AS part, i % 512 AS position, h % {DIMS} AS dim,
               CAST(CASE WHEN (h // {DIMS}) % 2 = 0 THEN 1 ELSE -1 END AS BIGINT) AS value
        FROM coded""",
)
def encode_tokens(spark, folder):
    docs = spread_table(spark, folder, "documents", "doc_id", "text")
    return E.encode_tokens(docs, ["doc_id"], "text", DIMS).select(
        "doc_id",
        F.col("window").alias("part"),
        "position",
        "dim",
        F.col("value").cast("bigint").alias("value"),
    )


@query(
    "pool_positions",
    f"""WITH {sql_vectors("documents", "doc_id", "text", "v", DIMS)},
        n AS (SELECT doc_id, ceil(len({sql_tokens("text")}) / 512.0) AS parts FROM documents)
        SELECT doc_id, dim, round(s / (512.0 * parts), 9) AS value
        FROM v_sum JOIN n USING (doc_id) WHERE s <> 0""",
)
def pool_positions(spark, folder):
    docs = spread_table(spark, folder, "documents", "doc_id", "text")
    encoded = E.encode_tokens(docs, ["doc_id"], "text", DIMS)
    pooled = E.pool_positions(encoded, ["doc_id"])
    return pooled.select("doc_id", "dim", F.round("value", 9).alias("value"))


@query(
    "mean_pool",
    """WITH x AS (SELECT label, unnest(embedding) AS v, unnest(range(0, 64)) AS dim
                  FROM embeddings)
       SELECT label, dim, round(avg(CAST(v AS DOUBLE)), 6) AS mean FROM x GROUP BY ALL""",
)
def mean_pool(spark, folder):
    vectors = table(spark, folder, "embeddings", "label", "embedding")
    means = E.mean_pool(vectors, "label", "embedding", DIMS)
    return means.select("label", F.posexplode("mean").alias("dim", "mean")).select(
        "label", F.col("dim").cast("bigint").alias("dim"), F.round("mean", 6).alias("mean")
    )


@query(
    "embed_table",
    f"""WITH {SQL_CHUNK_VECTORS} SELECT doc_id, chunk_number, {SQL_VECTOR_TEXT} AS vector
        FROM chunk_vec""",
)
def embed_table(spark, folder):
    return chunk_vectors(spark, folder).select(
        "doc_id",
        F.col("chunk_number").cast("bigint").alias("chunk_number"),
        vector_text("embedding", "content").alias("vector"),
    )


@query(
    "filter_embeddable",
    f"""WITH {SQL_PARTLY}, {sql_vectors("partly", "doc_id", "content", "v", DIMS)}
        SELECT doc_id, {SQL_VECTOR_TEXT} AS vector
        FROM partly LEFT JOIN v USING (doc_id)""",
)
def filter_embeddable(spark, folder):
    embedded = E.embed_table(partly_labelled(spark, folder), HashingEncoder(DIMS))
    return embedded.select("doc_id", vector_text("embedding", "content").alias("vector"))


@query(
    "embed_questions",
    f"""WITH q AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'user'),
        {sql_vectors("q", "conv_id, turn", "text", "v", DIMS)}
        SELECT conv_id, turn, {SQL_VECTOR_TEXT} AS vector FROM v""",
)
def embed_questions(spark, folder):
    turns = table(spark, folder, "conversations").where(F.col("role") == "user")
    asked = turns.select("conv_id", "turn", F.col("text").alias("question"))
    embedded = E.embed_questions(asked, HashingEncoder(DIMS))
    return embedded.select("conv_id", "turn", vector_text("embedding", "question").alias("vector"))


@query(
    "check_dims",
    """SELECT CASE WHEN label = 0 THEN 'rejected' ELSE 'accepted' END AS verdict, vec_id
       FROM embeddings""",
)
def check_dims(spark, folder):
    vectors = table(spark, folder, "embeddings")
    short = F.when(F.col("label") == 0, F.slice("embedding", 1, DIMS - 1))
    cut = vectors.withColumn("embedding", short.otherwise(F.col("embedding")))
    accepted, rejected = E.check_dims(cut, DIMS)
    return accepted.select(F.lit("accepted").alias("verdict"), "vec_id").unionByName(
        rejected.select(F.lit("rejected").alias("verdict"), "vec_id")
    )
