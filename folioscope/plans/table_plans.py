"""Sources and sinks: each query writes what it tests to the shared folder and reads it back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope import schemas, workspace
from folioscope.operators import chunk as CH
from folioscope.operators import ingest as I
from folioscope.plans.base import documents, query, sql_detokenize, sql_runs, table
from folioscope.plans.document_plans import SQL_HOST, SQL_LOCAL
from folioscope.sources import files, tables
from folioscope.sources.pages import pages_sink as sink
from folioscope.sources.pages import pages_source as source
from folioscope.sources.pages import saved_files


@query(
    "scan_files",
    """SELECT 'lang=' || lang AS folder, CAST(sum(strlen(text) + 1) AS BIGINT) AS n_bytes
       FROM documents GROUP BY 1""",
)
def scan_files(spark, folder):
    """Write the documents as text files, one folder per language, and walk the folders."""
    target = workspace.new_folder(spark, "files")
    docs = table(spark, folder, "documents", "text", "lang")
    docs.write.partitionBy("lang").text(target)
    found = files.scan_files(spark, target, "*.txt")
    name = F.regexp_extract("path", "([^/]*)/[^/]*$", 1)
    return found.groupBy(name.alias("folder")).agg(F.sum("length").alias("n_bytes"))


@query(
    "ingest_directory",
    """SELECT 'lang=' || lang AS folder, 'text/plain' AS content_type,
              CAST(sum(length(text) + 1) AS BIGINT) AS n_chars
       FROM documents GROUP BY 1""",
)
def ingest_directory(spark, folder):
    """The same walk, with the files' text extracted."""
    target = workspace.new_folder(spark, "files")
    docs = table(spark, folder, "documents", "text", "lang")
    docs.write.partitionBy("lang").text(target)
    found = I.ingest_directory(spark, target)
    name = F.regexp_extract("path", "([^/]*)/[^/]*$", 1)
    return found.groupBy(name.alias("folder"), "content_type").agg(
        F.sum(F.length("content")).alias("n_chars")
    )


@query("scan_table", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def scan_table(spark, folder):
    return table(spark, folder, "documents")


@query("count_rows", "SELECT count(*) AS n_rows FROM documents")
def count_rows(spark, folder):
    return tables.count_rows(table(spark, folder, "documents"))


@query(
    "create_or_replace",
    """SELECT doc_id, text AS content, length(text) AS content_length, lang AS language
       FROM documents""",
)
def create_or_replace(spark, folder):
    """A table of labelled documents is replaced by one of all documents."""
    target = workspace.new_folder(spark, "documents")
    docs = documents(spark, folder)
    labelled = docs.join(table(spark, folder, "labels", "doc_id"), "doc_id", "left_semi")
    tables.create_or_replace(labelled, target, schemas.DOCUMENTS)
    tables.create_or_replace(docs, target, schemas.DOCUMENTS, replace=True)
    return spark.read.parquet(target).select("doc_id", "content", "content_length", "language")


@query(
    "append_docs",
    """SELECT doc_id, text AS content, lang AS language FROM documents
       UNION ALL SELECT -1 - item_id, text, NULL FROM benchmark""",
)
def append_docs(spark, folder):
    target = workspace.new_folder(spark, "documents")
    tables.create_or_replace(documents(spark, folder), target, schemas.DOCUMENTS)
    items = table(spark, folder, "benchmark")
    more = items.select((-1 - F.col("item_id")).alias("doc_id"), F.col("text").alias("content"))
    tables.append_docs(more, target, schemas.DOCUMENTS)
    return spark.read.parquet(target).select("doc_id", "content", "language")


@query(
    "bulk_append",
    f"""WITH {sql_runs(64)} SELECT doc_id, chunk_number, {sql_detokenize("tokens")} AS content
        FROM runs""",
)
def bulk_append(spark, folder):
    target = workspace.new_folder(spark, "chunks")
    chunks = CH.chunk_documents(documents(spark, folder), 64)
    tables.bulk_append(chunks, target, schemas.CHUNKS, max_records_per_file=1000)
    number = F.col("chunk_number").cast("bigint").alias("chunk_number")
    return spark.read.parquet(target).select("doc_id", number, "content")


@query(
    "upsert_by_id",
    """SELECT d.doc_id, coalesce('quality ' || l.quality, d.text) AS content
       FROM documents d LEFT JOIN labels l USING (doc_id)""",
)
def upsert_by_id(spark, folder):
    """Labelled documents get a new version."""
    old = documents(spark, folder).select("doc_id", "content")
    labels = table(spark, folder, "labels", "doc_id", "quality")
    new = labels.join(old.select("doc_id"), "doc_id", "left_semi").select(
        "doc_id", F.concat(F.lit("quality "), "quality").alias("content")
    )
    return tables.upsert_by_id(old, new, ["doc_id"])


@query(
    "upsert_buckets",
    """SELECT d.doc_id, coalesce('quality ' || l.quality, d.text) AS content
       FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id AND l.toxic = 1
       UNION ALL SELECT -1 - item_id, text FROM benchmark""",
)
def upsert_buckets(spark, folder):
    """Documents labelled as toxic get a new version and benchmark items come in, where the
    table is stored; buckets without either are not touched."""
    target = workspace.new_folder(spark, "buckets")
    old = documents(spark, folder).select("doc_id", "content")
    tables.create_buckets(old, target, ["doc_id"], 64)
    labels = table(spark, folder, "labels", "doc_id", "quality", "toxic").where("toxic = 1")
    new = labels.join(old.select("doc_id"), "doc_id", "left_semi").select(
        "doc_id", F.concat(F.lit("quality "), "quality").alias("content")
    )
    items = table(spark, folder, "benchmark", "item_id", "text")
    added = items.select((-1 - F.col("item_id")).alias("doc_id"), F.col("text").alias("content"))
    tables.upsert_buckets(new.unionByName(added), target, ["doc_id"], 64)
    return spark.read.parquet(target).select("doc_id", "content")


_NAMES = ("documents", "pages", "embeddings", "conversations", "benchmark", "labels")


@query(
    "table_exists",
    " UNION ALL ".join(
        f"SELECT '{name}' AS name, true AS present, count(*) AS n_rows FROM {name}"
        for name in _NAMES
    )
    + " UNION ALL SELECT 'missing', false, 0",
)
def table_exists(spark, folder):
    def look(name: str) -> DataFrame:
        present = tables.table_exists(spark, f"{folder}/{name}.parquet")
        rows = table(spark, folder, name) if present else spark.range(0)
        return tables.count_rows(rows).select(
            F.lit(name).alias("name"), F.lit(present).alias("present"), "n_rows"
        )

    return reduce(DataFrame.unionByName, map(look, (*_NAMES, "missing")))


@query(
    "pages_source",
    """SELECT page_id, url, regexp_replace(url, '#.*$', '') AS fetch_url,
              'text/html' AS content_type, length(html) AS n_chars FROM pages""",
)
def pages_source(spark, folder):
    pages = source(spark, f"{folder}/pages.parquet")
    size = F.length("html").cast("bigint").alias("n_chars")
    return pages.select("page_id", "url", "fetch_url", "content_type", size)


@query(
    "pages_sink",
    f"""SELECT page_id, {SQL_HOST} AS host, {SQL_LOCAL} AS local_path, html AS body FROM pages
        QUALIFY row_number() OVER (PARTITION BY {SQL_LOCAL} ORDER BY page_id) = 1""",
)
def pages_sink(spark, folder):
    """Stored twice: the second time every file is there."""
    target = workspace.new_folder(spark, "saved")
    saved = saved_files(table(spark, folder, "pages", "page_id", "url", "html"))
    kept = saved.where(~F.col("unsafe"))
    files = kept.select("page_id", "host", "local_path", "url", F.col("html").alias("body"))
    for _ in range(2):
        sink(files, target)
    return spark.read.parquet(target).select("page_id", "host", "local_path", "body")
