"""Fetched web pages: the table a crawl reads and the table it fills."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope import workspace
from folioscope.functions import urls
from folioscope.sources.tables import table_exists
from folioscope.staging import let

HTML_TYPE = "text/html"


def with_fetch_key(pages: DataFrame) -> DataFrame:
    """Add ``fetch_url`` and, where the table has none, a ``content_type``."""
    if "content_type" not in pages.columns:
        pages = pages.withColumn("content_type", F.lit(HTML_TYPE))
    return pages.withColumn("fetch_url", urls.fetch_key("url"))


def pages_source(spark: SparkSession, path: str) -> DataFrame:
    """Fetched pages by the URL a server saw; a URL can be fetched iff it is found here."""
    return with_fetch_key(spark.read.parquet(path))


def saved_files(pages: DataFrame) -> DataFrame:
    """One row per page with the host and the file it is saved under, unsafe paths flagged."""
    hosted = let(with_fetch_key(pages), {"host": urls.url_authority("url")})
    return urls.with_local_path(hosted)


def first_wins(saves: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """The earliest row of every ``local_path``; a later one finds the file in its place."""
    others = [c for c in saves.columns if c not in order and c != "local_path"]
    first = saves.groupBy("local_path").agg(F.min(F.struct(*order, *others)).alias("_first"))
    return first.select("local_path", "_first.*").select(*saves.columns)


def pages_sink(
    saved: DataFrame, path: str, order: tuple[str, ...] = ("page_id",), by_host: bool = False
) -> None:
    """Add saved pages to a table that has one row for each ``local_path``.

    A file that is there stays; of several new pages for one file the first by ``order`` is
    kept.  No raw path is ever written to.
    """
    spark = saved.sparkSession
    if table_exists(spark, path):
        held = spark.read.parquet(path).select("local_path")
        saved = saved.join(held, "local_path", "left_anti").select(*saved.columns)
    # The winners are found without the bodies, and only their bodies are shuffled.
    key = ["local_path", *order]
    first = workspace.materialize(first_wins(saved.select(*key), order), "winners")
    winners = saved.join(first, key, "left_semi").select(*saved.columns)
    writer = winners.dropDuplicates(["local_path"]).write.mode("append")
    if by_host:
        writer = writer.partitionBy("host")
    writer.parquet(path)


def sink_status(saved: DataFrame, path: str, order: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """``local_path``, ``order`` and status of pages after the sink: ``saved`` where the table
    holds the page's row, ``skipped_exists`` where another page has its file."""
    keys = ["local_path", *order]
    held = saved.sparkSession.read.parquet(path).select(*keys, F.lit("saved").alias("status"))
    found = saved.select(*keys).join(held, keys, "left")
    return found.fillna("skipped_exists", ["status"])
