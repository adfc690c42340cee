"""Breadth-first crawl selection over a table of fetched pages.

The order of a first-in-first-out queue is rebuilt layer by layer.  The rank of a URL is the
rank of the page that links to it followed by the position of the link there, as bytes, so
ranks of a layer compare like the queue and no layer is sorted.

Links, known pages and visits are tables in buckets of one number, by the hash of the URL
that they are looked up by.  A layer moves to the buckets, they do not move; its new URLs
are appended to the visits as files of their own.  The driver holds the loop counter and the
stop test only.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope import workspace
from folioscope.functions import html as H
from folioscope.functions import urls
from folioscope.operators.ordering import first_rows, number_rows, ordered_ids
from folioscope.sources.pages import first_wins, with_fetch_key
from folioscope.staging import let

# Layers after which ranks are written anew as numbers, because they grow by a position each.
RANK_LAYERS = 32


def extract_links(pages: DataFrame, keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """Every ``<a href>`` of every page: the kept columns, pos from 0, href."""
    return pages.select(*keep, F.posexplode(H.html_links("html")).alias("pos", "href"))


def resolved_links(pages: DataFrame, keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """The links of every page with ``target``, the absolute URL; ``keep`` includes url."""
    staged = urls.with_base_parts(pages.select(*keep, "html"), "url")
    parts = [name for name in staged.columns if name not in (*keep, "html")]
    links = extract_links(staged, (*keep, *parts))
    return urls.resolve_links(links, "url", "href", "target")


def classify_links(
    links: DataFrame, start_url: str, url: str = "target", segment_aligned: bool = False
) -> DataFrame:
    """Add extension, in_scope and action of each link relative to a start URL."""
    authority, path = _start_parts(links, start_url)
    staged = urls.with_url_parts(links, url, "_", ("authority", "path"))
    staged = let(
        staged,
        {
            "extension": urls.url_extension("_path"),
            "in_scope": urls.in_scope(
                F.col("_authority"), F.col("_path"), authority, path, segment_aligned
            ),
        },
    )
    action = urls.classify_link(F.col("in_scope"), F.col("extension"))
    return staged.withColumn("action", action).drop("_authority", "_path")


def _start_parts(df: DataFrame, start_url: str) -> tuple[str, str]:
    row = (
        df.sparkSession.range(1)
        .select(urls.url_authority(F.lit(start_url)), urls.url_path(F.lit(start_url)))
        .first()
    )
    return row[0], row[1]


def visited_filter(candidates: DataFrame, visited: DataFrame, url: str = "url") -> DataFrame:
    """Each new URL once, with its smallest (rank, pos); URLs already seen are left out.

    The minimum is taken before the shuffle too, so a URL that every page links to costs
    one row per task.
    """
    first = candidates.groupBy(url).agg(F.min(F.struct("rank", "pos")).alias("_first"))
    new = first.join(visited.select(url), url, "left_anti")
    return new.select(url, "_first.rank", "_first.pos")


@dataclass
class Crawl:
    """``visits``: url, depth, rank, fetched.  ``tried``: tries to save a URL, with depth, rank,
    pos, url, local_path, status.  Ranks grow in queue order within a depth."""

    visits: DataFrame
    tried: DataFrame

    @cached_property
    def attempts(self) -> DataFrame:
        """The first try of each URL; stored when it is first asked for."""
        order = F.struct("depth", "rank", "pos", "local_path", "status")
        first = self.tried.groupBy("url").agg(F.min(order).alias("_first"))
        return workspace.materialize(first.select("_first.*", "url"), "attempts")

    def ordered_visits(self) -> DataFrame:
        """The visits numbered from 0 in queue order."""
        return number_rows(self.visits, ["depth", "rank"], "visit_order")

    def saves(self, max_saves: int | None = None) -> DataFrame:
        """The files, or the first ``max_saves``, numbered from 0 in the order they are saved."""
        good = self.attempts.where(F.col("status") == "candidate").drop("status")
        kept = first_wins(good, ("depth", "rank", "pos"))
        order = ["depth", "rank", "pos"]
        if max_saves is None:
            return number_rows(kept, order, "save_order")
        return first_rows(kept, order, max_saves, "save_order")

    def report(self, max_saves: int | None = None) -> DataFrame:
        """Attempts by what became of them; with a limit, those up to the last save."""
        key = ["depth", "rank", "pos"]
        done = self.saves(max_saves).select(*key, "url", F.lit("saved").alias("_saved"))
        full = done.agg(F.count(F.lit(1)).alias("_n"), F.max(F.struct(*key)).alias("_last"))
        at_limit = F.lit(False) if max_saves is None else F.col("_n") == max_saves
        last = full.where(at_limit).select("_last").first()
        tried = self.attempts
        if last is not None:
            end = F.struct(*(F.lit(v).alias(n) for n, v in zip(key, last[0], strict=True)))
            tried = tried.where(F.struct(*key) <= end)
        named = tried.join(done, [*key, "url"], "left")
        status = F.coalesce(
            "_saved",
            F.when(F.col("status") == "candidate", "skipped_exists").otherwise(F.col("status")),
        )
        return named.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n_files"))


def link_table(pages: DataFrame, start_url: str, segment_aligned: bool = False) -> DataFrame:
    """Links worth following or saving: src, pos, url, action.

    An empty href names the page itself, which has been visited, so it is left out.
    """
    links = resolved_links(pages, ("url", "fetch_url")).where(F.col("href") != "")
    classified = classify_links(links, start_url, "target", segment_aligned)
    useful = classified.where(F.col("action") != "ignore")
    return useful.select(
        F.col("fetch_url").alias("src"), "pos", F.col("target").alias("url"), "action"
    )


class _Buckets:
    """The tables of one crawl, each in the same number of buckets by a key of its own.

    They are in the session's catalog while the crawl runs, because only catalog tables are
    read by bucket; results are read by their path.
    """

    def __init__(self, spark: SparkSession, n: int):
        self.spark, self.n = spark, n
        self.folder = workspace.new_folder(spark, "crawl")
        self.prefix = f"crawl_{uuid.uuid4().hex}"
        self.names: list[str] = []

    def create(self, name: str, rows: DataFrame, key: str, part: str | None = None) -> None:
        """Store rows under a name; a column ``part`` becomes folders."""
        writer = rows.write.format("parquet").bucketBy(self.n, key)
        if part is not None:
            writer = writer.partitionBy(part)
        self.names.append(name)
        writer.option("path", f"{self.folder}/{name}").saveAsTable(f"{self.prefix}_{name}")

    def append(self, name: str, rows: DataFrame, depth: int) -> None:
        """Add a layer in a folder of its own.  The depth is not part of the rows, so Spark
        compiles the same code for every layer once."""
        self.spark.sql(
            f"INSERT INTO {self.prefix}_{name} PARTITION (depth = {depth}) SELECT * FROM {{rows}}",
            rows=rows,
        )

    def read(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.prefix}_{name}")

    def by_path(self, name: str) -> DataFrame:
        schema = self.read(name).schema
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}")

    def drop(self) -> None:
        """Forget the tables; their files stay."""
        for name in self.names:
            self.spark.sql(f"DROP TABLE {self.prefix}_{name}")


def _bytes(number: Column, size: int) -> Column:
    """A number that is not negative as ``size`` bytes, which compare like numbers."""
    return F.unhex(F.lpad(F.hex(number), 2 * size, "0"))


def next_layer(layer: DataFrame, follow: DataFrame, visits: DataFrame) -> DataFrame:
    """The URLs that pages of a layer (url, rank) link to and nobody has visited, with the
    least ``rank`` of a linking page and the least position ``pos`` on it.

    ``follow`` (src, pos, url) is in buckets by src and ``visits`` by url.
    """
    asked = layer.select(urls.fetch_key("url").alias("src"), "rank")
    found = asked.join(follow, "src").select("url", "rank", "pos")
    return visited_filter(found, visits)


def crawl_bfs(
    pages: DataFrame,
    start_url: str,
    max_saves: int | None = None,
    max_depth: int | None = None,
    segment_aligned: bool = False,
    n_buckets: int | None = None,
) -> Crawl:
    """Visit pages from a start URL in queue order.

    ``pages`` has url, html and optionally content_type.  With ``max_saves`` the loop ends
    after the layer that reaches that many files, with ``max_depth`` after that layer, and
    otherwise when a layer is empty.  ``n_buckets`` is the number of shuffle partitions
    unless given; choose it for the size of the link table.
    """
    spark = pages.sparkSession
    tables = _Buckets(spark, n_buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))
    try:
        return _crawled(tables, pages, start_url, max_saves, max_depth, segment_aligned)
    finally:
        tables.drop()


def _crawled(tables: _Buckets, pages, start_url, max_saves, max_depth, segment_aligned) -> Crawl:
    spark = tables.spark
    pages = with_fetch_key(pages)

    # One page per fetched URL.  The URLs with several pages are stored on their own: their
    # known size lets Spark broadcast them, so that no page body is shuffled.
    known = pages.groupBy("fetch_url").agg(
        F.min(F.struct("url", "content_type")).alias("_page"), F.count(F.lit(1)).alias("n_pages")
    )
    known = known.select("fetch_url", "_page.url", "_page.content_type", "n_pages")
    tables.create("known", known, "fetch_url")
    known = tables.read("known")
    several = known.where("n_pages > 1").select("fetch_url", F.col("url").alias("_kept"))
    several = workspace.stored(several, f"{tables.folder}/several")
    single = pages.join(several, "fetch_url", "left").where(
        F.col("_kept").isNull() | (F.col("_kept") == F.col("url"))
    )
    # Dealt out before they are written, so that a bucket is a file for each action.
    links = link_table(single, start_url, segment_aligned).repartition(tables.n, "src")
    tables.create("links", links, "src", "action")
    follow, files = (
        tables.read("links").where(F.col("action") == action).drop("action")
        for action in ("enqueue", "save")
    )

    depth = n_saved = 0
    start = spark.range(1).select(
        F.lit(start_url).alias("url"), F.lit(b"").alias("rank"), F.lit(0).alias("depth")
    )
    tables.create("visits", start, "url", "depth")
    while True:
        layer = tables.read("visits").where(F.col("depth") == depth)
        if layer.isEmpty():
            break
        if max_saves is not None:
            n_saved += _save_layer(tables, _fetch(layer, known), files, known, depth)
            if n_saved >= max_saves:
                break
        if depth == max_depth:
            break
        new = next_layer(layer, follow, tables.read("visits"))
        depth += 1
        if depth % RANK_LAYERS:
            rank = F.concat("rank", _bytes(F.col("pos"), 4))
        else:
            new = ordered_ids(new, ["rank", "pos"], "_id")
            rank = _bytes(F.col("_id"), 8)
        tables.append("visits", new.select("url", rank.alias("rank")), depth)

    known = tables.by_path("known")
    visits = workspace.materialize(_fetch(tables.by_path("visits"), known), "visits")
    if max_saves is None:
        files = tables.by_path("links").where(F.col("action") == "save").drop("action")
        tried = _attempts(visits, files, known)
    else:
        tried = tables.by_path("attempts")
    return Crawl(visits.select("url", "depth", "rank", "fetched"), tried)


def _save_layer(
    tables: _Buckets, layer: DataFrame, files: DataFrame, known: DataFrame, depth: int
) -> int:
    """Append a layer's attempts and the file names that no layer before has taken; how many
    those are."""
    key = ["rank", "pos", "url", "local_path", "status"]
    found = _attempts(layer, files, known)
    if depth:
        tables.append("attempts", found.select(*key), depth)
    else:
        tables.create("attempts", found.select(*key, "depth"), "url", "depth")
    tried = tables.read("attempts").where(F.col("depth") == depth)
    taken = tried.where(F.col("status") == "candidate").select("local_path").distinct()
    if depth:
        held = tables.read("taken").select("local_path")
        tables.append("taken", taken.join(held, "local_path", "left_anti"), depth)
    else:
        tables.create("taken", taken.withColumn("depth", F.lit(0)), "local_path", "depth")
    return tables.read("taken").where(F.col("depth") == depth).count()


def _fetch(urls_to_fetch: DataFrame, known: DataFrame) -> DataFrame:
    """Look up what a server would send for each URL."""
    fetchable = known.select("fetch_url", "content_type", F.lit(True).alias("_hit"))
    keyed = urls_to_fetch.withColumn("fetch_url", urls.fetch_key("url"))
    joined = keyed.join(fetchable, "fetch_url", "left")
    return joined.withColumn("fetched", F.coalesce("_hit", F.lit(False))).drop("_hit")


def _attempts(visits: DataFrame, files: DataFrame, known: DataFrame) -> DataFrame:
    """Tries to save a file: each page before its links, each PDF at its first link.

    The same PDF again is the same file again, so only its first link can save it.
    """
    key = ["depth", "rank", "pos"]
    pages = visits.withColumn("pos", F.lit(-1))
    fetched = visits.where("fetched").select(F.col("fetch_url").alias("src"), "depth", "rank")
    linked = fetched.join(files, "src").groupBy("url")
    linked = linked.agg(F.min(F.struct(*key)).alias("_first")).select("url", "_first.*")
    columns = [*key, "url", "fetched", "content_type"]
    tried = pages.select(*columns).unionByName(_fetch(linked, known).select(*columns))
    kind = urls.content_type_status("content_type")
    status = (
        F.when(~F.col("fetched"), "not_fetched")
        .when(kind != "keep", F.concat(F.lit("type_"), kind))
        .when(F.col("unsafe"), "unsafe_path")
        .otherwise("candidate")
    )
    placed = urls.with_local_path(tried)
    return placed.select(*key, "url", "local_path", status.alias("status"))
