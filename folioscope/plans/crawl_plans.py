"""Links, saved files and crawls.

The given pages do not link to each other, so the crawls run over pages that Spark derives
from the part table: page k links to (3k+1), (3k+2), (3k+3) and 7k modulo the number of
parts, to PDF files on two hosts and to a variant of itself.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from folioscope.functions import urls as U
from folioscope.operators import crawl as W
from folioscope.plans.base import query, spread_table, table
from folioscope.plans.document_plans import SQL_HOST, SQL_LOCAL, SQL_PATH
from folioscope.sources.pages import saved_files

START_URL = "http://parts.example/cat/"

SQL_LINKS = r"""links AS (
      SELECT page_id, url, unnest(hrefs) AS href, unnest(range(0, len(hrefs))) AS pos
      FROM (SELECT page_id, url,
                   regexp_extract_all(html, '<a\s[^>]*?href="([^"]*)"', 1) AS hrefs
            FROM pages))"""
SQL_TARGET = "regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || href"


def page_links(spark, folder, links=W.extract_links):
    pages = spread_table(spark, folder, "pages", "page_id", "url", "html")
    return links(pages, ("page_id", "url"))


@query("extract_links", f"WITH {SQL_LINKS} SELECT page_id, pos, href FROM links")
def extract_links(spark, folder):
    links = page_links(spark, folder)
    return links.select("page_id", F.col("pos").cast("bigint").alias("pos"), "href")


@query(
    "resolve_url",
    f"WITH {SQL_LINKS} SELECT page_id, pos, {SQL_TARGET} AS target FROM links",
)
def resolve_url(spark, folder):
    resolved = page_links(spark, folder, W.resolved_links)
    return resolved.select("page_id", F.col("pos").cast("bigint").alias("pos"), "target")


@query(
    "url_parts",
    f"""SELECT page_id, regexp_extract(url, '^([a-z]+):', 1) AS scheme, {SQL_HOST} AS authority,
               regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path,
               regexp_extract(url, '\\?([^#]*)', 1) AS query,
               regexp_extract(url, '#(.*)$', 1) AS fragment
        FROM pages""",
)
def url_parts(spark, folder):
    pages = table(spark, folder, "pages", "page_id", "url")
    parts = U.with_url_parts(pages, "url")
    return parts.select("page_id", "scheme", "authority", "path", "query", "fragment")


@query(
    "url_extension",
    f"""WITH {SQL_LINKS} SELECT page_id, pos,
        lower(regexp_extract(href, '[^/.][^/]*(\\.[^./]*)$', 1)) AS extension FROM links""",
)
def url_extension(spark, folder):
    staged = U.with_url_parts(page_links(spark, folder), "href", "_", ("path",))
    extension = U.url_extension("_path").alias("extension")
    return staged.select("page_id", F.col("pos").cast("bigint").alias("pos"), extension)


_SCOPE = "https://blog.tionsh.example.com/de/"


@query(
    "in_scope",
    f"""SELECT page_id, {SQL_HOST} = 'blog.tionsh.example.com'
               AND '/' || {SQL_PATH} LIKE '/de%' AS in_scope FROM pages""",
)
def in_scope(spark, folder):
    pages = table(spark, folder, "pages", "page_id", "url")
    return W.classify_links(pages, _SCOPE, "url").select("page_id", "in_scope")


@query(
    "classify_link",
    f"""WITH {SQL_LINKS}, t AS (
          SELECT page_id, pos, {SQL_HOST} = 'blog.tionsh.example.com' AS scoped,
                 lower(regexp_extract(href, '[^/.][^/]*(\\.[^./]*)$', 1)) AS extension
          FROM links)
        SELECT page_id, pos, CASE WHEN extension = '.pdf' THEN 'save'
          WHEN scoped AND extension IN ('.html', '.htm', '') THEN 'enqueue' ELSE 'ignore' END AS action
        FROM t""",
)
def classify_link(spark, folder):
    resolved = page_links(spark, folder, W.resolved_links)
    actions = W.classify_links(resolved, "https://blog.tionsh.example.com")
    return actions.select("page_id", F.col("pos").cast("bigint").alias("pos"), "action")


_TYPES = ("text/html; charset=utf-8", "application/pdf", "TEXT/plain", "image/png", "")


def typed_pages(spark, folder):
    """Pages with content types dealt out by id."""
    pages = table(spark, folder, "pages", "page_id", "url")
    kinds = F.array(*(F.lit(t) for t in _TYPES))
    kind = F.element_at(kinds, (F.col("page_id") % len(_TYPES) + 1).cast("int"))
    return pages.withColumn("content_type", kind)


@query(
    "content_type_filter",
    """SELECT page_id, CASE page_id % 5 WHEN 3 THEN 'skip' WHEN 4 THEN 'error' ELSE 'keep' END
              AS status FROM pages""",
)
def content_type_filter(spark, folder):
    status = U.content_type_status("content_type").alias("status")
    return typed_pages(spark, folder).select("page_id", status)


@query(
    "save_extension",
    f"""SELECT page_id, CASE page_id % 5 WHEN 0 THEN '.html' WHEN 1 THEN '.pdf'
               ELSE regexp_extract({SQL_PATH}, '(\\.[^./]*)$', 1) END AS extension FROM pages""",
)
def save_extension(spark, folder):
    staged = U.with_url_parts(typed_pages(spark, folder), "url", "_", ("path",))
    return staged.select("page_id", U.save_extension("content_type", "_path").alias("extension"))


@query("local_path", f"SELECT page_id, {SQL_LOCAL} AS local_path, false AS unsafe FROM pages")
def local_path(spark, folder):
    saved = saved_files(table(spark, folder, "pages", "page_id", "url"))
    return saved.select("page_id", "local_path", "unsafe")


@query(
    "first_wins",
    f"""SELECT {SQL_LOCAL} AS local_path, min(page_id) AS page_id FROM pages GROUP BY 1""",
)
def first_wins(spark, folder):
    saved = saved_files(table(spark, folder, "pages", "page_id", "url"))
    return W.first_wins(saved.select("page_id", "local_path"), ("page_id",))


@query(
    "visited_filter",
    f"""WITH {SQL_LINKS}, c AS (SELECT page_id AS rank, pos, {SQL_TARGET} AS url FROM links
          UNION ALL SELECT page_id, -1, url FROM pages),
        seen AS (SELECT url FROM pages WHERE page_id % 2 = 0)
        SELECT url, min(rank) AS rank, arg_min(pos, rank * 1000000 + pos) AS pos
        FROM c WHERE url NOT IN (SELECT url FROM seen) GROUP BY url""",
)
def visited_filter(spark, folder):
    """Pages and their links are found again; the pages with an even id have been seen."""
    links = page_links(spark, folder, W.resolved_links)
    pages = table(spark, folder, "pages", "page_id", "url")
    found = links.select(
        F.col("page_id").alias("rank"),
        F.col("pos").cast("bigint").alias("pos"),
        F.col("target").alias("url"),
    ).unionByName(
        pages.select(F.col("page_id").alias("rank"), F.lit(-1).cast("bigint").alias("pos"), "url")
    )
    return W.visited_filter(found, pages.where(F.col("page_id") % 2 == 0).select("url"))


# --- crawls over the derived pages -----------------------------------------------------


def part_pages(spark, folder):
    """url, html, content_type of the pages and files derived from the part table."""
    parts = spread_table(spark, folder, "part", "p_partkey", "p_size")
    n = parts.count()
    k = F.col("p_partkey")

    def href(number):
        return F.when(number == 0, "/cat/").otherwise(F.concat(F.lit("p"), number.cast("string")))

    targets = [
        href((3 * k + 1) % n),
        href((3 * k + 2) % n),
        href((3 * k + 3) % n),
        href((7 * k) % n),
        F.concat(F.lit("./f"), k % 97, F.lit(".PDF")),
        F.when(k % 5 == 0, F.concat(F.lit("//other.example/g"), k % 89, F.lit(".pdf"))).otherwise(
            "#top"
        ),
        F.when(k % 4 == 0, F.concat(F.lit("p"), k, F.lit("?v=1&amp;w"))).otherwise("mailto:a@b"),
    ]
    anchors = [F.concat(F.lit('<li><a class=x href="'), t, F.lit('">x</a>')) for t in targets]
    url = F.when(k == 0, START_URL).otherwise(F.concat(F.lit(START_URL + "p"), k))
    fetchable = parts.where((k == 0) | (F.col("p_size") != 13))
    pages = fetchable.select(
        url.alias("url"), F.concat(*anchors).alias("html"), F.lit("text/html").alias("content_type")
    )

    def files(source, address, html, kind):
        return source.select(
            address.alias("url"), F.lit(html).alias("html"), F.lit(kind).alias("content_type")
        ).distinct()

    pdf = "application/pdf"
    inside = F.concat(F.lit(START_URL + "f"), k % 97, F.lit(".PDF"))
    outside = F.concat(F.lit("http://other.example/g"), k % 89, F.lit(".pdf"))
    variant = F.concat(F.lit(START_URL + "p"), k, F.lit("?v=1&w"))
    return (
        pages.unionByName(files(parts.where(k % 3 != 0), inside, "", pdf))
        .unionByName(files(parts, outside, "", pdf))
        .unionByName(files(parts.where(k % 4 == 0), variant, "", "text/html"))
    )


_URL = "CASE WHEN {0} = 0 THEN 'http://parts.example/cat/' ELSE 'http://parts.example/cat/p' || ({0}) END"
SQL_GRAPH = f"""
    n AS (SELECT count(*) AS n FROM part),
    live AS (SELECT p_partkey AS k, n.n FROM part, n WHERE p_partkey = 0 OR p_size <> 13),
    edge AS (
      SELECT {_URL.format("k")} AS src, j AS pos, {_URL.format("(3 * k + 1 + j) % n")} AS dst
      FROM live, range(0, 3) r(j)
      UNION ALL SELECT {_URL.format("k")}, 3, {_URL.format("(7 * k) % n")} FROM live
      UNION ALL SELECT {_URL.format("k")}, 6, 'http://parts.example/cat/p' || k || '?v=1&w'
      FROM live WHERE k % 4 = 0
      UNION ALL SELECT {_URL.format("k")}, 5, {_URL.format("k")} || '#top' FROM live WHERE k % 5 <> 0),
    file_edge AS (
      SELECT {_URL.format("k")} AS src, 4 AS pos,
             'http://parts.example/cat/f' || (k % 97) || '.PDF' AS url FROM live
      UNION ALL
      SELECT {_URL.format("k")}, 5, 'http://other.example/g' || (k % 89) || '.pdf'
      FROM live WHERE k % 5 = 0),
    known AS (
      SELECT {_URL.format("k")} AS url FROM live
      UNION SELECT 'http://parts.example/cat/p' || p_partkey || '?v=1&w' FROM part
            WHERE p_partkey % 4 = 0
      UNION SELECT 'http://parts.example/cat/f' || (p_partkey % 97) || '.PDF' FROM part
            WHERE p_partkey % 3 <> 0
      UNION SELECT 'http://other.example/g' || (p_partkey % 89) || '.pdf' FROM part),
    all_edge AS (
      SELECT src, pos, dst FROM edge
      UNION ALL SELECT src || '#top', pos, CASE WHEN dst LIKE '%#top' THEN dst ELSE dst END
      FROM edge),
    bfs(url, depth, path) USING KEY (url) AS (
      SELECT 'http://parts.example/cat/', 0, [0]
      UNION
      (SELECT e.dst, b.depth + 1, min(list_append(b.path, e.pos))
       FROM bfs b JOIN all_edge e ON e.src = b.url
       WHERE NOT EXISTS (SELECT 1 FROM recurring.bfs r WHERE r.url = e.dst)
       GROUP BY e.dst, b.depth)),
    visit AS (
      SELECT url, depth, path, regexp_replace(url, '#.*$', '') IN (SELECT url FROM known) AS fetched
      FROM bfs),
    tried AS (
      SELECT url, depth, path, -1 AS pos,
             trim(regexp_extract(url, '^http://[^/]*([^?#]*)', 1), '/') || '.html' AS local_path
      FROM visit WHERE fetched
      UNION ALL
      SELECT f.url, v.depth, v.path, f.pos,
             CASE WHEN f.url LIKE '%.PDF'
                  THEN trim(regexp_extract(f.url, '^http://[^/]*(.*)', 1), '/') || '.pdf'
                  ELSE trim(regexp_extract(f.url, '^http://[^/]*(.*)', 1), '/') END
      FROM visit v JOIN file_edge f ON f.src = regexp_replace(v.url, '#.*$', '')
      WHERE v.fetched AND f.url IN (SELECT url FROM known)),
    saved AS (
      SELECT row_number() OVER (ORDER BY depth, path, pos) - 1 AS save_order, url, local_path
      FROM (SELECT *, row_number() OVER (PARTITION BY local_path ORDER BY depth, path, pos) AS nth
            FROM tried) WHERE nth = 1)"""


@query(
    "crawl_bfs",
    f"""WITH RECURSIVE {SQL_GRAPH}
        SELECT row_number() OVER (ORDER BY depth, path) - 1 AS visit_order, url,
               CAST(depth AS BIGINT) AS depth, fetched FROM visit""",
)
def crawl_bfs(spark, folder):
    crawl = W.crawl_bfs(part_pages(spark, folder), START_URL)
    return crawl.ordered_visits().select(
        "visit_order", "url", F.col("depth").cast("bigint").alias("depth"), "fetched"
    )


@query(
    "crawl_saves",
    f"WITH RECURSIVE {SQL_GRAPH} SELECT save_order, url, local_path FROM saved",
)
def crawl_saves(spark, folder):
    """Every file a crawl without a limit saves, in order."""
    saves = W.crawl_bfs(part_pages(spark, folder), START_URL).saves()
    return saves.select("save_order", "url", "local_path")


@query(
    "max_saves",
    f"""WITH RECURSIVE {SQL_GRAPH} SELECT save_order, url, local_path FROM saved
        WHERE save_order < 300""",
)
def max_saves(spark, folder):
    crawl = W.crawl_bfs(part_pages(spark, folder), START_URL, max_saves=300)
    return crawl.saves(300).select("save_order", "url", "local_path")


@query(
    "crawl_report",
    f"""WITH RECURSIVE {SQL_GRAPH},
        attempt AS (
          SELECT url FROM visit
          UNION
          SELECT f.url FROM visit v JOIN file_edge f ON f.src = regexp_replace(v.url, '#.*$', '')
          WHERE v.fetched)
        SELECT CASE WHEN url IN (SELECT url FROM saved) THEN 'saved'
                    WHEN url IN (SELECT url FROM tried) THEN 'skipped_exists'
                    ELSE 'not_fetched' END AS status, count(*) AS n_files
        FROM attempt GROUP BY 1""",
)
def crawl_report(spark, folder):
    return W.crawl_bfs(part_pages(spark, folder), START_URL).report()
