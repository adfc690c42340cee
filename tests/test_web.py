"""URLs and HTML against the standard library."""

import html
import itertools
import os.path
import time
from urllib.parse import urljoin, urlparse

from pyspark.sql import functions as F

from folioscope.functions import html as H
from folioscope.functions import urls as U
from folioscope.operators import crawl as W
from folioscope.operators import ingest as I

BASES = [
    "http://a/b/c",
    "http://a",
    "http://a/b/c/?q=1#f",
    "https://u:p@h:80/x/y;z/w;v?q",
    "http://a//b//c",
    "http://h/%7Ex/..",
]
HREFS = [
    "", "#", "#f", "?", "?x=1", "g", "./g", "g/", "/g", "//g", "//g/h?z", "../g", "../../../g",
    "./", "..", "../", ".", "g;x", "g;x=1/../y", ";x", "g?y/./x", "g#s/../x", "http:g",
    "http://x/./y/../z", "HTTP://X/y", "mailto:a@b", "ftp://f/x", " /lead", "a b", "/a//b",
    "a//b", "../a//b", "g?", "/..", "/../x", "/./x", "/a/./b", "/a/b/..", "..;x", "x:y", "1:2",
    "a\tb", "//", "//h", "/a;p", "http://h?q", "http://h#f", "g;", "/g;?#", "///x",
]
URLS = [
    "http://h",
    "http://u:1@h:8/p.PDF?q#f",
    "x/.htm",
    "http://h/a.tar.gz",
    "http://h/..a",
    "http://h/.a.b",
    "http://h/a.b/c",
    "http://h/a+b%20c%zz%",
    "http://h/a//b/./c.htm/",
    "http://h/a;x.pdf",
    "http://h/ü%C3%BC",
    "http://h/a./",
    "http://h/a b",
]


def test_links_resolve_like_urljoin(spark):
    pairs = list(itertools.product(BASES, HREFS))
    rows = spark.createDataFrame(pairs, "base string, href string")
    for row in U.resolve_links(rows, "base", "href", "target").collect():
        assert row.target == urljoin(row.base, row.href), row


def test_url_parts(spark):
    rows = spark.createDataFrame([(u,) for u in URLS], "url string")
    rows = U.with_url_parts(rows, "url").withColumn("extension", U.url_extension("path"))
    for row in rows.collect():
        part = urlparse(row.url)
        assert row[1:7] == (
            part.scheme,
            part.netloc,
            part.path,
            part.params,
            part.query,
            part.fragment,
        )
        assert row.extension == os.path.splitext(part.path)[1].lower()


SAVED_AS = [
    ("http://h", "text/html", "index.html"),
    ("http://u:1@h:8/p.PDF?q#f", "application/pdf", "p.PDF.pdf"),
    ("http://h/a.tar.gz", "text/plain", "a.tar.gz"),
    ("http://h/a.b/c", "text/html", "a.b/c.html"),
    ("http://h/a+b%20c%zz%", "text/html", "a+b c%zz%.html"),
    ("http://h/a//b/./c.htm/", "text/html", "a/b/c.htm.html"),
    ("http://h/a;x.pdf", "application/pdf", "a.pdf"),
    ("http://h/\u00fc%C3%BC", "text/html", "\u00fc\u00fc.html"),
    ("http://h/a b", "text/plain", "a b"),
]


def test_local_paths(spark):
    rows = spark.createDataFrame(SAVED_AS, "url string, content_type string, path string")
    for row in U.with_local_path(rows).collect():
        assert row.local_path == row.path and not row.unsafe, row


def test_unsafe_paths(spark):
    urls = ["http://h/%2F..", "http://h/a/%2e%2e/b", "http://h/a%5Cb", "http://h/a/../b"]
    rows = spark.createDataFrame([(u, "text/html") for u in urls], "url string, content_type string")
    assert all(r.unsafe for r in U.with_local_path(rows).collect())


def test_content_types(spark):
    kinds = ["text/html; charset=x", "APPLICATION/PDF", "image/png", "", None, "text/plain"]
    rows = spark.createDataFrame([(k,) for k in kinds], "k string")
    found = [r[0] for r in rows.select(U.content_type_status("k")).collect()]
    assert found == ["keep", "keep", "skip", "error", "error", "keep"]


def test_scope(spark):
    rows = spark.createDataFrame(
        [("http://h/foo/x",), ("http://h/foobar",), ("http://h:1/foo",), ("http://h/foo",)],
        "url string",
    )
    for aligned, wanted in ((False, [True, True, False, True]), (True, [True, False, False, True])):
        found = W.classify_links(rows, "http://h/foo/", "url", segment_aligned=aligned)
        assert [r.in_scope for r in found.collect()] == wanted


def test_actions(spark):
    cases = {
        "http://h/a.PDF": "save",
        "http://x/a.pdf": "save",
        "http://h/a.htm": "enqueue",
        "http://h/a": "enqueue",
        "http://h/a.png": "ignore",
        "http://x/a": "ignore",
        "mailto:a@h": "ignore",
    }
    rows = spark.createDataFrame([(u,) for u in cases], "url string")
    found = {r.url: r.action for r in W.classify_links(rows, "http://h", "url").collect()}
    assert found == cases


def test_entities(spark):
    texts = ["a &amp;lt; &copy;&nbsp;", "&#65;&#x1F600;&#150;&#0;&#xD800;", "&bogus; & x", "&auml;"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for row in rows.select("t", H.decode_entities("t").alias("d")).collect():
        assert row.d == html.unescape(row.t)


PAGE = """<!DOCTYPE html><HTML LANG='de'><head><title> A &amp; B </title>
<meta content="Ann &quot;A&quot;" name="Author"><meta name=keywords content=one>
<style>p{}</style><script>document.write('<a href="/no">x</a>')</script></head>
<body><!-- <a href="/hidden">x</a> --><p>One <b>tw</b>o</p><br/>
<a class="x" href="/q?a=1&amp;b=2">q</a><A HREF='p.html'>p</A><a href=bare>b</a>
<a name="no">n</a><a data-href="/no" title="a > b" href="">e</a><abbr href="/no">x</abbr>
<p title="a > b">5 &lt; 6</body></HTML>"""


def test_html(spark):
    rows = spark.createDataFrame([(PAGE,)], "html string")
    row = I.extract_metadata(I.extract_text(rows, "html"), "html").first()
    assert (row.title, row.author, row.keywords) == ("A & B", 'Ann "A"', "one")
    assert (row.content_type, row.language) == ("text/html", "de")
    assert row.content.startswith("One two\n") and row.content.endswith("5 < 6")
    assert "document" not in row.content and "b" not in row.content.splitlines()[-1]
    links = rows.select(F.explode(H.html_links("html"))).collect()
    assert [r[0] for r in links] == ["/q?a=1&b=2", "p.html", "bare", ""]


def test_hostile_html(spark):
    """Pages on which a careless pattern takes minutes or overflows the stack."""
    pages = [
        "<a " + 'x="1" ' * 20000 + 'href="/z">',
        "<!--" * 50000,
        "<a" * 50000,
        "<a " * 50000,
        "<a '" * 50001,
        "<a =\"'>" * 30001,
        "<a " + 'x="1>" ' * 50000 + "href=it's>",
        "<p " * 50000,
        "<title>" * 30000,
        "<" * 100000,
        "&" * 100000,
        " " * 100000 + "x",
    ]
    rows = spark.createDataFrame([(p,) for p in pages], "html string")
    begin = time.monotonic()
    rows = rows.coalesce(1)
    found = rows.select(
        H.html_links("html").alias("links"), H.html_text("html"), H.html_title("html")
    ).collect()
    assert found[0].links == ["/z"] and found[6].links == ["it's"]
    assert time.monotonic() - begin < 20


def test_plain_links_are_not_taken_apart(spark):
    """A path without segments to drop stays one text; the others are cut at their slashes."""
    cases = [
        ("/s/", "p1", "/s/p1", "/s/p1"),
        ("/s/x", "a/b", "/s/a/b", "/s/a/b"),
        ("", "p", "/p", "/p"),
        ("x", "p", "p", "p"),
        ("/s/x", "/a//b", "/a//b", "/a//b"),
        ("/s//x", "a", "/s//a", "/s/a"),
        ("/s/x", "../p", "/s/../p", "/p"),
        ("/s/x", "./", "/s/./", "/s/"),
        ("/s/x", ".a", "/s/.a", "/s/.a"),
    ]
    rows = spark.createDataFrame(cases, "base string, path string, laid string, tidy string")
    laid = U._laid(F.col("base"), F.col("path"))
    found = rows.select(
        laid.alias("laid"), U._tidy(F.col("base"), F.col("path"), laid).alias("tidy")
    ).collect()
    assert [(r.laid, r.tidy) for r in found] == [c[2:] for c in cases]
