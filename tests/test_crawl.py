"""Properties of crawls on random sites."""

import random

import pytest

from folioscope.operators import crawl as W
from folioscope.operators import ordering as O
from folioscope.sources.pages import with_fetch_key

PAGES = "url string, html string, content_type string"
START = "http://h/s/"


def site(seed, n=40):
    rng = random.Random(seed)
    names = [f"p{i}" for i in range(n)] + [f"p{i}.html" for i in range(0, n, 5)]
    hrefs = names + [
        "", "#x", "./", "../s/p1", "/s/p2?q=1", "/other", "/sx/p1", "http://x/p1", "a.PDF",
        "/s/b.pdf", "//x/s/b.pdf", "http://x/c.pdf", "pic.png", "gone", "mailto:a@b", "p3#y",
        "sub/p1", "sub/../p4", "plain.txt", "/s/%70%31",
    ]

    def links():
        return " ".join(rng.choice(hrefs) for _ in range(rng.randint(0, 6)))

    pages = [(START, links() + " p0 p1 a.PDF", "text/html")]
    for name in names + ["sub/p1", "p2?q=1", "%70%31"]:
        if rng.random() < 0.85:
            kind = rng.choice(["text/html"] * 6 + ["image/png", "text/plain"])
            pages.append((START + name, links(), kind))
    for url in ("http://h/s/a.PDF", "http://x/s/b.pdf", "http://h/s/b.pdf", "http://x/c.pdf"):
        if rng.random() < 0.8:
            pages.append((url, "", "application/pdf"))
    pages += [("http://h/sx/p1", links(), "text/html"), ("http://h/other", "p1", "text/html")]
    return pages


def table(spark, pages):
    def html(links):
        return "".join(f'<a href="{h}">x</a>' for h in links.split())

    return spark.createDataFrame([(u, html(h), k) for u, h, k in pages], PAGES)


def crawled(spark, pages, **limits):
    """Visits and saves in order, and for each fetched page its useful links in order."""
    rows = table(spark, pages)
    crawl = W.crawl_bfs(rows, START, **limits)
    visits = crawl.ordered_visits().orderBy("visit_order").collect()
    links = {}
    for link in W.link_table(with_fetch_key(rows), START).orderBy("src", "pos").collect():
        links.setdefault(link.src, []).append((link.url, link.action))
    saves = [(r.url, r.local_path) for r in crawl.saves().orderBy("save_order").collect()]
    return crawl, visits, links, saves


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_visits_are_first_appearances(spark, seed):
    """The visits are the start and then, once each, what the visited pages link to."""
    _, visits, links, _ = crawled(spark, site(seed))
    follow = [
        url
        for visit in visits
        if visit.fetched
        for url, action in links.get(visit.url.split("#")[0], [])
        if action == "enqueue"
    ]
    assert [v.url for v in visits] == list(dict.fromkeys([START, *follow]))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_saves_are_first_of_their_file(spark, seed):
    """A page is offered before the files that it links to; each file name is taken once."""
    crawl, visits, links, saves = crawled(spark, site(seed))
    offered = []
    for visit in visits:
        if visit.fetched:
            found = links.get(visit.url.split("#")[0], [])
            offered += [visit.url, *(url for url, action in found if action == "save")]
    order = {url: n for n, url in reversed(list(enumerate(offered)))}
    assert [order[url] for url, _ in saves] == sorted(order[url] for url, _ in saves)
    assert len({path for _, path in saves}) == len(saves)
    good = crawl.attempts.where("status = 'candidate'").collect()
    firsts = {}
    for row in good:
        firsts[row.local_path] = min(firsts.get(row.local_path, len(offered)), order[row.url])
    assert {path: order[url] for url, path in saves} == firsts
    report = {r.status: r.n_files for r in crawl.report().collect()}
    assert report["saved"] == len(saves) and sum(report.values()) == crawl.attempts.count()


@pytest.mark.parametrize("limit", [1, 4, 9])
def test_crawl_stops_at_the_limit(spark, limit):
    whole = crawled(spark, site(4))[3]
    crawl = W.crawl_bfs(table(spark, site(4)), START, max_saves=limit)
    found = [(r.url, r.local_path) for r in crawl.saves(limit).orderBy("save_order").collect()]
    assert found == whole[:limit]
    report = {r.status: r.n_files for r in crawl.report(limit).collect()}
    assert report["saved"] == limit


def test_crawl_stops_at_a_depth(spark):
    rows = table(spark, [(START, "p1", "text/html"), (START + "p1", "p2", "text/html")])
    for limit in (None, 5):
        crawl = W.crawl_bfs(rows, START, max_saves=limit, max_depth=1)
        assert sorted(r.url for r in crawl.visits.collect()) == [START, START + "p1"]
        assert crawl.saves(5).count() == 2


def test_unsafe_and_missing_start(spark):
    rows = table(
        spark,
        [(START, "%2e%2e/%2e%2e/x p1", "text/html"), (START + "%2e%2e/%2e%2e/x", "", "text/html")],
    )
    report = {r.status: r.n_files for r in W.crawl_bfs(rows, START).report().collect()}
    assert report == {"saved": 1, "unsafe_path": 1, "not_fetched": 1}
    nothing = W.crawl_bfs(rows, "http://h/nowhere")
    assert nothing.saves().count() == 0 and nothing.visits.count() == 1


def test_two_addresses_of_one_page(spark):
    rows = table(spark, [(START, "p1", "text/html"), (START + "#a", "p2", "text/html")])
    crawl = W.crawl_bfs(rows, START)
    assert sorted(r.url for r in crawl.visits.collect()) == [START, START + "p1"]


def test_row_numbers(spark):
    rows = spark.range(0, 5000, 1, 7).selectExpr("(id * 7919) % 5000 AS k")
    numbered = O.number_rows(rows, ["k"], "n")
    assert numbered.where("n <> k").count() == 0 and numbered.count() == 5000


@pytest.mark.parametrize("small", [10, 100_000])
def test_first_rows(spark, small, monkeypatch):
    monkeypatch.setattr(O, "SMALL_LIMIT", small)
    rows = spark.range(0, 1000, 1, 5).selectExpr("(id * 7) % 1000 AS k")
    found = sorted((r.k, r.n) for r in O.first_rows(rows, ["k"], 25, "n").collect())
    assert found == [(i, i) for i in range(25)]


def test_first_wins_keeps_ties_apart(spark):
    rows = spark.createDataFrame(
        [(2, "a", "f"), (1, "b", "f"), (3, "c", "g")], "n int, url string, local_path string"
    )
    found = sorted((r.n, r.url, r.local_path) for r in W.first_wins(rows, ("n",)).collect())
    assert found == [(1, "b", "f"), (3, "c", "g")]


def test_a_layer_moves_to_the_buckets(spark):
    """Links and visits are read by bucket; only the layer and its candidates are shuffled."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    tables = W._Buckets(spark, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        links = spark.range(500).selectExpr(
            "concat('u', id) AS src", "0 AS pos", "concat('u', id * 7 % 500) AS url"
        )
        visits = spark.range(50).selectExpr("concat('u', id) AS url", "X'00' AS rank", "0 AS depth")
        tables.create("links", links, "src")
        tables.create("visits", visits, "url", "depth")
        layer = tables.read("visits").where("depth = 0")
        new = W.next_layer(layer.repartition(3), tables.read("links"), tables.read("visits"))
        plan = new._jdf.queryExecution().executedPlan().toString()
        joins = plan.replace("REPARTITION_BY_NUM", "").count("ENSURE_REQUIREMENTS")
        assert joins == 2 and plan.count("Bucketed: true") == 2
        assert new.count() == len({f"u{i * 7 % 500}" for i in range(50)} - {f"u{i}" for i in range(50)})
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        tables.drop()


@pytest.mark.parametrize("n", [3, 40])
def test_ranks_over_many_layers(spark, monkeypatch, n):
    """Long chains: ranks are written anew every few layers and keep their order."""
    monkeypatch.setattr(W, "RANK_LAYERS", 3)
    pages = [(START, "a0 b0", "text/html")]
    for name in "ab":
        pages += [(f"{START}{name}{i}", f"{name}{i + 1}", "text/html") for i in range(8)]
    _, visits, _, _ = crawled(spark, pages, max_saves=n, n_buckets=3)
    names = [v.url.removeprefix(START) for v in visits]
    whole = ["", *(f"{c}{i}" for i in range(9) for c in "ab")]
    assert names == (whole[: len(names)] if n == 3 else whole)
    assert not spark.catalog.listTables("default")
