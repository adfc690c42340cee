"""Inlined references against plain graph searches."""

import random
import re

import pytest
from pyspark.sql import functions as F

from folioscope.operators import references as R


def reached(edges, start):
    seen, rest = set(), [start]
    while rest:
        for target in edges.get(rest.pop(), ()):
            if target not in seen:
                seen.add(target)
                rest.append(target)
    return seen


def plain(texts):
    """{id: (text, inlined, left)}, by recursion; what lies on a cycle stays a reference."""
    marks = {d: [int(m) for m in re.findall(r"\[\[doc:(\d+)\]\]", t or "")] for d, t in texts.items()}
    edges = {d: {t for t in own if texts.get(t) is not None} for d, own in marks.items()}
    reach = {d: reached(edges, d) for d in edges}
    held = {}

    def whole(doc):
        if doc not in held:
            inlined = left = 0
            out, at, text = [], 0, texts[doc]
            for m in re.finditer(r"\[\[doc:(\d+)\]\]", text):
                target = int(m[1])
                out.append(text[at : m.start()])
                at = m.end()
                if target not in edges[doc] or target == doc or doc in reach[target]:
                    out.append(m[0])
                    left += 1
                else:
                    inner, n, k = whole(target)
                    out.append(f"<{inner}>")
                    inlined, left = inlined + n + 1, left + k
            held[doc] = ("".join([*out, text[at:]]), inlined, left)
        return held[doc]

    return {d: (None, 0, 0) if t is None else whole(d) for d, t in texts.items()}


def graph(seed, n=30):
    """A random graph with long chains, cycles within cycles, doubled and dangling references."""
    rng = random.Random(seed)
    texts = {}
    for d in range(n):
        targets = [rng.choice([d // 2, rng.randrange(d + 1), n + 5]) for _ in range(rng.choice([0, 1, 2]))]
        if rng.random() < 0.15:
            targets.append(rng.randrange(n))
        texts[d] = f"t{d}" + "".join(f" [[doc:{t}]] x" for t in targets)
    texts[n] = None
    texts[n + 1] = ""
    texts[n + 2] = f"[[doc:{n}]][[doc:{n + 2}]][[doc:{n + 1}]][[doc:x]]"
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_against_recursion(spark, seed):
    texts = graph(seed)
    table = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    out = R.inline_references(table.withColumn("target", F.lit(0)), opening="<", closing=">")
    got = {r.doc_id: (r.text, r.n_inlined, r.n_left) for r in out.collect()}
    assert got == plain(texts)


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 1), (3, 4), (4, 5), (5, 4), (5, 6), (6, 7), (9, 1), (8, 8)]
    edges += [(i, i + 1) for i in range(20, 30)] + [(30, 20), (25, 22), (40, 20), (24, 41)]
    table = spark.createDataFrame(edges, "doc long, target long")
    got = {}
    for r in R.components(table).collect():
        got.setdefault(r.component, set()).add(r.node)
    assert got == {3: {1, 2, 3}, 5: {4, 5}, 30: set(range(20, 31))}
    assert R.components(table.where("doc = 9")).count() == 0


def test_no_documents(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert R.inline_references(empty).count() == 0
    one = spark.createDataFrame([(None, "a [[doc:1]]"), (1, "b")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in R.inline_references(one).collect()}
    assert got == {None: "a [[doc:1]]", 1: "b"}


@pytest.mark.parametrize("bundle,limit", [(1, 1), (3, 200), (256, 1 << 20)])
def test_written_texts_are_neither_stored_nor_shuffled(spark, monkeypatch, bundle, limit):
    monkeypatch.setattr(R, "BUNDLE_DOCS", bundle)
    monkeypatch.setattr(R, "WRITTEN_BYTES", limit)
    stored = []
    keep = R.workspace.stored

    def watched(df, folder):
        out = keep(df, folder)
        if "text" in out.columns:
            stored.append(out.agg(F.sum(F.length("text"))).first()[0])
        return out

    monkeypatch.setattr(R.workspace, "stored", watched)
    texts = {d: f"t{d} [[doc:{d // 2}]] and [[doc:{d // 3}]] ." for d in range(1, 120)}
    table = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    out = R.inline_references(table, opening="<", closing=">")
    got = {r.doc_id: (r.text, r.n_inlined, r.n_left) for r in out.collect()}
    assert got == plain(texts)
    assert sum(stored) == sum(map(len, texts.values())) < sum(len(t) for t, _, _ in got.values()) / 20
