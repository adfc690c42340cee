"""Registered queries against their SQL, and the pipeline against a plain version."""

import re

import duckdb
import pandas as pd
import public_tokenizers
import pytest

import corpus_pipeline
from folioscope.llm import pieces, queries, repetition

TABLES = ("documents", "benchmark", "conversations", "embeddings")


@pytest.fixture(scope="module")
def base(sample):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS FROM '{sample}/{name}.parquet'")
    return con


def comparable(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(pd.notna(frame), None)
    rows = [tuple(int(v) if isinstance(v, float) else v for v in r) for r in frame.to_numpy()]
    return list(frame.columns), sorted(rows, key=repr)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query(spark, sample, base, name):
    got = queries.QUERIES[name](spark, sample).toPandas()
    assert comparable(got) == comparable(base.sql(queries.ORACLES[name]).df())


def plain_words(text):
    low = re.sub("[A-Z]+", lambda m: m[0].lower(), text)
    return [(m.group(), m.span()) for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)]


def without_hits(text, windows):
    found = plain_words(text)
    hit = [False] * len(found)
    for size, own in windows.items():
        for at in range(len(found) - size + 1):
            if tuple(w for w, _ in found[at : at + size]) in own:
                hit[at : at + size] = [True] * size
    if 100 * sum(hit) > 50 * len(hit):
        return None
    out, place, at = [], 0, 0
    while at < len(hit):
        if hit[at]:
            end = at
            while end + 1 < len(hit) and hit[end + 1]:
                end += 1
            out.append(text[place : found[at][1][0]])
            place = found[end][1][1]
            at = end
        at += 1
    return "".join([*out, text[place:]])


def shingles(text):
    low = re.sub("[A-Z]+", lambda m: m[0].lower(), text)
    own = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(own[i : i + 5]) for i in range(max(len(own) - 4, 1))} if own else set()


def linked(a, b):
    common = len(a & b)
    return common and 100 * common >= 80 * len(a | b)


def without_wide_lines(docs):
    def bare(line):
        return line.strip(" \t\n\x0b\f\r")

    sites = {}
    for source, text in docs.values():
        for line in text.split("\n"):
            if bare(line):
                sites.setdefault(bare(line), set()).add(source)
    wide = {line for line, own in sites.items() if len(own) >= 10}
    flagged, heavy = {}, {}
    for doc, (_, text) in docs.items():
        lines = text.split("\n")
        flagged[doc] = [bare(line) in wide for line in lines]
        share = sum(len(line) for line, f in zip(lines, flagged[doc]) if f)
        if 100 * share > 50 * sum(map(len, lines)):
            heavy[doc] = shingles(text)
    copies = {a for a in heavy for b in heavy if a != b and linked(heavy[a], heavy[b])}
    out = {}
    for doc, (source, text) in docs.items():
        if doc not in copies:
            lines = zip(text.split("\n"), flagged[doc])
            text = "\n".join(line for line, f in lines if not f)
        out[doc] = (source, text)
    return out


def one_of_each(docs):
    sets = {doc: shingles(text) for doc, (_, text) in docs.items()}
    label = {doc: doc for doc in docs}
    order = sorted(docs)
    for x, a in enumerate(order):
        for b in order[:x]:
            if label[a] != label[b] and linked(sets[a], sets[b]):
                low, high = sorted((label[a], label[b]))
                label = {k: low if v == high else v for k, v in label.items()}
    return {doc: row for doc, row in docs.items() if label[doc] == doc}


def test_pipeline(spark, sample, base):
    rows = base.sql("SELECT doc_id, source, text FROM documents").fetchall()
    report = queries.QUERIES["op1_quality_rules"](spark, sample).where("kept").collect()
    good = {r.doc_id for r in report}
    docs = {doc: (source, text) for doc, source, text in rows if doc in good}
    docs = one_of_each(without_wide_lines(docs))
    windows = {}
    for (text,) in base.sql("SELECT text FROM benchmark WHERE text IS NOT NULL").fetchall():
        own = [w for w, _ in plain_words(text)]
        size = min(len(own), 10)
        for at in range(len(own) - size + 1 if size else 0):
            windows.setdefault(size, set()).add(tuple(own[at : at + size]))
    expected = {doc: without_hits(text, windows) for doc, (_, text) in docs.items()}
    expected = {doc: text for doc, text in expected.items() if text is not None}
    model = public_tokenizers.path("piece_bpe_32k.model")
    out = pieces.decode(corpus_pipeline.run(spark, sample), model).collect()
    assert {r.doc_id: r.decoded for r in out} == expected
    assert all(r.n_ids == len(r.ids) for r in out)


def test_stages_keep_the_columns(spark, sample):
    docs = spark.read.parquet(f"{sample}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(20), sample).columns == docs.columns


def test_rules_have_effect(spark, sample):
    docs = spark.read.parquet(f"{sample}/documents.parquet")
    kept = repetition.keep_varied(docs).count()
    assert 0 < kept < docs.count()
