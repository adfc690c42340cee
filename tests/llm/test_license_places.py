"""The base columns of the license scan against a plain search of every whole text."""

import re

from folioscope.llm import licenses, queries

PHRASES = {
    ("cc", "by"): "cc-by",
    ("general", "public", "license"): "gpl",
    ("all", "rights", "reserved"): "reserved",
}
ODD = [
    None,
    "",
    "CC BY cc-by, (CC) by",
    "All rights reserved " * 2000,
    "general GENERAL public license general public licenses ccby c c by",
    "Äll rights reserved; all RIGHTS reservedé all rights\nreserved",
    "cc\x00by",
]


def plain(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places, labels = [], set()
    for phrase, label in PHRASES.items():
        at = [i for i in range(len(own)) if tuple(own[i : i + len(phrase)]) == phrase]
        places += [(i, i) for i in at]
        if at:
            labels.add(label)
    starts = [i for i, _ in places]
    return (
        len(own),
        len(starts),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted(labels)),
    )


def columns(r):
    return r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels


def test_base_columns(spark, sample):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sample}/documents.parquet").collect()}
    rows = queries.QUERIES["op2_license_scan"](spark, sample).collect()
    assert {r.doc_id: columns(r) for r in rows} == {k: plain(t) for k, t in texts.items()}
    assert any(r.n_base for r in rows)
    for r in rows:
        assert set(r.base_labels.split(",")) <= {*r.labels.split(","), ""} and 0 <= r.score <= 1


def test_odd_texts(spark):
    table = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string")
    rows = licenses.license_report(table).collect()
    assert {r.doc_id: columns(r) for r in rows} == {k: plain(t) for k, t in enumerate(ODD)}
