"""Nulls, empty and very long texts, repeated rows, empty tables and clashing columns."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from folioscope.llm import (
    decontaminate,
    licenses,
    paragraphs,
    pieces,
    quotes,
    repeats,
    repetition,
    setjoin,
    spread,
    tokencount,
)

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(30_000))

ROWS = [
    (1, None, "a"),
    (2, "", "b"),
    (3, " \n\t ", None),
    (4, "one two", "a"),
    (4, "one two", "a"),
    (5, LONG, "a"),
    (6, LONG, "c"),
    (None, "three four five six seven eight", "a"),
    (7, "All rights reserved. ÄÖ\n\n😀", None),
]
CLASHES = (
    "key", "row", "set", "n", "label", "kept", "n_words", "_gone", "_hits", "ids", "seed", "c0",
    "_n_words", "_items", "_n_lines", "_n_flagged", "_n_removed", "_flagged", "_spared", "_key",
    "other_key", "_other", "sets", "prefix", "line", "site", "decoded", "lowest", "first",
)


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.createDataFrame(ROWS, "doc_id bigint, text string, source string")
    for name in CLASHES:
        rows = rows.withColumn(name, F.lit(name))
    return rows.withColumn("label2", F.lit(1)).cache()


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, "three four five six"), (2, None), (None, "one two"), (3, ""), (1, "zzz")]
    return spark.createDataFrame(rows, "item_id bigint, text string")


def operators(benchmark):
    return {
        "rules": repetition.repetition_report,
        "licenses": licenses.license_report,
        "tokens": lambda d: tokencount.count_tokens(d, WORDS),
        "repeats": lambda d: repeats.digest(repeats.remove_repeats(d)),
        "paragraphs": lambda d: paragraphs.digest(paragraphs.remove_near_copies(d)),
        "pieces": lambda d: pieces.encode_sampled(d, PIECES),
        "classes": setjoin.jaccard_classes,
        "hits": lambda d: decontaminate.hit_report(
            decontaminate.mark_hits(d, benchmark)
        ),
        "lines": lambda d: spread.digest(spread.remove_wide_lines(d)),
    }


NAMES = list(operators(None))


@pytest.mark.parametrize("name", NAMES)
def test_rows_stay(docs, benchmark, name):
    out = operators(benchmark)[name](docs).collect()
    ids = sorted(r.doc_id if r.doc_id is not None else -1 for r in out)
    assert ids == sorted(r[0] if r[0] is not None else -1 for r in ROWS)


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(docs, benchmark, name):
    assert operators(benchmark)[name](docs.where("false")).count() == 0


def test_defined_results(docs, benchmark):
    by = {}
    for name, run in operators(benchmark).items():
        by[name] = {r.doc_id: r.asDict() for r in run(docs).collect()}
    assert by["rules"][1]["n_words"] == 0 and not by["rules"][1]["kept"]
    assert by["licenses"][7]["base_labels"] == "reserved"
    assert by["licenses"][7]["first_word"] == by["licenses"][7]["last_word"] == 0
    assert by["tokens"][1]["n_tokens"] == by["tokens"][2]["n_tokens"] == 0
    assert by["tokens"][5]["over_limit"]
    assert by["repeats"][5]["n_removed"] == by["repeats"][5]["n_bytes"] == len(LONG)
    assert by["repeats"][4]["n_removed"] == 0  # shorter than a repeat
    # The copy loses all of its pieces.
    assert by["paragraphs"][5]["n_removed"] == 0 and by["paragraphs"][6]["n_repeated"] == 1
    assert by["paragraphs"][6]["n_removed"] == by["paragraphs"][6]["n_paragraphs"] > 1
    assert by["pieces"][1]["ids"] is None and by["pieces"][2]["ids"] == []
    classes = {k: v["component_id"] for k, v in by["classes"].items()}
    assert classes == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 5, None: None, 7: 7}
    assert by["hits"][None]["n_hit"] == 4 and by["hits"][None]["n_items"] == 1
    # An item without an id marks hits and counts, and stays out of the list of ids.
    assert (by["hits"][4]["n_hit"], by["hits"][4]["n_items"]) == (2, 1)
    assert by["hits"][4]["items_sha256"] == by["hits"][1]["items_sha256"]
    assert by["lines"][1]["n_lines"] == 0


def test_keep_one(docs):
    kept = setjoin.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 1, 2, 3, 4, 4, 5, 7]


def test_filters_keep_columns(docs, benchmark):
    assert repetition.keep_varied(docs).columns == docs.columns
    base = docs.drop(*decontaminate.ADDED)
    cleaned = decontaminate.remove_hits(decontaminate.mark_hits(base, benchmark))
    assert cleaned.columns == base.columns
    rows = sorted(map(repr, cleaned.collect()))
    assert {r.doc_id: r.text for r in cleaned.collect()}[1] is None
    for limit in (decontaminate.SHARD_BYTES, 8):
        once = decontaminate.remove_benchmark(base, benchmark, shard_bytes=limit)
        assert once.columns == base.columns
        assert sorted(map(repr, once.collect())) == rows


def test_messages(spark):
    rows = [
        (1, 0, "user", "first line\nsecond line"),
        (1, 1, "bot", "> First  LINE\nreply"),
        (1, 1, "bot", "> First  LINE\nreply"),
        (1, 2, "user", ">> first line\n> reply\n> unknown\n\nthanks"),
        (1, 3, None, None),
        (None, 0, "user", "> first line"),
        (2, None, "user", ""),
        (2, 0, "user", "> second line"),
        (1, 4, "bot", "On Monday, someone wrote:\n > second line\nback to the start"),
    ]
    table = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string")
    table = table.withColumn("conv", F.lit("x")).withColumn("origin", F.lit(0))
    out = quotes.link_quotations(table).collect()
    assert len(out) == len(rows)
    got = {(r.conv_id, r.turn): r for r in out}
    assert [got[1, t].reply_to for t in range(5)] == [None, 0, 1, None, 0]
    assert [got[1, t].depth for t in range(5)] == [0, 1, 2, 0, 1]
    assert [got[1, t].root for t in range(5)] == [0, 0, 0, 3, 0]
    assert got[1, 2].text == "thanks" and got[1, 4].text == "back to the start"
    assert got[1, 2].n_quoted == 3 and got[1, 2].n_linked == 2
    assert got[2, 0].reply_to is None and got[1, 3].text is None
    places = sorted(r.position for r in out if r.conv_id == 1)
    assert places == list(range(6))
    assert got[1, 4].position == 4 and got[1, 3].position == 5
    assert quotes.link_quotations(table.where("false")).count() == 0


def test_stages_take_any_column(spark, docs, benchmark, tmp_path):
    """All names of work columns at once, nulls, empty and long texts, and empty tables."""
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert all(r._spared == "_spared" and r._hits == "_hits" for r in rows), name
        assert rows or name == "quality rules"
        assert stage(spark, docs.where("false"), str(tmp_path)).count() == 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs.drop("ids", "n_ids"), str(tmp_path))
    assert last.count() == len(ROWS)


def test_decode_replaces_a_column(docs):
    encoded = pieces.encode_sampled(docs.select("doc_id", "text", "decoded"), PIECES)
    back = pieces.decode(encoded.withColumn("decoded", F.lit("own")), PIECES).collect()
    assert {r.doc_id: r.decoded for r in back if r.doc_id in (2, 4)} == {2: "", 4: "one two"}


def test_mail(spark):
    rows = [(1, 0, "user", "a\nb"), (1, 0, "bot", "A"), (1, 1, "bot", None), (1, 2, None, ""),
            (None, 0, "user", "x"), (2, None, "user", "y"), (2, 1, "user", "z" * 50_000)]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    mail = quotes.as_mail(table.withColumn("said", F.lit("own")).withColumn("by", F.lit("own")))
    got = sorted(((r.conv_id, r.turn, r.role, r.text) for r in mail.collect()), key=repr)
    assert len(got) == len(rows) and (1, 1, "bot", None) in got
    assert (1, 0, "user", "a\nb") in got and quotes.as_mail(table.where("false")).count() == 0
