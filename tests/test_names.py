"""Proper names and their places against plain searches."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioscope.operators import names as N


def plain_places(docs, name):
    wanted = name.split(" ")
    out = {}
    for doc, text in docs:
        if doc is None or text is None:
            continue
        own = re.findall(r"[^\W_]+", text.lower())
        at = [i for i in range(len(own)) if own[i : i + len(wanted)] == wanted]
        if at:
            out[name, doc] = (len(at), at[0])
    return out


def found(rows):
    return {(r.name, r.doc_id): (r.n_places, r.first_place) for r in rows.collect()}


@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize("range_docs", [1, 7, 1024])
def test_against_plain_search(spark, monkeypatch, range_docs, broadcast):
    if not broadcast:
        monkeypatch.setattr(N, "WORDS_BROADCAST", 0)
    rng = random.Random(range_docs)
    docs = [
        (i * 3 - 40, " ".join(rng.choice("a b c Über der der der".split()) for _ in range(40)))
        for i in range(60)
    ]
    docs += [(None, "a b"), (500, None), (501, ""), (502, "a, b-c der." * 2000)]
    names = ["a b", "der der", "der der der", "über a", "c c c c c c", "a", "nowhere a", "b", "", None]
    table = spark.createDataFrame(docs, "doc_id long, text string").withColumn("word", F.lit("x"))
    asked = spark.createDataFrame([(n,) for n in names + ["a b"]], "name string")
    index = N.positional_index(table, range_docs=range_docs)
    expected = {}
    for name in filter(None, names):
        expected |= plain_places(docs, name)
    assert found(N.find_names(asked, index)) == expected
    assert N.find_names(asked, index.where("false")).count() == 0
    assert N.find_names(asked.where("false"), index).count() == 0


def test_hot_word_is_many_postings(spark):
    docs = spark.range(0, 5000, 1, 4).selectExpr("id AS doc_id", "concat('hot w', id) AS text")
    index = N.positional_index(docs, range_docs=100)
    hot = index.where("word = 'hot'")
    assert hot.count() == 50 and hot.agg(F.sum("n_docs")).first()[0] == 5000
    assert index.agg(F.max(F.size("docs"))).first()[0] == 100
    # Texts are dealt out once; both groupings keep that.
    plan = index._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_gaps_and_merge():
    doc, place = N._occurrences(np.array([5, 2]), np.array([3, 1]), np.array([1, 1, 4, 9]))
    assert doc.tolist() == [5, 5, 5, 7] and place.tolist() == [1, 2, 6, 9]
    blocks = [
        {"offset": 0, "docs": [5, 2], "places": [[1, 1, 4], [9]]},
        {"offset": 1, "docs": [5], "places": [[2, 1, 4]]},
    ]
    doc, place = N.phrase_places(blocks)
    assert doc.tolist() == [5, 5, 5][: len(doc)] and place.tolist() == [1, 2, 6]


@pytest.mark.parametrize(
    "min_words,text,names",
    [
        (2, "Frau Müller-Lüdenscheidt kam. Sie ging auch.", ["frau müller lüdenscheidt"]),
        (2, "Ein Herr Dr No und Herr Dr No", ["ein herr dr no", "herr dr no"]),
        (1, "Heute kam Anna, Berta und Carl Otto. Dann ging er.", ["anna", "berta", "carl otto"]),
        (2, "keine hier", []),
        (2, None, []),
        (2, "", []),
    ],
)
def test_proper_names(spark, min_words, text, names):
    rows = spark.createDataFrame([(1, text)], "id int, text string")
    assert [r.name for r in N.proper_names(rows, min_words=min_words).collect()] == names


def test_long_names_of_few_words_copy_no_posting(spark):
    text = "das " + "Th " * 700
    docs = spark.range(0, 40, 1, 4).selectExpr("id AS doc_id", f"concat('{text}', id) AS text")
    index = N.positional_index(docs, range_docs=8)
    asked = spark.createDataFrame([(" ".join(["th"] * n),) for n in (2, 500)], "name string")
    places = N.find_names(asked, index)
    assert found(places) == {
        (" ".join(["th"] * n), doc): (701 - n, 1) for n in (2, 500) for doc in range(40)
    }
    # Names find their ranges by two joins of words; none joins the postings' places to names.
    assert places._jdf.queryExecution().analyzed().toString().count("Join ") == 2


@pytest.mark.parametrize("held", [1, 50_000])
def test_names_in_cells(spark, monkeypatch, held):
    monkeypatch.setattr(N, "NAMES_HELD", held)
    docs = [(i, f"a b c{i % 3} a b") for i in range(-5, 30)]
    names = ["a b", "B; c1", "c2 a b", "b a", "-", "c1 a b a"]
    asked = spark.createDataFrame([(n,) for n in names], "name string")
    table = spark.createDataFrame(docs, "doc_id long, text string")
    expected = {}
    for name in names:
        plain = plain_places(docs, " ".join(re.findall(r"[^\W_]+", name.lower())))
        expected |= {(name, doc): v for (_, doc), v in plain.items() if name != "-"}
    assert found(N.find_names(asked, N.positional_index(table, range_docs=4))) == expected


def runs(longest):
    """Documents of one word over and over, names of that word in many lengths, what is found."""
    docs = [(i, "x " + "th " * n) for i, n in enumerate([*range(0, 90, 6), longest])]
    names = [" ".join(["th"] * n) for n in range(2, longest + 2, 3)]
    expected = {}
    for doc, text in docs:
        have = text.count("th")
        for name in names:
            asked = name.count("th")
            if have >= asked:
                expected[name, doc] = (have - asked + 1, 1)
    return docs, names, expected


@pytest.mark.parametrize("held", [{}, {"NAME_WORDS_HELD": 4000, "FOUND_HELD": 50, "ROWS_OUT": 7}])
def test_many_names_meet_a_range_once(spark, monkeypatch, held):
    for limit, value in held.items():
        monkeypatch.setattr(N, limit, value)
    docs, names, expected = runs(200)
    table = spark.createDataFrame(docs, "doc_id long, text string")
    asked = spark.createDataFrame([(n,) for n in names], "name string")
    places = N.find_names(asked, N.positional_index(table, range_docs=4, names=asked))
    rows = places.collect()
    assert found(places) == expected and len(rows) == len(expected)
    if not held:
        # The lists of words travel to their range; names, of which each range has all, do not.
        plan = places._jdf.queryExecution().executedPlan().toString()
        plan = plan.split("== Initial Plan ==")[0]
        assert plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("broadcast", [True, False])
def test_index_of_names_lists_no_other_word(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(N, "WORDS_BROADCAST", 0)
    docs = [(i, f"Anna w{i} und w{i + 1} Anna berta") for i in range(20)]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    names = spark.createDataFrame([("Anna W3",), ("anna berta",), (None,), ("-",)], "name string")
    part = N.positional_index(table, range_docs=5, names=names)
    whole = N.positional_index(table, range_docs=5).where("word IN ('anna', 'w3', 'berta')")
    assert sorted(part.collect()) == sorted(whole.collect())
    # Other words are left out where they are listed, before anything is shuffled.
    plan = part._jdf.queryExecution().optimizedPlan().toString()
    assert broadcast != ("LeftSemi" in plan) and "LeftSemi" not in plan.split("Aggregate")[0]


def test_walk_against_plain_search():
    rng = random.Random(3)
    for _ in range(200):
        phrases = [[rng.choice("abcd") for _ in range(rng.randrange(1, 6))] for _ in range(12)]
        phrases += phrases[:2]
        ids = np.array(rng.sample(range(1000), len(phrases)))
        known, edges, begin, ends, by_node = N._tree(N.pa.array(phrases), ids)
        texts = [[rng.choice("abcde") for _ in range(rng.randrange(1, 30))] for _ in range(4)]
        number = {w: i for i, w in enumerate(known.to_pylist())}
        text = np.array([number.get(w, -1) for t in texts for w in [*t, "-"]], np.int32)
        starts = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
        pairs = list(N._walk(text, len(known), edges, begin, ends))
        got = set()
        if pairs:
            columns = N._told(pairs, starts, ends, by_node)
            got = set(zip(*(c.tolist() for c in columns), strict=True))
        expected = set()
        for id_, phrase in zip(ids.tolist(), phrases, strict=True):
            for doc, own in enumerate(texts):
                at = [i for i in range(len(own)) if own[i : i + len(phrase)] == phrase]
                if at:
                    expected.add((id_, doc, len(at), at[0]))
        assert got == expected
