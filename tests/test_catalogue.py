"""Overlaps with good answers against a table of prefixes, and the log of open questions."""

import random

from folioscope.operators import catalogue as G


def plain(one, two):
    table = [[0] * (len(two) + 1) for _ in range(len(one) + 1)]
    for i, a in enumerate(one):
        for j, b in enumerate(two):
            same = table[i][j] + 1
            table[i + 1][j + 1] = same if a == b else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_common_length():
    rng = random.Random(1)
    for _ in range(300):
        one, two = ([rng.choice("abcd") for _ in range(rng.randrange(90))] for _ in range(2))
        assert G.common_length(one, two) == plain(one, two)


def test_grades(spark):
    good = [(1, "The red house"), (1, "a red big house stands"), (2, ""), (3, None)]
    given = [(1, "a RED house stands"), (1, "a RED house stands"), (1, None), (2, ""), (3, "x"), (9, "y")]
    answers = spark.createDataFrame(given, "item_id int, answer string").repartition(3)
    rows = G.grade_answers(answers, spark.createDataFrame(good, "item_id int, text string"))
    got = sorted(((r.item_id, r.answer, r.n_common, r.overlap) for r in rows.collect()), key=repr)
    best = (1, "a RED house stands", 4, 8 / 9)
    assert got == sorted(
        [best, best, (1, None, 0, 0.0), (2, "", 0, 0.0), (3, "x", 0, 0.0), (9, "y", None, None)],
        key=repr,
    )


def test_open_questions(spark):
    asked = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "qid int, text string")
    hits = spark.createDataFrame([(1, 1.9), (1, 1.2), (2, 1.4), (2, 1.1)], "qid int, score double")
    log = {r.qid: (r.reason, r.best_score) for r in G.unanswered(asked, hits, ["qid"]).collect()}
    assert log == {2: ("low_score", 1.4), 3: ("no_documents", None)}
