"""Summary trees against a loop, with failing parts and summaries that do not get shorter."""

import re
import sys

import pytest
from pyspark import cloudpickle

from folioscope.operators import summaries as S

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Short:
    """Answers with the first and the last word of the text, and fails where it says so."""

    def generate(self, prompt, model, temperature):
        text = re.search(r"(?s)enough:\n\n(.*)\n\nSummary:$", prompt)[1]
        if "boom" in text:
            raise ValueError("boom")
        own = text.split()
        return f"{own[0]} {own[-1]}" if own else "empty"


class Echo:
    def generate(self, prompt, model, temperature):
        return prompt


def table(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, content string")


def plain(text, budget):
    """(summary, levels) with pieces cut behind blanks."""
    levels = 0
    while True:
        levels += 1
        pieces = re.findall(rf"(?s).{{1,{budget}}}(?:(?<=\s)|\Z)|.{{1,{budget}}}", text) or [""]
        assert "".join(pieces) == text
        told = [Short().generate(f"enough:\n\n{p}\n\nSummary:", "", 0) for p in pieces]
        if len(told) == 1:
            return told[0], levels
        text = "\n\n".join(told)


@pytest.mark.parametrize("budget", [40, 200])
def test_against_a_loop(spark, budget):
    texts = [" ".join(f"w{i}x{d}" for i in range(3 ** d)) for d in range(8)]
    texts += ["y" * 1000, "", "a " * 19 + "b" * 50, "one\ntwo  three"]
    told, nodes = S.summary_tree(table(spark, texts), Short(), budget)
    found = {r.doc_id: r for r in told.collect()}
    for doc, text in enumerate(texts):
        if found[doc].status == "no_progress":
            assert doc in (8, 10) and found[doc].summary is None  # words longer than pieces
            continue
        assert (found[doc].summary, found[doc].levels) == plain(text, budget)
    rows = nodes.collect()
    assert max(r.n_chars for r in rows) <= budget
    assert len(rows) == sum(r.n_prompts for r in found.values())
    whole = {d: sum(r.n_chars for r in rows if r.doc_id == d and r.level == 0) for d in found}
    assert whole == {d: len(text) for d, text in enumerate(texts)}


def test_failures(spark):
    texts = ["fine", "boom", "good " * 30 + "boom " + "end " * 30, None]
    told, nodes = S.summary_tree(table(spark, texts), Short(), 40)
    got = {r.doc_id: (r.status, r.summary is None, r.n_failed) for r in told.collect()}
    assert got == {0: ("ok", False, 0), 1: ("failed", True, 1), 2: ("partial", False, 1), 3: ("ok", False, 0)}
    bad = nodes.where("status <> 'ok'").collect()
    assert {r.doc_id for r in bad} == {1, 2} and all("boom" in r.error for r in bad)


def test_summaries_that_do_not_get_shorter(spark):
    told, nodes = S.summary_tree(table(spark, ["a b " * 50, "a"]), Echo(), 40)
    got = {r.doc_id: (r.status, r.levels) for r in told.collect()}
    assert got == {0: ("no_progress", 1), 1: ("ok", 1)} and nodes.where("level > 0").count() == 0


def test_no_documents(spark):
    told, nodes = S.summary_tree(table(spark, ["a"]).where("doc_id > 0"), Short(), 40)
    assert told.count() == 0 and nodes.count() == 0
