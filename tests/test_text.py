"""Text scalars against what Python does with the same strings."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioscope.functions import text as X
from folioscope.functions import tokens as K

ODD = [
    "",
    " ",
    "\r\n\r\n",
    "\x0b",
    "\x1c",
    "\x85",
    "\xa0",
    " ",
    "　",
    "​",
    "a\n\nb",
    "a\n\n\nb",
    "a\n\n\n\nb",
    " a\r\n \x0b b\x1c\x1d\x85c   ",
    "\U0001f600 x",
    "a\rb\r\n\nc\n",
    "one  two\tthree four",
]


def column(spark, values, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[0] for r in rows.orderBy("i").select(expression).collect()]


def lines(text):
    return "\n".join(line for line in text.splitlines() if line.strip())


def check(spark, values):
    assert column(spark, values, X.strip_text("t")) == [v.strip() for v in values]
    assert column(spark, values, X.remove_blank_lines("t")) == [lines(v) for v in values]
    assert column(spark, values, X.collapse_newlines("t")) == [
        v.replace("\n\n", "\n") for v in values
    ]
    assert column(spark, values, X.content_length("t")) == [len(v) for v in values]
    assert column(spark, values, K.tokenize("t")) == [v.split() for v in values]


def test_odd_whitespace(spark):
    check(spark, ODD)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="ab.\n\r\t \x0b\x0c\x1c\x1e\x1f\x85\xa0 　é"), min_size=40))
def test_random_whitespace(spark, values):
    check(spark, values)


def test_null_text(spark):
    assert column(spark, [None], X.remove_blank_lines("t")) == [""]
    assert column(spark, [None], X.default_empty("t")) == [""]
    assert column(spark, [None], K.tokenize("t")) == [None]


def test_truncation(spark):
    values = ["abc", "abcd", "\U0001f600bcde"]
    assert column(spark, values, X.truncate_chars("t", 3)) == ["abc", "abc", "\U0001f600bc"]
    assert column(spark, values, X.was_truncated("t", 3)) == [False, True, True]


def test_paths(spark):
    import os.path

    values = ["/a/b.txt", "b", "/b", "//b", "/a//b", "a/", "", "/"]
    assert column(spark, values, X.base_name("t")) == [os.path.basename(v) for v in values]
    assert column(spark, values, X.dir_name("t")) == [os.path.dirname(v) for v in values]


def test_exit(spark):
    values = ["exit", " EXIT ", "exit now", "Exit"]
    assert column(spark, values, X.exit_predicate("t", "strip")) == [True, True, False, True]
    assert column(spark, values, X.exit_predicate("t", "exact")) == [True, False, False, True]
    assert column(spark, values, X.exit_predicate("t", "none")) == [False] * 4
    with pytest.raises(ValueError):
        X.exit_predicate("t", "other")


def test_template_is_filled_once(spark):
    filled = X.render_template("{language}: {text} {{x}}", language="de", text=F.col("t"))
    assert column(spark, ["see {language}"], filled) == ["de: see {language} {x}"]


def test_template_with_unknown_placeholder():
    with pytest.raises(KeyError):
        X.render_template("{text} {name}", text="x")


def test_pad_truncate(spark):
    padded = column(spark, ["a b c", "a", ""], K.pad_truncate(K.tokenize("t"), 2))
    assert padded == [["a", "b"], ["a", "<pad>"], ["<pad>", "<pad>"]]


def test_detokenize_tidies_blanks(spark):
    text = "Stop . Why ? I do n't , he 's ' in ' !"
    tidy = "Stop. Why? I don't, he's'in '!"
    assert column(spark, [text], K.detokenize(K.tokenize("t"))) == [tidy]
    assert column(spark, [text], K.detokenize(K.tokenize("t"), clean_up=False)) == [text]
