"""Summaries of documents that are longer than a prompt may be: a tree of part summaries.

A text is cut into parts that fit a prompt, every part is summarised, and the summaries of a
document, in order, are the text of the next level, until one part is left.  Every level is
one batch over all documents, stored before the next one starts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope import plugins, workspace
from folioscope.operators import conversation as C
from folioscope.operators.infer import FACTUAL_TEMPERATURE, MODEL, generate_batch

# Characters of text in one prompt.
BUDGET_CHARS = 12_000
BETWEEN = "\n\n"


def text_parts(texts: DataFrame, budget: int, at_blanks: bool = True) -> DataFrame:
    """``doc``, ``part`` and ``text``: pieces of at most ``budget`` characters, which joined
    give the text; an empty text is one empty piece.

    Pieces end behind white space where there is some within the budget, else (and without
    ``at_blanks``) where the budget ends.
    """
    if at_blanks:
        pattern = rf"(?s)(.{{1,{budget}}}(?:(?<=\s)|\z)|.{{1,{budget}}})"
        cut = F.regexp_extract_all("text", F.lit(pattern), 1)
    else:
        count = F.greatest(F.ceil(F.length("text") / F.lit(budget)), F.lit(1)).cast("int")
        cut = F.transform(
            F.sequence(F.lit(0), count - 1),
            lambda i: F.substring(F.col("text"), i * budget + 1, F.lit(budget)),
        )
    pieces = F.when(F.col("text") == "", F.array(F.lit(""))).otherwise(cut)
    return texts.select("doc", F.posexplode(pieces).alias("part", "text"))


def summary_tree(
    docs: DataFrame,
    generator: plugins.Generator,
    budget_chars: int = BUDGET_CHARS,
    doc_id: str = "doc_id",
    content: str = "content",
    model: str = MODEL,
    language: str = C.SUMMARY_LANGUAGE,
    template: str = C.SUMMARY_TEMPLATE,
    at_blanks: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """One summary per document, and the nodes that it was made from.

    Summaries have ``doc_id``, ``summary``, ``levels``, ``n_prompts``, ``n_failed`` and
    ``status``; nodes have ``doc_id``, ``level`` (0: parts of the document), ``part``,
    ``n_chars``, ``summary``, ``status`` and ``error``.  Every character of a document is in
    one prompt of level 0, and every summary in one of the next level.

    A part that fails marks its node and adds nothing to the next level; ``status`` is ``ok``,
    ``partial`` if parts have failed, ``failed`` if nothing came back, and ``no_progress`` if
    the summaries of a level are together as long as its text: such a document gets no
    summary instead of prompts without end.  A null text is an empty one.  Ids are unique.
    """
    texts = workspace.materialize(
        docs.select(docs[doc_id].alias("doc"), F.coalesce(docs[content], F.lit("")).alias("text")),
        "texts",
    )
    nodes, ends = [], []
    level = 0
    while True:
        parts = text_parts(texts, budget_chars, at_blanks)
        asked = parts.withColumn("_prompt", C.summary_prompt("text", language, template, None))
        told = generate_batch(asked, generator, model, FACTUAL_TEMPERATURE, "_prompt")
        answer = F.when(F.col("status") == "ok", C.clean_answer("response", "lines"))
        told = workspace.materialize(
            told.select(
                "doc",
                F.lit(level).alias("level"),
                F.col("part").cast("bigint").alias("part"),
                F.length("text").cast("bigint").alias("n_chars"),
                answer.alias("summary"),
                "status",
                "error",
            ),
            "summary-nodes",
        )
        nodes.append(told)
        # One document is one row: its summaries are shorter than its text, or it ends here.
        listed = F.array_sort(F.collect_list(F.struct("part", "summary")))
        joined = F.array_join(F.filter(listed["summary"], lambda s: s.isNotNull()), BETWEEN)
        folded = workspace.materialize(
            told.groupBy("doc").agg(
                joined.alias("text"),
                F.count(F.lit(1)).alias("n"),
                F.count("summary").alias("good"),
                F.sum("n_chars").alias("chars"),
            ),
            "summary-level",
        )
        open_ = "n > 1 AND good > 0 AND length(text) < chars"
        end = F.when(F.col("good") == 0, "failed").when(F.col("n") > 1, "no_progress")
        ends.append(
            folded.where(f"NOT ({open_})").select(
                "doc",
                F.when(end.isNull(), F.col("text")).alias("summary"),
                end.alias("end"),
                F.lit(level + 1).alias("levels"),
            )
        )
        texts = folded.where(open_).select("doc", "text")
        if not texts.limit(1).count():
            break
        level += 1
    every = reduce(DataFrame.unionByName, nodes)
    counts = every.groupBy("doc").agg(
        F.count(F.lit(1)).alias("n_prompts"),
        F.count_if(F.col("status") != "ok").alias("n_failed"),
    )
    partial = F.when(F.col("n_failed") > 0, "partial").otherwise("ok")
    summaries = reduce(DataFrame.unionByName, ends).join(counts, "doc").select(
        F.col("doc").alias(doc_id), "summary", "levels", "n_prompts", "n_failed",
        F.coalesce("end", partial).alias("status"),
    )
    return summaries, every.withColumnRenamed("doc", doc_id)
