"""Conversation history and prompts.

A conversation is a table of turns ``(conv_id, turn, role, text)`` with consecutive turn
numbers from 0 and the roles user, assistant and system.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.functions import text as X

# The wording of prompts and of the histories inside them.
SUMMARY_TEMPLATE = (
    "Summarize the following text in {language}. "
    "Two paragraphs will be enough:\n\n{text}\n\nSummary:"
)
DOCUMENT_SYSTEM_TEMPLATE = (
    "You are a helpful assistant and inform the user about the following document:\n\n"
    "{text}\n\nNow take the user's question."
)
CONTEXT_INTRODUCTION = "Answer the question based on the following information:\n\n"
QUESTION_REMINDER = ("Here is the question again: ", "\n\n")
CLOSING_INSTRUCTION = (
    "Answer the question naturally, in the user's language. "
    "If no question is asked, just keep the conversation going."
)
GREETING = "Assistant: Hallo, wie kann ich Ihnen helfen?\n\n"
SYSTEM_PROMPT = "You are a helpful assistant."
WELCOME_MESSAGE = "Willkommen beim RAG Chat"
USER_PREFIX = "Du sagst: "
BOT_PREFIX = "Antwort: "
SUMMARY_LANGUAGE = "deutsch"

# Turns per window; longer conversations are folded in blocks of this many.
FANOUT = 256


@dataclass(frozen=True)
class Layout:
    """How turns become history text."""

    opening: str
    user: tuple[str, str]
    assistant: tuple[str, str]
    system: tuple[str, str] | None = None
    answer: str = "raw"
    keep_failed_question: bool = False


CHAT = Layout(opening=GREETING, user=("User: ", "\n\n"), assistant=("Assistant: ", "\n\n"))
DOCUMENT_CHAT = Layout(
    opening="", user=("\nUser: ", "\n\n"), assistant=("Assistant: ", "\n"), answer="lines"
)


def retrieval_layout(
    system_prompt: str = SYSTEM_PROMPT,
    welcome: str = WELCOME_MESSAGE,
    user_prefix: str = USER_PREFIX,
    bot_prefix: str = BOT_PREFIX,
) -> Layout:
    return Layout(
        opening=f"{system_prompt}\n\n{bot_prefix}{welcome}\n\n",
        user=(user_prefix, "\n\n"),
        assistant=(bot_prefix, "\n\n"),
        system=("", "\n\n"),
        answer="collapse",
        keep_failed_question=True,
    )


RETRIEVAL = retrieval_layout()

CLEANERS = {
    "raw": X.default_empty,
    "lines": X.remove_blank_lines,
    "collapse": lambda text: X.collapse_newlines(X.default_empty(text)),
}


def clean_answer(text: Column | str, mode: str) -> Column:
    return CLEANERS[mode](text)


def with_answer(layout: Layout, answer: str) -> Layout:
    """The same layout with answers kept ``raw``, without blank ``lines`` or ``collapse``-d."""
    return replace(layout, answer=answer)


def cut_at_exit(turns: DataFrame, mode: str = "strip") -> DataFrame:
    """Drop the first exit turn of the user and all that follows it.

    The exit turn is a minimum per conversation, found before the shuffle.
    """
    exits = turns.where((F.col("role") == "user") & X.exit_predicate("text", mode))
    ends = exits.groupBy("conv_id").agg(F.min("turn").alias("_end"))
    kept = turns.join(ends, "conv_id", "left")
    return kept.where(F.col("_end").isNull() | (F.col("turn") < F.col("_end"))).drop("_end")


def turn_segments(turns: DataFrame, layout: Layout) -> DataFrame:
    """Add ``segment``: what a turn contributes to the history after it.

    Unless the layout keeps them, questions without an answer leave no trace; the answer
    is looked up as the next turn, a join on (conversation, turn) that no long
    conversation can skew.
    """

    def wrapped(marks: tuple[str, str], text: Column) -> Column:
        return F.concat(F.lit(marks[0]), text, F.lit(marks[1]))

    text = X.default_empty("text")
    question = wrapped(layout.user, text)
    if not layout.keep_failed_question:
        answers = turns.where(F.col("role") == "assistant").select(
            "conv_id", (F.col("turn") - 1).alias("turn"), F.lit(True).alias("_answered")
        )
        turns = turns.join(answers, ["conv_id", "turn"], "left")
        question = F.when(F.col("_answered"), question).otherwise("")
    segment = F.when(F.col("role") == "user", question).when(
        F.col("role") == "assistant", wrapped(layout.assistant, clean_answer("text", layout.answer))
    )
    if layout.system:
        segment = segment.when(F.col("role") == "system", wrapped(layout.system, text))
    return turns.withColumn("segment", segment.otherwise("")).drop("_answered")


def _earlier(text: str, key: Sequence[str], order: str) -> Column:
    window = Window.partitionBy(*key).orderBy(order)
    rows = window.rowsBetween(Window.unboundedPreceding, -1)
    return F.array_join(F.collect_list(text).over(rows), "")


def concat_before(
    df: DataFrame,
    key: Sequence[str],
    order: str,
    text: str,
    out: str,
    last: int,
    fanout: int = FANOUT,
) -> DataFrame:
    """Add ``out``: the texts of all earlier rows of the same key, joined in order.

    ``order`` counts from 0 and ends at ``last``.  No window holds more than ``fanout``
    rows: longer groups are cut into blocks, the blocks' texts are treated the same way,
    and every row puts the text before its block in front of the text before it in its
    block.
    """
    key = list(key)
    if last < fanout:
        return df.withColumn(out, _earlier(text, key, order))
    block = f"_block_{last}"
    cut = df.withColumn(block, F.floor(F.col(order) / F.lit(fanout)).cast("bigint"))
    parts = F.array_sort(F.collect_list(F.struct(F.col(order), F.col(text).alias("_text"))))
    blocks = cut.groupBy(*key, block).agg(
        F.array_join(F.transform(parts, lambda p: p["_text"]), "").alias("_whole")
    )
    before = concat_before(blocks, key, block, "_whole", "_before", last // fanout, fanout)
    inside = cut.withColumn("_inside", _earlier(text, [*key, block], order))
    joined = inside.join(before.select(*key, block, "_before"), [*key, block])
    whole = F.concat("_before", "_inside")
    return joined.withColumn(out, whole).select(*df.columns, out)


def history(turns: DataFrame, layout: Layout = RETRIEVAL, fanout: int = FANOUT) -> DataFrame:
    """Add ``history``: the opening and all earlier turns, with their role prefixes."""
    last = turns.agg(F.max("turn")).first()[0] or 0
    told = concat_before(
        turn_segments(turns, layout), ["conv_id"], "turn", "segment", "_told", last, fanout
    )
    return told.withColumn("history", F.concat(F.lit(layout.opening), "_told")).drop("_told")


def questions(told: DataFrame) -> DataFrame:
    """The user turns of a table with histories: conv_id, turn, question, history."""
    return told.where(F.col("role") == "user").select(
        "conv_id", "turn", X.default_empty("text").alias("question"), "history"
    )


def chat_prompt(history: Column | str, question: Column | str) -> Column:
    return F.concat(
        F.lit("\n"),
        X.as_column(history),
        F.lit("\nUser: "),
        X.as_column(question),
        F.lit("\n\nAssistant:\n"),
    )


def document_prompt(history: Column | str, question: Column | str) -> Column:
    """``history`` starts with the system text of the document."""
    return F.concat(
        F.lit("\n"),
        X.as_column(history),
        F.lit("\n\nUser: "),
        X.as_column(question),
        F.lit("\n\nAssistant:\n"),
    )


def document_system_text(
    document: Column | str,
    template: str = DOCUMENT_SYSTEM_TEMPLATE,
    context_chars: int | None = X.DEFAULT_CONTEXT_CHARS,
) -> Column:
    """The opening of a conversation about one document; its template may name {text}."""
    text = X.truncate_chars(X.default_empty(document), context_chars)
    return X.render_template(template, text=text)


def summary_prompt(
    document: Column | str,
    language: str = SUMMARY_LANGUAGE,
    template: str = SUMMARY_TEMPLATE,
    context_chars: int | None = X.DEFAULT_CONTEXT_CHARS,
) -> Column:
    """A template may name {language} and {text}."""
    text = X.truncate_chars(X.default_empty(document), context_chars)
    return X.render_template(template, language=language, text=text)


def document_prompts(
    turns: DataFrame,
    documents: DataFrame,
    context_chars: int | None = X.DEFAULT_CONTEXT_CHARS,
    template: str = DOCUMENT_SYSTEM_TEMPLATE,
) -> DataFrame:
    """One prompt per user turn of conversations about documents: with status.

    ``documents`` has conv_id and content, one row per conversation.  The status is ``ok``,
    ``truncated`` where ``context_chars`` cut the document, or ``no_document`` with a null
    prompt, which generation passes by.
    """
    asked = questions(history(turns, DOCUMENT_CHAT))
    long = F.lit(False) if context_chars is None else F.length("content") > context_chars
    system = documents.select(
        "conv_id",
        document_system_text("content", template, context_chars).alias("_system"),
        F.when(long, "truncated").otherwise("ok").alias("_status"),
    )
    joined = asked.join(system, "conv_id", "left")
    prompt = document_prompt(F.concat("_system", "history"), "question")
    status = F.coalesce("_status", F.lit("no_document"))
    return joined.select("conv_id", "turn", prompt.alias("prompt"), status.alias("status"))


def context_block(hits: DataFrame, key: Sequence[str], document: str = "document") -> DataFrame:
    """The retrieved documents of each question, numbered in rank order: key, context.

    A question has at most k hits, so its list is bounded.
    """
    ranked = F.array_sort(F.collect_list(F.struct("rank", F.col(document).alias("_text"))))
    shown = F.transform(
        ranked,
        lambda hit, i: F.concat(
            F.lit("Document "),
            (i + 1).cast("string"),
            F.lit(":\n"),
            hit["_text"],
            F.lit("\n\n"),
        ),
    )
    return hits.groupBy(*key).agg(F.array_join(shown, "").alias("context"))


def answer_prompt(
    history: Column | str,
    question: Column | str,
    context: Column | str,
    layout: Layout = RETRIEVAL,
) -> Column:
    """History with the current question, the documents, the question again, the closing."""
    question = X.as_column(question)
    return F.concat(
        X.as_column(history),
        F.lit(layout.user[0]),
        question,
        F.lit(layout.user[1]),
        F.lit(CONTEXT_INTRODUCTION),
        X.as_column(context),
        F.lit(QUESTION_REMINDER[0]),
        question,
        F.lit(QUESTION_REMINDER[1]),
        F.lit(CLOSING_INSTRUCTION),
    )
