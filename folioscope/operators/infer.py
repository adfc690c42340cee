"""Batch inference: prompts through a generator plug-in, and whole question-answer runs."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope import plugins, workspace
from folioscope.operators import conversation as C
from folioscope.operators.arrow import add_columns
from folioscope.operators.embed import embed_questions
from folioscope.operators.retrieve import DOC_LIMIT, hit_projection, topk_batch

# What a generator is asked for unless the caller says otherwise.
CHAT_TEMPERATURE = 0.8
FACTUAL_TEMPERATURE = 0.0
MODEL = "llama3.1"

_FIELDS = [T.StructField(name, T.StringType()) for name in ("response", "status", "error")]


def generate_batch(
    df: DataFrame,
    generator: plugins.Generator,
    model: str = MODEL,
    temperature: float = CHAT_TEMPERATURE,
    prompt: str = "prompt",
) -> DataFrame:
    """Add response, status and error.

    A prompt that fails marks its own row: ``error`` when the generator raises,
    ``invalid`` when it returns no text, otherwise ``ok``.  A null prompt is ``not_asked``.
    """
    shipped = plugins.Shipped(generator)

    def prepare():
        writer = plugins.start(shipped)

        def one(text):
            if text is None:
                return None, "not_asked", None
            try:
                answer = writer.generate(text, model, temperature)
            except Exception as error:
                return None, "error", f"{type(error).__name__}: {error}"
            if not isinstance(answer, str):
                return None, "invalid", None
            return answer, "ok", None

        def compute(batch):
            rows = [one(text) for text in batch.column(0).to_pylist()]
            return [pa.array([r[i] for r in rows], pa.string()) for i in range(3)]

        return compute

    return add_columns(df, [prompt], _FIELDS, prepare)


def generation_status(generated: DataFrame) -> DataFrame:
    return generated.groupBy("status").agg(F.count(F.lit(1)).alias("n_prompts"))


def summarize_documents(
    docs: DataFrame,
    generator: plugins.Generator,
    model: str = MODEL,
    language: str = C.SUMMARY_LANGUAGE,
    template: str = C.SUMMARY_TEMPLATE,
    context_chars: int | None = C.X.DEFAULT_CONTEXT_CHARS,
) -> DataFrame:
    """Add ``summary``, ``truncated``, status and error; the prompt is not kept.

    Whole documents are summarised unless ``context_chars`` sets a limit.
    """
    prompt = C.summary_prompt("content", language, template, context_chars)
    asked = docs.withColumn("_prompt", prompt)
    told = generate_batch(asked, generator, model, FACTUAL_TEMPERATURE, "_prompt")
    summary = F.when(F.col("status") == "ok", C.clean_answer("response", "lines"))
    cut = F.coalesce(C.X.was_truncated("content", context_chars), F.lit(False))
    return told.withColumns({"summary": summary, "truncated": cut}).drop("_prompt", "response")


def answer_prompts(
    turns: DataFrame,
    chunks: DataFrame,
    encoder: plugins.Encoder,
    k: int = DOC_LIMIT,
    ids: Sequence[str] = ("doc_id", "chunk_number"),
    layout: C.Layout = C.RETRIEVAL,
) -> DataFrame:
    """One row per user turn: conv_id, turn, question, prompt; null without documents.

    ``chunks`` has the ids, content and embedding.
    """
    key = ["conv_id", "turn"]
    asked = C.questions(C.history(turns, layout))
    hits = question_hits(turns, chunks, encoder, k, ids)
    context = C.context_block(hit_projection(hits, chunks, ids), key)
    joined = asked.join(context, key, "left")
    prompt = C.answer_prompt("history", "question", "context", layout)
    return joined.select(*key, "question", prompt.alias("prompt"))


def question_hits(
    turns: DataFrame,
    chunks: DataFrame,
    encoder: plugins.Encoder,
    k: int = DOC_LIMIT,
    ids: Sequence[str] = ("doc_id", "chunk_number"),
) -> DataFrame:
    """The nearest chunks of every user turn: conv_id, turn, rank, ids, score."""
    asked = turns.where(F.col("role") == "user").select(
        F.struct("conv_id", "turn").alias("qid"), F.coalesce("text", F.lit("")).alias("question")
    )
    # Stored, so that every question is encoded once however often the search reads it.
    embedded = workspace.materialize(embed_questions(asked, encoder), "questions")
    hits = topk_batch(embedded, chunks, encoder.dims, k, "qid", ids)
    return hits.select("qid.conv_id", "qid.turn", "rank", *ids, "score")


def answer_questions(
    turns: DataFrame,
    chunks: DataFrame,
    encoder: plugins.Encoder,
    generator: plugins.Generator,
    k: int = DOC_LIMIT,
    model: str = MODEL,
    ids: Sequence[str] = ("doc_id", "chunk_number"),
    layout: C.Layout = C.RETRIEVAL,
) -> DataFrame:
    """Answer every user turn: conv_id, turn, question, answer, status, error.

    A question without documents is reported as ``no_documents`` and not asked.
    """
    prompts = answer_prompts(turns, chunks, encoder, k, ids, layout)
    told = generate_batch(prompts, generator, model, FACTUAL_TEMPERATURE)
    answer = F.when(F.col("status") == "ok", C.clean_answer("response", layout.answer))
    status = F.when(F.col("prompt").isNull(), "no_documents").otherwise(F.col("status"))
    return told.select(
        "conv_id",
        "turn",
        "question",
        answer.alias("answer"),
        status.alias("status"),
        "error",
    )
