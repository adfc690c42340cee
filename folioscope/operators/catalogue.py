"""What a collection does not answer, and how answers compare with a catalogue of good ones."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope import workspace
from folioscope.functions import tokens as K

# Cosine plus one below which the best hit does not count as an answer.
LEAST_SCORE = 1.5


def unanswered(
    questions: DataFrame, hits: DataFrame, key: Sequence[str], least: float = LEAST_SCORE
) -> DataFrame:
    """The rows of ``questions`` to be looked into, with ``best_score`` and ``reason``.

    ``hits`` has the key and ``score``.  A question without hits is ``no_documents``, one whose
    best score is below ``least`` is ``low_score``.  Hits shrink to one row per question and
    task before they are shuffled.
    """
    best = hits.groupBy(*key).agg(F.max("score").alias("best_score"))
    known = questions.join(best, list(key), "left")
    reason = F.when(F.col("best_score").isNull(), "no_documents").when(
        F.col("best_score") < least, "low_score"
    )
    return known.withColumn("reason", reason).where("reason IS NOT NULL")


def common_length(one: Sequence[str], two: Sequence[str]) -> int:
    """Length of the longest common subsequence.

    Row by row of the table of prefixes, a whole row as the bits of one number: a bit is zero
    where the length grows by one.
    """
    places: dict[str, int] = {}
    for at, word in enumerate(one):
        places[word] = places.get(word, 0) | 1 << at
    full = (1 << len(one)) - 1
    row = full
    for word in two:
        met = row & places.get(word, 0)
        row = ((row + met) | (row - met)) & full
    return len(one) - row.bit_count()


def grade_answers(
    answers: DataFrame,
    catalogue: DataFrame,
    item: str = "item_id",
    answer: str = "answer",
    good: str = "text",
) -> DataFrame:
    """``answers`` with ``n_common`` and ``overlap`` of the best good answer to its item.

    Words are those of the default tokenizer in lower case; ``n_common`` is the length of
    their longest common subsequence and ``overlap`` twice that over both lengths.  An item
    may have several good answers; one with the largest overlap counts.  Answers to unknown
    items have nulls, empty and null answers an overlap of 0.
    """
    # Stored, so that a row that is computed again keeps its number.
    given = workspace.materialize(answers, "answers")
    given = given.withColumn("_row", F.monotonically_increasing_id())
    known = catalogue.select(
        F.col(item), K.tokenize(F.lower(F.coalesce(F.col(good), F.lit("")))).alias("_good")
    )
    words = K.tokenize(F.lower(F.coalesce(F.col(answer), F.lit(""))))
    pairs = given.withColumn("_given", words).join(known, item, "left")

    def compare(batches):
        for batch in batches:
            own, model = (batch.column(batch.schema.get_field_index(c)) for c in ("_given", "_good"))
            common = [
                None if b is None else common_length(a, b)
                for a, b in zip(own.to_pylist(), model.to_pylist(), strict=True)
            ]
            yield batch.append_column("_common", pa.array(common, pa.int64()))

    schema = T.StructType([*pairs.schema.fields, T.StructField("_common", T.LongType())])
    matched = pairs.mapInArrow(compare, schema)
    both = F.size("_given") + F.size("_good")
    overlap = F.when(both > 0, 2 * F.col("_common") / both).otherwise(F.lit(0.0))
    overlap = F.when(F.col("_common").isNotNull(), overlap)
    kept = F.struct(*(F.col(c) for c in answers.columns))
    best = matched.groupBy("_row").agg(
        F.max(F.struct(overlap.alias("overlap"), F.col("_common").alias("n_common"))).alias("_best"),
        F.any_value(kept).alias("_answer"),
    )
    return best.select("_answer.*", "_best.n_common", "_best.overlap")
