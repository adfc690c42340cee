"""From raw documents to token ids: the stages of a training-data pipeline, in order.

Each stage reads what the one before has written and keeps the columns of ``documents``,
but for the last, which returns token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope import workspace
from folioscope.llm import decontaminate, pieces, repetition, setjoin, spread


def _counted(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of ``documents``, with ``n_chars`` of the text as it is now."""
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.length("text").cast("bigint"))
    return docs.select(*columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules on length and repetition; null and empty texts do not.

    Repeated rows stay or go together.  Here and in all stages, an empty table gives an empty
    result, and other columns are carried along whatever their names.
    """
    return repetition.keep_varied(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that stand on many sites; near copies are left to the next stage.

    Null texts stay null; a text of which nothing is left stays as an empty one.  Repeated
    rows are cleaned one by one.
    """
    return _counted(spread.without_wide_lines(docs), docs.columns)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each class of near copies.

    Null and empty texts are in no class and stay.  Rows without an id go if their class has
    one with an id; rows that share an id stay or go together.
    """
    return setjoin.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without benchmark passages; documents that mostly consist of them go.

    Null and empty texts stay.  Items without an id count like others; repeated rows, of
    documents or items, change nothing.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _counted(decontaminate.remove_benchmark(docs, benchmark), docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of a sampled segmentation of every text, seeded by the document's id.

    Null texts have null ids, empty ones an empty list; rows that repeat id and text
    have the same ids.
    """
    import public_tokenizers

    encoded = pieces.encode_sampled(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return encoded.withColumn("n_ids", F.size("ids").cast("bigint"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", jaccard_join),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding and decoding", token_ids),
]

# The last stage samples segmentations, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = workspace.materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
