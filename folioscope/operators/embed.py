"""Embedding vectors: encoding, pooling, dimension checks."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope import plugins, schemas
from folioscope.functions import tokens as K
from folioscope.functions import vectors as V
from folioscope.operators.arrow import add_columns

EMBED_TOKENS = 512


def embed_table(df: DataFrame, encoder: plugins.Encoder, text: str = "content") -> DataFrame:
    """Add ``embedding`` and its ``norm`` to every row with text; other rows get nulls.

    An empty text is embedded, a null one is not.  The encoder is started once per
    worker process and sees ``encoder.batch_size`` texts at a time.
    """
    shipped = plugins.Shipped(encoder)

    def prepare():
        model = plugins.start(shipped)

        def compute(batch):
            texts = batch.column(0).to_pylist()
            rows = [i for i, t in enumerate(texts) if t is not None]
            vectors = np.zeros((len(texts), model.dims), dtype=np.float32)
            for at in range(0, len(rows), model.batch_size):
                part = rows[at : at + model.batch_size]
                vectors[part] = model.encode([texts[i] for i in part])
            absent = np.ones(len(texts), dtype=bool)
            absent[rows] = False
            # A null entry repeats the offset before it.
            ends = np.cumsum(np.where(absent, 0, model.dims))
            offsets = np.concatenate([[0], ends]).astype(np.int32)
            values = pa.array(vectors[~absent].ravel(), pa.float32())
            lists = pa.ListArray.from_arrays(
                pa.array(offsets, pa.int32()), values, mask=pa.array(absent)
            )
            wide = vectors.astype(np.float64)
            norms = np.sqrt(np.einsum("ij,ij->i", wide, wide))
            return [lists, pa.array(norms, pa.float64(), mask=absent)]

        return compute

    return add_columns(df, [text], schemas.EMBEDDING_FIELDS, prepare)


def embed_questions(
    questions: DataFrame, encoder: plugins.Encoder, text: str = "question"
) -> DataFrame:
    """The same encoder and pooling as for chunks."""
    return embed_table(questions, encoder, text)


def pad_tokens(df: DataFrame, text: str, positions: int = EMBED_TOKENS) -> DataFrame:
    return df.withColumn("tokens", K.pad_truncate(K.tokenize(text), positions))


def encode_tokens(
    df: DataFrame, key: Sequence[str], text: str, dims: int, positions: int = EMBED_TOKENS
) -> DataFrame:
    """The hashing encoder as rows: key, windows, window, position, dim, value.

    Every token of a text is one row: its place is a position from 0 in one of the text's
    ``windows`` runs of ``positions`` tokens.  Empty positions have no row.
    """
    whole = df.select(*key, K.tokenize(text).alias("_tokens"))
    counted = whole.withColumn("windows", F.ceil(F.size("_tokens") / F.lit(positions)))
    placed = counted.select(*key, "windows", F.posexplode("_tokens").alias("_at", "_token"))
    coded = placed.withColumn("_code", K.hash_token("_token"))
    return coded.select(
        *key,
        "windows",
        F.expr(f"_at div {positions}").alias("window"),
        (F.col("_at") % positions).cast("bigint").alias("position"),
        K.hashed_dimension(F.col("_code"), dims).alias("dim"),
        K.hashed_sign(F.col("_code"), dims).alias("value"),
    )


def pool_positions(encoded: DataFrame, key: Sequence[str], positions: int = EMBED_TOKENS) -> DataFrame:
    """Mean over all positions of all windows, the empty ones included: key, dim, value.

    Zeros are left out.
    """
    mean = F.sum("value") / (F.max("windows") * float(positions))
    return encoded.groupBy(*key, "dim").agg(mean.alias("value")).where(F.col("value") != 0)


def mean_pool(df: DataFrame, key: str, vector: str, dims: int) -> DataFrame:
    """The mean vector of every group: key, mean; vectors of another size are left out.

    Each task ships one row per group and dimension it saw, however large the group.  The
    list put together per group has ``dims`` entries.
    """
    sized = df.where(F.size(vector) == dims)
    numbers = sized.select(key, F.posexplode(vector).alias("_dim", "_number"))
    means = numbers.groupBy(key, "_dim").agg(F.avg(F.col("_number").cast("double")).alias("_mean"))
    parts = F.array_sort(F.collect_list(F.struct("_dim", "_mean")))
    return means.groupBy(key).agg(F.transform(parts, lambda p: p["_mean"]).alias("mean"))


def check_dims(df: DataFrame, dims: int, vector: str = "embedding") -> tuple[DataFrame, DataFrame]:
    """Rows whose vector has ``dims`` numbers, and all the others."""
    fits = V.has_dims(vector, dims)
    return df.where(fits), df.where(~fits)
