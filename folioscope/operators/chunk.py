"""Documents to fixed-length token chunks: one stage without a shuffle."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope import plugins
from folioscope.functions import tokens as K
from folioscope.functions.text import content_length

CHUNK_TOKENS = 512


def skip_empty_docs(docs: DataFrame, content: str = "content") -> DataFrame:
    return docs.where(F.col(content) != "")


def chunk_documents(
    docs: DataFrame,
    chunk_tokens: int = CHUNK_TOKENS,
    tokenizer: plugins.Tokenizer | None = None,
    clean_up: bool = True,
) -> DataFrame:
    """One row per chunk, numbered from 1, with every other column of its document.

    Without a tokenizer plug-in the tokens are the words between whitespace and all work
    stays on the JVM.
    """
    if chunk_tokens < 1:
        raise ValueError("chunk_tokens must be at least 1")
    docs = docs.drop("content_length", "chunk_number")
    carried = [name for name in docs.columns if name != "content"]
    full = skip_empty_docs(docs)
    if tokenizer is None:
        pieces = _native_chunks(full, carried, chunk_tokens, clean_up)
    else:
        pieces = _plugin_chunks(full, carried, chunk_tokens, tokenizer)
    return pieces.withColumn("content_length", content_length("content"))


def token_runs(docs: DataFrame, chunk_tokens: int, content: str = "content") -> DataFrame:
    """One row per run of tokens: the document's other columns, chunk_number and tokens."""
    carried = [name for name in docs.columns if name != content]
    tokenized = docs.withColumn("_tokens", K.tokenize(content))
    return tokenized.select(
        *carried, F.posexplode(K.fixed_chunks("_tokens", chunk_tokens)).alias("_pos", "tokens")
    ).select(*carried, (F.col("_pos") + 1).alias("chunk_number"), "tokens")


def _native_chunks(docs, carried, chunk_tokens, clean_up):
    runs = token_runs(docs, chunk_tokens)
    return runs.select(*carried, "chunk_number", K.detokenize("tokens", clean_up).alias("content"))


def _plugin_chunks(docs, carried, chunk_tokens, tokenizer):
    docs = docs.select(*carried, "content")
    schema = T.StructType(
        docs.schema.fields[:-1]
        + [T.StructField("chunk_number", T.IntegerType()), T.StructField("content", T.StringType())]
    )
    names = schema.names
    shipped = plugins.Shipped(tokenizer)

    def run(batches):
        cutter = plugins.start(shipped)
        for batch in batches:
            parents, numbers, texts = [], [], []
            for parent, text in enumerate(batch.column(len(carried)).to_pylist()):
                tokens = cutter.encode(text)
                for number, start in enumerate(range(0, len(tokens), chunk_tokens), 1):
                    parents.append(parent)
                    numbers.append(number)
                    texts.append(cutter.decode(tokens[start : start + chunk_tokens]))
            kept = batch.take(pa.array(parents, pa.int64()))
            columns = [kept.column(i) for i in range(len(carried))]
            columns += [pa.array(numbers, pa.int32()), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, schema)


def chunk_counts(chunks: DataFrame, key: str = "doc_id") -> DataFrame:
    return chunks.groupBy(key).agg(F.count(F.lit(1)).alias("n_chunks"))
