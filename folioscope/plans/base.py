"""The registry of queries, the tables they read and SQL shared by their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope import schemas
from folioscope.functions import tokens as K
from folioscope.sources.tables import conform, scan_table, spread
from folioscope.staging import bind

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and the DuckDB SQL that must give the same rows."""

    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    return scan_table(spark, f"{folder}/{name}.parquet", columns or None)


def spread_table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """A table in front of heavy work, on all cores even when it is one small file."""
    return spread(table(spark, folder, name, *columns))


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """The documents table in the schema of the document index."""
    rows = spread_table(spark, folder, "documents", "doc_id", "text", "lang", "source")
    shaped = rows.select(
        "doc_id",
        F.col("text").alias("content"),
        F.length("text").cast("bigint").alias("content_length"),
        F.concat(F.lit("doc"), "doc_id", F.lit(".txt")).alias("file_name"),
        F.col("source").alias("directory_path"),
        F.lit("").alias("title"),
        F.lit("").alias("author"),
        F.lit("").alias("keywords"),
        F.lit("text/plain").alias("content_type"),
        F.col("lang").alias("language"),
        F.array("source").alias("tags"),
    )
    return conform(shaped, schemas.DOCUMENTS)


# --- SQL -------------------------------------------------------------------------------

WS = r"[\t-\r\x1c-\x20\x{85}\p{Z}]"
LINE_BREAK = r"\r\n|[\n-\r\x1c-\x1e\x{85}\x{2028}\x{2029}]"


def sql_strip(text: str) -> str:
    return f"regexp_replace({text}, '^{WS}+|{WS}+$', '', 'g')"


def sql_blank_lines(text: str) -> str:
    lines = f"regexp_split_to_array({text}, '{LINE_BREAK}')"
    return f"array_to_string(list_filter({lines}, lambda l: {sql_strip('l')} <> ''), chr(10))"


def sql_collapse(text: str) -> str:
    return f"replace({text}, chr(10) || chr(10), chr(10))"


def sql_tokens(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '{WS}+'), lambda t: t <> '')"


def sql_detokenize(tokens: str) -> str:
    text = f"array_to_string({tokens}, ' ')"
    for mark in ".?!,":
        text = f"replace({text}, ' {mark}', '{mark}')"
    text = f"replace({text}, ' '' ', '''')"
    for ending in ("n''t", "''m", "''s", "''ve", "''re"):
        text = f"replace({text}, ' {ending}', '{ending}')"
    return text


def sql_runs(size: int, source: str = "documents", key: str = "doc_id", text: str = "text") -> str:
    """CTEs `t` (key, tok) and `runs` (key, chunk_number, tokens)."""
    return f"""
      t AS (SELECT {key}, {sql_tokens(text)} AS tok FROM {source} WHERE {text} <> ''),
      numbered AS (
        SELECT {key}, tok, unnest(range(0, CAST(ceil(len(tok) / {size}.0) AS BIGINT))) AS i
        FROM t WHERE len(tok) > 0),
      runs AS (
        SELECT {key}, i + 1 AS chunk_number, tok[i * {size} + 1 : (i + 1) * {size}] AS tokens
        FROM numbered)"""


def sql_vectors(source: str, keys: str, text: str, name: str, dims: int = 64) -> str:
    """CTE `name` (keys, vec): the hashing encoder's vectors as whole numbers, that is times
    512 and the number of windows of 512 tokens."""
    return f"""
      {name}_tok AS (
        SELECT {keys}, unnest({sql_tokens(text)}) AS tok FROM {source}),
      {name}_code AS (
        SELECT {keys}, CAST('0x' || substr(md5(tok), 1, 8) AS BIGINT) AS h FROM {name}_tok),
      {name}_sum AS (
        SELECT {keys}, h % {dims} AS dim,
               sum(CASE WHEN (h // {dims}) % 2 = 0 THEN 1 ELSE -1 END) AS s
        FROM {name}_code GROUP BY ALL),
      {name}_map AS (
        SELECT {keys}, map(list(dim), list(s)) AS m FROM {name}_sum GROUP BY ALL),
      {name} AS (
        SELECT {keys},
               list_transform(range(0, {dims}), lambda d: coalesce(m[d], 0)) AS vec
        FROM {name}_map)"""


def vector_text(vector: str, text: str):
    """A text's hashed vector as text, exact because its numbers are whole multiples of 1/512
    divided by the number of windows of 512 tokens."""
    windows = F.greatest(F.ceil(F.size(K.tokenize(text)) / F.lit(512)), F.lit(1))

    def whole(scale):
        numbers = F.transform(vector, lambda x: F.round(x.cast("double") * scale).cast("int"))
        return F.array_join(numbers.cast("array<string>"), ",")

    return bind(windows * 512, whole)


SQL_VECTOR_TEXT = "array_to_string(list_transform(vec, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ',')"
