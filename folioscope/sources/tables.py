"""Stored tables: scan, create or replace, append, upsert, existence checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope import workspace

SPREAD_SPLITS = 64


def scan_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Every row of a Parquet table; name the columns to read only those."""
    table = spark.read.parquet(path)
    return table.select(*columns) if columns else table


def spread(table: DataFrame) -> DataFrame:
    """Deal out a small table, stored in fewer splits than there are cores, to all cores.

    Meant for scans in front of heavy work.  Tables of ``SPREAD_SPLITS`` splits or more
    are left as they are, so what moves is bounded whatever the size of the cluster.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    few = table.rdd.getNumPartitions() < min(cores, SPREAD_SPLITS)
    return table.repartition(cores) if few else table


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns, order and types of ``schema``; columns that ``df`` lacks become null."""
    return df.select(
        *(
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        )
    )


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether Parquet files are there; a folder without any is no table."""
    try:
        spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return True


def require_table(spark: SparkSession, path: str) -> None:
    if not table_exists(spark, path):
        raise FileNotFoundError(f"table {path} does not exist")


def create_or_replace(
    df: DataFrame, path: str, schema: T.StructType | None = None, replace: bool = False
) -> None:
    """Write a typed table.  An existing one is replaced with consent, else it is an error."""
    typed = conform(df, schema) if schema else df
    typed.write.mode("overwrite" if replace else "errorifexists").parquet(path)


def append_docs(df: DataFrame, path: str, schema: T.StructType | None = None) -> None:
    typed = conform(df, schema) if schema else df
    typed.write.mode("append").parquet(path)


def bulk_append(
    df: DataFrame,
    path: str,
    schema: T.StructType | None = None,
    max_records_per_file: int = 1_000_000,
) -> None:
    """Append with bounded files; each task writes its own rows, nothing is shuffled."""
    typed = conform(df, schema) if schema else df
    writer = typed.write.mode("append").option("maxRecordsPerFile", max_records_per_file)
    writer.parquet(path)


def _last_by_id(new: DataFrame, ids: Sequence[str], order: str | None) -> DataFrame:
    """One row per id: that with the largest ``order``; without ``order`` ids must be unique."""
    if order is None:
        twice = new.groupBy(*ids).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").first()
        if twice is not None:
            shown = ", ".join(f"{c} {twice[c]!r}" for c in ids)
            raise ValueError(f"{twice['_n']} new rows with {shown}; name a column to order them")
        return new
    whole = F.struct(F.col(order).alias("_order"), *(F.col(c) for c in new.columns))
    last = new.groupBy(*(F.col(c).alias(f"_{c}") for c in ids)).agg(F.max(whole).alias("_new"))
    return last.select(*(F.col("_new")[c].alias(c) for c in new.columns))


def upsert_by_id(
    old: DataFrame, new: DataFrame, ids: Sequence[str], order: str | None = None
) -> DataFrame:
    """The next version of a table: rows of ``new`` replace those of ``old`` with their id.

    Of several new rows with one id that with the largest ``order`` stays; without ``order``
    they are an error, found before anything is written.  Write the result to a new path, or
    keep the table in buckets (``upsert_buckets``) if few rows change.  When every row
    changes, adding a column is cheaper.
    """
    new = _last_by_id(new, ids, order)
    kept = old.join(new.select(*ids), list(ids), "left_anti")
    return kept.select(*old.columns).unionByName(new, allowMissingColumns=True)


# The folder that a row of a bucketed table is in, by the hash of its id.
BUCKET = "_bucket"


def _bucket(ids: Sequence[str], n_buckets: int) -> Column:
    return F.pmod(F.xxhash64(*ids), F.lit(n_buckets)).cast("int").alias(BUCKET)


def create_buckets(df: DataFrame, path: str, ids: Sequence[str], n_buckets: int) -> None:
    """Write a table for ``upsert_buckets``, one folder per bucket of ids."""
    dealt = df.select("*", _bucket(ids, n_buckets)).repartition(n_buckets, BUCKET)
    dealt.write.partitionBy(BUCKET).parquet(path)


def upsert_buckets(
    new: DataFrame, path: str, ids: Sequence[str], n_buckets: int, order: str | None = None
) -> list[int]:
    """Replace and add rows of a table in buckets; the buckets that were written anew.

    Only buckets that get a row are read, merged with their new rows, stored aside and put
    in place of the old ones; all other folders stay as they are.  ``n_buckets`` is that of
    the table.  Columns that only one side has become null on the other; read a table that
    got columns with ``mergeSchema``.  Repeated new ids are treated as in ``upsert_by_id``.
    """
    spark = new.sparkSession
    new = workspace.materialize(new.select("*", _bucket(ids, n_buckets)), "new-rows")
    touched = sorted(r[0] for r in new.select(BUCKET).distinct().collect())  # n_buckets at most
    if not touched:
        return []
    old = spark.read.parquet(path)
    merged = upsert_by_id(old.where(F.col(BUCKET).isin(touched)), new, ids, order)
    merged = workspace.materialize(merged, "merged")
    dealt = merged.repartition(len(touched), BUCKET)
    writer = dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(BUCKET).parquet(path)
    return touched
