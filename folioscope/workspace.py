"""Where intermediate tables live: the shared folder named by ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def work_root(spark: SparkSession) -> str:
    """The shared folder of this session.

    A local session that names none gets a temporary one.  A cluster session must name
    one, because a folder of one machine is lost with that machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="folioscope-"))
    return context.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A folder name under the shared folder that nobody has used."""
    return f"{work_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, folder: str) -> DataFrame:
    """Write a table and read it back: the lineage ends at files that outlive executors."""
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    return stored(df, new_folder(df.sparkSession, purpose))
