"""Arrow-batched Python functions that add columns to a DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def add_columns(
    df: DataFrame,
    inputs: Sequence[str],
    fields: Sequence[T.StructField],
    prepare: Callable[[], Callable[[pa.RecordBatch], Sequence[pa.Array]]],
) -> DataFrame:
    """Append ``fields``; ``prepare`` runs once per task and returns the batch function.

    Only the columns ``inputs`` go to Python, as batches of just these; all others stay in
    the JVM.  The function counts as one that may answer differently each time, so Spark
    neither repeats it nor moves filters on its results in front of it.
    """
    names = [f.name for f in fields]
    # A result is a row of its own until its fields are taken out of it.
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields])

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        compute = prepare()
        for rows in batches:
            batch = pa.RecordBatch.from_arrays(rows.flatten(), names=list(inputs))
            yield pa.StructArray.from_arrays(list(compute(batch)), names=names)

    added = F.arrow_udf(run, schema).asNondeterministic()
    column = "_added"
    while column in df.columns:
        column += "_"
    told = df.withColumn(column, added(F.struct(*(df[name] for name in inputs))))
    return told.select(*(df[name] for name in df.columns), *(f"{column}.{n}" for n in names))
