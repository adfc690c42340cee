"""Vector expressions, all computed in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioscope.functions.text import as_column


def dot(left: Column | str, right: Column | str) -> Column:
    products = F.zip_with(
        as_column(left), as_column(right), lambda x, y: x.cast("double") * y.cast("double")
    )
    return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)


def norm(vector: Column | str) -> Column:
    return F.sqrt(dot(vector, vector))


def cosine_score(left: Column | str, right: Column | str) -> Column:
    """Cosine + 1.0, between 0 and 2; null when a side is missing, zero or of another size."""
    left, right = as_column(left), as_column(right)
    scale = norm(left) * norm(right)
    usable = (F.size(left) == F.size(right)) & (scale > 0)
    return F.when(usable, dot(left, right) / scale + 1.0)


def has_dims(vector: Column | str, dims: int) -> Column:
    """True for a vector of ``dims`` numbers, false for any other one, null included."""
    vector = as_column(vector)
    complete = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x))
    return F.coalesce((F.size(vector) == dims) & complete, F.lit(False))
