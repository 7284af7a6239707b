"""Vector columns (``array<float>``); arithmetic is done in double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(left: Column, right: Column) -> Column:
    products = F.zip_with(left, right, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)


def norm(vector: Column) -> Column:
    return F.sqrt(dot(vector, vector))


def l2_normalize(vector: Column) -> Column:
    """Unit length; a zero vector stays zero."""
    length = norm(vector)
    unit = F.transform(vector, lambda x: (x / length).cast("float"))
    return F.when(length > 0, unit).otherwise(vector.cast("array<float>"))


def cosine(left: Column, right: Column) -> Column:
    lengths = norm(left) * norm(right)
    return F.when(lengths > 0, dot(left, right) / lengths).otherwise(F.lit(0.0))


def squared_l2(left: Column, right: Column) -> Column:
    squares = F.zip_with(
        left, right, lambda x, y: F.pow(x.cast("double") - y.cast("double"), F.lit(2.0))
    )
    return F.aggregate(squares, F.lit(0.0), lambda total, s: total + s)


def literal_vector(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])
