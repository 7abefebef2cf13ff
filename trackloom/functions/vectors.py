"""Vector arithmetic on array columns, in double precision inside the JVM."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def _total(products: Column) -> Column:
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return _total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(
        _total(F.zip_with(a, b, lambda x, y: F.pow(x.cast("double") - y.cast("double"), F.lit(2.0))))
    )


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 when either vector has no length."""
    return F.coalesce(F.try_divide(dot(a, b), norm(a) * norm(b)), F.lit(0.0))


def assembled(columns: list[str]) -> Column:
    """The columns as one vector. A NULL is an error, as it would spoil every distance."""
    missing = reduce(or_, [F.col(c).isNull() for c in columns])
    vector = F.array(*[F.col(c).cast("double") for c in columns])
    return F.when(missing, F.raise_error(F.lit("NULL in a feature column")).cast("array<double>")).otherwise(vector)
