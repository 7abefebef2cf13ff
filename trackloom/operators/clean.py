"""Row filters and column repairs of the catalogue and record lanes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom.functions import names, values


def drop_incomplete(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows in which none of ``columns`` is NULL."""
    return df.dropna(subset=columns)


def in_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Rows whose value lies in [low, high]; a NULL value is dropped too."""
    return df.filter(F.col(column).between(low, high))


def fill_unknown_artist(df: DataFrame, column: str = "artist_name") -> DataFrame:
    return df.withColumn(column, names.or_unknown(F.col(column)))


def normalize_names(df: DataFrame, columns: tuple[str, ...] = ("track_name", "artist_name")) -> DataFrame:
    return df.withColumns({c: names.normalized(F.col(c)) for c in columns})


def sanitize(df: DataFrame, text: list[str] = (), numbers: list[str] = ()) -> DataFrame:
    """Trim text and turn blanks into NULL; turn NaN and infinities into NULL."""
    repairs = {c: names.blank_to_null(F.col(c)) for c in text}
    repairs |= {c: values.finite_or_null(F.col(c)) for c in numbers}
    return df.withColumns(repairs) if repairs else df
