"""Column expressions for numbers, completeness and reproducible hashing."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def finite_or_null(value: Column) -> Column:
    """NULL for NaN and both infinities."""
    return F.when(~F.isnan(value) & (F.abs(value) != F.lit(float("inf"))), value)


def filled_count(columns: list[str]) -> Column:
    """How many of ``columns`` are not NULL in the row."""
    return reduce(add, [F.when(F.col(c).isNotNull(), 1).otherwise(0) for c in columns])


def hex_word(text: Column, word: int) -> Column:
    """The 32-bit word number ``word`` (0..3) of the MD5 of ``text``, as a bigint."""
    return F.conv(F.substring(F.md5(text), 8 * word + 1, 8), 16, 10).cast("bigint")


def row_hash(keys: list[str], seed: int) -> Column:
    """A 32-bit hash of the key values: a pure function of the row and the seed."""
    return hex_word(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))), 0)
