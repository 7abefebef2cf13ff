"""One row per key, chosen by a total order so that every run keeps the same row.

``row_number() <= k`` lets Spark cut each group to ``k`` rows before the shuffle
(WindowGroupLimit), so a key that holds a large share of all rows sends at most
``k`` rows per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackloom.functions import values
from trackloom.operators.conform import TARGET_TYPES


def top_per_group(
    df: DataFrame, group: list[str], order: list[Column], k: int, rank: str | None = None
) -> DataFrame:
    """The first ``k`` rows of each group in ``order``; NULL keys form one group."""
    name = rank or "_rank"
    placed = df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    kept = placed.filter(F.col(name) <= k)
    return kept if rank else kept.drop(name)


def best_record(
    df: DataFrame, key: str = "track_id", rank_column: str = "source_rank", columns: list[str] | None = None
) -> DataFrame:
    """The best row per ``key``: one with an artist first, then the most complete.

    What is still tied goes to the earlier source and then to the smallest values.
    """
    columns = columns or [c for c in TARGET_TYPES if c != key]
    order = [
        # Only an empty name is none here; a blank one counts, as in the catalogues' own merge.
        F.nullif("artist_name", F.lit("")).isNotNull().desc(),
        values.filled_count(columns).desc(),
        F.col(rank_column).asc(),
        *[F.col(c).asc_nulls_last() for c in columns],
    ]
    return top_per_group(df, [key], order, 1).drop(rank_column)


def dedupe(df: DataFrame, subset: list[str], keep: list[str]) -> DataFrame:
    """One row per ``subset`` (NULLs equal): the smallest by ``keep``, which must be unique."""
    return top_per_group(df, subset, [F.col(c).asc_nulls_last() for c in keep], 1)
