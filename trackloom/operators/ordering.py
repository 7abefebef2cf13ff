"""Positions and running totals over a global order, without a single-task window.

The rows are range partitioned and sorted, written once, and each partition's
own positions are shifted by the totals of the partitions before it. What
reaches the driver is one number per partition.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackloom.session import materialize

_PART = "_part"
_LOCAL = "_local"
# monotonically_increasing_id() keeps the row's index in the low 33 bits.
_ROW_MASK = (1 << 33) - 1


def _spread(df: DataFrame, order: list[str], partitions: int | None) -> DataFrame:
    ranges = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    return ranges.sortWithinPartitions(*order)


def _shifted(placed: DataFrame, sizes: DataFrame, output: str) -> DataFrame:
    """Add the sum of all earlier partitions; ``sizes`` has one row per partition."""
    totals = sorted((row[_PART], row["size"]) for row in sizes.collect())
    starts = [0, *accumulate(size for _, size in totals)]
    offsets = placed.sparkSession.createDataFrame(
        [(part, start) for (part, _), start in zip(totals, starts)], f"{_PART} int, _start bigint"
    )
    # One row per partition of this job, hence small whatever the size of the data.
    joined = placed.join(F.broadcast(offsets), _PART)
    return joined.withColumn(output, F.col("_start") + F.col(_LOCAL)).drop(_PART, _LOCAL, "_start")


def with_position(df: DataFrame, order: list[str], output: str, partitions: int | None = None) -> DataFrame:
    """Add the zero-based position of each row in ``order``, which must be unique per row."""
    placed = materialize(
        _spread(df, order, partitions)
        .withColumn(_PART, F.spark_partition_id())
        .withColumn(_LOCAL, F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_MASK))),
        f"position-{output}",
    )
    sizes = placed.groupBy(_PART).agg(F.count("*").alias("size"))
    return _shifted(placed, sizes, output)


def with_running_total(
    df: DataFrame, order: list[str], weight: str, output: str, partitions: int | None = None
) -> DataFrame:
    """Add the total of ``weight`` over all rows up to and including this one in ``order``."""
    placed = materialize(
        _spread(df, order, partitions).withColumn(_PART, F.spark_partition_id()), f"total-{output}"
    )
    sizes = placed.groupBy(_PART).agg(F.sum(weight).alias("size"))
    within = Window.partitionBy(_PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return _shifted(placed.withColumn(_LOCAL, F.sum(weight).over(within)), sizes, output)


def dense_ids(df: DataFrame, columns: list[str], output: str) -> DataFrame:
    """Distinct values of ``columns`` numbered 0, 1, 2, ... in sorted order, as ints."""
    numbered = with_position(df.select(*columns).distinct(), columns, output)
    return numbered.withColumn(output, F.col(output).cast("int"))
