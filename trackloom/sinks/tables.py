"""Table writers. Every task writes its own file; nothing is squeezed into one.

A table is written beside its place and takes it by renaming, so that a write that fails
leaves the old table as it was, and a table may be written from itself.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, DataFrameWriter

from trackloom.session import exists, move, remove


def _swapped(df: DataFrame, path: str, write) -> None:
    spark, place, run = df.sparkSession, path.rstrip("/"), uuid.uuid4().hex
    new, old = f"{place}._new-{run}", f"{place}._old-{run}"
    try:
        write(df.write, new)
        if exists(spark, place):
            move(spark, place, old)
        try:
            move(spark, new, place)
        except Exception:
            if exists(spark, old):
                move(spark, old, place)
            raise
    finally:
        for rest in (new, old):
            if exists(spark, rest):
                remove(spark, rest)


def write_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Replace the whole table at ``path``."""
    _swapped(df, path, lambda writer, place: writer.partitionBy(*partition_by).parquet(place))


def write_partitions(df: DataFrame, path: str, partition_by: tuple[str, ...]) -> None:
    """Replace the partitions that ``df`` has rows of; the others stay. Spark stages and renames them."""
    writer: DataFrameWriter = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header in each file, readable by :func:`trackloom.sources.tables.scan_csv`."""
    _swapped(df, path, lambda writer, place: writer.csv(place, header=True))
