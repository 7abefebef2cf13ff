"""Row counts of the stages of a run."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stage_report(stages: dict[str, DataFrame], follows: dict[str, str] | None = None) -> DataFrame:
    """stage_no, stage, n_rows, n_columns and rows removed since the stage before, as one relation.

    ``follows`` names the stage that each was made from; a stage it does not name removes
    nothing. Without it every stage follows the one listed before. Hand in stored
    relations: their counts come from the Parquet footers.
    """
    listed = list(stages)
    before = dict(zip(listed[1:], listed)) if follows is None else follows
    counts = [
        df.agg(F.count("*").alias("n_rows")).select(
            F.lit(i).alias("stage_no"),
            F.lit(name).alias("stage"),
            "n_rows",
            F.lit(len(df.columns)).alias("n_columns"),
            F.lit(before.get(name)).cast("string").alias("_from"),
        )
        for i, (name, df) in enumerate(stages.items())
    ]
    report = reduce(DataFrame.unionByName, counts)
    earlier = report.select(F.col("stage").alias("_from"), F.col("n_rows").alias("_before"))
    return (
        report.join(earlier, "_from", "left")
        .withColumn("n_removed", F.coalesce(F.col("_before") - F.col("n_rows"), F.lit(0)))
        .drop("_from", "_before")
    )
