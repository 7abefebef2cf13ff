"""Small helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.session import materialize


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def held_out(key: str, parts: int, held: int):
    """Rows whose crc32 of the id, as text, leaves ``held`` modulo ``parts``. A null id is held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % parts == held, F.lit(True))


def components(edges: DataFrame, a: str, b: str, hint: str | None = None) -> DataFrame:
    """Connected components: ``node`` and ``root``, its component's smallest node.

    Labels fall to the smallest among the neighbours and then to the label's own
    label, so that long chains halve each round. Every round is a table in the
    shared folder; only the number of changed labels reaches the driver. ``hint`` is that of
    the joins, else Catalyst decides by size what to broadcast.
    """

    def hinted(df: DataFrame) -> DataFrame:
        return df.hint(hint) if hint else df

    ends = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    both = materialize(ends.union(ends.select("v", "u")).distinct(), "edges")
    labels = materialize(
        both.groupBy("u").agg(F.min("v").alias("low")).select(F.col("u").alias("node"), F.least("u", "low").alias("root")),
        "labels",
    )
    while True:
        offered = (
            both.join(hinted(labels), both.v == labels.node)
            .groupBy("u")
            .agg(F.min("root").alias("offer"))
        )
        # The label's own node learns of a smaller label too: chains hook onto each other.
        hooks = (
            labels.join(hinted(offered), labels.node == offered.u)
            .select(F.col("root").alias("u"), "offer")
            .groupBy("u")
            .agg(F.min("offer").alias("offer"))
        )
        best = offered.union(hooks).groupBy("u").agg(F.min("offer").alias("offer"))
        lower = labels.join(hinted(best), labels.node == best.u, "left").select(
            "node", "root", F.least("root", "offer").alias("next")
        )
        jump = lower.select(F.col("node").alias("hop"), F.col("next").alias("far"))
        stepped = lower.join(hinted(jump), lower.next == jump.hop).select("node", "root", F.least("next", "far").alias("next"))
        stepped = materialize(stepped, "labels")
        changed = stepped.where("next <> root").limit(1).count()
        labels = stepped.select("node", F.col("next").alias("root"))
        if not changed:
            return labels
