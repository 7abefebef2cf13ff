"""Mixing sources to target weights by Sainte-Laguë apportionment.

All sizes are words. The mix is cut into blocks of equal size, which go to the sources by
the highest quotients target / 1, target / 3, target / 5, ...; a source's blocks go to its
shards by the same rule, by shard size. A shard takes whole passes over its documents as
often as its quota allows and fills the rest from them in a seeded order, so reruns agree.

Only quotients that can decide are ranked: the final divisor lies so near total / blocks
that all but about four quotients per party are certain (see ``apportion``).

Documents without words have size 0 and take nothing. A null source is a source of its
own, the last. Repeated doc_ids are documents of their own. Everything is built of
DataFrame functions; nothing runs in Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackloom.session import materialize

WEIGHTS = (5, 2, 1)
LIMIT = 3
BLOCK = 16
SHARD = 4096  # documents of a shard, about
SEED = "mix-1"
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """Add weight and target to rows of ``source_key``, ``source`` and ``source_size``.

    There is one row per source; the windows run over these rows only. Sources are filled
    in the order of size / weight: one whose limit lies under its share is capped, and the
    first that is not sets the level for the rest.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(weights)
    weighed = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), place + 1))
    by_level = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy(F.lit(1))
    capacity = F.col("source_size") * limit
    levels = (
        weighed.withColumn("_total", F.sum("source_size").over(whole))
        .withColumn("_level", (F.col("_total") - F.coalesce(F.sum(capacity).over(before), F.lit(0))) / F.sum("weight").over(after))
        .withColumn("_rank", F.row_number().over(by_level))
        .withColumn("_open", capacity > F.col("_level") * F.col("weight"))
    )
    level = F.min_by("_level", F.when(F.col("_open"), F.col("_rank"))).over(whole)
    target = F.when(F.col("_open"), level * F.col("weight")).otherwise(capacity.cast("double"))
    return levels.withColumn("target", target).drop("_level", "_rank", "_open")


def apportion(parties: DataFrame, group: str, name: str, weight: str, seats: str, output: str) -> DataFrame:
    """Add to each party its seats of its group, by the highest quotients weight / (2k - 1).

    ``seats`` is the group's number of seats. A divisor d gives round(w / d) seats each, so
    all seats together differ from total / d by at most half a seat per party; hence total / d
    is within m / 2 of the number of seats, for m parties, and a party's own quota within its
    share of m / 2. Seats under that range are certain; the quotients in it are ranked. Ties
    go to the smaller ``name``.
    """
    every = Window.partitionBy(group)
    quota = F.col("_share") * F.col(seats)
    slack = F.col("_share") * F.col("_parties") / 2
    ranged = (
        parties.withColumn("_parties", F.count("*").over(every))
        .withColumn("_all", F.sum(weight).over(every))
        .withColumn("_share", F.coalesce(F.col(weight) / F.nullif("_all", F.lit(0.0)), F.lit(0.0)))
        .withColumn("_sure", F.greatest(F.lit(0), F.floor(quota - slack - 1)).cast("long"))
        .withColumn("_most", F.ceil(quota + slack + 1).cast("long"))
        .withColumn("_left", F.col(seats) - F.sum("_sure").over(every))
    )
    best = Window.partitionBy(group).orderBy(F.desc("_quotient"), name, "_seat")
    won = (
        ranged.where(F.col(weight) > 0)
        .select(group, name, weight, "_left", F.explode(F.sequence(F.col("_sure") + 1, F.col("_most"))).alias("_seat"))
        .withColumn("_quotient", F.col(weight) / (2 * F.col("_seat") - 1))
        .withColumn("_place", F.row_number().over(best))
        .where("_place <= _left")
        .groupBy(group, name)
        .agg(F.count("*").alias("_won"))
    )
    return (
        ranged.join(won, [group, name], "left")
        .withColumn(output, F.col("_sure") + F.coalesce("_won", F.lit(0)))
        .drop("_parties", "_all", "_share", "_sure", "_most", "_left", "_won")
    )


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    limit: int = LIMIT,
    block: int = BLOCK,
    shard: int = SHARD,
    seed: str = SEED,
    keep: bool = False,
) -> DataFrame:
    """doc_id, size, source_size, target and taken for each document.

    With ``keep`` these follow the columns of ``docs`` (which they replace where names clash).
    """
    made = ["size", "source_size", "target", "taken"]
    extra = [c for c in docs.columns if keep and c not in (*made, "doc_id", "source")]
    packed = F.struct(*extra).alias("_kept") if extra else F.lit(None).cast("int").alias("_kept")
    code = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    sized = materialize(
        docs.select(
            "doc_id",
            "source",
            F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("source_key"),
            words(F.col("text")).alias("size"),
            code.alias("code"),
            packed,
        ),
        "sizes",
    )
    sources = sized.groupBy("source_key", "source").agg(
        F.sum("size").alias("source_size"), F.ceil(F.count("*") / shard).alias("shards")
    )
    aimed = (
        targets(sources, weights, limit)
        .withColumn("mix", F.lit(1))
        .withColumn("blocks", F.round(F.col("_total") / block).cast("long"))
    )
    served = materialize(
        apportion(aimed, "mix", "source_key", "target", "blocks", "source_blocks").select(
            "source_key", "source_size", "shards", "target", "source_blocks"
        ),
        "source-quotas",
    )
    number = F.conv(F.substring("code", 1, 8), 16, 10).cast("long")
    placed = sized.join(served, "source_key").withColumn("shard", F.pmod(number, F.col("shards")))
    shards = (
        placed.groupBy("source_key", "shard", "source_blocks")
        .agg(F.sum("size").alias("shard_size"))
        .withColumn("shard_weight", F.col("shard_size").cast("double"))
    )
    quotas = apportion(shards, "source_key", "shard", "shard_weight", "source_blocks", "shard_blocks").select(
        "source_key", "shard", "shard_size", (F.col("shard_blocks") * block).alias("quota")
    )
    order = Window.partitionBy("source_key", "shard").orderBy("code", "doc_id", "size")
    earlier = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    passes = F.floor(F.col("quota") / F.nullif("shard_size", F.lit(0)))
    rest = F.col("quota") - F.col("passes") * F.col("shard_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("earlier")))
    mixed = (
        placed.join(quotas, ["source_key", "shard"])
        .withColumn("earlier", earlier)
        .withColumn("passes", F.coalesce(passes, F.lit(0)))
        .withColumn("taken", F.least(F.col("passes") * F.col("size") + part, F.col("size") * limit).cast("long"))
    )
    if not keep:
        return mixed.select("doc_id", *made)
    whole = [F.col("_kept")[c].alias(c) if c in extra else F.col(c) for c in docs.columns if c not in made]
    return mixed.select(*whole, *made)
