"""Running sums over a sorted table that is spread over many tasks, and list ranking.

Both work on tables of any size: the driver sees one row per partition, or a count per round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom.session import materialize

RULERS = 8
SMALL = 2048
SALT = 0x5EED


def _running(group: str | None, columns: list[str], combine: np.ufunc):
    """Add each row's running value since its group began in this partition, and whether it began here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, key, first = TaskContext.get().partitionId(), None, True
        carry = np.zeros(len(columns), np.int64)
        began = False  # a group whose first row is not the partition's first began here
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            values = np.array([np.asarray(batch.column(c)) for c in columns], np.int64).reshape(len(columns), n)
            keys = np.asarray(batch.column(group)) if group else np.zeros(n, np.int64)
            new = np.flatnonzero(np.r_[not first and keys[0] != key, keys[1:] != keys[:-1]])
            sums = combine.accumulate(np.hstack([carry[:, None], values]), axis=1)[:, 1:]
            # What had run up before a group began is taken off again: both operations have an inverse.
            before = np.zeros((len(columns), n), np.int64)
            if len(new):
                ahead = np.where(new > 0, sums[:, new - 1], carry[:, None])
                before[:, new[0] :] = np.repeat(ahead, np.diff(np.r_[new, n]), axis=1)
            sums = sums - before if combine is np.add else sums ^ before
            here = np.full(n, began)
            if len(new):
                here[new[0] :] = True
            key, first, carry, began = keys[-1], False, sums[:, -1], bool(here[-1])
            extra = [*sums, np.full(n, part, np.int32), here]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *map(pa.array, extra)], names=[*batch.schema.names, *(f"{c}_run" for c in columns), "_part", "_here"]
            )

    return run


def running(df: DataFrame, order: list[str], columns: list[str], group: str | None = None, xor: bool = False) -> DataFrame:
    """Add ``<column>_run``: the sum, or exclusive or, of a long column over the rows up to and including this.

    ``order`` is unique per row and begins with ``group`` (a long without nulls), where
    the sums begin anew. A group may be spread over any number of partitions.
    """
    combine = np.bitwise_xor if xor else np.add
    names = [f"{c}_run" for c in columns]
    schema = ", ".join(
        [*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields), *(f"{n} long" for n in names), "_part int, _here boolean"]
    )
    placed = materialize(
        df.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_running(group, columns, combine), schema), "running"
    )
    ends = placed.groupBy("_part").agg(
        F.max_by(F.struct(*names, F.col(group).alias("key") if group else F.lit(0).alias("key"), "_here"), F.struct(*order)).alias("end")
    )
    # One row per partition.
    offsets, carry, key = [], [0] * len(columns), None
    for row in ends.orderBy("_part").collect():
        offsets.append((row["_part"], key, *carry))
        own, same = list(row["end"])[: len(columns)], not row["end"]["_here"]
        joins = same and row["end"]["key"] == key
        carry = [a ^ b if xor else a + b for a, b in zip(carry, own)] if joins else own
        key = row["end"]["key"]
    kinds = "_part int, _key long, " + ", ".join(f"_before{i} long" for i in range(len(columns)))
    before = df.sparkSession.createDataFrame(offsets, kinds)
    mine = ~F.col("_here") & (F.col("_key") == F.col(group)) if group else F.col("_key").isNotNull()
    joined = placed.join(F.broadcast(before), "_part")

    def total(name: str, i: int):
        offset = F.when(mine, F.col(f"_before{i}")).otherwise(F.lit(0))
        return F.col(name).bitwiseXOR(offset) if xor else F.col(name) + offset

    return joined.select(*df.columns, *(total(n, i).alias(n) for i, n in enumerate(names)))


def _ranked(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The few arcs of a contracted list, walked from its start."""
    rows = pa.Table.from_batches(list(frames)).to_pylist()
    after = {r["arc"]: (r["to"], r["hops"]) for r in rows}
    (arc,) = after.keys() - {to for to, _ in after.values()}
    walk = []
    while arc is not None:
        walk.append(arc)
        arc = after[arc][0]
    ahead, out = 0, {}
    for arc in reversed(walk):
        out[arc] = ahead = ahead + after[arc][1] if after[arc][0] is not None else 0
    yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.int64()), pa.array(list(out.values()), pa.int64())], names=["arc", "ahead"])


def list_ranks(arcs: DataFrame, last: int, rulers: int = RULERS, small: int | None = None) -> DataFrame:
    """arc and ``ahead``, how many steps each arc (long) is from ``last``, the end of one linked list.

    ``arcs`` has arc and ``to``, the next one, null for ``last``. One arc in ``rulers``, chosen by
    a hash, is a ruler. All arcs jump along the list, twice as far each round, until they
    meet a ruler; the rulers are a shorter list of their own, with hops for its steps. When at
    most ``small`` arcs are left, one task walks them; then the others add their ruler's rank.
    Each level costs joins on unique keys only, and the levels shrink by ``rulers``.
    """
    levels, small = [], SMALL if small is None else small
    state = materialize(arcs.select("arc", "to", F.when(F.col("to").isNull(), 0).otherwise(1).cast("long").alias("hops")), "arcs")
    while True:
        n = state.count()
        if n <= small:
            break

        def ruler(arc, salt=SALT + len(levels)):
            return (F.pmod(F.xxhash64(arc, F.lit(salt)), F.lit(rulers)) == 0) | (arc == last)

        while True:
            waiting = state.where(F.col("to").isNotNull() & ~ruler(F.col("to")))
            if not waiting.limit(1).count():
                break
            far = state.select(F.col("arc").alias("to"), F.col("to").alias("_to"), F.col("hops").alias("_hops"))
            waiting = waiting.join(far, "to").select("arc", F.col("_to").alias("to"), (F.col("hops") + F.col("_hops")).alias("hops"))
            state = materialize(state.where(F.col("to").isNull() | ruler(F.col("to"))).unionByName(waiting), "arcs")
        levels.append((state, ruler))
        state = materialize(state.where(ruler(F.col("arc"))), "rulers")
    ranks = state.coalesce(1).mapInArrow(_ranked, "arc long, ahead long") if n else state.selectExpr("arc", "hops AS ahead")
    for state, ruler in reversed(levels):
        ranks = materialize(ranks, "ranks")
        reached = ranks.select(F.col("arc").alias("to"), "ahead")
        others = state.where(~ruler(F.col("arc"))).join(reached, "to")
        ranks = others.select("arc", (F.col("hops") + F.col("ahead")).alias("ahead")).unionByName(ranks)
    return ranks
