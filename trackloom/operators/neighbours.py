"""Nearest catalogue rows of each seed, exact or among hash buckets, for any number of seeds.

The exact search parts the catalogue by pivots: a row belongs to its nearest pivot's cell, and a
cell is cut into rings by the distance to the pivot. A seed first searches the rings that
lie nearest to it and hold ``k`` rows, which gives the distance of its ``k``-th row so far. By the
triangle inequality, a row that is nearer lies in a ring whose distances to the pivot differ
from the seed's by no more than that; and a row of another cell is at least half the
difference of the seed's distances to the two pivots away. Only rings that pass both bounds
are searched. A seed is sent to strips of rings, which a task holds, and searches its rings there: on
vectors without structure it passes to all rings, and a copy of its vector for each
would be the square of the table.

Catalogue and seeds are relations that meet in :func:`trackloom.operators.blocked.best_in_blocks`.
What the driver and every task hold is up to ``PIVOTS`` vectors and ``PIVOTS * RINGS`` rings. Relations
with a row per catalogue row, seed or visit are joined by shuffles: their numbers pack into files so small
that Spark would broadcast them, through the driver, at millions of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from trackloom.functions import values
from trackloom.operators.blocked import DIGITS, RINGS_A_WORD, best_in_blocks, best_in_strips, matrix
from trackloom.operators.dedupe import top_per_group
from trackloom.session import materialize

__all__ = ["DIGITS", "fit_lsh", "nearest", "nearest_lsh", "recall", "rows_compared", "with_buckets"]

PIVOTS = 256
RINGS = 64
# Rows that are worth a ring: a visit costs about as much as this many comparisons.
RING_ROWS = 1024
# Rows that a task holds to compare seeds with.
BLOCK = 1 << 15
# Blocks of rows, and words of rings, that a strip of rings has at most.
STRIP_BLOCKS, STRIP_WORDS = 8, 4
# Seeds of a strip that a task compares, at least and at most; between them, an eighth of all.
FEW_SEEDS, MANY_SEEDS = 1 << 12, 1 << 18
# Distances to pivots come from matrix products; bounds give way by this much of the lengths.
SLACK = 1e-6


class Rings(NamedTuple):
    """What is known of the parted catalogue: the pivots, and of each ring (cell * RINGS + place) its bounds and size."""

    pivots: list[list[float]]
    ring: list[int]
    near: list[float]
    far: list[float]
    size: list[int]


def _pivots(rows: DataFrame, id_column: str, total: int, ring_rows: int) -> list[list[float]]:
    """One for every ``ring_rows`` rows, up to PIVOTS, spread by a hash of the id; different vectors."""
    wanted = min(PIVOTS, max(1, total // ring_rows))
    first = rows.orderBy(values.row_hash([id_column], 17), id_column).limit(wanted).select("vector").collect()
    for row in first:
        if row["vector"] is None or None in row["vector"]:
            raise ValueError("NULL in a vector column")
    return [list(v) for v in dict.fromkeys(tuple(r["vector"]) for r in first)]


def _to_pivots(x, pivots):
    import numpy as np

    squares = (x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1) - 2 * (x @ pivots.T)
    return np.sqrt(np.maximum(squares, 0))


def _assign(pivots: list[list[float]]):
    """Add the nearest pivot of each row and the distance to it."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        points = np.asarray(pivots, dtype="float64")
        for batch in batches:
            x = matrix(batch.column("vector"))
            cell = np.zeros(len(x), np.int64)
            for start in range(0, len(x), 1024):
                s = slice(start, start + 1024)
                cell[s] = _to_pivots(x[s], points).argmin(axis=1)
            far = np.sqrt(((x - points[cell]) ** 2).sum(axis=1))
            names = [*batch.schema.names, "cell", "far"]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(far)], names=names)

    return run


def _strips(rings: Rings, rows: int) -> tuple[list[int], list[int]]:
    """Of each ring its strip and its number there: neighbouring rings of up to ``rows`` rows together."""
    strips, places, held = [], [], 0
    for size in rings.size:
        if strips and held + size <= rows and places[-1] + 1 < RINGS_A_WORD * STRIP_WORDS:
            strips.append(strips[-1])
            places.append(places[-1] + 1)
            held += size
        else:
            strips.append(strips[-1] + 1 if strips else 0)
            places.append(0)
            held = size
    return strips, places


def _first_visits(rings: Rings, k: int):
    """Seeds to the rings they search first: key, block.

    Those nearest by the distance to the pivot, of the nearest cells, that hold ``k`` rows together.
    """

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        points = np.asarray(rings.pivots, dtype="float64")
        ring, size = np.asarray(rings.ring), np.asarray(rings.size)
        near, far = np.asarray(rings.near), np.asarray(rings.far)
        cell = ring // RINGS
        held = np.bincount(cell, size, minlength=len(points))
        for batch in batches:
            keys, x = np.asarray(batch.column("key")), matrix(batch.column("vector"))
            out = []
            for start in range(0, len(x), 1024):
                for dist in _to_pivots(x[start : start + 1024], points):
                    own = dist[cell]
                    order = np.argsort(dist, kind="stable")
                    last = np.searchsorted(np.cumsum(held[order]), k)
                    inside = np.flatnonzero(np.isin(cell, order[: last + 1]))
                    off = np.maximum(np.maximum(near[inside] - own[inside], own[inside] - far[inside]), 0)
                    chosen = inside[np.argsort(off, kind="stable")]
                    out.append(chosen[: np.searchsorted(np.cumsum(size[chosen]), k) + 1])
            if out:
                key = np.repeat(keys, [len(o) for o in out])
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(ring[np.concatenate(out)])], names=["key", "block"])

    return run


def _further_visits(rings: Rings, strips: list[int], places: list[int]):
    """Seeds to the strips with rings that may hold a row within the seed's ``floor`` and that it has not ``seen``.

    key, block (the strip), rings (see :func:`best_in_strips`) and n_rows, the rows of those rings.
    """

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        points = np.asarray(rings.pivots, dtype="float64")
        ring, size = np.asarray(rings.ring), np.asarray(rings.size)
        near, far = np.asarray(rings.near), np.asarray(rings.far)
        cell, place = ring // RINGS, np.asarray(places)
        longest = np.sqrt((points * points).sum(axis=1).max())
        # A word per strip and RINGS_A_WORD rings; rings are in the order of strips.
        word = np.asarray(strips) * STRIP_WORDS + place // RINGS_A_WORD
        bit = np.left_shift(np.int64(1), place % RINGS_A_WORD)
        firsts = np.flatnonzero(np.r_[True, np.diff(strips) > 0])
        starts = np.flatnonzero(np.r_[True, np.diff(word) > 0])
        for batch in batches:
            keys, x = np.asarray(batch.column("key")), matrix(batch.column("vector"))
            floor = batch.column("floor").to_numpy(zero_copy_only=False).astype("float64")
            limits = np.where(np.isnan(floor), np.inf, floor) + SLACK * (1 + longest + np.sqrt((x * x).sum(axis=1)))
            seen = batch.column("seen")
            of, seen = np.repeat(np.arange(len(x)), np.diff(np.asarray(seen.offsets))), np.searchsorted(ring, np.asarray(seen.flatten()))
            # So few seeds at a time that a flag for each ring is small.
            for start in range(0, len(x), 256):
                s = slice(start, start + 256)
                dist, limit = _to_pivots(x[s], points), limits[s][:, None]
                own = dist[:, cell]
                passes = (near <= own + limit) & (far >= own - limit) & ((own - dist.min(axis=1)[:, None]) / 2 <= limit)
                mine = slice(*np.searchsorted(of, [start, start + 256]))
                passes[of[mine] - start, seen[mine]] = False
                words = np.zeros((len(passes), (strips[-1] + 1) * STRIP_WORDS), np.int64)
                words[:, word[starts]] = np.add.reduceat(passes * bit, starts, axis=1)
                rows = np.add.reduceat(passes * size, firsts, axis=1)
                seed, strip = np.nonzero(rows)
                if len(seed):
                    lists = words.reshape(len(passes), -1, STRIP_WORDS)[seed, strip].ravel()
                    offsets = pa.array(np.arange(0, len(lists) + 1, STRIP_WORDS), pa.int32())
                    columns = [keys[s][seed], strip.astype("int64"), pa.ListArray.from_arrays(offsets, pa.array(lists)), rows[seed, strip]]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "block", "rings", "n_rows"])

    return run


def _precision(vector_column: str, *tables: DataFrame) -> str:
    """Numbers are stored and sent as they are in all tables, if single; what is computed of them is double."""
    return "float" if all(df.schema[vector_column].dataType.simpleString() == "array<float>" for df in tables) else "double"


def _asking(seeds: DataFrame, id_column: str, vector_column: str, kind: str = "double") -> DataFrame:
    """seed_id, vector and a number for each different seed."""
    vector = F.transform(vector_column, lambda x: x.cast(kind)).alias("vector")
    rows = seeds.select(F.col(id_column).alias("seed_id"), vector).distinct()
    return materialize(rows.withColumn("key", F.monotonically_increasing_id()), "seeds")


def _final(found: DataFrame, asking: DataFrame, rows: DataFrame, k: int, id_column: str, kept: list[str]) -> DataFrame:
    """seed_id, dist, rk and the kept columns of the ``k`` best rows found."""
    # Rows at the limit stay until their ids decide: no more than k of a block.
    near = found.withColumn("_rank", F.rank().over(Window.partitionBy("key").orderBy("value"))).where(F.col("_rank") <= k)
    listed = near.join(rows.select("member", *kept).hint("merge"), "member")
    listed = listed.join(asking.select("key", "seed_id").hint("merge"), "key")
    order = [F.col("value").asc(), F.col(id_column).asc(), F.col("member").asc()]
    best = top_per_group(listed, ["key"], order, k, rank="rk")
    return best.select("seed_id", F.col("value").alias("dist"), *kept, "rk")


def _parted(rows: DataFrame, pivots: list[list[float]], places: int) -> tuple[DataFrame, Rings]:
    """The rows, stored with member (a number) and block (their ring), and all rings."""
    schema = StructType([*rows.schema.fields, StructField("cell", LongType()), StructField("far", DoubleType())])
    near = rows.mapInArrow(_assign(pivots), schema).withColumn("member", F.monotonically_increasing_id())
    near = materialize(near, "cells")
    # ``places`` rings a cell of about equal size, at quantiles of the distances; one row per pivot.
    shares = F.lit([i / places for i in range(1, places)] or [1.0])
    cuts = near.groupBy("cell").agg(F.array_distinct(F.percentile_approx("far", shares, 1000)).alias("_cuts"))
    cuts = near.sparkSession.createDataFrame(cuts.collect(), cuts.schema)
    ring = F.size(F.filter("_cuts", lambda cut: cut < F.col("far")))
    placed = near.join(F.broadcast(cuts), "cell").withColumn("block", F.col("cell") * RINGS + ring).drop("_cuts", "cell")
    found = placed.groupBy("block").agg(F.min("far").alias("near"), F.max("far").alias("far"), F.count("*").alias("size"))
    columns = zip(*found.orderBy("block").collect()) if pivots else ()
    return placed.drop("far"), Rings(pivots, *(list(c) for c in columns))


def nearest(
    catalog: DataFrame,
    seeds: DataFrame,
    k: int = 50,
    id_column: str = "track_id",
    vector_column: str = "features",
    keep: tuple[str, ...] = (),
    block: int = BLOCK,
    ring_rows: int = RING_ROWS,
) -> DataFrame:
    """The ``k`` catalogue rows with the smallest Euclidean distance to each seed, exactly.

    Returns seed_id, dist, rk, ``id_column`` and the ``keep`` columns. A seed that is
    in the catalogue is its own nearest row. ``seeds`` has ``id_column`` and
    ``vector_column``; repeated seeds count once. NULL, NaN or infinity in a vector is an error.
    """
    return _searched(catalog, seeds, k, id_column, vector_column, keep, block, ring_rows)[0]


def rows_compared(
    catalog: DataFrame,
    seeds: DataFrame,
    k: int = 50,
    id_column: str = "track_id",
    vector_column: str = "features",
    ring_rows: int = RING_ROWS,
) -> DataFrame:
    """seed_id and n_compared, the number of catalogue rows that the exact search compares with the seed."""
    _, first, further, rows, asking = _searched(catalog, seeds, k, id_column, vector_column, (), BLOCK, ring_rows)
    sizes = rows.groupBy("block").agg(F.count("*").alias("n_rows"))
    visits = first.join(sizes, "block").select("key", "n_rows")
    if further is not None:
        visits = visits.unionByName(further.select("key", "n_rows"))
    compared = visits.groupBy("key").agg(F.sum("n_rows").alias("n_compared"))
    return compared.join(asking, "key").select("seed_id", "n_compared")


def _searched(catalog, seeds, k, id_column, vector_column, keep, block, ring_rows):
    """The result of :func:`nearest`; the visits of rings and, unless all is one ring, of strips; the parted rows; the seeds."""
    kept = list(dict.fromkeys([id_column, *keep]))
    kind = _precision(vector_column, catalog, seeds)
    vector = F.transform(vector_column, lambda x: x.cast(kind)).alias("vector")
    rows, asking = catalog.select(*kept, vector), _asking(seeds, id_column, vector_column, kind)
    total = rows.count()
    pivots = _pivots(rows, id_column, total, ring_rows)
    if not pivots:
        asking = asking.limit(0)
    places = min(RINGS, max(1, total // (ring_rows * max(len(pivots), 1))))
    placed, rings = _parted(rows, pivots, places) if pivots else (rows.selectExpr("*", "0L AS member", "0L AS block"), Rings([[0.0]], [0], [0.0], [0.0], [0]))
    members = placed.select("block", "member", F.col(id_column).alias("order"), "vector")
    plain = asking.select("key", "vector")
    first = materialize(plain.mapInArrow(_first_visits(rings, k), "key long, block long"), "visits")
    found = best_in_blocks(members, first.join(plain.hint("merge"), "key"), k, distances=True, size=block)
    if len(rings.ring) == 1:  # every seed has searched all there is
        return _final(found, asking, placed, k, id_column, kept), first, None, placed, asking
    found = materialize(found, "found")
    # The distance of the k-th row so far; none for seeds that have found fewer.
    kth = top_per_group(found, ["key"], [F.col("value").asc()], k).groupBy("key")
    floors = kth.agg(F.when(F.count("*") >= k, F.max("value")).alias("floor"))
    seen = first.groupBy("key").agg(F.collect_set("block").alias("seen"))
    known = plain.join(floors.hint("merge"), "key", "left").join(seen.hint("merge"), "key", "left")
    known = materialize(known.withColumn("seen", F.coalesce("seen", F.array().cast("array<long>"))), "floors")
    strips, numbers = _strips(rings, STRIP_BLOCKS * block)
    passing = known.mapInArrow(_further_visits(rings, strips, numbers), "key long, block long, rings array<long>, n_rows long")
    further = materialize(passing, "visits")
    # One row per ring, up to PIVOTS * RINGS.
    strip_of = placed.sparkSession.createDataFrame(list(zip(rings.ring, strips, ([n] for n in numbers))), "block long, strip long, rings array<long>")
    striped = members.join(F.broadcast(strip_of), "block").drop("block").withColumnRenamed("strip", "block")
    visits = further.drop("n_rows").join(known.select("key", "vector", "floor").hint("merge"), "key")
    bucket = min(MANY_SEEDS, max(FEW_SEEDS, known.count() // 8))
    found = found.unionByName(best_in_strips(striped, visits, k, STRIP_BLOCKS * block, bucket))
    return _final(found, asking, placed, k, id_column, kept), first, further, placed, asking


def fit_lsh(
    catalog: DataFrame,
    vector_column: str = "features",
    bucket_length: float = 2.0,
    tables: int = 3,
    seed: int = 42,
):
    """MLlib's random-projection hashing, fitted for vectors of the catalogue's width."""
    vectors = catalog.select(array_to_vector(F.col(vector_column).cast("array<double>")).alias("_vector"))
    return BucketedRandomProjectionLSH(
        inputCol="_vector", outputCol="_hashes", bucketLength=bucket_length, numHashTables=tables, seed=seed
    ).fit(vectors)


def with_buckets(df: DataFrame, model, vector_column: str = "features") -> DataFrame:
    """Add ``_buckets``: the bucket number of the row in each hash table."""
    vector = array_to_vector(F.col(vector_column).cast("array<double>"))
    hashed = model.transform(df.withColumn("_vector", vector))
    tables = [vector_to_array(F.col("_hashes")[i])[0] for i in range(model.getNumHashTables())]
    return hashed.withColumn("_buckets", F.array(*tables)).drop("_vector", "_hashes")


def nearest_lsh(
    catalog: DataFrame,
    seeds: DataFrame,
    k: int = 50,
    id_column: str = "track_id",
    vector_column: str = "features",
    keep: tuple[str, ...] = (),
    bucket_length: float = 2.0,
    tables: int = 3,
    seed: int = 42,
    block: int = BLOCK,
) -> DataFrame:
    """As :func:`nearest`, but only among rows that share a hash bucket with the seed.

    The rows of buckets that no seed is in leave the plan at a join, before their vectors leave the JVM.
    """
    kept = list(dict.fromkeys([id_column, *keep]))
    model = fit_lsh(catalog, vector_column, bucket_length, tables, seed)
    vector = F.transform(vector_column, lambda x: x.cast("double")).alias("vector")
    rows = with_buckets(catalog.select(*kept, vector), model, "vector").withColumn("member", F.monotonically_increasing_id())
    rows = materialize(rows, "hashed")
    asking = _asking(seeds, id_column, vector_column)

    def bucketed(df: DataFrame, *columns) -> DataFrame:
        """One row per table; a bucket's number and its table's are one long."""
        buckets = df.select(*columns, "vector", F.posexplode("_buckets").alias("_table", "_bucket"))
        number = F.col("_bucket").cast("long") * tables + F.col("_table")
        return buckets.withColumn("block", number).drop("_table", "_bucket")

    members = bucketed(rows, "member", F.col(id_column).alias("order"))
    visits = bucketed(with_buckets(asking, model, "vector"), "key")
    found = best_in_blocks(members, visits, k, distances=True, size=block)
    found = found.groupBy("key", "member").agg(F.min("value").alias("value"))
    return _final(found, asking, rows, k, id_column, kept)


def recall(exact: DataFrame, approximate: DataFrame, id_column: str = "track_id") -> DataFrame:
    """Per seed the share of the exact neighbours that the approximate search found."""
    hits = approximate.select("seed_id", id_column, F.lit(1).alias("hit"))
    return (
        exact.select("seed_id", id_column)
        .join(hits, ["seed_id", id_column], "left")
        .groupBy("seed_id")
        .agg(F.avg(F.coalesce("hit", F.lit(0))).alias("recall"), F.count("*").alias("neighbours"))
    )
