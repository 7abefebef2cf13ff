"""Nearest vectors by inner product, over several shifted Hilbert curves.

Vectors are parted into bands by their lengths, each up to four times its least. In a band
they get one more component that makes them equally long, so that the largest inner product
is the smallest angle; queries get 0 there. A few very long vectors are a band of their own and
do not flatten the others. For each band and curve the vectors are turned at random,
projected to a few dimensions, shifted at random on a grid and numbered along the Hilbert curve.
Spark sorts all keys; a vector's position falls into a block of bounded size, and a query
visits, in every band, the blocks within half a ``window`` of the band's vectors to each side of its
own place, and within ``LEAST`` vectors in any case. A task holds a range of neighbouring blocks,
merges each query's best over them, and scores by exact inner products in double precision. Any
number of queries may visit a block: they are scored in tiles of fixed size, so that no
matrix grows with the table. The best of all curves and bands are merged at the end.

The window is a share of the rows, because vectors without low-dimensional structure (those
of the test tables) need a fixed share to be found again; ``window`` and ``curves`` set
the recall, and together how many vectors a query is scored against (see ``rows_scored``).
Vectors that are null or zero, hold null or non-finite components, or do not have the
commonest number of components (of equally common ones the largest) take no part, as an inner
product with them is not defined. Rows with a null id take none either; of several vectors
under one id the smallest, by its components in order, stands for all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackloom.operators.ordering import with_running_total
from trackloom.session import materialize

NEAREST = 20
CURVES = 16
DIMENSIONS = 8
BITS = 6
WINDOW = 0.06
BLOCK = 128
LEAST = 256  # vectors to each side of a query's place that it is scored against at least
TILE = 1024  # queries scored at a time
KEPT = 1 << 16  # queries whose lists a task holds


def curve_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Place of each grid point (row) along the Hilbert curve of its cube, by Skilling's transform."""
    x = points.astype(np.uint32).copy()
    dims = x.shape[1]
    for level in range(bits - 1, 0, -1):
        bit, low = np.uint32(1 << level), np.uint32((1 << level) - 1)
        for i in range(dims):
            on = (x[:, i] & bit) != 0
            swap = np.where(on, np.uint32(0), (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(on, low, swap)
            x[:, i] ^= swap
    for i in range(1, dims):
        x[:, i] ^= x[:, i - 1]
    turn = np.zeros(len(x), np.uint32)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[:, -1] >> np.uint32(level)) & np.uint32(1), np.uint32((1 << level) - 1), np.uint32(0)).astype(np.uint32)
    x ^= turn[:, None]
    key = np.zeros(len(x), np.uint64)
    for level in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << np.uint64(1)) | ((x[:, i] >> np.uint32(level)) & np.uint32(1)).astype(np.uint64)
    return key


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, size)


def _key_rows(size: int, longest: dict[int, float], curves: int, dims: int, bits: int, seed: int):
    """Keys of the vectors in their bands and of the queries in all bands; ``longest`` has the bands' lengths."""
    dims = min(dims, size + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("vector"), size)
            ids, queries = np.asarray(batch.column("vec_id")), np.asarray(batch.column("query").cast(pa.int8())) == 1
            band = np.asarray(batch.column("band"))
            reach = np.array([longest[b] for b in band.tolist()])
            # Lengths are compared after division: squares of very long vectors would overflow.
            x = x / np.abs(x).max(axis=1, keepdims=True) * np.where(queries, 1, np.abs(x).max(axis=1) / reach)[:, None]
            length = np.sqrt((x * x).sum(axis=1))
            x = np.where(queries[:, None], x / length[:, None], x)
            extra = np.where(queries, 0, np.sqrt(np.maximum(1 - length**2, 0)))
            full = np.hstack([x, extra[:, None]]) * np.sqrt(size + 1)
            for curve in range(curves):
                draw = np.random.default_rng(seed * 1_000 + curve)
                turned = np.linalg.qr(draw.normal(size=(size + 1, size + 1)))[0][:, :dims]
                # Components of a random direction are near to normal: eight deviations, shifted, are the grid.
                place = (np.clip(full @ turned, -4, 4) + 4 + 8 * draw.random(dims)) / 16
                key = curve_keys((place * (1 << bits)).astype(np.uint32), bits)
                yield pa.RecordBatch.from_arrays(
                    [band * curves + curve, key.astype(np.int64), ids, batch.column("query")],
                    names=["curve", "key", "vec_id", "query"],
                )

    return run


def best(queries: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, ids: np.ndarray, k: int):
    """The k nearest rows of ``vectors`` for each query, itself left out: (query row, vector row, score)."""
    scores = queries @ vectors.T
    scores[query_ids[:, None] == ids[None, :]] = -np.inf
    if scores.shape[1] > k:
        level = -np.partition(-scores, k - 1, axis=1)[:, k - 1 : k]
    else:
        level = np.full((len(queries), 1), -np.inf)
    # Products of matrices round differently by position: near ties are decided by plain sums.
    slack = 1e-9 * np.linalg.norm(queries, axis=1, keepdims=True) * (np.linalg.norm(vectors, axis=1).max() if len(vectors) else 1)
    q, v = np.nonzero((scores >= level - slack) & np.isfinite(scores))
    return q, v, (queries[q] * vectors[v]).sum(axis=1)


def _cut(query: np.ndarray, vec: np.ndarray, score: np.ndarray, k: int):
    """The k best of each query: highest score, then smallest id; each vector once."""
    order = np.lexsort((vec, -score, query))
    query, vec, score = query[order], vec[order], score[order]
    new = np.ones(len(query), bool)
    new[1:] = (query[1:] != query[:-1]) | (vec[1:] != vec[:-1]) | (score[1:] != score[:-1])
    query, vec, score = query[new], vec[new], score[new]
    start = np.searchsorted(query, query)
    keep = np.arange(len(query)) - start < k
    return query[keep], vec[keep], score[keep]


def _search_rows(size: int, k: int, tile: int, kept: int):
    """Stream of blocks in order, in each the vectors before its queries, by id.

    The vectors of one block are held and ``tile`` queries at a time. What a query has found is
    kept while its blocks go on, up to ``kept`` queries; beyond that it is handed on, to
    be merged with the rest at the end.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, vectors, queries, waiting = None, [], [], 0
        none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        before, found = none, []  # by the queries of earlier blocks, and by those of this one

        def packed(rows):
            return pa.RecordBatch.from_arrays(list(map(pa.array, rows)), names=["query_id", "vec_id", "score"])

        def joined(parts):
            return tuple(map(np.concatenate, zip(*parts))) if parts else none

        def matrix(held):
            rows = pa.Table.from_batches(held).combine_chunks()
            return rows.column("vec_id").to_numpy(), _matrix(rows.column("vector"), size)

        def solve():
            nonlocal before, found, vectors, queries, waiting
            if queries and vectors:
                if isinstance(vectors, list):
                    vectors = matrix(vectors)
                qid, x = matrix(queries)
                q, v, s = best(x, vectors[1], qid, vectors[0], k)
                end = np.searchsorted(before[0], qid[-1], side="right")
                mine = np.isin(before[0][:end], qid)
                if not mine.all():
                    yield packed(a[:end][~mine] for a in before)
                found.append(_cut(*joined([[a[:end][mine] for a in before], (qid[q], vectors[0][v], s)]), k))
                before = tuple(a[end:] for a in before)
                if sum(len(f[0]) for f in found) > kept * k:
                    yield packed(joined(found))
                    found = []
            queries, waiting = [], 0

        for batch in batches:
            curve, block = np.asarray(batch.column("curve")), np.asarray(batch.column("block"))
            query = np.asarray(batch.column("query").cast(pa.int8()))
            cuts = np.flatnonzero((np.diff(curve) != 0) | (np.diff(block) != 0) | (np.diff(query) != 0)) + 1
            for a, b in zip(np.r_[0, cuts], np.r_[cuts, batch.num_rows]):
                if a == b:
                    continue
                now = int(curve[a]), int(block[a])
                if now != key:
                    yield from solve()
                    yield packed(before)
                    before, found, vectors, key = joined(found), [], [], now
                if not query[a]:
                    vectors.append(batch.slice(a, b - a).select(["vec_id", "vector"]))
                    continue
                while a < b:
                    taken = min(b - a, tile - waiting)
                    queries.append(batch.slice(a, taken).select(["vec_id", "vector"]))
                    a, waiting = a + taken, waiting + taken
                    if waiting == tile:
                        yield from solve()
        yield from solve()
        yield packed(before)
        yield packed(joined(found))

    return run


def usable(vectors: DataFrame, id_: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id and vector, one row per id, of the vectors that can take part."""
    x = F.transform(vector, lambda v: v.cast("double"))
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.select(F.col(id_).cast("long").alias("vec_id"), x.alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False)))
    return rows.where(F.exists("vector", lambda v: v != 0))


def _parts(queries: DataFrame, vectors: DataFrame) -> tuple[DataFrame, int]:
    """All rows of the commonest size, stored, with ``band``; queries have none."""
    rows = usable(vectors).withColumn("query", F.lit(False)).union(usable(queries).withColumn("query", F.lit(True)))
    top = F.array_max(F.transform("vector", F.abs))
    # The length, without squares that overflow or vanish.
    length = top * F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, v: a + (v / top) * (v / top)))
    rows = materialize(rows.withColumn("length", length).withColumn("size", F.size("vector")), "vectors")
    sizes = rows.where("NOT query").groupBy("size").count().orderBy(F.desc("count"), F.desc("size")).first()
    size = sizes["size"] if sizes else 1
    one = rows.where(F.col("size") == size).groupBy("vec_id", "query").agg(F.min(F.struct("vector", "length")).alias("_"))
    one = materialize(one.select("vec_id", "query", "_.vector", "_.length"), "unique")
    # The middle of the lengths is the middle of a band, so that usual lengths are not split.
    middle = one.where("NOT query").agg(F.round(F.avg(F.log2("length")), 2).alias("m")).first()["m"] or 0.0
    band = F.when(~F.col("query"), F.floor((F.log2("length") - middle) / 2 + 0.5).cast("long"))
    return one.withColumn("band", band), size


def _visits(rows: DataFrame, size: int, curves: int, window: float, block: int, least: int, dims: int, bits: int, seed: int):
    """curve, vec_id, query and block: where each vector lies and which blocks each query visits."""
    facts = rows.where("NOT query").groupBy("band").agg(F.max("length").alias("longest"), F.count("*").alias("n"))
    # One row per factor of four between the lengths: fewer than doubles have exponents.
    bands = facts.orderBy("band").collect()
    number = {row["band"]: i for i, row in enumerate(bands)}
    longest = {i: row["longest"] for i, row in enumerate(bands)}
    places = F.lit([row["n"] for row in bands] or [0])
    before = F.lit([curves * sum(row["n"] for row in bands[:i]) for i in range(len(bands))] or [0])
    known = F.create_map(*[F.lit(x).cast("long") for pair in number.items() for x in pair]) if number else None
    own = F.array(known[F.col("band")]) if number else F.array(F.lit(0).cast("long"))
    every = F.when(F.col("query"), F.sequence(F.lit(0).cast("long"), F.lit(len(bands) - 1).cast("long"))).otherwise(own)
    spread = rows.where(F.lit(bool(bands))).select("vec_id", "query", "vector", F.explode(every).alias("band"))
    keys = spread.mapInArrow(_key_rows(size, longest, curves, dims, bits, seed), "curve long, key long, vec_id long, query boolean")
    keys = keys.withColumn("one", F.when(F.col("query"), 0).otherwise(1).cast("long"))
    placed = with_running_total(keys, ["curve", "key", "vec_id", "query"], "one", "reached")
    band = F.floor(F.col("curve") / curves).cast("int")
    n = places[band]
    # Vectors before this row, on its own curve.
    at = F.col("reached") - F.col("one") - before[band] - (F.col("curve") % curves) * n
    half = F.greatest(F.floor(n * (window / 2)), F.lit(least))
    last = F.floor((n - 1) / block)
    low = F.least(F.greatest(F.floor((at - half) / block), F.lit(0).cast("long")), last)
    high = F.least(F.floor((at + half) / block), last)
    blocks = F.when(F.col("query"), F.sequence(low, high)).otherwise(F.array(F.floor(at / block)))
    return placed.select("curve", "vec_id", "query", F.explode(blocks).alias("block"))


def search(
    queries: DataFrame,
    vectors: DataFrame,
    k: int = NEAREST,
    curves: int = CURVES,
    window: float = WINDOW,
    block: int = BLOCK,
    least: int = LEAST,
    dims: int = DIMENSIONS,
    bits: int = BITS,
    seed: int = 11,
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the nearest vectors found for each query.

    Both inputs have vec_id and embedding.
    """
    rows, size = _parts(queries, vectors)
    visits = _visits(rows, size, curves, window, block, least, dims, bits, seed)
    found = (
        visits.join(rows.select("vec_id", "query", "vector"), ["vec_id", "query"])
        .repartitionByRange("curve", "block")
        .sortWithinPartitions("curve", "block", "query", "vec_id")
        .select("curve", "block", "vec_id", "query", "vector")
        .mapInArrow(_search_rows(size, k, TILE, KEPT), "query_id long, vec_id long, score double")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def rows_scored(queries: DataFrame, vectors: DataFrame, **settings) -> DataFrame:
    """query_id and n_scored, how many vectors a query is scored against; one on several curves counts as often."""
    given = {"curves": CURVES, "window": WINDOW, "block": BLOCK, "least": LEAST, "dims": DIMENSIONS, "bits": BITS, "seed": 11} | settings
    rows, size = _parts(queries, vectors)
    visits = materialize(_visits(rows, size, **given), "visits")
    sizes = visits.where("NOT query").groupBy("curve", "block").agg(F.count("*").alias("n"))
    return visits.where("query").join(sizes, ["curve", "block"]).groupBy(F.col("vec_id").alias("query_id")).agg(F.sum("n").alias("n_scored"))
