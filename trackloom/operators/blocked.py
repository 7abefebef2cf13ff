"""The best members for many queries, where each query visits some blocks of members.

Members and queries are two relations of any size; neither reaches the driver. A task gets
one block's members and up to ``BUCKET`` of the queries that visit it: it keeps the
members as one matrix and compares the queries in tiles, so that what it holds is bounded,
and hands on at most ``k`` members a visit. Which blocks a query visits is the caller's
business: :mod:`trackloom.operators.neighbours` and :mod:`trackloom.operators.factors`
leave out the blocks that cannot hold one of the best, which keeps their results exact.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Queries of one block that a task compares.
BUCKET = 1 << 15
# Pairs that are compared, and pairs that are measured, at a time.
_TILE = 1 << 20
_PAIRS = 1 << 16
# Values are compared at this many digits, so that the order of a floating-point sum cannot
# decide between two members; their order does.
DIGITS = 9
GROUP = ["block", "bucket", "part"]
# Rings that a word of a visit's list tells apart; members of a ring that are compared at a time.
RINGS_A_WORD = 62
RING_TILE = 1 << 12


def may_reach(norm, top, floor):
    """Whether a vector's product with one no longer than ``top`` can reach ``floor``; sums are rounded."""
    return norm * top * (1 + 1e-9) + 1e-9 >= floor


def matrix(column, kind: str | None = "float64"):
    """An Arrow list column as a matrix, of its own precision without ``kind``. NULL, NaN and infinity are errors."""
    import numpy as np

    numbers = column.flatten()
    if column.null_count or numbers.null_count:
        raise ValueError("NULL in a vector column")
    flat = numbers.to_numpy(zero_copy_only=False)
    flat = flat.astype(kind) if kind else flat
    if not np.isfinite(flat).all():
        raise ValueError("NaN or infinity in a vector column")
    return flat.reshape(len(column), -1)


def _best(k: int, distances: bool, rounds: list[tuple[int, list[float]]] | None = None, ringed: bool = False):
    """Arrow batches of sorted groups, in each the members before the visits: the best of each visit.

    With ``ringed`` a visit is compared with the members of its rings only: see :func:`best_in_strips`.
    With ``rounds`` members are taken in rounds of so many, each of which ends a visit that cannot
    find better in the next: see :func:`best_in_rounds`.
    """

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def compared(q, x, floor, skipped):
            """(query, member, value) of the best: largest product or smallest distance, then first member."""
            near = q @ x.T
            if distances:
                near = 2 * near - (q * q).sum(axis=1)[:, None] - (x * x).sum(axis=1)
            if skipped is not None:
                near[skipped] = -np.inf
            level = np.where(np.isnan(floor), -np.inf, -(floor**2) if distances else floor)
            many = np.flatnonzero(np.count_nonzero(near >= level[:, None], axis=1) > k)
            if len(many):
                level[many] = np.maximum(level[many], -np.partition(-near[many], k - 1, axis=1)[:, k - 1])
            # Matrix products lose digits, so what is near the limit is decided by plain sums.
            sizes = (q * q).sum(axis=1)[:, None], (x * x).sum(axis=1)[None, :]
            slack = 1e-7 * (1 + sizes[0] + sizes[1]) if distances else 1e-9 * (1 + np.sqrt(sizes[0] * sizes[1].max(initial=0)))
            a, b = np.nonzero((near >= level[:, None] - slack) & np.isfinite(near))
            value = np.empty(len(a))
            for start in range(0, len(a), _PAIRS):
                s = slice(start, start + _PAIRS)
                if distances:
                    delta = q[a[s]] - x[b[s]]
                    value[s] = np.sqrt((delta * delta).sum(axis=1))
                else:
                    value[s] = (q[a[s]] * x[b[s]]).sum(axis=1)
            value = np.round(value, DIGITS)
            order = np.lexsort((b, value if distances else -value, a))
            a, b, value = a[order], b[order], value[order]
            kept = np.arange(len(a)) - np.searchsorted(a, a) < k
            return a[kept], b[kept], value[kept]

        def in_rounds(vectors, names, x, skipped):
            """(query, member, value) of the best, and the number of blocks each query read."""
            n = len(vectors)
            norm, floor, read = np.sqrt((vectors * vectors).sum(axis=1)), np.full(n, np.nan), np.zeros(n, np.int64)
            q, m, value = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
            start = 0
            for size, tops in rounds:
                needed = np.isnan(floor)[:, None] | may_reach(norm[:, None], np.asarray(tops), floor[:, None])
                read += needed.sum(axis=1)
                here = np.flatnonzero(needed[:, 0])
                s = slice(start, start + size)
                start += size
                a, b, v = compared(vectors[here], x[s], floor[here], skipped[here, s])
                q, m, value = np.r_[q, here[a]], np.r_[m, b + s.start], np.r_[value, v]
                order = np.lexsort((names[m], -value, q))
                q, m, value = q[order], m[order], value[order]
                place = np.arange(len(q)) - np.searchsorted(q, q)
                q, m, value, place = (c[place < k] for c in (q, m, value, place))
                floor[q[place == k - 1]] = value[place == k - 1]
            return q, m, value, read

        def solved(members, x, visits):
            names, sorter = members, np.argsort(members)
            width = max(1, _TILE // max(1, len(x) if rounds is None else max(size for size, _ in rounds)))
            for start in range(0, visits.num_rows, width):
                tile = visits.slice(start, width)
                skipped = np.zeros((tile.num_rows, len(x)), bool)
                skip = tile.column("skip")
                held = np.asarray(skip.flatten(), dtype=np.int64)
                if len(held):
                    lengths = np.asarray([len(s) if s.is_valid else 0 for s in skip])
                    skipped[np.repeat(np.arange(tile.num_rows), lengths), sorter[np.searchsorted(names, held, sorter=sorter)]] = True
                floor = tile.column("floor").to_numpy(zero_copy_only=False).astype("float64")
                vectors, read = matrix(tile.column("vector")), None
                if rounds is None:
                    q, m, value = compared(vectors, x, floor, skipped)
                else:
                    q, m, value, read = in_rounds(vectors, names, x, skipped)
                found = [tile.column("key").take(pa.array(q)), pa.array(names[m]), pa.array(value)]
                if read is None:
                    yield pa.RecordBatch.from_arrays(found, names=["key", "member", "value"])
                    continue
                none, blank = pa.nulls(len(q), pa.int64()), [pa.nulls(len(read), t) for t in (pa.int64(), pa.float64())]
                yield pa.RecordBatch.from_arrays([*found, none], names=["key", "member", "value", "blocks"])
                yield pa.RecordBatch.from_arrays([tile.column("key"), *blank, pa.array(read)], names=["key", "member", "value", "blocks"])

        def by_ring(members, ring, x):
            """The members with their places, ring by ring, and (ring, first, last) of up to RING_TILE of a ring."""
            order = np.argsort(ring, kind="stable")
            ring = ring[order]
            cuts = np.r_[0, np.flatnonzero(np.diff(ring)) + 1, len(ring)]
            chunks = [(int(ring[a]), i, min(i + RING_TILE, b)) for a, b in zip(cuts, cuts[1:]) for i in range(a, b, RING_TILE)]
            return members[order], order, x[order], chunks

        def in_rings(members, place, x, chunks, visits):
            """As ``solved``: a visit's limit falls with what it finds in one ring after the other."""
            width = max(1, _TILE // max(b - a for _, a, b in chunks))
            for start in range(0, visits.num_rows, width):
                tile = visits.slice(start, width)
                words = np.asarray(tile.column("rings").flatten(), np.int64).reshape(tile.num_rows, -1)
                floor = tile.column("floor").to_numpy(zero_copy_only=False).astype("float64")
                vectors = matrix(tile.column("vector"))
                q, m, value = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
                for ring, first, last in chunks:
                    here = np.flatnonzero(words[:, ring // RINGS_A_WORD] >> (ring % RINGS_A_WORD) & 1)
                    if not len(here):
                        continue
                    a, b, v = compared(vectors[here], x[first:last].astype("float64"), floor[here], None)
                    if not len(a):
                        continue
                    q, m, value = np.r_[q, here[a]], np.r_[m, b + first], np.r_[value, v]
                    order = np.lexsort((place[m], value, q))
                    q, m, value = q[order], m[order], value[order]
                    rank = np.arange(len(q)) - np.searchsorted(q, q)
                    q, m, value, rank = (c[rank < k] for c in (q, m, value, rank))
                    last_one = rank == k - 1
                    floor[q[last_one]] = np.fmin(floor[q[last_one]], value[last_one])
                found = [tile.column("key").take(pa.array(q)), pa.array(members[m]), pa.array(value)]
                yield pa.RecordBatch.from_arrays(found, names=["key", "member", "value"])

        group, waiting, members, x = None, [], None, None
        for batch in batches:
            keys = np.array([np.asarray(batch.column(c)) for c in (*GROUP, "kind")], np.int64)
            cuts = np.flatnonzero((np.diff(keys) != 0).any(axis=0)) + 1
            for a, b in zip(np.r_[0, cuts], np.r_[cuts, batch.num_rows]):
                if a == b:
                    continue
                part, now = batch.slice(a, b - a), tuple(keys[:-1, a])
                if now != group:
                    group, waiting, members = now, [], None
                if keys[-1, a] == 0:
                    waiting.append(part)
                    continue
                if members is None and waiting:
                    table = pa.Table.from_batches(waiting).combine_chunks()
                    members = table.column("key").to_numpy()
                    vector = table.column("vector").combine_chunks()
                    if not ringed:
                        x, waiting = matrix(vector), []
                    else:  # in the precision they came in
                        ring = np.asarray(table.column("rings").combine_chunks().flatten(), np.int64)
                        waiting, table = [], None
                        members, place, x, chunks = by_ring(members, ring, matrix(vector, None))
                        vector = None
                if ringed and members is not None:
                    yield from in_rings(members, place, x, chunks, part)
                elif members is not None:  # a part can be empty
                    yield from solved(members, x, part)

    return run


def best_in_rounds(members: DataFrame, visits: DataFrame, k: int, rounds: list[tuple[int, list[float]]]) -> DataFrame:
    """As :func:`best_in_blocks` by products, in one block whose members are read in rounds, within a task.

    ``rounds`` lists how many members a round has and the largest norm of each block of the round;
    ``order`` is the round of a member. A visit goes on while a block can reach its ``k``-th
    product so far. A row per visit has NULL as member and the number of ``blocks`` it read.
    """
    return _grouped(members, visits, None, BUCKET).mapInArrow(
        _best(k, False, rounds), "key long, member long, value double, blocks long"
    )


def best_in_blocks(
    members: DataFrame, visits: DataFrame, k: int, distances: bool, size: int | None = None, bucket: int = BUCKET
) -> DataFrame:
    """key, member, value: of each visit the ``k`` best members of its block.

    ``members`` has block and member (longs), ``order`` (what decides between equal
    values) and vector (array<double>). ``visits`` has block, key (a long), vector, and
    may have floor, a value that members must reach, and skip, members of the block to leave out.
    Best are the smallest Euclidean distances, or else the largest inner products.

    Blocks of unknown size are cut into parts of about ``size`` members, each of which
    gives up to ``k``; without ``size`` the caller bounds the blocks.
    """
    return _grouped(members, visits, size, bucket).mapInArrow(_best(k, distances), "key long, member long, value double")


def best_in_strips(members: DataFrame, visits: DataFrame, k: int, size: int, bucket: int) -> DataFrame:
    """As :func:`best_in_blocks` by distances, where a block is a strip of rings and a visit searches some of them.

    ``rings`` is an array of longs: of a member, the number of its ring in the strip; of a visit, words
    of RINGS_A_WORD bits, one for each ring of the strip. A visit is sent once a strip, with its vector,
    whatever the number of rings; it is compared with the rings it names, and hands on ``k`` members.
    """
    return _grouped(members, visits, size, bucket).mapInArrow(_best(k, True, ringed=True), "key long, member long, value double")


def _grouped(members: DataFrame, visits: DataFrame, size: int | None, bucket: int) -> DataFrame:
    """Members and visits of a block, part and bucket together, the members first."""
    # Empty lists, not NULL: Spark would go over all NULL lists of an Arrow batch again for each further one.
    none = {"floor": F.lit(None).cast("double"), "skip": F.array().cast("array<long>")}
    visits = visits.withColumns({c: F.coalesce(c, v) if c in visits.columns else v for c, v in none.items()})
    more = [c for c in ("rings",) if c in members.columns]
    # One row per visited block, with the number of tasks that share its queries and its members.
    spread = visits.groupBy("block").agg(F.ceil(F.count("*") / bucket).alias("_tasks"))
    parts = F.lit(1).cast("long")
    if size:
        spread = spread.join(members.groupBy("block").agg(F.ceil(F.count("*") / size).alias("_parts")), "block")
        parts = F.col("_parts")
    task, part = F.pmod(F.xxhash64("key"), F.col("_tasks")), F.pmod(F.xxhash64("member"), parts)
    asked = visits.join(spread, "block").select(
        "block",
        task.alias("bucket"),
        F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part"),
        F.lit(1).alias("kind"),
        "key",
        F.lit(None).cast(members.schema["order"].dataType).alias("order"),
        "vector",
        "floor",
        "skip",
        *more,
    )
    held = members.join(spread, "block").select(
        "block",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("_tasks") - 1)).alias("bucket"),
        part.alias("part"),
        F.lit(0).alias("kind"),
        F.col("member").alias("key"),
        "order",
        "vector",
        *(v.alias(c) for c, v in none.items()),
        *more,
    )
    return (
        held.unionByName(asked)
        .repartition(*GROUP)
        .sortWithinPartitions(*GROUP, "kind", "order", "key")
        .drop("order")
    )
