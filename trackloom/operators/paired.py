"""Products of many given pairs of vectors, without a copy of the vectors for each pair.

A join hands every pair its two vectors, hundreds of bytes for the few that a pair has, and they go
through the next shuffle. Here either side's vectors are dealt into blocks by a hash of
the id, and a pair goes to the cell of its two blocks. A task holds the vectors of one
cell, some ``BLOCK`` of either side, and reads the cell's pairs past them. A vector is sent
as often as the other side has blocks, whatever the number of pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

# Vectors of a side that a task holds.
BLOCK = 1 << 17
# Blocks of a side at least, so that small tables with many pairs have work for many tasks.
LEAST_BLOCKS = 8
# Pairs that are multiplied at a time: their vectors stay in a core's cache.
_TILE = 1 << 10


class _Side:
    """The vectors of a cell's block: ids in ascending order, which may repeat, and where a vector has no NULL."""

    def __init__(self):
        self._ids, self._values, self._lengths, self._whole = [], [], [], []
        self.ids = None

    def add(self, ids, column):
        import numpy as np

        lengths = np.diff(np.asarray(column.offsets, np.int64))
        flat = column.flatten()
        whole = np.ones(len(column), bool)
        if column.null_count:
            whole &= np.asarray(column.is_valid())
            lengths = np.where(whole, lengths, 0)
        if flat.null_count:
            at = np.repeat(np.arange(len(column)), lengths)
            whole[at[np.asarray(flat.is_null())]] = False
            flat = flat.fill_null(0.0)
        self._ids.append(np.array(ids, np.int64))
        self._values.append(np.array(flat))
        self._lengths.append(lengths)
        self._whole.append(whole)

    def close(self):
        import numpy as np

        ids = np.concatenate(self._ids) if self._ids else np.empty(0, np.int64)
        lengths = np.concatenate(self._lengths) if self._ids else np.empty(0, np.int64)
        whole = np.concatenate(self._whole) if self._ids else np.empty(0, bool)
        values = np.concatenate(self._values) if self._ids else np.empty(0)
        self._ids, self._values, self._lengths, self._whole = [], [], [], []
        self.order = np.argsort(ids, kind="stable")
        self.ids, self.lengths, self.whole = ids[self.order], lengths, whole
        width = int(lengths.max(initial=0))
        if (lengths == width).all():
            self.matrix = values.reshape(len(ids), width)
        else:
            self.matrix = np.zeros((len(ids), width), values.dtype)
            starts = np.cumsum(lengths) - lengths
            for w in np.unique(lengths):
                here = np.flatnonzero(lengths == w)
                self.matrix[here, :w] = values[starts[here][:, None] + np.arange(w)]

    def range_of(self, keys):
        """Of each key the first place among the sorted ids, and how many there are."""
        import numpy as np

        low = np.searchsorted(self.ids, keys, "left")
        return low, np.searchsorted(self.ids, keys, "right") - low


def _multiplied(kept: list[str]):
    """Arrow batches sorted by place (cell * 3 + kind): left vectors, right vectors, then pairs."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def met(left, right, part):
            l_null, r_null = part.column("l").null_count, part.column("r").null_count
            l_key = part.column("l").fill_null(0).to_numpy(zero_copy_only=False)
            r_key = part.column("r").fill_null(0).to_numpy(zero_copy_only=False)
            (l_low, l_many), (r_low, r_many) = left.range_of(l_key), right.range_of(r_key)
            if l_null:
                l_many = np.where(np.asarray(part.column("l").is_null()), 0, l_many)
            if r_null:
                r_many = np.where(np.asarray(part.column("r").is_null()), 0, r_many)
            # A pair comes once for each of its left vectors and each of its right ones, or for none on the right.
            copies = l_many * np.maximum(r_many, 1)
            row = np.repeat(np.arange(part.num_rows), copies)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(copies) - copies, copies)
            each = np.maximum(r_many, 1)[row]
            found = r_many[row] > 0
            a = left.order[l_low[row] + nth // each]
            b = np.zeros(len(row), np.int64)
            b[found] = right.order[(r_low[row] + nth % each)[found]]
            known = found.copy()
            known[found] = left.whole[a[found]] & right.whole[b[found]] & (left.lengths[a[found]] == right.lengths[b[found]])
            value = np.zeros(len(row))
            here = np.flatnonzero(known)
            width = min(left.matrix.shape[1], right.matrix.shape[1])
            for start in range(0, len(here), _TILE):
                at = here[start : start + _TILE]
                terms = left.matrix[a[at], :width].astype("float64") * right.matrix[b[at], :width]
                # One by one, in the order of the vector, as the expression on columns adds.
                total = np.zeros(len(at))
                for i in range(width):
                    total += terms[:, i]
                value[at] = total
            columns = [part.column(c).take(pa.array(row)) for c in ("l", "r", *kept)]
            return pa.RecordBatch.from_arrays([*columns, pa.array(value, mask=~known)], names=["l", "r", *kept, "_product"])

        cell, left, right = None, None, None
        for batch in batches:
            place = np.asarray(batch.column("place"))
            cuts = np.flatnonzero(np.diff(place)) + 1
            for start, stop in zip(np.r_[0, cuts], np.r_[cuts, batch.num_rows]):
                if start == stop:
                    continue
                part, (here, kind) = batch.slice(start, stop - start), divmod(int(place[start]), 3)
                if here != cell:
                    cell, left, right = here, _Side(), _Side()
                if kind < 2:
                    (left, right)[kind].add(part.column("l" if kind == 0 else "r"), part.column("vector"))
                    continue
                for side in (left, right):
                    if side.ids is None:
                        side.close()
                yield met(left, right, part)

    return run


def products(pairs: DataFrame, left: DataFrame, right: DataFrame, left_on: str, right_on: str, output: str) -> DataFrame:
    """``pairs`` with the inner product of the vectors that columns ``left_on`` and ``right_on`` name.

    ``left`` and ``right`` have id (a whole number) and features. As of an inner join with
    ``left`` and a left join with ``right``: a pair whose left id has no row is left out; the product
    is NULL without a right one, with a NULL in a vector and for vectors of different lengths;
    a pair comes as often as its ids have rows.
    """
    kept = [c for c in pairs.columns if c not in (left_on, right_on)]
    blocks = [max(LEAST_BLOCKS, -(-side.count() // BLOCK)) for side in (left, right)]
    single = all(side.schema["features"].dataType.simpleString() == "array<float>" for side in (left, right))
    kind = "array<float>" if single else "array<double>"
    vector = F.col("features").cast(kind).alias("vector")

    def block(key: str, side: int):
        return F.pmod(F.xxhash64(F.col(key)), F.lit(blocks[side]))

    cell = block("l", 0) * blocks[1] + block("r", 1)
    none = [F.lit(None).cast(pairs.schema[c].dataType).alias(c) for c in kept]
    number, empty = F.col("id").cast("long"), F.lit(None).cast("long")

    def spread(side: int):
        """The blocks of the other side."""
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks[1 - side] - 1).cast("long"))).alias("_other")

    lefts = left.where("id IS NOT NULL").select(number.alias("l"), empty.alias("r"), vector, spread(0))
    rights = right.where("id IS NOT NULL").select(empty.alias("l"), number.alias("r"), vector, spread(1))
    asked = pairs.select(F.col(left_on).cast("long").alias("l"), F.col(right_on).cast("long").alias("r"), *kept).where("l IS NOT NULL")
    dealt = (
        lefts.select(((block("l", 0) * blocks[1] + F.col("_other")) * 3).alias("place"), "l", "r", "vector", *none)
        .unionByName(rights.select(((F.col("_other") * blocks[1] + block("r", 1)) * 3 + 1).alias("place"), "l", "r", "vector", *none))
        .unionByName(asked.select((cell * 3 + 2).alias("place"), "l", "r", F.array().cast(kind).alias("vector"), *kept))
    )
    # Pairs have an empty vector: Spark would go over all NULL lists of an Arrow batch again for each further one.
    fields = [StructField("l", LongType()), StructField("r", LongType()), *(pairs.schema[c] for c in kept)]
    found = (
        dealt.repartition(F.floor(F.col("place") / 3))
        .sortWithinPartitions("place")
        .mapInArrow(_multiplied(kept), StructType([*fields, StructField("_product", DoubleType())]))
    )
    return found.select(
        F.col("l").cast(pairs.schema[left_on].dataType).alias(left_on),
        F.col("r").cast(pairs.schema[right_on].dataType).alias(right_on),
        *kept,
        F.col("_product").alias(output),
    )

