"""Near-duplicate join: word n-gram Jaccard of 0.8 or more, by MinHash banding.

1. Each text becomes its set of hashed five-word shingles and, of that set, ``bands``
   hashes of ``rows`` minima each. Two texts of similarity s share a band with
   probability 1 - (1 - s**rows)**bands: 0.9999 at s = 0.8 for 30 bands of 6 rows.
2. Texts with equal shingle sets form one class before anything is shuffled by band, so
   copies cost one row, however many there are.
3. Classes that share a band value are linked to the least class of that value; the
   connected components of these links hold every candidate pair.
4. Within a component all pairs are verified on the full shingle sets. A component is
   cut into blocks of bounded shingles and sets; each pair of blocks is one unit of work, in which
   the sizes of all intersections come from one product of incidence matrices. Only
   counts and one link per text to its group leave the task, never the pairs.

Words are runs of characters other than ASCII white space, as written. A text of one to
four words has one shingle of all its words; a text without words has an empty set,
links to nothing and is its own class. Null text is empty. Rows with a null doc_id are
left out. Repeated rows of a doc_id count as one document per text: texts of one doc_id are
classes of their own, linked only if their sets are, and doc_id is the least of several classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom.llm import arrays
from trackloom.llm.tables import components
from trackloom.session import materialize

WORDS = 5
SIMILARITY = 0.8
BANDS = 30
ROWS = 6
BLOCK = 1 << 17  # shingles of a block
SETS = 1 << 11  # sets of a block, about: the matrices of two blocks have a row and a column for each
_COLUMNS = 1 << 12  # shingles of one matrix product


def _sorted_sets(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each row."""
    row = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    order = np.lexsort((values, row))
    values, row = values[order], row[order]
    keep = np.ones(len(values), bool)
    keep[1:] = (values[1:] != values[:-1]) | (row[1:] != row[:-1])
    values, row = values[keep], row[keep]
    return values, np.searchsorted(row, np.arange(len(starts)))


def text_sets(data: np.ndarray, starts: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    begins, ends, counts = arrays.words(data, starts)
    values, first = arrays.shingles(arrays.word_hashes(data, begins, ends), counts, words)
    return _sorted_sets(values, first)


def band_hashes(values: np.ndarray, starts: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit hash per text and band; texts must not be empty."""
    draw = np.random.default_rng(bands * 1_000 + rows)
    factors = draw.integers(1, 1 << 32, (bands, rows), dtype=np.uint32) | np.uint32(1)
    shifts = draw.integers(0, 1 << 32, (bands, rows), dtype=np.uint32)
    low = (values >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(starts) - 1, bands), np.uint64)
    for band in range(bands):
        key = np.full(len(starts) - 1, band + 1, np.uint64)
        for row in range(rows):
            least = np.minimum.reduceat(low * factors[band, row] + shifts[band, row], starts[:-1])
            key = arrays.mixed(key * np.uint64(0x9E3779B97F4A7C15) + least.astype(np.uint64))
        out[:, band] = key
    return out


def set_keys(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Two numbers that identify each row's set; zeros for an empty one."""
    keys = np.zeros((len(cuts) - 1, 2), np.uint64)
    full = np.flatnonzero(np.diff(cuts))
    if len(full):
        begins = cuts[full]
        keys[full, 0] = np.add.reduceat(values, begins)
        keys[full, 1] = np.add.reduceat(arrays.mixed(values ^ np.uint64(0xA5A5A5A5)), begins)
    return keys.view(np.int64)


def _lists(flat: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))


def _signature_rows(words: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = arrays.utf8(batch.column("text"))
            ids = batch.column("doc_id")
            for first, last in arrays.pieces(starts):
                base = starts[first]
                values, cuts = text_sets(data[base : starts[last]], starts[first : last + 1] - base, words)
                sizes = np.diff(cuts)
                full = np.flatnonzero(sizes)
                keys = set_keys(values, cuts)
                bandkeys = np.zeros((0, bands), np.uint64)
                if len(full):
                    bandkeys = band_hashes(values, np.r_[cuts[full], cuts[-1]], bands, rows)
                ends = np.concatenate([[0], np.cumsum(np.where(sizes > 0, bands, 0))])
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(first, last - first),
                        batch.column("text_md5").slice(first, last - first),
                        np.ascontiguousarray(keys[:, 0]),
                        np.ascontiguousarray(keys[:, 1]),
                        sizes.astype(np.int64),
                        _lists(np.ascontiguousarray(bandkeys).view(np.int64).ravel(), ends),
                    ],
                    names=["doc_id", "text_md5", "k1", "k2", "n", "bands"],
                )

    return run


def _set_rows(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = arrays.utf8(batch.column("text"))
            for first, last in arrays.pieces(starts):
                base = starts[first]
                values, cuts = text_sets(data[base : starts[last]], starts[first : last + 1] - base, words)
                body = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), last - first, [None, pa.py_buffer((cuts * 8).astype(np.int64)), pa.py_buffer(values.tobytes())]
                ).cast(pa.binary())
                kept = ["component", "node", "copies", "blocks"]
                cols = [batch.column(n).slice(first, last - first) for n in kept]
                made = pa.RecordBatch.from_arrays([*cols, body], names=[*kept, "body"])
                # A doc_id with several texts brings all of them; only that of the class has its set.
                keys = set_keys(values, cuts)
                wanted = (np.asarray(batch.column(n))[first:last] for n in ("k1", "k2"))
                own = np.logical_and.reduce([keys[:, i] == w for i, w in enumerate(wanted)])
                yield made.filter(pa.array(own))

    return run


def intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all left with all right sets, as one matrix."""
    a, b = np.concatenate(left), np.concatenate(right)
    common = np.intersect1d(a, b)  # other shingles cannot be in an intersection
    out = np.zeros((len(left), len(right)), np.int64)

    def placed(flat, sets):
        row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        at = np.searchsorted(common, flat)
        at[at == len(common)] = 0
        hit = common[at] == flat if len(common) else np.zeros(len(flat), bool)
        return row[hit], at[hit]

    (row_a, at_a), (row_b, at_b) = placed(a, left), placed(b, right)
    order_a, order_b = np.argsort(at_a, kind="stable"), np.argsort(at_b, kind="stable")
    row_a, at_a, row_b, at_b = row_a[order_a], at_a[order_a], row_b[order_b], at_b[order_b]
    for begin in range(0, len(common), _COLUMNS):
        span = min(_COLUMNS, len(common) - begin)
        one = np.zeros((len(left), span), np.float32)
        two = np.zeros((len(right), span), np.float32)
        i, j = np.searchsorted(at_a, [begin, begin + span])
        one[row_a[i:j], at_a[i:j] - begin] = 1
        i, j = np.searchsorted(at_b, [begin, begin + span])
        two[row_b[i:j], at_b[i:j] - begin] = 1
        out += (one @ two.T).astype(np.int64)
    return out


def linked(left: list[np.ndarray], right: list[np.ndarray], similarity: float) -> np.ndarray:
    shared = intersections(left, right)
    sizes = np.array([len(x) for x in left])[:, None] + np.array([len(x) for x in right])[None, :]
    return shared >= similarity * (sizes - shared) - 1e-9


def _verify(similarity: float):
    """Rows of one pair of blocks -> for each text, its verified copies and a link."""

    def unit(rows: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        reps, copies, block = (np.array(rows[n]) for n in ("node", "copies", "block"))
        sets = [np.frombuffer(x, np.uint64) for x in rows["body"]]
        if rows["lo"][0] == rows["hi"][0]:
            mask = linked(sets, sets, similarity)
            np.fill_diagonal(mask, False)
            one = two = np.arange(len(sets))
        else:
            one, two = np.flatnonzero(block == rows["lo"][0]), np.flatnonzero(block == rows["hi"][0])
            if not len(one) or not len(two):
                return reps[:0], copies[:0], reps[:0]
            mask = linked([sets[i] for i in one], [sets[i] for i in two], similarity)
        counts = np.zeros(len(sets), np.int64)
        best = reps.copy()
        top = np.iinfo(np.int64).max
        counts[one] += mask @ copies[two]
        best[one] = np.minimum(best[one], np.where(mask, reps[two], top).min(axis=1))
        if one is not two:
            counts[two] += mask.T @ copies[one]
            best[two] = np.minimum(best[two], np.where(mask.T, reps[one], top).min(axis=1))
        # The least partner alone may leave a group in parts, so links are followed to a root.
        root = {r: r for r in reps.tolist()}

        def find(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for i, j in _tree(mask):
            a, b = find(int(reps[one[i]])), find(int(reps[two[j]]))
            root[max(a, b)] = min(a, b)
        return reps, counts, np.array([find(r) for r in reps.tolist()], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        key = None
        done: list = []

        def finish():
            if held:
                done.append(unit(held))

        def packed():
            made = [np.concatenate(x) for x in zip(*done)]
            done.clear()
            return pa.RecordBatch.from_arrays(made, names=["node", "links", "root"])

        for batch in batches:
            rows = batch.to_pydict()
            for i in range(batch.num_rows):
                now = rows["component"][i], rows["lo"][i], rows["hi"][i]
                if now != key:
                    finish()
                    held, key = {n: [] for n in rows}, now
                elif held["node"][-1] == rows["node"][i]:
                    continue  # texts of one doc_id with one set
                for n in rows:
                    held[n].append(rows[n][i])
            if done:
                yield packed()
        finish()
        if done:
            yield packed()

    return run


def _tree(mask: np.ndarray) -> Iterator[tuple[int, int]]:
    """A few links of ``mask`` that connect what all of them connect (a spanning forest)."""
    rows, columns = mask.shape
    open_rows, open_columns = np.ones(rows, bool), np.ones(columns, bool)
    for start in range(rows):
        queue = [start] if open_rows[start] else []
        open_rows[start] = False
        while queue:
            i = queue.pop()
            for j in np.flatnonzero(mask[i] & open_columns):
                open_columns[j] = False
                yield i, int(j)
                for k in np.flatnonzero(mask[:, j] & open_rows):
                    open_rows[k] = False
                    yield int(k), int(j)
                    queue.append(int(k))


def near_duplicates(docs: DataFrame, **settings) -> DataFrame:
    """One row per document: doc_id, class_id, n_links, copy_id.

    class_id is the least doc_id of the document's connected group, n_links the number of
    other documents of the similarity or more, copy_id the least doc_id with the same
    shingle set. ``settings`` are those of :func:`grouped`.
    """
    return grouped(docs, **settings).drop("text_md5")


def grouped(
    docs: DataFrame,
    words: int = WORDS,
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
    block: int = BLOCK,
    sets_block: int = SETS,
) -> DataFrame:
    """As :func:`near_duplicates`, and text_md5, the digest of the row's text (null is empty)."""
    texts = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text")
    signed = materialize(
        texts.withColumn("text_md5", F.md5(F.coalesce("text", F.lit("")).cast("binary"))).mapInArrow(
            _signature_rows(words, bands, rows), "doc_id long, text_md5 string, k1 long, k2 long, n long, bands array<long>"
        ),
        "signatures",
    )
    # One row per different set, with a number of its own: a doc_id can be the least of several.
    alike = ["k1", "k2", "n"]
    classes = signed.where("n > 0").groupBy(*alike).agg(
        F.min("doc_id").alias("rep"), F.countDistinct("doc_id").alias("copies"), F.any_value("bands").alias("bands")
    )
    classes = materialize(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    banded = classes.select("node", F.explode("bands").alias("band"))
    least = banded.groupBy("band").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    edges = banded.join(least.drop("high"), "band").where("node <> low").select("node", "low").distinct()
    found = components(edges, "node", "low").withColumnRenamed("root", "component")
    members = materialize(classes.drop("bands").join(found, "node"), "members")
    most = F.greatest(F.sum("n") / block, F.count("*") / sets_block)
    blocks = members.groupBy("component").agg(F.ceil(most).cast("int").alias("blocks"))
    # It grows with the input, so it is never broadcast, however small it is today.
    wanted = members.join(blocks, "component").select("component", "node", "rep", "k1", "k2", "copies", "blocks").hint("merge")
    sets = (
        texts.join(wanted, F.col("doc_id") == F.col("rep"))
        .select("component", "node", "copies", "blocks", "k1", "k2", "text", F.md5(F.col("text").cast("binary")).alias("md5"))
        .dropDuplicates(["node", "md5"])
        .mapInArrow(_set_rows(words), "component long, node long, copies long, blocks int, body binary")
    )
    mine = F.pmod(F.xxhash64("node"), F.col("blocks").cast("long")).cast("int")
    units = (
        sets.withColumn("block", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "component",
            F.least("block", "other").alias("lo"),
            F.greatest("block", "other").alias("hi"),
            "block",
            "node",
            "copies",
            "body",
        )
    )
    checked = materialize(
        units.repartition("component", "lo", "hi")
        .sortWithinPartitions("component", "lo", "hi", "node")
        .mapInArrow(_verify(similarity), "node long, links long, root long"),
        "verified",
    )
    links = checked.groupBy("node").agg(F.sum("links").alias("links"))
    groups = materialize(components(checked.where("node <> root"), "node", "root"), "groups")
    named = groups.join(classes.select("node", "rep"), "node").groupBy("root").agg(F.min("rep").alias("class_id"))
    summary = (
        classes.drop("bands")
        .join(links, "node", "left")
        .join(groups.join(named, "root").select("node", "class_id"), "node", "left")
        .select(
            *alike,
            "rep",
            F.coalesce("class_id", "rep").alias("class_id"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    return (
        signed.drop("bands")
        .join(summary, alike, "left")
        .select(
            "doc_id",
            F.coalesce("class_id", "doc_id").alias("class_id"),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("rep", "doc_id").alias("copy_id"),
            "text_md5",
        )
    )
