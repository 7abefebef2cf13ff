"""Benchmark passages in documents, also with small edits, by CGK embedding.

An item leaks into a document when some part of the document is within ``1 - similarity``
of the item's bytes in edit distance.

1. *Windows* are as long as the items of a length class. A window with at most d edits keeps at
   least n - 11 - 12 d of an item's n - 11 runs of twelve bytes; places that are followed by
   fewer runs known from any item cannot begin a leak. All other places can, whatever is
   before them, and windows begin at every few of them: so close that the nearest is fewer
   bytes off than the item may have edits.
2. *Embedding.* A random walk reads the window: each step writes the byte under the
   pointer and moves on if a random bit for this step and byte says so (Chakraborty,
   Goldenberg, Koucky). Few edits become few differing places.
3. *Bit sampling.* ``samples`` keys of ``bits`` places from each of ``walks`` walks meet
   those of the items. Two embeddings that differ in a share h of the places share a key
   with probability 1 - (1 - (1 - h) ** bits) ** samples for each walk.
4. *Verification.* Edit distance of the whole item to the best part around the window.

Items of more than ``LONGEST`` bytes are looked for by all pieces of that length, of which one
has no more than its share of the edits, and verified whole. Items of fewer than twelve
bytes have no runs and no edits; they are matched as they are.

Items come to the tasks in blocks of ``ITEMS`` pieces, so that what is broadcast has a bound: a
task draws the walks again from their seed. A larger benchmark takes more passes over the
documents, one after the other, whose finds are stored.

Null or empty texts and items take no part; rows with a null doc_id or item_id neither.
Repeated ids are searched each and reported once. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom.llm import arrays
from trackloom.session import materialize

SIMILARITY = 0.95
WALKS = 3
SAMPLES = 32
BITS = 5
ITEMS = 2_000
LONGEST = 2_000
GRAM = 12
_SLOTS = 22
_SPREAD = 1.3  # longest to shortest item of a class
_PIECE = 1 << 21  # bytes of texts searched at a time
_APART = 4  # bytes between windows, for items that may have so many edits


def grams(data: np.ndarray) -> np.ndarray:
    """Each run of twelve bytes as one number, spread over the slots of the filter."""
    if len(data) < GRAM:
        return np.zeros(0, np.int64)
    four = data.astype(np.uint32)
    for step in (1, 2):
        four = four[:-step] | (four[step:] << np.uint32(8 * step))
    four = four.astype(np.uint64)
    x = four[:-8] * np.uint64(0x9E3779B97F4A7C15)
    x += four[4:-4] * np.uint64(0xC2B2AE3D27D4EB4F)
    x += four[8:] * np.uint64(0x165667B19E3779F9)
    return (x >> np.uint64(64 - _SLOTS)).astype(np.int32)


def edits(size: int, similarity: float) -> int:
    """Edits allowed to an item, as many as leave one run of twelve bytes at least."""
    return max(0, min(int(size * (1 - similarity) + 1e-9), (size - GRAM) // GRAM))


def piece_places(size: int) -> list[int]:
    """Where the pieces of an item begin: all are LONGEST bytes, or the whole of a shorter item."""
    return [0] if size <= LONGEST else [*range(0, size - LONGEST, LONGEST), size - LONGEST]


def walk_places(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, bits: np.ndarray, sampled: np.ndarray) -> np.ndarray:
    """The bytes that the walk with ``bits`` (step, byte) writes at the sampled steps, one row per window.

    ``data`` ends with a zero byte, which a walk past its window reads.
    """
    at = begins.astype(np.int64)
    last = len(data) - 1
    out = np.zeros((len(begins), len(bits)), np.uint8)
    wanted = np.zeros(len(bits), bool)
    wanted[sampled] = True
    for step in range(len(bits)):
        here = data[np.where(at < ends, at, last)]
        if wanted[step]:
            out[:, step] = here
        at += bits[step][here]
    return out[:, sampled]


def fitting_distance(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Least edit distance of ``item`` to any part of ``text``, and where that part ends."""
    columns = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for i, symbol in enumerate(item):
        step = np.empty_like(row)
        step[0] = i + 1
        step[1:] = np.minimum(row[:-1] + (text != symbol), row[1:] + 1)
        row = np.minimum.accumulate(step - columns) + columns
    end = int(row.argmin())
    return int(row[end]), end


class Probe:
    """The pieces of one block of items: filter, classes and keys.

    ``pieces`` has (item id, whole item, where the piece begins in it); what is derived of them is
    made once in each worker.
    """

    def __init__(self, pieces, similarity, walks, samples, bits, seed=5):
        self.pieces = sorted(pieces, key=lambda p: (min(len(p[1]) - p[2], LONGEST), p[0], p[2], p[1]))
        self.similarity, self.walks, self.samples, self.bits, self.seed = similarity, walks, samples, bits, seed

    def __reduce__(self):
        return Probe, (self.pieces, self.similarity, self.walks, self.samples, self.bits, self.seed)

    @cached_property
    def items(self):
        """(id, whole item, place of the piece, the piece, edits of the piece, edits of the item) of at least twelve bytes."""
        out = []
        for name, text, place in self.pieces:
            if len(text) >= GRAM:
                whole = np.frombuffer(text, np.uint8)
                piece = whole[place : place + LONGEST]
                out.append((name, whole, place, piece, edits(len(piece), self.similarity), edits(len(whole), self.similarity)))
        return out

    @cached_property
    def short(self):
        return [(name, text) for name, text, _ in self.pieces if len(text) < GRAM]

    @cached_property
    def grams(self):
        return [grams(piece) for _, _, _, piece, _, _ in self.items]

    @cached_property
    def known(self):
        """For each slot of the filter, a bit for every class that has an item with such a run."""
        known = np.zeros(1 << _SLOTS, np.uint32)
        for number, (first, last, *_) in enumerate(self.classes):
            for runs in self.grams[first:last]:
                known[runs] |= np.uint32(1 << number)
        return known

    @cached_property
    def classes(self):
        """(first and last item, window, known runs it needs, its reach, bytes between windows, tables)."""
        out, first = [], 0
        draw = np.random.default_rng(self.seed)
        pieces = [(piece, d) for _, _, _, piece, d, _ in self.items]
        while first < len(pieces):
            short = len(pieces[first][0])
            last = first
            while last < len(pieces) and len(pieces[last][0]) <= short * _SPREAD:
                last += 1
            members = pieces[first:last]
            need = min(len(t) - GRAM + 1 - GRAM * d for t, d in members)
            reach = max(len(t) + d for t, d in members)
            apart = max(1, min(_APART, min(d for _, d in members)))
            tables = []
            # In two steps a byte the walk has read about the whole window.
            steps = 2 * short
            data = np.concatenate([*(t for t, _ in members), np.zeros(1, np.uint8)])
            begins = np.concatenate([[0], np.cumsum([len(t) for t, _ in members])])[:-1]
            for _ in range(self.walks):
                moves = draw.integers(0, 2, (steps, 256), dtype=np.uint8)
                places = np.sort(draw.integers(0, steps, (self.samples, self.bits)), axis=1)
                sampled, index = np.unique(places, return_inverse=True)
                index = index.reshape(places.shape)
                mine = _keys(walk_places(data, begins, begins + short, moves, sampled), index)
                order = np.argsort(mine, axis=0, kind="stable")
                tables.append((moves, sampled, index, np.take_along_axis(mine, order, 0), order))
            out.append((first, last, short, max(1, need), reach, apart, tables))
            first = last
        return out

    def windows(self, data, starts):
        """For each class, begins and row ends of the windows with enough runs known from its items."""
        runs = grams(data)
        if not len(runs) or not self.classes:
            return
        found = self.known[runs]
        places = np.flatnonzero(found)
        found = found[places]
        for number, group in enumerate(self.classes):
            _, _, _, need, reach, apart, _ = group
            own = places[(found >> np.uint32(number)) & np.uint32(1) == 1]
            if len(own) < need:
                continue
            # Where ``need`` of the runs follow: the places up to the first of them, not too far from the last.
            high = own[: len(own) - need + 1]
            low = np.maximum(own[need - 1 :] - (reach - GRAM), 0)
            row = np.searchsorted(starts, high, side="right") - 1
            low = np.maximum(low, starts[row])
            fits = (low <= high) & (own[need - 1 :] + GRAM <= starts[row + 1])
            low, high = low[fits], high[fits]
            if not len(low):
                continue
            # Both ends rise, so that ranges that overlap or touch are united in order.
            new = np.r_[True, low[1:] > high[:-1] + 1]
            first, last = low[new], high[np.r_[new[1:], True]]
            # Every few places of a range, its first and its last.
            count = (last - first) // apart + 1
            begins = np.repeat(first, count) + apart * (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count))
            begins = np.unique(np.concatenate([begins, last]))
            yield group, begins, starts[np.searchsorted(starts, begins, side="right")]

    def candidates(self, data, starts):
        """(item index, window start) pairs that share a key, each once, and how often."""
        padded = np.r_[data, np.uint8(0)]
        for (first, _, short, _, _, _, tables), begins, ends in self.windows(data, starts):
            until = np.minimum(begins + short, ends)
            found = []
            for moves, sampled, index, sorted_keys, order in tables:
                mine = _keys(walk_places(padded, begins, until, moves, sampled), index)
                for s in range(mine.shape[1]):
                    low = np.searchsorted(sorted_keys[:, s], mine[:, s])
                    high = np.searchsorted(sorted_keys[:, s], mine[:, s], side="right")
                    at = np.flatnonzero(high > low)
                    while len(at):
                        found.append((first + order[low[at], s]) * (len(data) + 1) + begins[at])
                        low[at] += 1
                        at = at[low[at] < high[at]]
            if found:
                pairs, votes = np.unique(np.concatenate(found), return_counts=True)
                yield pairs // (len(data) + 1), pairs % (len(data) + 1), votes

    def exact(self, data, starts):
        """(row, item id, 0, byte offset) of the first place of each short item in each row."""
        body = data.tobytes() if self.short else b""
        for name, text in self.short:
            at = body.find(text)
            while at >= 0:
                row = int(np.searchsorted(starts, at, side="right")) - 1
                if at + len(text) <= starts[row + 1]:
                    yield row, name, 0, at - int(starts[row])
                    at = int(starts[row + 1]) - 1  # on to the next row
                at = body.find(text, at + 1)

    def leaks(self, data, starts):
        """(row, item id, distance, byte offset) of verified leaks, the best of each row and item."""
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for row, name, distance, at in self.exact(data, starts):
            best[row, name] = min(best.get((row, name), (1, 0)), (distance, at))
        for which, at, votes in self.candidates(data, starts):
            row = np.searchsorted(starts, at, side="right") - 1
            order = np.lexsort((at, -votes, row, which))
            tried: list[int] = []
            group = None
            for k in order.tolist():
                index, r = int(which[k]), int(row[k])
                name, item, place, piece, _, most = self.items[index]
                if (r, index) != group:
                    group, tried = (r, index), []
                low, high = int(starts[r]), int(starts[r + 1])
                begin = int(at[k]) - place  # where the whole item would begin
                if best.get((r, name), (most + 1, 0))[0] == 0 or any(abs(begin - t) <= most // 2 for t in tried):
                    continue
                if begin >= low and np.array_equal(data[begin : min(begin + len(item), high)], item):
                    best[r, name] = (0, begin - low)
                    continue
                tried.append(begin)
                left, right = max(low, begin - most - _APART), min(high, begin + len(item) + most + _APART)
                around = data[left:right]
                runs = self.grams[index] if len(piece) == len(item) else grams(item)
                if np.isin(grams(around), runs).sum() < len(item) - GRAM + 1 - GRAM * most:
                    continue  # too few runs in common for so few edits
                distance, end = fitting_distance(item, around)
                if distance <= most and distance < best.get((r, name), (most + 1, 0))[0]:
                    best[r, name] = (distance, max(left + end - len(item), low) - low)
        return [(r, name, *value) for (r, name), value in sorted(best.items())]


def _keys(places: np.ndarray, index: np.ndarray) -> np.ndarray:
    """One number per window and sample of places."""
    out = np.zeros((len(places), len(index)), np.uint64)
    for sample, columns in enumerate(index):
        for column in columns:
            out[:, sample] = out[:, sample] * np.uint64(257) + places[:, column]
    return out


def _search(probe):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = probe.value
        for batch in batches:
            data, starts = arrays.utf8(batch.column("text"))
            ids, digests = np.asarray(batch.column("doc_id")), batch.column("text_md5")
            found = []
            for a, b in arrays.pieces(starts, _PIECE):
                own = starts[a : b + 1] - starts[a]
                for r, *x in items.leaks(data[starts[a] : starts[b]], own):
                    found.append((int(ids[a + r]), digests[int(a + r)].as_py(), *x))
            if found:
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
                columns = [pa.array(c, k) for c, k in zip(zip(*found), kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_md5", "item_id", "distance", "begin"])

    return run


def _blocks(benchmark: DataFrame, size: int) -> Iterator[list[tuple[int, bytes, int]]]:
    """Pieces of items, about ``size`` of them at a time; one block is on the driver."""
    rows = benchmark.where(F.col("item_id").isNotNull() & (F.octet_length("text") > 0)).select("item_id", "text")
    held = []
    for row in rows.distinct().orderBy("item_id", "text").toLocalIterator():
        body = row.text.encode()
        held += [(row.item_id, body, place) for place in piece_places(len(body))]
        if len(held) >= size:
            yield held
            held = []
    if held:
        yield held


def found_in(
    docs: DataFrame,
    benchmark: DataFrame,
    similarity: float = SIMILARITY,
    walks: int = WALKS,
    samples: int = SAMPLES,
    bits: int = BITS,
    block: int = ITEMS,
) -> DataFrame:
    """doc_id, text_md5, item_id, distance and begin of all that is found, by text; stored block by block."""
    spark = docs.sparkSession
    texts = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text")
    texts = texts.withColumn("text_md5", F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    schema = "doc_id long, text_md5 string, item_id long, distance long, begin long"
    found = spark.createDataFrame([], schema)
    for pieces in _blocks(benchmark, block):
        probe = spark.sparkContext.broadcast(Probe(pieces, similarity, walks, samples, bits))
        found = found.union(materialize(texts.mapInArrow(_search(probe), schema), "leaks"))
        probe.unpersist()
    return found


def leaks(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """doc_id, item_id, distance (edits) and begin (byte, about) of each leaked item."""
    return (
        found_in(docs, benchmark, **settings)
        .groupBy("doc_id", "item_id")
        .agg(F.min(F.struct("distance", "begin")).alias("best"))
        .select("doc_id", "item_id", "best.distance", "best.begin")
    )


def clean(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """``docs`` without the rows into whose text an item leaks."""
    leaky = found_in(docs, benchmark, **settings).select("doc_id", "text_md5").distinct()
    same = (docs["doc_id"] == leaky["doc_id"]) & (F.md5(F.coalesce(docs["text"], F.lit("")).cast("binary")) == leaky["text_md5"])
    return docs.join(leaky, same, "left_anti").select(docs.columns)
