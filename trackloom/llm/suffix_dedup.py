"""Repeated passages across documents, by column-wise construction of suffix order.

A byte goes when it is covered by a run of ``span`` bytes that also starts in a
document with a smaller id. Steps:

1. *Anchors.* Of each document the least hash in every window of ``span`` bytes
   (a minimizer) is kept. Equal windows have equal anchors at equal offsets, so only
   anchors found in two documents matter, and the windows whose least hash they are.
2. *Segments.* Such windows, with the bytes they cover, go to their anchor's hash:
   a segment is a string of at most ``2 * span - key`` bytes, aligned at its anchor.
   Of equal segments in one piece of texts only those of the smallest document go
   there: all windows of the others are removed, whatever else the anchor has.
3. *Columns.* The segments of many anchors are built as one collection. Each round
   inserts one symbol per segment, from the last column to the first: the new order
   of the suffixes is the stable sort of the old one by the inserted symbol (the
   Burrows-Wheeler step of Bauer, Cox and Rosone), and the common prefix of two
   neighbours is one more than the least common prefix between their predecessors.
   Neighbours of a column with a common prefix of ``span`` bytes hold equal windows.
4. *Removal.* Every window equal to one of a smaller id is removed from its document.

The external files are Spark's sorted shuffle partitions: a task streams them, in the
order of (anchor, document), in collections of bounded size. When an anchor has more
segments than one collection holds, the distinct windows seen so far are carried over.
Exact copies of a text are settled by their digest and never reach steps 1 to 3.

Texts are shuffled once, compressed, and that exchange serves all steps. Anchors are
shuffled as packed arrays; those that a piece of some megabytes holds in two documents are
known to be shared there and leave it once, so that a passage of a third of all documents
brings a task one entry per piece, not one per document.

Null text is empty. A null doc_id neither removes nor loses anything. Rows that repeat a
doc_id do not remove each other's bytes; each is cut against the smaller ids.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom.llm import arrays

SPAN = 50
KEY = 20
COLLECTION = 30_000
RANGE = 1 << 24  # bytes of text whose anchors one task compares
_PIECE = 1 << 21
_SINGLE, _KNOWN, _HEAD = 0, 1, 2
_NONE = np.iinfo(np.int64).max


def anchors(data: np.ndarray, starts: np.ndarray, span: int, key: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of all anchors; windows that leave a text do not count."""
    width = span - key + 1
    hashes = arrays.window_hashes(data, key)
    if len(data) < span:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    hashes = np.maximum(hashes, np.uint64(1))
    least = arrays.sliding(hashes, width, np.minimum)
    ends = np.repeat(starts[1:], np.diff(starts))[: len(least)]
    least[np.arange(len(least)) + span > ends] = 0
    padded = np.zeros(len(least) + 2 * (width - 1), np.uint64)
    padded[width - 1 : width - 1 + len(least)] = least
    most = arrays.sliding(padded, width, np.maximum)
    at = np.flatnonzero(hashes == most[: len(hashes)])
    return at, hashes[at]


def window_ranges(at: np.ndarray, values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last window whose least hash is that of each anchor (last < first: none)."""
    low, high = at - width + 1, at.copy()
    for side in (-1, 1):
        open_ = np.arange(len(at))
        step = 1
        while len(open_):
            other = open_ + side * step
            open_, other = open_[(other >= 0) & (other < len(at))], other[(other >= 0) & (other < len(at))]
            near = np.abs(at[other] - at[open_]) < width
            open_, other = open_[near], other[near]
            less = values[other] < values[open_]
            if side < 0:
                low[open_[less]] = np.maximum(low[open_[less]], at[other[less]] + 1)
            else:
                high[open_[less]] = np.minimum(high[open_[less]], at[other[less]] - width)
            open_ = open_[~less]
            step += 1
    return low, high


def _planes(values: np.ndarray, kind) -> bytes:
    """The bytes of ``values``, the lowest of all first: high bytes are mostly zero and compress."""
    raw = np.ascontiguousarray(values, kind).view(np.uint8).reshape(len(values), np.dtype(kind).itemsize)
    return raw.T.tobytes()


def _unplaned(data: bytes, kind, width: int | None = None) -> np.ndarray:
    size = np.dtype(kind).itemsize
    width = width or size
    raw = np.frombuffer(data, np.uint8).reshape(width, -1)
    out = np.zeros((raw.shape[1], size), np.uint8)
    out[:, :width] = raw.T
    return out.view(kind).ravel()


def _texts(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the compressed texts of a batch, and where each begins."""
    bodies = [zlib.decompress(x) for x in batch.column("body").to_pylist()]
    starts = np.concatenate([[0], np.cumsum([len(x) for x in bodies], dtype=np.int64)]).astype(np.int64)
    return np.frombuffer(b"".join(bodies), np.uint8), starts


def _packed(kind: int, part: int, docs, at, hashes) -> tuple:
    """One row: anchors of one piece and part, in the order of their documents."""
    new = np.flatnonzero(np.r_[True, docs[1:] != docs[:-1]]) if len(docs) else np.zeros(0, np.int64)
    ids, counts = docs[new], np.diff(np.r_[new, len(docs)])
    return (
        part,
        kind,
        _planes(np.diff(ids, prepend=0), np.int64),
        _planes(counts, np.int32),
        _planes(at, np.int32),
        _planes(hashes, np.uint64)[: 6 * len(hashes)],
    )


def _unpacked(row: dict):
    ids = np.cumsum(_unplaned(row["docs"], np.int64))
    docs = np.repeat(ids, _unplaned(row["counts"], np.int32))
    return docs, _unplaned(row["at"], np.int32), _unplaned(row["hashes"], np.uint64, 6)


_PACKED = "part int, kind int, docs binary, counts binary, at binary, hashes binary"
_PACKED_NAMES = ["part", "kind", "docs", "counts", "at", "hashes"]


def _anchor_rows(span: int, key: int, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.small(batches):
            batch = batch.filter(_eligible(batch))
            if not batch.num_rows:
                continue
            data, starts = _texts(batch)
            ids = np.asarray(batch.column("doc_id"))
            for first, last in arrays.pieces(starts, _PIECE):
                found = [(a, b) for a, b in _anchors_of(data, starts, first, last, span, key)]
                at = np.concatenate([x[1] for x, _ in found])
                row = np.concatenate([x[0] for x, _ in found])
                # 48 bits: a chance match costs a comparison later, never a wrong result.
                values = np.concatenate([v for _, v in found]) >> np.uint64(16)
                if not len(at):
                    continue
                docs = ids[row]
                order = np.argsort(values, kind="stable")
                heads = np.flatnonzero(np.r_[True, values[order][1:] != values[order][:-1]])
                low, high = np.minimum.reduceat(docs[order], heads), np.maximum.reduceat(docs[order], heads)
                many = np.zeros(len(at), bool)
                many[order] = np.repeat(low != high, np.diff(np.r_[heads, len(at)]))
                known = values[order][heads][low != high]
                rows = [_packed(_KNOWN, int(ids[first] % parts), docs[many], at[many], values[:0])] if many.any() else []
                part = (values % np.uint64(parts)).astype(np.int64)
                for which, sel in _by_part(part, ~many):
                    rows.append(_packed(_SINGLE, which, docs[sel], at[sel], values[sel]))
                for which, sel in _by_part((known % np.uint64(parts)).astype(np.int64), np.ones(len(known), bool)):
                    rows.append(_packed(_HEAD, which, docs[:0], at[:0], known[sel]))
                kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 4]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=_PACKED_NAMES
                )

    return run


def _anchors_of(data, starts, first, last, span, key):
    """((row, position in the text), hash) of the anchors of the rows, a smaller piece at a time."""
    for a, b in arrays.pieces(starts[first : last + 1]):
        a, b = a + first, b + first
        own = starts[a : b + 1] - starts[a]
        at, values = anchors(data[starts[a] : starts[b]], own, span, key)
        row = np.searchsorted(own, at, side="right") - 1
        yield (row + a, (at - own[row]).astype(np.int32)), values


def _by_part(part: np.ndarray, chosen: np.ndarray):
    rows = np.flatnonzero(chosen)
    rows = rows[np.argsort(part[rows], kind="stable")]
    cuts = np.flatnonzero(np.diff(part[rows])) + 1
    for piece in np.split(rows, cuts):
        if len(piece):
            yield int(part[piece[0]]), piece


def _shared_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Positions of the anchors that two documents hold, from the packed rows of whole parts."""
    now, held = None, []

    def out(docs, at):
        return pa.RecordBatch.from_arrays([pa.array(docs), pa.array(at)], names=["doc_id", "at"])

    def solve():
        docs, at, values = (np.concatenate(x) for x in zip(*[_unpacked(r) for r in held]))
        single = np.concatenate([np.full(len(r["hashes"]) // 6, r["kind"] == _SINGLE) for r in held])
        known = values[~single]
        values = values[single]
        order = np.argsort(values, kind="stable")
        sorted_ = values[order]
        heads = np.flatnonzero(np.r_[True, sorted_[1:] != sorted_[:-1]]) if len(values) else np.zeros(0, np.int64)
        if not len(heads):
            return out(docs, at)
        ids = docs[order]
        shared = np.minimum.reduceat(ids, heads) != np.maximum.reduceat(ids, heads)
        shared |= np.isin(sorted_[heads], known)
        keep = order[np.repeat(shared, np.diff(np.r_[heads, len(values)]))]
        return out(docs[keep], at[keep])

    for batch in batches:
        for row in batch.to_pylist():
            if row["kind"] == _KNOWN:
                docs, at, _ = _unpacked(row)
                yield out(docs, at)
                continue
            if held and row["part"] != now:
                yield solve()
                held = []
            now = row["part"]
            held.append(row)
    if held:
        yield solve()


def _eligible(batch: pa.RecordBatch) -> pa.Array:
    return pc.and_(pc.is_valid(batch.column("doc_id")), pc.invert(batch.column("copy")))


def checks(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A digest of each range of bytes."""
    body = data.tobytes()
    digests = (xxhash.xxh64_intdigest(body[a:b]) for a, b in zip(begin.tolist(), end.tolist()))
    return np.fromiter(digests, np.uint64, len(begin)).view(np.int64)


def held_earlier(values, lead, low, sizes, docs, data: np.ndarray, columns: int) -> np.ndarray:
    """Whether a smaller document has an equal segment (anchor, lead and bytes) among these."""
    covered = np.zeros(len(values), bool)
    order = np.argsort(values, kind="stable")
    heads = np.flatnonzero(np.r_[True, values[order][1:] != values[order][:-1]]) if len(order) else order
    counts = np.diff(np.r_[heads, len(order)])
    some = order[np.repeat(counts > 1, counts)]
    if not len(some):
        return covered
    padded = np.concatenate([data, np.zeros(columns, np.uint8)])
    body = np.lib.stride_tricks.sliding_window_view(padded, columns)[low[some]]
    body[np.arange(columns) >= sizes[some, None]] = 0
    shape = np.column_stack([values[some].view(np.int64), lead[some], sizes[some]]).astype(np.int64)
    rows = np.hstack([shape.view(np.uint8), body])
    _, group = np.unique(rows.view(np.dtype((np.void, rows.shape[1]))).ravel(), return_inverse=True)
    least = np.full(len(some), _NONE)
    np.minimum.at(least, group, docs[some])
    covered[some] = docs[some] > least[group]
    return covered


def _segment_rows(span: int, key: int):
    width = span - key + 1
    names = ["anchor", "doc_id", "low", "lead", "bytes", "check"]

    def removed(data, base, docs, begin, end) -> pa.RecordBatch:
        """Ranges of known result, in order: united, without bytes, their length in place of the lead."""
        new = np.flatnonzero(np.r_[True, (docs[1:] != docs[:-1]) | (base[1:] != base[:-1]) | (begin[1:] > end[:-1])])
        last = np.r_[new[1:] - 1, len(docs) - 1]
        docs, base, begin, size = docs[new], base[new], begin[new], end[last] - begin[new]
        check = checks(data, base + begin, base + begin + size)
        none = pa.nulls(len(docs), pa.binary())
        return pa.RecordBatch.from_arrays([docs, docs, begin.astype(np.int32), size.astype(np.int32), none, check], names=names)

    def piece(data, own, ids, shared) -> Iterator[pa.RecordBatch]:
        at, values = anchors(data, own, span, key)
        row = np.searchsorted(own, at, side="right") - 1
        known = np.isin(at, shared, assume_unique=True)
        low, high = window_ranges(at, values, width)
        low, high = np.maximum(low, own[row]), np.minimum(high, own[row + 1] - span)
        keep = known & (low <= high)
        at, row, low, high, values = at[keep], row[keep], low[keep], high[keep], values[keep]
        sizes = high - low + span
        covered = held_earlier(values, at - low, low, sizes, ids[row], data, 2 * span - key)
        if covered.any():
            begin = (low - own[row])[covered]
            yield removed(data, own[row][covered], ids[row][covered], begin, begin + sizes[covered])
            at, row, low, values, sizes = (x[~covered] for x in (at, row, low, values, sizes))
        ends = np.concatenate([[0], np.cumsum(sizes)])
        index = np.arange(ends[-1]) - np.repeat(ends[:-1] - low, sizes)
        body = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(at), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data[index].tobytes())]
        )
        yield pa.RecordBatch.from_arrays(
            [
                values.view(np.int64),
                ids[row],
                (low - own[row]).astype(np.int32),
                (at - low).astype(np.int32),
                body.cast(pa.binary()),
                pa.nulls(len(at), pa.int64()),
            ],
            names=names,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.small(batches):
            batch = batch.filter(pc.and_(_eligible(batch), pc.is_valid(batch.column("at"))))
            if not batch.num_rows:
                continue
            data, starts = _texts(batch)
            ids = np.asarray(batch.column("doc_id"))
            lists = batch.column("at")
            cuts, flat = np.asarray(lists.offsets), np.asarray(lists.values)
            for first, last in arrays.pieces(starts):
                base = starts[first]
                own = starts[first : last + 1] - base
                counts = np.diff(cuts[first : last + 1])
                shared = flat[cuts[first] : cuts[last]] + np.repeat(own[:-1], counts)
                yield from piece(data[base : starts[last]], own, ids[first:last], np.sort(shared))

    return run


def smaller_windows(
    matrix: np.ndarray, first: np.ndarray, last: np.ndarray, docs: np.ndarray, span: int
) -> np.ndarray:
    """For each segment and column: the least document among equal windows.

    ``matrix`` holds one aligned segment a row, zero outside it; windows start at the
    columns ``first`` to ``last`` of their row. Columns are inserted from the last to the
    first, one symbol per segment and round.
    """
    rows, columns = matrix.shape
    least = np.full((rows, max(columns - span + 1, 0)), _NONE, np.int64)
    order = np.arange(rows)
    common = np.zeros(rows, np.int32)  # with the suffix before it in the order
    for column in range(columns - 1, -1, -1):
        symbols = matrix[order, column]
        step = np.argsort(symbols, kind="stable")
        symbols = symbols[step]
        heads = np.flatnonzero(np.r_[True, symbols[1:] != symbols[:-1]])
        grown = np.zeros(rows, np.int32)
        for begin, end in zip(heads, np.r_[heads[1:], rows]):
            if end - begin > 1:
                places = step[begin:end]
                # Least common prefix between each two predecessors; the last range is dropped.
                grown[begin + 1 : end] = np.minimum.reduceat(common[: places[-1] + 1], places[:-1] + 1) + 1
        order, common = order[step], grown
        if column < least.shape[1]:
            classes = np.flatnonzero(np.r_[True, common[1:] < span])
            valid = (first[order] <= column) & (column <= last[order])
            lowest = np.minimum.reduceat(np.where(valid, docs[order], _NONE), classes)
            sizes = np.diff(np.r_[classes, rows])
            least[order, column] = np.repeat(lowest, sizes)
    return least


class _Collection:
    """Segments of whole anchors, in the order of (anchor, document)."""

    def __init__(self, span: int, key: int):
        self.span, self.lead = span, span - key
        self.columns = 2 * span - key

    def solve(self, anchor, docs, low, lead, ends, data):
        """Removed windows as (doc, from, to, check), and the rows that show each new window first."""
        rows = len(docs)
        sizes = np.diff(ends)
        shift = self.lead - lead.astype(np.int64)  # the first window's column
        matrix = np.zeros((rows, self.columns), np.uint8)
        row = np.repeat(np.arange(rows), sizes)
        matrix[row, np.arange(ends[-1]) - ends[row] + shift[row]] = data
        last = shift + sizes - self.span
        least = smaller_windows(matrix, shift, last, docs, self.span)
        column = np.arange(least.shape[1])
        valid = (column >= shift[:, None]) & (column <= last[:, None])
        gone = valid & (least < docs[:, None])
        edge = np.zeros((rows, least.shape[1] + 2), np.int8)
        edge[:, 1:-1] = gone
        turns = np.diff(edge, axis=1)
        at_row, begin = np.nonzero(turns == 1)
        _, end = np.nonzero(turns == -1)
        base = low.astype(np.int64) - shift
        begin, end = base[at_row] + begin, base[at_row] + end - 1 + self.span
        inside = (ends[:-1] - low)[at_row]
        removed = docs[at_row], begin, end, checks(data, begin + inside, end + inside)
        return removed, (valid & ~gone).any(axis=1)


def _column_rows(span: int, key: int, limit: int):
    solver = _Collection(span, key)
    names = ["anchor", "doc_id", "low", "lead", "bytes"]

    def table(batches):
        return pa.Table.from_batches(batches).combine_chunks()

    def parts(rows: pa.Table):
        anchor, docs, low, lead = (rows.column(n).to_numpy() for n in names[:4])
        data, ends = _binary(rows.column("bytes"))
        return anchor, docs, low, lead, ends, data

    def out(found) -> pa.RecordBatch:
        docs, begin, end, check = found
        return pa.RecordBatch.from_arrays(
            [docs, begin.astype(np.int32), end.astype(np.int32), check], names=["doc_id", "begin", "end", "check"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, carried = [], 0, None

        def flush(final: bool):
            """Solve what is held; keep the windows of the last anchor unless it is complete."""
            nonlocal held, size, carried
            rows = table(held)
            held, size = [], 0
            open_anchor = None if final else rows.column("anchor")[-1].as_py()
            seen = 0
            if carried is not None:
                seen, rows = carried.num_rows, pa.concat_tables([carried, rows]).combine_chunks()
            found, new = solver.solve(*parts(rows))
            carried = None
            if open_anchor is not None:
                same = rows.column("anchor").to_numpy() == open_anchor
                carried = rows.filter(pa.array(same & new))
            return out(found), seen

        for batch in batches:
            batch = batch.select([*names, "check"])
            settled = pc.is_null(batch.column("bytes"))
            if pc.any(settled).as_py():
                known = batch.filter(settled)
                docs, begin, length, check = (known.column(n).to_numpy() for n in ("doc_id", "low", "lead", "check"))
                yield out((docs, begin, begin + length, check))
                batch = batch.filter(pc.invert(settled))
            batch = batch.select(names)
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.num_rows
            if size >= limit:
                yield flush(False)[0]
        if held:
            yield flush(True)[0]

    return run


def _binary(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(values, pa.ChunkedArray):
        values = values.chunk(0)
    values = values.cast(pa.large_binary())
    _, offsets, data = values.buffers()
    ends = np.frombuffer(offsets, np.int64)[values.offset : values.offset + len(values) + 1]
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def merged(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unite intervals that overlap or touch."""
    order = np.argsort(begin, kind="stable")
    begin, reach = begin[order], np.maximum.accumulate(end[order])
    new = np.flatnonzero(np.r_[True, begin[1:] > reach[:-1]])
    return begin[new], reach[np.r_[new[1:] - 1, len(begin) - 1]]


def _cut_rows(span: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.small(batches):
            data, starts = _texts(batch)
            copies, repeated = (batch.column(c).to_pylist() for c in ("copy", "repeated"))
            filled = batch.column("filled").to_pylist()
            begins, ends = batch.column("begins"), batch.column("ends")
            rows = []
            for i, copy in enumerate(copies):
                body = data[starts[i] : starts[i + 1]]
                size, spans, gone = len(body), [], 0
                if copy and size >= span:
                    spans = [(0, size)]
                elif begins[i].is_valid:
                    b, e = np.array(begins[i].values), np.array(ends[i].values)
                    if repeated[i]:  # another text of this doc_id may have lent its ranges
                        mine = e <= size
                        b, e, check = b[mine], e[mine], np.array(batch.column("checks")[i].values)[mine]
                        mine = checks(body, b, e) == check
                        b, e = b[mine], e[mine]
                    b, e = merged(b, e) if len(b) else (b, e)
                    spans = list(zip(b.tolist(), e.tolist()))
                keep = np.ones(size, bool)
                for b, e in spans:
                    keep[b:e] = False
                    gone += e - b
                kept = body[keep].tobytes() if gone else body.tobytes()
                text = kept.decode("utf-8", "ignore") if filled[i] else None
                rows.append((size, gone, len(spans), hashlib.sha256(kept).hexdigest(), text))
            made = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.column("extra").flatten(),
                    pa.array(made[0], pa.int64()),
                    pa.array(made[1], pa.int64()),
                    pa.array(made[2], pa.int64()),
                    pa.array(made[3], pa.string()),
                    pa.array(made[4], pa.string()),
                ],
                names=[*(f.name for f in batch.column("extra").type), *_MADE],
            )

    return run


_MADE = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text")


def _compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in arrays.small(batches):
        texts = pc.fill_null(batch.column("text").cast(pa.string()), "").cast(pa.binary())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("extra"),
                pc.is_valid(batch.column("text")),
                pa.array([zlib.compress(x, 1) for x in texts.to_pylist()], pa.binary()),
            ],
            names=["doc_id", "extra", "filled", "body"],
        )


def removed_spans(texts: DataFrame, parts: int, span: int = SPAN, key: int = KEY, limit: int = COLLECTION) -> DataFrame:
    """Covered byte ranges (doc_id, begin, end, check) of the rows that are no copies; ranges may overlap.

    ``texts`` has doc_id, extra, filled, body (compressed text) and copy; anchors are
    compared in ``parts`` parts.
    """
    found = texts.mapInArrow(_anchor_rows(span, key, parts), _PACKED)
    shared = (
        found.repartition(parts, "part")
        .sortWithinPartitions("part")
        .mapInArrow(_shared_rows, "doc_id long, at int")
        .groupBy("doc_id")
        .agg(F.collect_list("at").alias("at"))
    )
    segments = texts.join(shared, "doc_id", "left").mapInArrow(
        _segment_rows(span, key), "anchor long, doc_id long, low int, lead int, bytes binary, check long"
    )
    return (
        segments.repartition("anchor")
        .sortWithinPartitions("anchor", "doc_id")
        .mapInArrow(_column_rows(span, key, limit), "doc_id long, begin int, end int, check long")
    )


def remove_repeats(
    docs: DataFrame, span: int = SPAN, key: int = KEY, limit: int = COLLECTION, range_: int = RANGE
) -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans, kept_sha256 and kept_text in place of text.

    kept_text is the remaining bytes as text; a character that lost some of its bytes is
    dropped from it (kept_sha256 is over the bytes as they are). Extra columns of
    ``docs`` come back unchanged; columns of the names above are replaced. The kept text of a
    null text is null.
    """
    extra = [c for c in docs.columns if c not in ("text", *_MADE)]
    packed = docs.select("doc_id", F.struct(*extra).alias("extra"), "text")
    kind = packed.schema["extra"].dataType.simpleString()
    # Left joins only, and no filter on these columns: one exchange of the texts serves all three uses.
    rows = packed.mapInArrow(_compress, f"doc_id long, extra {kind}, filled boolean, body binary").repartition("doc_id")
    digests = docs.select("doc_id", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("digest"))
    sizes = docs.agg(F.sum(F.octet_length("text")).alias("bytes")).first()
    parts = max(1, -(-(sizes.bytes or 0) // range_))
    copies = (
        digests.groupBy("digest")
        .agg(F.min("doc_id").alias("keeper"), F.count("*").alias("n"))
        .where("n > 1 and keeper is not null")
        .drop("n")
    )
    # A doc_id that repeats is a copy only if all its texts are. Ranges are known by doc_id; where
    # it has several texts, each keeps those whose bytes are its own.
    marked = (
        digests.join(copies, "digest", "left")
        .groupBy("doc_id")
        .agg(
            F.min(F.coalesce(F.col("doc_id") > F.col("keeper"), F.lit(False))).alias("copied"),
            (F.min("digest") != F.max("digest")).alias("several"),
        )
        .where("copied OR several")
    )
    no = F.lit(False)
    texts = rows.join(marked, "doc_id", "left").withColumns({"copy": F.coalesce("copied", no), "repeated": F.coalesce("several", no)})
    texts = texts.drop("copied", "several")
    spans = (
        removed_spans(texts, parts, span, key, limit)
        .groupBy("doc_id")
        .agg(*(F.collect_list(c).alias(f"{c}s") for c in ("begin", "end", "check")))
    )
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*extra).schema)
    return texts.join(spans, "doc_id", "left").mapInArrow(
        _cut_rows(span),
        f"{schema}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string",
    )
