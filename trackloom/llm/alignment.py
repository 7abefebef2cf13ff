"""Alignment of two tokenizers over a corpus by interval coalescing.

A is a byte-level BPE (a ``tokenizers`` JSON file), B a sentencepiece model. Both see the same
bytes: a space and the text (B adds the space itself). Special tokens are never added, and
their strings inside texts are plain text. Each token covers a range of bytes.

A task concatenates the texts of a batch and sorts the ranges of all A and B tokens by their
starts. The running maximum of their ends (``maximum.accumulate``) breaks them into groups
where a start reaches it; as both tokenizers cover all bytes, those are the offsets where a
token of each ends. Within a group the pairs whose ranges overlap are expanded: these are the
links.

How many documents hold an id pair linked is a count over the whole corpus. Tokens are made
once: a task writes its documents in *blocks* of about ``BLOCK`` distinct (document, pair) rows,
and for each block one list of its distinct pairs and their document counts; a document's
pairs are places in that list. Spark adds the lists' counts per pair, finds the highest of
each A id, and sends each block the counts of its own pairs, so that nothing of the corpus' size
is broadcast or held: a task holds one block's pairs. A pair in all documents is one row
per block.

Texts that are null, empty, or whose joined tokens of A or B are not the bytes of the space and
the text have no tokens: zeros, and an empty text instead of a digest. Rows are documents of
their own, whatever their ids: repeated rows count twice, null ids too. Very long texts are
batches of their own; texts are never cut. Further columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackloom.llm import arrays
from trackloom.session import materialize

# Ids of B take the low bits of a pair.
B_BITS = 20
BATCH = 1 << 20  # bytes of text that are aligned at a time
BLOCK = 1 << 22
# How GPT-2's byte-level vocabularies are split before merging: a fixed value.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

DOCUMENT = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
# Of a document: places and times, packed. Of a block: pairs and how many documents hold them.
STORED = f"doc_id long, block long, {DOCUMENT}, places binary, times binary, pairs array<long>, held array<long>"


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies.

    Bytes that print stand for themselves, the others for the characters from 256 on.
    """
    printing = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(printing)]
    return {chr(b): b for b in printing} | {chr(256 + i): b for i, b in enumerate(rest)}


def ranked(spec: dict) -> dict[bytes, int] | None:
    """Bytes -> id where the ids are in the order of the merges, else None.

    Then merging the pair of least id is the same as merging by the list.
    """
    model = spec["model"]
    plain = (spec.get("pre_tokenizer") or {}) | {"trim_offsets": None}
    if (
        spec.get("normalizer")
        or model.get("dropout")
        or model.get("ignore_merges")
        or plain != {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": None, "use_regex": True}
    ):
        return None
    vocabulary, alphabet = model["vocab"], byte_alphabet()
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    ids = [vocabulary["".join(pair)] for pair in pairs]
    added = {token["content"] for token in spec.get("added_tokens", [])}
    ranks = {bytes(alphabet[c] for c in entry): i for entry, i in vocabulary.items() if entry not in added}
    in_order = ids == sorted(set(ids)) and len(ranks) == 256 + len(ids)
    return ranks if in_order and max(ranks[bytes([b])] for b in range(256)) < min(ids, default=256) else None


class Tokens:
    """The bytes of each id, and the ids of texts."""

    def __init__(self, entries: list[bytes], encode):
        self.encode = encode
        self.entries = entries
        self.sizes = np.array([len(e) for e in entries], np.int64)
        text = [str(i).encode() for i in range(len(entries))]
        # Each id as it is written inside a group.
        self.inner = np.array([t + b"," for t in text], object)
        self.text = text

    def joined(self, ids: list[int]) -> bytes:
        return b"".join(map(self.entries.__getitem__, ids))


@cache
def byte_level(path: str) -> Tokens:
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    alphabet = byte_alphabet()
    by_id = {i: entry for entry, i in spec["model"]["vocab"].items()}
    by_id |= {t["id"]: t["content"] for t in spec.get("added_tokens", [])}
    entries = [b""] * (max(by_id) + 1)
    for i, entry in by_id.items():
        entries[i] = bytes(alphabet[c] for c in entry) if all(c in alphabet for c in entry) else entry.encode()
    ranks = ranked(spec)
    if ranks:
        import tiktoken

        fast = tiktoken.Encoding(os.path.basename(path), pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        return Tokens(entries, lambda texts: [fast.encode_ordinary(" " + t) for t in texts])
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(path)
    slow.encode_special_tokens = True
    return Tokens(entries, lambda texts: [slow.encode(" " + t, add_special_tokens=False).ids for t in texts])


@cache
def pieces(path: str) -> Tokens:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    entries = [
        bytes([int(model.id_to_piece(i)[3:-1], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode()
        for i in range(model.get_piece_size())
    ]
    return Tokens(entries, lambda texts: model.encode(texts, num_threads=1))


def ranges(ids: list[list[int]], sizes: np.ndarray):
    """Of all texts' tokens, one behind the other: id, begin and end."""
    flat = np.fromiter(chain.from_iterable(ids), np.int64, sum(map(len, ids)))
    ends = np.cumsum(sizes[flat])
    return flat, ends - sizes[flat], ends


def coalesced(begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The group of each range: groups break where a start reaches the running maximum of ends."""
    order = np.lexsort((ends, begins))
    reached = np.maximum.accumulate(ends[order])
    breaks = np.zeros(len(order), np.int64)
    breaks[1:] = begins[order][1:] >= reached[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks)
    return group


def overlaps(a_begin, a_end, b_begin, b_end) -> tuple[np.ndarray, np.ndarray]:
    """All (A, B) positions whose ranges overlap. Both sides are in order and without gaps."""
    first = np.searchsorted(b_end, a_begin, side="right")
    last = np.searchsorted(b_begin, a_end, side="left")
    n = last - first
    a = np.repeat(np.arange(len(a_begin)), n)
    b = np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n) + first[a]
    return a, b


def _written(tokens_a: Tokens, tokens_b: Tokens, a_ids, b_ids, a_group, b_group, n_groups: int) -> np.ndarray:
    """Each token of all groups, in order, as it is written: ``a1,a2|b1;a3|b2,b3;``."""
    a_in, b_in = np.bincount(a_group, minlength=n_groups), np.bincount(b_group, minlength=n_groups)
    a_done, b_done = np.cumsum(a_in), np.cumsum(b_in)
    out = np.empty(len(a_ids) + len(b_ids), object)
    a_at = np.arange(len(a_ids)) + (b_done - b_in)[a_group]
    b_at = np.arange(len(b_ids)) + a_done[b_group]
    out[a_at], out[b_at] = tokens_a.inner[a_ids], tokens_b.inner[b_ids]
    ends = a_at[a_done - 1]
    out[ends] = [tokens_a.text[i] + b"|" for i in a_ids[a_done - 1].tolist()]
    ends = b_at[b_done - 1]
    out[ends] = [tokens_b.text[i] + b";" for i in b_ids[b_done - 1].tolist()]
    return out


def aligned(texts: list[str | None], tokens_a: Tokens, tokens_b: Tokens):
    """Per text: n_a, n_b, n_groups, n_links, digest; then the pairs of all links and their texts."""
    a, b = [[]] * len(texts), [[]] * len(texts)
    there = [i for i, t in enumerate(texts) if t]
    made = zip(there, tokens_a.encode([texts[i] for i in there]), tokens_b.encode([texts[i] for i in there]))
    for i, of_a, of_b in made:
        plain = b" " + texts[i].encode()
        if tokens_a.joined(of_a) == plain and tokens_b.joined(of_b) == plain:
            a[i], b[i] = of_a, of_b
    rows = np.zeros((4, len(texts)), np.int64)
    rows[0], rows[1] = list(map(len, a)), list(map(len, b))
    digests = [""] * len(texts)
    none = np.zeros(0, np.int64)
    if not rows[0].any():
        return rows, digests, none, none
    a_ids, a_begin, a_end = ranges(a, tokens_a.sizes)
    b_ids, b_begin, b_end = ranges(b, tokens_b.sizes)
    group = coalesced(np.concatenate([a_begin, b_begin]), np.concatenate([a_end, b_end]))
    a_group, b_group = group[: len(a_ids)], group[len(a_ids) :]
    n_groups = int(group.max()) + 1
    text_of = np.repeat(np.arange(len(texts)), rows[0])
    of_group = np.empty(n_groups, np.int64)
    of_group[a_group] = text_of
    rows[2] = np.bincount(of_group, minlength=len(texts))
    left, right = overlaps(a_begin, a_end, b_begin, b_end)
    linked = text_of[left]
    rows[3] = np.bincount(linked, minlength=len(texts))
    written = _written(tokens_a, tokens_b, a_ids, b_ids, a_group, b_group, n_groups).tolist()
    at = 0
    for i, n in enumerate((rows[0] + rows[1]).tolist()):
        if n:
            digests[i] = hashlib.sha256(b"".join(written[at : at + n])[:-1]).hexdigest()
        at += n
    return rows, digests, (a_ids[left] << B_BITS) | b_ids[right], linked


def _counted(text_of: np.ndarray, pairs: np.ndarray):
    """Distinct (text, pair) in order, and how often each is linked."""
    order = np.lexsort((pairs, text_of))
    text_of, pairs = text_of[order], pairs[order]
    new = np.ones(len(pairs), bool)
    new[1:] = (pairs[1:] != pairs[:-1]) | (text_of[1:] != text_of[:-1])
    at = np.flatnonzero(new)
    return text_of[at], pairs[at], np.diff(np.r_[at, len(pairs)])


def packed(values: np.ndarray) -> bytes:
    """Small whole numbers, least bytes first, so that compression finds the zeros together."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(4, -1) if data else np.zeros((4, 0), np.uint8)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def _tokenized(path_a: str, path_b: str, batch_bytes: int, block_size: int):
    """Rows of documents, and after each block's a row without n_a: its pairs and document counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens_a, tokens_b = byte_level(path_a), pieces(path_b)
        block, waiting, size = TaskContext.get().partitionId() << 32, [], 0
        names = [c.split()[0] for c in STORED.split(", ")]
        kinds = [*[pa.int64()] * 6, pa.string(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]

        def batch_of(columns):
            made = [c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, kinds)]
            return pa.RecordBatch.from_arrays(made, names=names)

        def written():
            known, place = np.unique(np.concatenate([w[3] for w in waiting]), return_inverse=True)
            at = 0
            for ids, rows, digests, pairs, times, held in waiting:
                cuts = np.r_[0, np.cumsum(held)]
                mine, at = place[at : at + len(pairs)], at + len(pairs)
                each = list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))
                places = [packed(np.diff(mine[a:b], prepend=0)) for a, b in each]
                none = [None] * len(each)
                yield batch_of([ids, [block] * len(each), *rows, digests, places, [packed(times[a:b]) for a, b in each], none, none])
            if len(known):
                yield batch_of([[None], [block], *[[None]] * 7, [known], [np.bincount(place, minlength=len(known))]])

        for batch in arrays.small(batches):
            _, starts = arrays.utf8(batch.column("text"))
            for first, last in arrays.pieces(starts, batch_bytes):
                part = batch.slice(first, last - first)
                rows, digests, pairs, text_of = aligned(part.column("text").to_pylist(), tokens_a, tokens_b)
                text_of, pairs, times = _counted(text_of, pairs)
                held = np.bincount(text_of, minlength=len(digests))
                waiting.append((part.column("doc_id"), rows, digests, pairs, times, held))
                size += len(pairs) + len(digests)
                if size > block_size:
                    yield from written()
                    block, waiting, size = block + 1, [], 0
        if waiting:
            yield from written()

    return run


def _looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks in order, in each the counts of its pairs, in order, before its documents."""
    names = ["doc_id", *(c.split()[0] for c in DOCUMENT.split(", ")), "n_best", "count_sum"]
    block, known, parts = None, None, []
    for batch in batches:
        blocks = np.asarray(batch.column("block"))
        kind = np.asarray(batch.column("kind"))
        cuts = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(kind) != 0)) + 1
        for a, b in zip(np.r_[0, cuts], np.r_[cuts, batch.num_rows]):
            if a == b:
                continue
            part = batch.slice(a, b - a)
            if blocks[a] != block:
                block, known, parts = blocks[a], None, []
            if kind[a] == 0:
                parts.append([np.asarray(part.column(c)) for c in ("best", "count")])
                continue
            if known is None:
                known = [np.concatenate(c) for c in zip(*parts)] or [np.zeros(0, np.int64)] * 2
            sums = np.zeros((2, b - a), np.int64)
            for i, (places, times) in enumerate(zip(part.column("places"), part.column("times"))):
                at, times = np.cumsum(unpacked(places.as_py())), unpacked(times.as_py())
                sums[:, i] = [int(times @ column[at]) for column in known]
            yield pa.RecordBatch.from_arrays([*map(part.column, names[:6]), *map(pa.array, sums)], names=names)


def _totals(lists: DataFrame) -> DataFrame:
    """pair, and in how many documents of the corpus it is linked."""
    return lists.groupBy("pair").agg(F.sum("held").alias("count"))


def _lists(stored: DataFrame) -> DataFrame:
    """block, at, pair, held: the lists of all blocks."""
    zipped = F.posexplode(F.arrays_zip("pairs", "held")).alias("at", "x")
    return stored.where("n_a IS NULL").select("block", zipped).select("block", "at", "x.pairs", "x.held").toDF("block", "at", "pair", "held")


def align(docs: DataFrame, path_a: str, path_b: str, batch_bytes: int = BATCH, block_size: int = BLOCK) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best and count_sum of every row of ``docs``.

    The paths are files that every executor can open. n_best counts the links whose pair's
    document count is the highest of its A id; count_sum adds up the counts of all links.
    """
    run = _tokenized(path_a, path_b, batch_bytes, block_size)
    stored = materialize(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, STORED), "alignment")
    # An A id has no more pairs than B has ids, which bounds the window.
    of_a = Window.partitionBy(F.shiftright("pair", B_BITS))
    totals = _totals(_lists(stored)).withColumn("best", (F.col("count") == F.max("count").over(of_a)).cast("long"))
    known = _lists(stored).join(totals, "pair").select(F.lit(0).alias("kind"), "block", "at", "count", "best")
    texts = stored.where("n_a IS NOT NULL").drop("pairs", "held").withColumn("kind", F.lit(1))
    return (
        texts.unionByName(known, allowMissingColumns=True)
        .repartition("block")
        .sortWithinPartitions("block", "kind", "at")
        .mapInArrow(_looked_up, f"doc_id long, {DOCUMENT}, n_best long, count_sum long")
    )


def pair_counts(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """a_id, b_id, n_docs: in how many rows of ``docs`` each id pair is linked."""
    stored = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_tokenized(path_a, path_b, BATCH, BLOCK), STORED)
    return _totals(_lists(stored)).select(
        F.shiftright("pair", B_BITS).alias("a_id"), F.col("pair").bitwiseAND(F.lit((1 << B_BITS) - 1)).alias("b_id"), F.col("count").alias("n_docs")
    )
