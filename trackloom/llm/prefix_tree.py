"""The trie of conversation prefixes, measured along its Euler tour.

Conversations are rebuilt with a shared head: conversation ``c`` begins with the first ``h`` turns
of conversation ``c - c % FAMILY`` (all, if it has fewer; none, if it is absent) and goes on
with its own turns after its first ``h``, where ``h`` is the unsigned crc32 of the decimal
``c`` modulo ``HEADS``. Each distinct sequence of the first ``d`` rebuilt turns (role, text) is
a node of depth ``d``; the root stands for no turns.

* Turns are numbered, and prefixes named, by running counts and running exclusive ors over a
  range-sorted table: a turn's term is a digest of its depth, role and text, and a prefix's
  name is the exclusive or of its terms. A conversation is spread over any number of tasks.
  Names are proved to be right by induction: all members of a node must have one
  parent and one last turn, else the query stops with an error.
* Every node has an enter and an exit arc. An enter arc leads to the first child's enter arc, or
  to its own exit; an exit arc to the next sibling's enter arc, or to the parent's exit.
  The tour is ranked distributedly (``scans.list_ranks``); with prefix sums at the arcs'
  positions, a subtree's total is what the sum gains between its enter and its exit arc.

A null role or text is empty. Turns are in the order of turn (null first), role and text;
repeated rows are turns of their own. Rows with a null conv_id belong to no conversation. An
empty table has no nodes. Further columns are not read.

One digest over all ids that end at a node is sequential, so one task streams those of a node, as
texts of up to ``CHUNK`` ids that other tasks have joined; it holds one of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.llm.scans import list_ranks, running
from trackloom.operators.ordering import with_position
from trackloom.session import materialize

FAMILY = 5
HEADS = 9
CHUNK = 4096
NODE = ["hi", "lo"]
EMPTY = hashlib.sha256(b"").hexdigest()


def _digit_pair(text: Column) -> tuple[Column, Column]:
    """Two longs of 60 bits each from the digest of a text."""
    digest = F.md5(text.cast("binary"))
    return tuple(F.conv(F.substring(digest, at, 15), 16, 10).cast("long") for at in (1, 17))


def numbered(conversations: DataFrame) -> DataFrame:
    """conv_id, index (from 1), turn's digest and the bytes of its text."""
    turns = conversations.select(
        F.col("conv_id").cast("long"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.lit(1).cast("long").alias("one"),
    ).where("conv_id IS NOT NULL")
    placed = running(turns, ["conv_id", "turn", "role", "text"], ["one"], group="conv_id")
    said = F.concat_ws("\n", F.length("role"), "role", "text")
    return placed.select(
        "conv_id", F.col("one_run").alias("index"), F.sha2(said.cast("binary"), 256).alias("said"), F.octet_length("text").cast("long").alias("bytes")
    )


def rebuilt(turns: DataFrame, family: int = FAMILY, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """conv_id, depth, said, bytes of all rebuilt turns; and all conv_ids."""
    convs = materialize(turns.select("conv_id").distinct(), "conversations")
    base = (F.col("conv_id") - F.col("conv_id") % family).alias("base")
    taken = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(heads)).alias("taken")
    # At most heads - 1 turns of a conversation are shared, with its family.
    heads_of = turns.where((F.col("index") < heads) & (F.col("conv_id") % family == 0)).withColumnRenamed("conv_id", "base")
    shared = (
        convs.select("conv_id", base, taken)
        .join(heads_of, "base")
        .where("index <= taken")
        .select("conv_id", F.col("index").alias("depth"), "said", "bytes")
    )
    sizes = heads_of.groupBy("base").agg(F.count("*").alias("there"))
    own = (
        turns.select("*", base, taken)
        .where("index > taken")
        .join(sizes, "base", "left")
        .withColumn("depth", F.least("taken", F.coalesce("there", F.lit(0))) + F.col("index") - F.col("taken"))
        .select("conv_id", "depth", "said", "bytes")
    )
    return shared.unionByName(own), convs


def named(turns: DataFrame) -> DataFrame:
    """conv_id, depth, said, bytes, the node (hi, lo) that ends with the turn, and its parent (up_hi, up_lo)."""
    hi, lo = _digit_pair(F.concat_ws("\n", "depth", "said"))
    paths = running(turns.select("*", hi.alias("hi"), lo.alias("lo")), ["conv_id", "depth"], NODE, group="conv_id", xor=True)
    up = [F.col(f"{c}_run").bitwiseXOR(F.col(c)).alias(f"up_{c}") for c in NODE]
    return paths.select("conv_id", "depth", "said", "bytes", *up, *(F.col(f"{c}_run").alias(c) for c in NODE))


def nodes_of(paths: DataFrame, convs: DataFrame) -> DataFrame:
    """hi, lo, up_hi, up_lo, depth, conv_id, n_convs and bytes of every node; the root has no parent."""
    alike = ["depth", "said", "bytes", "up_hi", "up_lo"]
    same = F.min(F.struct(*alike)) == F.max(F.struct(*alike))
    deep = paths.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        F.when(same, F.min(F.struct(*alike))).otherwise(F.raise_error(F.lit("two prefixes have one name"))).alias("_node"),
    )
    none = F.lit(None).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    return deep.select(*NODE, "_node.up_hi", "_node.up_lo", "_node.depth", "conv_id", "n_convs", "_node.bytes").unionByName(
        root.select(
            F.lit(0).cast("long").alias("hi"),
            F.lit(0).cast("long").alias("lo"),
            none.alias("up_hi"),
            none.alias("up_lo"),
            F.lit(0).cast("long").alias("depth"),
            "conv_id",
            "n_convs",
            F.lit(0).cast("long").alias("bytes"),
        )
    )


def linked(nodes: DataFrame) -> DataFrame:
    """The nodes with their number ``p``, children (first, last, n_children) and parent (up_p, up_last, parent_conv_id).

    Siblings have consecutive numbers; the root, without a parent, comes first and is 0.
    """
    placed = with_position(nodes, ["up_hi", "up_lo", *NODE], "p")
    kids = placed.where("up_hi IS NOT NULL").groupBy(F.col("up_hi").alias("hi"), F.col("up_lo").alias("lo"))
    kids = kids.agg(F.min("p").alias("first"), F.max("p").alias("last"), F.count("*").alias("n_children"))
    full = placed.join(kids, NODE, "left")
    parents = full.where("first IS NOT NULL").select(
        F.col("hi").alias("up_hi"),
        F.col("lo").alias("up_lo"),
        F.col("p").alias("up_p"),
        F.col("last").alias("up_last"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    return materialize(full.join(parents, ["up_hi", "up_lo"], "left"), "tree")


def tour(tree: DataFrame) -> DataFrame:
    """arc and ``to``, the arc after it; node ``p`` is entered by arc 2p and left by arc 2p + 1."""
    enter, leave = F.col("p") * 2, F.col("p") * 2 + 1
    down = F.coalesce(F.col("first") * 2, leave)
    on = F.when(F.col("p") < F.col("up_last"), enter + 2).otherwise(F.col("up_p") * 2 + 1)
    arcs = F.array(F.struct(enter.alias("arc"), down.alias("to")), F.struct(leave.alias("arc"), on.alias("to")))
    return tree.select(F.inline(arcs))


def subtree_sums(tree: DataFrame, weights: dict[str, Column]) -> DataFrame:
    """p and, for each weight of the nodes, its sum over the subtree."""
    total = 2 * tree.count()
    ranks = list_ranks(tour(tree), last=1)
    at = ranks.select(
        F.shiftright("arc", 1).alias("p"), (F.col("arc") % 2 == 1).alias("exit"), (F.lit(total - 1) - F.col("ahead")).alias("position")
    )
    weighed = at.join(tree.select("p", *(w.cast("long").alias(n) for n, w in weights.items())), "p")
    # A node's weight lies on its enter arc.
    weighed = weighed.withColumns({n: F.when(F.col("exit"), 0).otherwise(F.col(n)).cast("long") for n in weights})
    sums = running(weighed.select("position", "p", "exit", *weights), ["position"], list(weights))
    gain = {n: F.when(F.col("exit"), F.col(f"{n}_run")).otherwise(F.col(n) - F.col(f"{n}_run")) for n in weights}
    return sums.groupBy("p").agg(*(F.sum(g).alias(n) for n, g in gain.items()))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], int, int]]:
    hi, lo = (np.asarray(batch.column(c)) for c in NODE)
    cuts = np.flatnonzero((np.diff(hi) != 0) | (np.diff(lo) != 0)) + 1
    for a, b in zip(np.r_[0, cuts], np.r_[cuts, batch.num_rows]):
        if a < b:
            yield (int(hi[a]), int(lo[a])), int(a), int(b)


def _chunked(chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            ids = np.asarray(batch.column("conv_id")).tolist()
            for node, a, b in _runs(batch):
                rows += [(*node, ids[i], ",".join(map(str, ids[i : min(i + chunk, b)]))) for i in range(a, b, chunk)]
            if rows:
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[*NODE, "at", "ids"])

    return run


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    node, state = None, None

    def packed(rows):
        kinds = [pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[*NODE, "ends_sha256"])

    for batch in batches:
        done = []
        texts = batch.column("ids")
        for now, a, b in _runs(batch):
            if now != node:
                if node is not None:
                    done.append((*node, state.hexdigest()))
                node, state = now, None
            for i in range(a, b):
                if state is None:
                    state = hashlib.sha256()
                else:
                    state.update(b",")
                state.update(texts[i].as_py().encode())
        if done:
            yield packed(done)
    if node is not None:
        yield packed([(*node, state.hexdigest())])


def end_digests(paths: DataFrame, convs: DataFrame) -> DataFrame:
    """hi, lo and ends_sha256 of the nodes where conversations end."""
    last = paths.groupBy("conv_id").agg(F.max_by(F.struct(*NODE), "depth").alias("_end"))
    zero = F.lit(0).cast("long")
    ends = convs.join(last, "conv_id", "left").select("conv_id", *(F.coalesce(f"_end.{c}", zero).alias(c) for c in NODE))
    order = [*NODE, "conv_id"]
    return (
        ends.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(_chunked(CHUNK), "hi long, lo long, at long, ids string")
        .repartition(*NODE)
        .sortWithinPartitions(*NODE, "at")
        .mapInArrow(_hashed, "hi long, lo long, ends_sha256 string")
    )


def prefix_trie(conversations: DataFrame, family: int = FAMILY, heads: int = HEADS) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations.

    conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves (nodes
    without children in its subtree, itself included), saved_tokens (summed over the subtree,
    the bytes of each node's last text for all its members but one), ends_sha256.
    """
    turns, convs = rebuilt(numbered(conversations), family, heads)
    paths = named(turns)
    tree = linked(nodes_of(paths, convs))
    leaf = F.col("n_children").isNull().cast("long")
    sums = subtree_sums(tree, {"n_leaves": leaf, "saved_tokens": (F.col("n_convs") - 1) * F.col("bytes")})
    return (
        tree.join(sums, "p")
        .join(end_digests(paths, convs), NODE, "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
        )
    )
