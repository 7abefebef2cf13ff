"""Fixity audit of two replicas of a WARC archive by Merkle trees.

An archive is a sequence of records at byte offsets. The leaves of its tree are the
SHA-256 digests of the records; the nodes above them cover ordered ranges of offsets,
``first`` bytes wide on the lowest level and ``fan`` times as wide on each next one, and
hash the digests under them in order. The roots are compared first; after that only the
children of ranges that differ are looked at, down to the records.

A record that one side lacks is a difference of its own. Equal records (same id, same
bytes) are one leaf that covers the bytes of all of them, so a record repeated without
end is one row. A null id sorts first; null url or html is empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.operators.ordering import with_running_total
from trackloom.session import materialize

FIRST = 1 << 16
FAN = 16


def warc_record(url: Column, body: Column) -> Column:
    """A resource record as text; its bytes are the text in UTF-8."""
    url, body = F.coalesce(url, F.lit("")), F.coalesce(body, F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Target-URI: "),
        url,
        F.lit("\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
        body,
        F.lit("\r\n\r\n"),
    )


def manifest(records: DataFrame, key: str) -> DataFrame:
    """Offsets of the records in the order of id and digest: key, at, bytes, digest.

    ``records`` has ``key`` and ``record``. Only digests and lengths are sorted.
    """
    leaves = (
        records.select(
            F.col(key), F.octet_length("record").cast("long").alias("length"), F.sha2(F.col("record").cast("binary"), 256).alias("digest")
        )
        .groupBy(key, "digest", "length")
        .agg((F.count("*") * F.col("length")).alias("bytes"))
    )
    return with_running_total(leaves, [key, "digest"], "bytes", "end").select(
        key, (F.col("end") - F.col("bytes")).alias("at"), "bytes", "digest"
    )


def tree(leaves: DataFrame, first: int = FIRST, fan: int = FAN) -> list[DataFrame]:
    """Levels above the leaves (at, digest), lowest first, each of range and digest; the last is the root.

    The leaves of a range number at most ``first`` divided by the shortest record.
    """
    top = leaves.agg(F.max("at")).first()[0] or 0
    levels, below, width = [], leaves.select(F.col("at").alias("place"), "digest"), first
    while True:
        hashed = (
            below.groupBy(F.floor(F.col("place") / width).alias("range"))
            .agg(F.array_sort(F.collect_list(F.struct("place", "digest"))).alias("parts"))
            .select(
                "range",
                F.sha2(
                    F.array_join(
                        F.transform("parts", lambda p: F.concat_ws(":", p["place"].cast("string"), p["digest"])), ","
                    ).cast("binary"),
                    256,
                ).alias("digest"),
            )
        )
        levels.append(materialize(hashed, "merkle"))
        top //= width
        if top == 0:
            return levels
        below, width = levels[-1].select(F.col("range").alias("place"), "digest"), fan


def audit(left: DataFrame, right: DataFrame, first: int = FIRST, fan: int = FAN) -> DataFrame:
    """Records of ``left`` and ``right`` (at, bytes, digest) that differ, found from the roots down.

    Returns at, bytes, expected (null: only the right side has it) and found (null: lost).
    """
    ours, theirs = tree(left, first, fan), tree(right, first, fan)
    depth = max(len(ours), len(theirs))
    while len(ours) < depth:
        ours.append(ours[-1])
    while len(theirs) < depth:
        theirs.append(theirs[-1])

    def differing(a: DataFrame, b: DataFrame) -> DataFrame:
        joined = a.join(b.withColumnRenamed("digest", "other"), "range", "full")
        return joined.where(~F.col("digest").eqNullSafe(F.col("other"))).select("range")

    bad = differing(ours[-1], theirs[-1])
    for a, b in zip(ours[-2::-1], theirs[-2::-1]):
        inside = bad.withColumnRenamed("range", "parent")
        parent = F.floor(F.col("range") / fan) == F.col("parent")
        bad = materialize(differing(a.join(inside, parent, "left_semi"), b.join(inside, parent, "left_semi")), "differing")
    inside = F.floor(F.col("at") / first) == F.col("range")
    a = left.join(bad, inside, "left_semi").select("at", "bytes", F.col("digest").alias("expected"))
    b = right.join(bad, inside, "left_semi").select("at", F.col("bytes").alias("bytes_b"), F.col("digest").alias("found"))
    return (
        a.join(b, "at", "full")
        .where(~F.col("expected").eqNullSafe(F.col("found")))
        .select("at", F.coalesce("bytes", "bytes_b").alias("bytes"), "expected", "found")
    )
