"""Reproducible splits and samples: membership is a pure function of the row and the seed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackloom.functions import values
from trackloom.operators.ordering import with_position

SEED = 42
_HASH_RANGE = 1 << 32
_BUCKET_BITS = 16


def hash_split(
    df: DataFrame, keys: list[str], weights: dict[str, float], seed: int = SEED, output: str = "split"
) -> DataFrame:
    """Label each row with the name of its part; ``weights`` maps names to shares.

    No shuffle, and the same rows get the same label however they are partitioned.
    """
    total = sum(weights.values())
    value = F.col("_hash")
    label: Column | None = None
    reached = 0.0
    *head, last = weights
    for name in head:
        reached += weights[name]
        test = value < F.lit(int(round(reached / total * _HASH_RANGE)))
        label = F.when(test, F.lit(name)) if label is None else label.when(test, F.lit(name))
    label = F.lit(last) if label is None else label.otherwise(F.lit(last))
    return df.withColumn("_hash", values.row_hash(keys, seed)).withColumn(output, label).drop("_hash")


def train_test_validation(df: DataFrame, keys: list[str], seed: int = SEED) -> DataFrame:
    """The 80/10/10 split of the collaborative lane."""
    return hash_split(df, keys, {"train": 0.8, "test": 0.1, "validation": 0.1}, seed)


def hash_sample(df: DataFrame, keys: list[str], n: int, seed: int = SEED) -> DataFrame:
    """Exactly ``n`` rows (all when there are fewer), uniform by the hash of ``keys``.

    A histogram over the upper hash bits gives the range that surely holds the
    ``n`` smallest hashes, so the final sort sees little more than ``n`` rows
    instead of ``n`` rows from every task.
    """
    hashed = df.withColumn("_hash", values.row_hash(keys, seed))
    bucket = F.shiftright("_hash", 32 - _BUCKET_BITS)
    histogram = hashed.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))
    # At most 2^16 rows, whatever the data.
    reached = histogram.withColumn("reached", F.sum("n").over(Window.orderBy("bucket")))
    cut = reached.agg(F.min(F.when(F.col("reached") >= n, F.col("bucket"))).alias("cut")).scalar()
    near = hashed.filter(bucket <= F.coalesce(cut, F.lit(1 << _BUCKET_BITS)))
    return near.orderBy("_hash", *keys).limit(n).drop("_hash")


def sample_playlist(catalog: DataFrame, n: int = 20, seed: int = SEED) -> DataFrame:
    """A test playlist drawn from the catalogue."""
    return hash_sample(catalog.select("track_id", "track_name", "artist_name"), ["track_id"], n, seed)


def eval_pairs(held_out: DataFrame, n: int | None = 5000, seed: int = SEED) -> DataFrame:
    """Up to ``n`` held-out (user, song) pairs to rank, spread over all tasks again after the cut; None: all."""
    pairs = held_out.select("user_id", "song_id")
    if n is None:
        return pairs
    pairs = hash_sample(pairs, ["user_id", "song_id"], n, seed)
    return pairs.repartition("user_id", "song_id")


def _next_prime(n: int) -> int:
    def prime(x: int) -> bool:
        return x > 1 and all(x % d for d in range(2, int(x**0.5) + 1))

    while not prime(n):
        n += 1
    return n


def negative_samples(pairs: DataFrame, train: DataFrame, n: int = 99, seed: int = SEED) -> DataFrame:
    """Every pair with itself (``draw`` 0) and ``n`` other training items (``draw`` 1..n).

    Items of the training relation are numbered 0..N-1. With P the first prime
    not below N, the walk ``start + step * j mod P`` never repeats, so after
    leaving out numbers >= N and the positive its first ``n`` stops are a sample
    without replacement, for any N, with no set to keep and no shuffle. A
    catalogue of fewer than n + 1 items gives as many negatives as it has.
    Returns user_id, song_id, draw, candidate.
    """
    items = with_position(train.select("song_id").distinct(), ["song_id"], "item_index")
    size = items.count()
    # Sorted numbers pack into so small a file that Spark would broadcast millions of them.
    items = items.hint("merge")
    prime = _next_prime(max(size, 2))
    stops = min(prime, n + 1 + prime - size)
    text = F.concat_ws("|", F.col("user_id").cast("string"), F.col("song_id").cast("string"), F.lit(str(seed)))
    start = F.pmod(values.hex_word(text, 0), F.lit(prime))
    step = F.pmod(values.hex_word(text, 1), F.lit(prime - 1)) + 1
    walked = pairs.select("user_id", "song_id", start.alias("_start"), step.alias("_step")).join(
        items.withColumnRenamed("item_index", "_own"), "song_id", "left"
    )
    walk = F.transform(
        F.sequence(F.lit(0).cast("bigint"), F.lit(stops - 1).cast("bigint")),
        lambda j: F.pmod(F.col("_start") + F.col("_step") * j, F.lit(prime)),
    )
    others = F.filter(walk, lambda x: (x < size) & (x != F.coalesce(F.col("_own"), F.lit(-1).cast("bigint"))))
    drawn = walked.select(
        "user_id", "song_id", F.posexplode(F.slice(others, 1, n)).alias("_place", "item_index")
    )
    negatives = drawn.join(items.withColumnRenamed("song_id", "candidate"), "item_index").select(
        "user_id", "song_id", (F.col("_place") + 1).alias("draw"), "candidate"
    )
    positives = pairs.select("user_id", "song_id", F.lit(0).alias("draw"), F.col("song_id").alias("candidate"))
    return positives.unionByName(negatives)
