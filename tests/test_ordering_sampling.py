"""Dense ids, running totals, splits, samples and negatives."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from trackloom.operators import interactions, ordering, sampling
from trackloom.plans import interactions as plan


def pairs(spark, users, songs, partitions=4):
    df = spark.range(users).withColumnRenamed("id", "user_id")
    df = df.withColumn("song_id", F.explode(F.sequence(F.lit(0), F.lit(songs - 1))))
    return df.withColumn("interaction", F.lit(1.0)).repartition(partitions)


@pytest.mark.parametrize("partitions", [None, 1, 4, 7])
def test_positions_equal_a_global_window(spark, partitions):
    df = spark.range(5000).select(F.sha2(F.col("id").cast("string"), 256).alias("key"))
    ours = ordering.with_position(df, ["key"], "p", partitions)
    window = df.withColumn("q", F.row_number().over(Window.orderBy("key")) - 1)
    assert ours.join(window, "key").filter("p = q").count() == 5000


@pytest.mark.parametrize("partitions", [1, 5])
def test_running_total(spark, partitions):
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("w"))
    rows = ordering.with_running_total(df, ["id"], "w", "total", partitions).orderBy("id").collect()
    total = 0
    for row in rows:
        total += row.w
        assert row.total == total


def test_dense_ids_of_nothing(spark):
    assert ordering.dense_ids(spark.range(0), ["id"], "code").count() == 0


def test_songs_with_one_display_key_keep_two_ids(spark):
    rows = [("u", "a||b", "c"), ("u", "a", "b||c"), ("v", "a", "b||c"), ("v", "a", None)]
    out = plan.build_interactions(spark.createDataFrame(rows, "user_id string, trackname string, artistname string"))
    rows = out.collect()
    assert len(rows) == 3 and {r.song_id for r in rows} == {0, 1} and {r.user_id for r in rows} == {0, 1}


def test_repeated_plays_count(spark):
    rows = [("u", "a", "b")] * 3 + [("v", "a", "b")]
    out = plan.build_interactions(spark.createDataFrame(rows, "user_id string, trackname string, artistname string"))
    assert {r.user_id_original: r.interaction for r in out.collect()} == {"u": 3.0, "v": 1.0}


def test_history_of_some_users(spark):
    df = pairs(spark, 5, 30)
    some = spark.createDataFrame([(1,), (3,)], "user_id bigint")
    out = interactions.user_history(df, 15, some)
    assert out.count() == 30 and {r.user_id for r in out.collect()} == {1, 3}


@pytest.mark.parametrize("partitions", [1, 4, 7])
def test_split_does_not_depend_on_partitions(spark, partitions):
    one = sampling.train_test_validation(pairs(spark, 50, 40), ["user_id", "song_id"])
    other = sampling.train_test_validation(pairs(spark, 50, 40, partitions), ["user_id", "song_id"])
    assert one.exceptAll(other).count() == 0
    shares = {r["split"]: r["count"] / 2000 for r in one.groupBy("split").count().collect()}
    assert shares == pytest.approx({"train": 0.8, "test": 0.1, "validation": 0.1}, abs=0.03)


@pytest.mark.parametrize("n", [0, 1, 20, 999, 1000, 5000])
def test_hash_sample_is_exact(spark, n):
    df = spark.range(1000).withColumnRenamed("id", "k")
    out = [r.k for r in sampling.hash_sample(df, ["k"], n).collect()]
    from trackloom.functions import values

    brute = df.withColumn("h", values.row_hash(["k"], 42)).orderBy("h", "k").limit(n)
    assert out == [r.k for r in brute.collect()] and len(out) == min(n, 1000)


@pytest.mark.parametrize("items", [1, 2, 5, 100, 101, 250])
def test_negatives_are_distinct_and_never_the_positive(spark, items):
    train = pairs(spark, 3, items)
    asked = pairs(spark, 4, items).filter("song_id % 3 = 0").select("user_id", "song_id")
    asked = asked.unionByName(spark.createDataFrame([(9, 10_000)], "user_id bigint, song_id int"))
    rows = sampling.negative_samples(asked, train).collect()
    found = {}
    for r in rows:
        found.setdefault((r.user_id, r.song_id), []).append((r.draw, r.candidate))
    assert len(found) == asked.count()
    for (_, song), drawn in found.items():
        negatives = [c for d, c in drawn if d > 0]
        room = items - (song < items)
        assert len(negatives) == len(set(negatives)) == min(99, room)
        assert song not in negatives and dict(drawn)[0] == song


def test_negatives_are_spread_evenly(spark):
    train = pairs(spark, 2, 500)
    asked = pairs(spark, 400, 5).select("user_id", "song_id")
    counts = sampling.negative_samples(asked, train).filter("draw > 0").groupBy("candidate").count().collect()
    assert len(counts) == 500
    sizes = [r["count"] for r in counts]
    assert 300 < min(sizes) and max(sizes) < 500  # 396 expected


@settings(max_examples=50, deadline=None)
@given(st.integers(min_value=2, max_value=10**6))
def test_next_prime(n):
    p = sampling._next_prime(n)
    assert p >= n and all(p % d for d in range(2, int(p**0.5) + 1))
