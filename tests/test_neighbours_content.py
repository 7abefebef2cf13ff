"""Nearest neighbours against brute force, and the content blend."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackloom.functions import vectors
from trackloom.operators import content, neighbours


def catalog(spark, n=400, d=9, seed=1, copies=0, partitions=5):
    rng = np.random.default_rng(seed)
    points = rng.random((n, d))
    if copies:
        points[:copies] = points[0]
    rows = [(f"t{i:04d}", f"song {i}", f"artist {i % 10}", [float(x) for x in p]) for i, p in enumerate(points)]
    ddl = "track_id string, track_name string, artist_name string, features array<double>"
    return spark.createDataFrame(rows, ddl).repartition(partitions), points


def brute(points, seed, k):
    dist = np.round(np.sqrt(((points - points[seed]) ** 2).sum(axis=1)), 9)
    order = sorted(range(len(points)), key=lambda i: (dist[i], i))[:k]
    return [(f"t{i:04d}", dist[i]) for i in order]


@pytest.mark.parametrize("copies", [0, 150])
@pytest.mark.parametrize("block", [4096, 3])
def test_nearest_equals_brute_force(spark, copies, block):
    df, points = catalog(spark, copies=copies)
    wanted = [0, 7, 399, 20, 21, 22, 160]
    seeds = df.filter(F.col("track_id").isin([f"t{i:04d}" for i in wanted]))
    found = {}
    for r in neighbours.nearest(df, seeds, 25, keep=("artist_name",), block=block).orderBy("seed_id", "rk").collect():
        found.setdefault(r.seed_id, []).append((r.track_id, r.dist))
    assert set(found) == {f"t{i:04d}" for i in wanted}
    for i in wanted:
        assert found[f"t{i:04d}"] == brute(points, i, 25)


def test_nearest_of_small_catalogue_and_no_seed(spark):
    df, _ = catalog(spark, n=5)
    assert neighbours.nearest(df, df.limit(1), 50).count() == 5
    assert neighbours.nearest(df, df.filter(F.lit(False)), 50).count() == 0


def test_null_vector_is_an_error(spark):
    df, _ = catalog(spark, n=5)
    bad = df.unionByName(df.limit(1).withColumn("features", F.lit(None).cast("array<double>")))
    with pytest.raises(Exception, match="NULL in a vector column"):
        neighbours.nearest(bad, df.limit(1), 3).collect()


@pytest.mark.parametrize("value", [None, float("nan"), float("inf")])
def test_bad_element_is_an_error(spark, value):
    df, _ = catalog(spark, n=5)
    bad = df.limit(1).withColumn("features", F.array(*[F.lit(value).cast("double")] * 9))
    with pytest.raises(Exception, match="in a vector column"):
        neighbours.nearest(df.unionByName(bad), df.limit(1), 3).collect()


def test_lsh_filters_before_the_arrow_stage(spark):
    df, _ = catalog(spark, n=50)
    plan = neighbours.nearest_lsh(df, df.limit(2), 5, bucket_length=0.25)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("MapInArrow") < plan.index("_buckets") and "Filter" in plan[plan.index("MapInArrow"):]


def test_lsh_finds_what_shares_a_bucket(spark):
    df, _ = catalog(spark, n=600)
    seeds = df.filter(F.col("track_id").isin("t0001", "t0002"))
    exact = neighbours.nearest(df, seeds, 50)
    wide = neighbours.nearest_lsh(df, seeds, 50, bucket_length=50.0)
    assert exact.exceptAll(wide).count() == 0
    model = neighbours.fit_lsh(df, bucket_length=0.25)
    hashed = neighbours.with_buckets(df, model)
    narrow = neighbours.nearest_lsh(df, seeds, 600, bucket_length=0.25)
    buckets = {r.track_id: r["_buckets"] for r in hashed.collect()}
    for seed in ("t0001", "t0002"):
        shared = {t for t, b in buckets.items() if any(x == y for x, y in zip(b, buckets[seed]))}
        assert {r.track_id for r in narrow.filter(F.col("seed_id") == seed).collect()} == shared
    recall = neighbours.recall(exact, neighbours.nearest_lsh(df, seeds, 50, bucket_length=0.25)).collect()
    assert all(0.0 < r.recall <= 1.0 and r.neighbours == 50 for r in recall)


def test_vector_functions(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<double>, b array<double>")
    a, b = F.col("a"), F.col("b")
    out = df.select(vectors.dot(a, b), vectors.norm(a), vectors.euclidean(a, b), vectors.cosine(a, b)).collect()
    assert tuple(out[0]) == pytest.approx((24.0, 5.0, 2**0.5, 0.96))
    assert tuple(out[1]) == pytest.approx((0.0, 0.0, 2**0.5, 0.0))


def test_assembled(spark):
    df = spark.createDataFrame([(1, 2.0), (None, 2.0)], "a int, b double")
    assert df.limit(1).select(vectors.assembled(["a", "b"]).alias("v")).first().v == [1.0, 2.0]
    with pytest.raises(Exception, match="NULL in a feature column"):
        df.select(vectors.assembled(["a", "b"])).collect()


def test_mean_cosine_with_zero_vectors(spark):
    df, points = catalog(spark, n=30, d=3)
    zero = spark.createDataFrame([("z", "z", "z", [0.0, 0.0, 0.0])], df.schema)
    rows = df.unionByName(zero)
    seeds = rows.filter(F.col("track_id").isin("t0000", "t0001", "z"))
    out = rows.select("track_id", content.mean_cosine(content.mean_direction(seeds)).alias("s")).collect()
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    want = unit @ (unit[0] + unit[1]) / 3
    got = {r.track_id: r.s for r in out}
    assert got["z"] == 0.0
    assert [got[f"t{i:04d}"] for i in range(30)] == pytest.approx(list(want), abs=1e-8)


PLAYLIST = "track_id string, track_name string, artist_name string"


def test_match_by_id_by_name_and_without_id_column(spark):
    df, _ = catalog(spark, n=20)
    listed = spark.createDataFrame(
        [(" t0001 ", "wrong", "wrong"), ("", " SONG 2", "Artist 2 "), (None, "song 3", "artist 9"), ("zz", "song 4", "artist 4")],
        PLAYLIST,
    )
    matched = content.match_seeds(df, content.normalize_playlist(listed))
    assert sorted(r.track_id for r in matched.collect()) == ["t0001", "t0002"]
    no_ids = content.normalize_playlist(listed.drop("track_id"))
    assert sorted(r.track_id for r in content.match_seeds(df, no_ids).collect()) == ["t0002", "t0004"]


def reference_blend(points, artists, seeds, size, slots, k):
    """The blend in plain Python: ids in order per section."""
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    score = np.round((unit @ unit[seeds].T).mean(axis=1), 9)
    pool = {int(t[1:]) for s in seeds for t, _ in brute(points, s, k)}
    group = {i for i in range(len(points)) if artists[i] in {artists[s] for s in seeds}}
    ranked = sorted((pool | group) - set(seeds), key=lambda i: (-score[i], i))
    overall = ranked[: size - slots]
    return overall, [i for i in ranked if i in group and i not in overall][:slots]


@pytest.mark.parametrize("size,slots,k", [(50, 10, 50), (20, 10, 50), (50, 45, 5), (8, 8, 3)])
def test_recommendations_equal_the_plain_form(spark, size, slots, k):
    df, points = catalog(spark)
    artists = [f"artist {i % 10}" for i in range(len(points))]
    seeds = [3, 14, 25]
    listed = df.filter(F.col("track_id").isin([f"t{i:04d}" for i in seeds])).select("track_id", "track_name", "artist_name")
    rows = content.recommend_content(df, listed, size, slots, k).orderBy("section", "rk").collect()
    overall, group = reference_blend(points, artists, seeds, size, slots, k)
    assert [r.track_id for r in rows if r.section == "similar"] == [f"t{i:04d}" for i in overall]
    assert [r.track_id for r in rows if r.section == "same_group"] == [f"t{i:04d}" for i in group]


def test_no_match_gives_an_empty_list(spark):
    df, _ = catalog(spark, n=20)
    listed = spark.createDataFrame([("zz", "no", "no")], PLAYLIST)
    assert content.recommend_content(df, listed).count() == 0


def test_repeated_names_are_dropped_after_the_cut(spark):
    df, _ = catalog(spark, n=60)
    df = df.withColumn("track_name", F.when(F.col("track_id") > "t0030", F.lit("same")).otherwise(F.col("track_name")))
    listed = df.filter("track_id = 't0001'").select("track_id", "track_name", "artist_name")
    rows = content.recommend_content(df, listed).collect()
    pairs = [(r.track_name, r.artist_name) for r in rows]
    assert len(pairs) == len(set(pairs)) < 45
