"""ALS, recommendations and ranking metrics."""

import pytest
from pyspark.sql import functions as F

from trackloom.operators import evaluate, factors, sampling
from trackloom.plans import collaborative

INF = float("-inf")


@pytest.fixture(scope="module")
def planted(spark):
    """Users and songs in eight groups; a user plays half of the group's songs and few others."""
    users = spark.range(160).select(F.col("id").cast("int").alias("user_id"))
    songs = F.explode(F.sequence(F.lit(0), F.lit(239))).alias("song_id")
    pairs = users.select("user_id", songs)
    inside = F.col("user_id") % 8 == F.col("song_id") % 8
    draw = F.pmod(F.xxhash64("user_id", "song_id"), F.lit(100))
    rows = pairs.filter((inside & (draw < 60)) | (draw < 2)).withColumn("interaction", F.lit(1.0))
    rows = rows.withColumns({"track_name": F.concat(F.lit("s"), "song_id"), "artist_name": F.lit("a")})
    return sampling.train_test_validation(rows, ["user_id", "song_id"]).cache()


def split(planted, name):
    return planted.filter(F.col("split") == name)


def test_planted_groups_are_learned_and_fits_repeat(spark, planted):
    train = split(planted, "train")
    tuned = collaborative.train_final(
        train, split(planted, "validation"), split(planted, "test"), [{"rank": 4, "regParam": 0.1, "alpha": 1.0},
                                                                   {"rank": 8, "regParam": 0.1, "alpha": 20.0}]
    )
    test = tuned.test.first()
    assert test.hr > 0.5 and 0.1 < test.mrr <= test.hr <= 1.0 and test.n == split(planted, "test").count()
    best = max(tuned.validation.collect(), key=lambda r: (r.hr, -r.grid_index))
    assert tuned.params == {"rank": best["rank"], "regParam": best.regParam, "alpha": best.alpha}
    again = factors.fit_als(train.repartition(7), 15, **tuned.params)
    gap = tuned.model.userFactors.alias("a").join(again.userFactors.alias("b"), "id")
    worst = gap.select(F.array_max(F.zip_with("a.features", "b.features", lambda x, y: F.abs(x - y))).alias("g"))
    assert worst.agg(F.max("g")).first()[0] < 1e-4


def test_recommend_new_fills_every_list(spark, planted):
    train = split(planted, "train")
    hot = spark.range(235).select(F.lit(0).alias("user_id"), F.col("id").cast("int").alias("song_id"))
    hot = hot.withColumns({"interaction": F.lit(1.0), "track_name": F.concat(F.lit("s"), "song_id"), "artist_name": F.lit("a")})
    train = train.drop("split").filter("user_id <> 0").unionByName(hot)
    model = factors.fit_als(train, 3, rank=4)
    out = factors.recommend_new(model, train, 10, 50)
    counts = {r.user_id: r["count"] for r in out.groupBy("user_id").count().collect()}
    items = train.select("song_id").distinct().count()
    assert counts.pop(0) == items - 235 and set(counts.values()) == {10} and len(counts) == 159
    assert out.join(train, ["user_id", "song_id"], "left_semi").count() == 0
    # The lists are the exact best: compare with the full ranking.
    full = factors.explode_recommendations(factors.recommend(model, items))
    exact = factors.best_per_user(factors.drop_heard(full, train), 10)
    assert exact.select("user_id", "song_id").exceptAll(out.select("user_id", "song_id")).count() == 0


def test_recommend_for_some_users(spark, planted):
    train = split(planted, "train")
    model = factors.fit_als(train, 2, rank=4)
    asked = spark.createDataFrame([(5,), (99_999,)], "user_id int")
    out = factors.recommend_new(model, train, 10, 50, asked)
    assert {r.user_id for r in out.collect()} == {5} and out.count() == 10


def test_model_round_trip(spark, planted, tmp_path):
    model = factors.fit_als(split(planted, "train"), 2, rank=4)
    factors.save_model(model, str(tmp_path / "m"))
    loaded = factors.load_model(str(tmp_path / "m"))
    assert loaded.rank == 4
    assert model.itemFactors.exceptAll(loaded.itemFactors).count() == 0


def scored(spark, lists):
    rows = [(u, 0, d, float(s)) for u, scores in lists.items() for d, s in enumerate(scores)]
    return spark.createDataFrame(rows, "user_id int, song_id int, draw int, score double")


def test_ranks_and_metrics(spark):
    lists = {
        1: [5.0] + [1.0] * 99,
        2: [1.0] + [1.0] * 99,
        3: [INF] + [INF] * 99,
        4: [INF] + [0.0] * 99,
        5: [5.0] + [6.0] * 9 + [1.0] * 90,
        6: [5.0] + [6.0] * 10 + [1.0] * 89,
        7: [2.0],
    }
    ranks = evaluate.rank_positive(scored(spark, lists))
    assert {r.user_id: r["rank"] for r in ranks.collect()} == {1: 1, 2: 1, 3: 1, 4: 100, 5: 10, 6: 11, 7: 1}
    m = evaluate.rank_metrics(ranks).first()
    assert (m.hr, m.mrr, m.n) == (pytest.approx(5 / 7), pytest.approx(4.1 / 7), 7)


def test_metrics_of_nothing(spark):
    m = evaluate.rank_metrics(evaluate.rank_positive(scored(spark, {1: [1.0]}).filter(F.lit(False)))).first()
    assert tuple(m) == (0.0, 0.0, 0)


def test_unseen_items_and_users(spark):
    users = spark.createDataFrame([(1, [1.0, 2.0])], "id int, features array<float>")
    items = spark.createDataFrame([(7, [3.0, 4.0])], "id int, features array<float>")
    asked = spark.createDataFrame([(1, 7, 0, 7), (1, 7, 1, 8), (2, 7, 0, 7)], "user_id int, song_id int, draw int, candidate int")
    out = {(r.user_id, r.candidate): r.score for r in factors.score_candidates(asked, users, items).collect()}
    assert out == {(1, 7): 11.0, (1, 8): INF}


def test_first_grid_point_wins_ties(spark):
    rows = [(0, 0.5), (1, 0.7), (2, 0.7)]
    results = spark.createDataFrame(rows, "grid_index int, hr double")
    assert evaluate.select_best(results).first().grid_index == 1
