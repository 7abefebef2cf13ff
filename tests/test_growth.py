"""What must hold for a query to grow with its input: joins that stay off the driver, files, rounds and shuffles."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackloom.operators import blocked, evaluate, factors, neighbours, sampling
from trackloom.sources import packed


def plan(df):
    """As it ran: Spark turns joins into broadcasts by the sizes it meets."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_factor_tables_are_not_broadcast(spark):
    ids = spark.range(50).select(F.col("id"), F.array(F.lit(1.0), F.lit(2.0)).alias("features"))
    asked = spark.range(50).selectExpr("id AS user_id", "id AS song_id", "0 AS draw", "id AS candidate")
    scored = plan(factors.score_candidates(asked, ids, ids))
    assert "BroadcastHashJoin" not in scored and scored.count("SortMergeJoin") == 2


def test_items_to_draw_from_are_not_broadcast(spark):
    train = spark.range(300).selectExpr("id AS user_id", "id AS song_id")
    drawn = plan(sampling.negative_samples(train.limit(20), train, 5))
    assert drawn.count("SortMergeJoin") == 2


def rated(spark):
    """The metrics of two factorisations, of two and three dimensions."""
    ids = spark.range(50).select(F.col("id"), F.array(F.lit(1.0), F.lit(2.0)).alias("features"))
    wider = ids.withColumn("features", F.concat("features", F.array(F.col("id") / 2)))
    asked = spark.range(50).selectExpr("id AS user_id", "id AS song_id", "0 AS draw", "id AS candidate")
    return [evaluate.evaluate_factors(table, table, asked) for table in (ids, wider)]


def test_metrics_of_candidates_broadcast_nothing(spark):
    ran = plan(rated(spark)[0])
    assert "Broadcast" not in ran and ran.count("SortMergeJoin") == 2


def test_the_best_of_stacked_metrics_broadcasts_nothing(spark):
    ran = plan(evaluate.select_best(evaluate.stack_results([({"rank": i + 2}, m) for i, m in enumerate(rated(spark))])))
    assert "Broadcast" not in ran and ran.count("SortMergeJoin") == 4


def test_rows_seeds_and_visits_are_not_broadcast(spark):
    points = np.random.default_rng(1).normal(size=(200, 4))
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
    df = spark.createDataFrame(rows, "track_id long, features array<double>")
    found = plan(neighbours.nearest(df, df, 3, ring_rows=20))
    assert found.count("SortMergeJoin") >= 3  # visits with seeds, found rows with the catalogue's and with seeds


@pytest.mark.parametrize("kind", ["float", "double"])
@pytest.mark.parametrize("block", [5, 1 << 15])
def test_seeds_are_sent_to_strips_of_rings(spark, block, kind):
    """Without structure a seed searches all rings; it is sent once for all of a strip, and finds the same rows."""
    points = np.random.default_rng(2).integers(-3, 4, (400, 5)).astype("float32")  # many equal distances
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
    df = spark.createDataFrame(rows, f"track_id long, features array<{kind}>")
    found, first, further, placed, _ = neighbours._searched(df, df, 6, "track_id", "features", (), block, 4)
    rings, strips = placed.select("block").distinct().count(), further.select("block").distinct().count()
    assert rings >= 90 and strips <= (2 if block > 5 else 20)
    visits = further.groupBy("key").agg(F.count("*").alias("n"), F.countDistinct("block").alias("strips"))
    assert visits.where("n <> strips").count() == 0 and visits.agg(F.sum("n")).first()[0] < 400 * 20 + 1
    assert placed.schema["vector"].dataType.simpleString() == f"array<{kind}>"
    exact = np.round(np.sqrt(((points[:, None].astype("float64") - points) ** 2).sum(axis=2)), 9)
    got = {(r.seed_id, r.rk): (r.dist, r.track_id) for r in found.collect()}
    assert got == {(i, n + 1): (exact[i, j], j) for i in range(400) for n, j in enumerate(np.lexsort((np.arange(400), exact[i]))[:6])}


def test_lists_that_are_lacking_are_sent_empty(spark):
    """Of NULL lists Spark goes over a whole Arrow batch for each row."""
    rows = spark.range(9).selectExpr("0L AS block", "id AS member", "id AS order", "array(1.0D) AS vector")
    asked = spark.range(9).selectExpr("0L AS block", "id AS key", "array(1.0D) AS vector", "if(id > 4, array(id), null) AS skip")
    assert blocked._grouped(rows, asked, None, 4).where("skip IS NULL OR vector IS NULL").count() == 0


def test_a_fit_leaves_few_shuffle_files(spark):
    import time

    rows = spark.range(3000).select(
        (F.col("id") % 100).cast("int").alias("user_id"), (F.col("id") * 7 % 90).cast("int").alias("song_id"), F.lit(1.0).alias("interaction")
    )
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    spark.sparkContext._jvm.System.gc()
    time.sleep(2)
    before = files.getAllFiles().size()
    model = factors.fit_als(rows, 12, rank=3)
    deadline = time.time() + 10
    while files.getAllFiles().size() - before > 200 and time.time() < deadline:
        time.sleep(0.5)
    assert files.getAllFiles().size() - before <= 200  # some 500 of 24 half-steps are left else
    assert model.userFactors.count() == 100


@pytest.mark.parametrize("strip", [8, 24, 100])
def test_blocks_are_read_in_strips(spark, monkeypatch, strip):
    """The lists and the blocks each user needs, round by round, whatever a task holds."""
    monkeypatch.setattr(factors, "STRIP", strip)
    draw, block, k = np.random.default_rng(5), 4, 3
    users, items = draw.normal(size=(30, 5)), draw.normal(size=(203, 5)) * np.exp(-np.arange(203) / 60)[:, None]
    heard = {(u, int(i)) for u in range(30) for i in draw.integers(0, 203, 20)} | {(3, i) for i in range(202)}
    table = lambda x: spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "id long, features array<double>")
    left_out = spark.createDataFrame([*heard, *heard], "user_id long, song_id long")
    found, read = factors.search_products(table(users), table(items), k, left_out, block)
    lists = {}
    for r in found.collect():
        lists.setdefault(r.user_id, []).append((-r.confidence_score, r.song_id))
    norms = np.sqrt((items * items).sum(axis=1))
    place = sorted(range(203), key=lambda i: (-norms[i], i))
    counts = {}
    for u, x in enumerate(users):
        score, n, low, best = np.round((items * x).sum(axis=1), 9), 0, 0, []
        while low * block < 203:
            high = 2 * low + 1
            floor = -best[k - 1][0] if len(best) >= k else -np.inf
            n += sum(np.sqrt((x * x).sum()) * norms[place[b * block]] >= floor for b in range(low, high) if b * block < 203)
            best = sorted((-score[i], i) for i in place[: high * block] if (u, i) not in heard)[:k]
            low = high
        counts[u] = n
        assert sorted(lists[u]) == best
    assert {r.user_id: r.n_blocks for r in read.collect()} == counts


def test_files_are_written_by_many_tasks_and_read_by_few(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(packed, "OPENERS", 5)
    rows = spark.range(3000, numPartitions=1).select(
        F.format_string("%d/%d.txt", F.col("id") % 3, "id").alias("name"), F.encode(F.col("id").cast("string"), "UTF-8").alias("content")
    )
    packed.write_records(rows, str(tmp_path / "new"))
    read = packed.read_texts(spark, str(tmp_path / "new"), partition_bytes=4 << 20)
    assert {r.content for r in read.collect()} == {str(i) for i in range(3000)} and read.rdd.getNumPartitions() <= 6
    assert [p.name for p in tmp_path.iterdir()] == ["new"]
    # A folder that is there keeps its files.
    packed.write_records(rows.limit(5).withColumn("name", F.concat(F.lit("more/"), F.col("content").cast("string"))), str(tmp_path / "new"))
    assert packed.read_texts(spark, str(tmp_path / "new")).count() == 3005
    with pytest.raises(Exception, match="two records are named"):
        packed.write_records(rows.withColumn("name", F.lit("a")), str(tmp_path / "twice"))
    assert [p.name for p in tmp_path.iterdir()] == ["new"]


def test_files_of_failed_attempts_are_left_out(tmp_path):
    writer = packed._FileWriter(str(tmp_path / "t"), str(tmp_path / "s"))

    def cut():
        yield "lost.txt", b"x"
        raise OSError("cut")

    with pytest.raises(OSError):
        writer.write(cut())
    writer.commit([writer.write(iter([("a/kept.txt", b"y")])), None])
    assert [str(p.relative_to(tmp_path)) for p in tmp_path.rglob("*") if p.is_file()] == ["t/a/kept.txt"]


def test_rows_of_one_user_share_a_list(spark):
    draw, block, k = np.random.default_rng(8), 4, 4
    items = draw.normal(size=(90, 5)) * np.exp(-np.arange(90) / 20)[:, None]
    users = draw.normal(size=(12, 5))
    table = lambda rows: spark.createDataFrame([(i, [float(c) for c in v]) for i, v in rows], "id long, features array<double>")
    twice = [*enumerate(users), *list(enumerate(users))[:5]]
    found, read = factors.search_products(table(twice), table(enumerate(items)), k, None, block)
    norms = np.sqrt((items * items).sum(axis=1))
    place, counts = sorted(range(90), key=lambda i: (-norms[i], i)), {}
    for u, x in enumerate(users):
        copies, low, best, n = 1 + (u < 5), 0, [], 0
        score = np.round((items * x).sum(axis=1), 9)
        while low * block < 90:
            floor = -best[k - 1][0] if len(best) >= k else -np.inf
            n += sum(np.sqrt((x * x).sum()) * norms[place[b * block]] >= floor for b in range(low, 2 * low + 1) if b * block < 90)
            low = 2 * low + 1
            best = sorted([(-score[i], i) for i in place[: low * block]] * copies)[:k]
        counts[u] = n * copies
    assert {r.user_id: r.n_blocks for r in read.collect()} == counts
