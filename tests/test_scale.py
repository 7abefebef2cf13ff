"""Plan shapes and skew: what must hold when the tables are a thousand times larger."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from trackloom.operators import content, dedupe, interactions, sampling
from trackloom.session import scratch_path, shared_folder
from workload import roles

LAZY = [
    "best_record", "dedupe_by_name", "clean_catalog", "left_enrich", "conform_sources", "interaction_counts",
    "user_history", "hash_split", "eval_pairs", "minmax_scale", "mean_impute", "profile_hist", "profile_corr",
    "profile_dups", "profile_missing", "match_seeds", "same_group_pool", "knn_exact", "candidate_pool", "anti_heard",
    "explode_recs",
]


def plan_of(df, mode="formatted"):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    )


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join(spark, folder, name):
    plan = plan_of(contract.queries()[name](spark, folder))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["best_record", "dedupe_by_name", "user_history", "knn_exact", "anti_heard"])
def test_groups_are_cut_before_the_shuffle(spark, folder, name):
    plan = plan_of(contract.queries()[name](spark, folder), "simple")
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_scan_reads_only_what_is_used(spark, folder):
    plan = plan_of(contract.queries()["profile_hist"](spark, folder))
    read = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert read and all("l_shipdate" not in line and "l_quantity" in line for line in read)
    near = plan_of(contract.queries()["knn_exact"](spark, folder))
    assert "label" not in near


def test_only_rows_of_searched_rings_are_shuffled_for_neighbours(spark, folder):
    """Below the exchange that brings rows and seeds together, rows are joined with the rings that a seed searches."""
    plan = plan_of(contract.queries()["knn_exact"](spark, folder), "simple")
    meeting = plan.index("Exchange hashpartitioning(block")
    assert plan.index("MapInArrow") < meeting and "Join [block" in plan[meeting:]


def test_range_filter_reaches_the_scan(spark, folder):
    from trackloom.operators import clean

    plan = plan_of(clean.in_range(roles.table(spark, folder, "part"), "p_retailprice", 900, 950))
    assert "GreaterThanOrEqual(p_retailprice,900.0)" in plan and "LessThanOrEqual(p_retailprice,950.0)" in plan


def test_hot_key_sends_one_row_per_task(spark):
    """A third of all rows share the NULL key; at most one of them leaves each map task."""
    df = spark.range(30_000, numPartitions=6).select(
        F.when(F.col("id") % 3 != 0, F.col("id")).alias("k"), (F.col("id") % 101).alias("v"), "id"
    )
    out = dedupe.top_per_group(df, ["k"], [F.col("v").asc(), F.col("id").asc()], 1)
    rows = out.filter("k is null").collect()
    assert [r.id for r in rows] == [0] and out.count() == 20_001


def test_hot_user_and_song(spark):
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 500).cast("string")).alias("user_id"),
        F.when(F.col("id") % 3 == 1, F.lit("hit")).otherwise((F.col("id") % 700).cast("string")).alias("trackname"),
        F.lit("a").alias("artistname"),
    )
    counts = interactions.count_interactions(df, ["user_id", "trackname", "artistname"])
    out = interactions.encode_ids(counts)
    assert out.agg(F.sum("interaction")).first()[0] == 60_000.0
    assert out.count() == counts.count()


def test_same_group_with_a_hot_artist(spark):
    df = spark.range(9000).select(
        F.col("id").cast("string").alias("track_id"),
        F.concat(F.lit("s"), "id").alias("track_name"),
        F.when(F.col("id") % 3 == 0, F.lit("unknown artist")).otherwise(F.concat(F.lit("a"), F.col("id") % 50)).alias("artist_name"),
        F.array(*[F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1000)) / 1000.0 for i in range(4)]).alias("features"),
    )
    listed = df.filter("track_id = '0'").select("track_id", "track_name", "artist_name")
    rows = content.recommend_content(df, listed).collect()
    assert len(rows) == 50 and sum(r.section == "same_group" for r in rows) == 10


def test_results_do_not_depend_on_shuffle_partitions(spark, folder):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    try:
        for n in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            plays = roles.plays(spark, folder)
            rows = sampling.negative_samples(sampling.eval_pairs(plays, 50), plays).collect()
            best = contract.queries()["best_record"](spark, folder).collect()
            found.append((sorted(map(tuple, rows)), sorted(map(str, best))))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1]


def test_scratch_lies_in_the_shared_folder(spark):
    path = scratch_path(spark, "x")
    assert path.startswith(shared_folder(spark)) and path != scratch_path(spark, "x")
