"""Ranks of all held-out pairs, and products of given pairs in cells of two blocks."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackloom.operators import factors, paired
from workload import queries, roles


def shop(spark, folder, pairs):
    """Tables of an item each for ``pairs`` orders, by a hundred customers of five hundred parts."""
    n = spark.range(pairs)
    n.selectExpr("id AS o_orderkey", "id % 100 AS o_custkey").write.parquet(f"{folder}/orders.parquet")
    n.selectExpr("id AS l_orderkey", "id * 7 % 499 AS l_partkey").write.parquet(f"{folder}/lineitem.parquet")
    spark.range(100).selectExpr("id AS c_custkey").write.parquet(f"{folder}/customer.parquet")
    spark.range(500).selectExpr("id AS p_partkey").write.parquet(f"{folder}/part.parquet")


def test_all_held_out_pairs_are_ranked(spark, tmp_path):
    shop(spark, str(tmp_path), 49_000)
    held = roles.part_of(roles.split_plays(spark, str(tmp_path)), "validation").count()
    assert held > 4_500
    monkey = {"pairs": 1_000}  # the sample that other queries draw
    assert roles.candidates(spark, str(tmp_path), **monkey).where("draw = 0").count() == 1_000
    assert queries.rank_positive(spark, str(tmp_path)).count() == held


@pytest.mark.parametrize("block", [3, 1 << 17])
@pytest.mark.parametrize("kind", ["float", "double"])
def test_products_are_those_of_the_joins(spark, monkeypatch, block, kind):
    """Ids that repeat, lack or have no vector; vectors with NULL, NaN, and of other lengths."""
    monkeypatch.setattr(paired, "BLOCK", block)
    monkeypatch.setattr(paired, "LEAST_BLOCKS", 2)
    draw = np.random.default_rng(3)

    def table(ids):
        rows = [(i, [float(x) for x in draw.normal(size=4)]) for i in ids]
        rows += [(ids[0], None), (None, [1.0] * 4), (ids[1], [1.0, None, 2.0, 3.0]), (ids[2], [1.0]), (ids[3], []), (ids[4], [math.nan] * 4)]
        return spark.createDataFrame(rows, f"id long, features array<{kind}>")

    users, items = table([*range(20), 3, 3, 7]), table([*range(5, 40), 9, 9, 11])
    asked = spark.createDataFrame(
        [(int(u), int(i), int(d), int(i)) for d, (u, i) in enumerate(draw.integers(0, 45, (400, 2)))] + [(None, 1, 900, 1), (1, 2, 901, None)],
        "user_id long, song_id long, draw int, candidate long",
    )
    got, want = (factors.score_candidates(asked, users, items, dense) for dense in (True, False))
    assert got.dtypes == want.dtypes and got.columns == want.columns
    text = lambda df: sorted(map(str, df.collect()))
    assert text(got) == text(want) and got.where("isnan(score)").count() and got.where("score = -double('inf')").count()


def test_vectors_are_not_joined_to_pairs(spark):
    ids = spark.range(50).select("id", F.array(F.lit(1.0), F.lit(2.0)).alias("features"))
    asked = spark.range(50).selectExpr("id AS user_id", "id AS song_id", "0 AS draw", "id AS candidate")
    scored = factors.score_candidates(asked, ids, ids, dense=True)
    assert [r.score for r in scored.collect()] == [5.0] * 50
    assert "Join" not in scored._jdf.queryExecution().executedPlan().toString()
