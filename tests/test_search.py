"""Searches over blocks that bounds leave out: exact against brute force, and what they save."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackloom.operators import blocked, factors, neighbours


def table(spark, points, first=0, id_="id", vector="features"):
    rows = [(first + i, [float(x) for x in p]) for i, p in enumerate(points)]
    return spark.createDataFrame(rows, f"{id_} long, {vector} array<double>").repartition(4)


def best_products(users, items, k, heard):
    out = {}
    for u, x in enumerate(users):
        scores = np.round((items * x).sum(axis=1), 9)
        order = sorted((i for i in range(len(items)) if (u, i) not in heard), key=lambda i: (-scores[i], i))
        out[u] = [(i, scores[i]) for i in order[:k]]
    return out


def lists(df):
    out = {}
    for r in factors.best_per_user(df, 1 << 20).orderBy("user_id", "rk").collect():
        out.setdefault(r.user_id, []).append((r.song_id, r.confidence_score))
    return out


@pytest.mark.parametrize("block,kind", [(7, "long tail"), (64, "equal"), (64, "copies"), (1024, "copies"), (64, "negative")])
def test_largest_products(spark, block, kind):
    draw = np.random.default_rng(block)
    users, items = draw.normal(size=(40, 6)), draw.normal(size=(300, 6))
    if kind == "long tail":
        items *= np.exp(-np.arange(300) / 20)[:, None]
    if kind == "copies":
        items[:200] = items[0]
    if kind == "negative":
        users, items = np.abs(users), -np.abs(items)
    heard = {(u, i) for u in range(40) for i in range(300) if (u * 31 + i * 7) % 5 == 0} | {(3, i) for i in range(295)}
    pairs = spark.createDataFrame([*heard, (99, 1), (1, 999)], "user_id long, song_id long")
    found, read = factors.search_products(table(spark, users), table(spark, items), 10, pairs, block)
    assert lists(found) == {u: best for u, best in best_products(users, items, 10, heard).items() if best}
    counts = {r.user_id: r.n_blocks for r in read.collect()}
    blocks = -(-300 // block)
    assert set(counts) == set(range(40)) and all(1 <= n <= blocks for n in counts.values())
    assert counts[3] == blocks  # who has heard nearly all must look everywhere
    if kind == "long tail" and block == 7:
        assert np.mean([n for u, n in counts.items() if u != 3]) < blocks / 2


def test_products_without_users_items_or_a_history(spark):
    none, some = table(spark, np.zeros((0, 3))), table(spark, np.ones((4, 3)))
    assert factors.search_products(none, some, 3)[0].count() == 0
    assert factors.search_products(some, none, 3)[0].count() == 0
    found, read = factors.search_products(some, some, 3)
    assert {u: [i for i, _ in best] for u, best in lists(found).items()} == {u: [0, 1, 2] for u in range(4)}
    assert read.count() == 4


def test_many_queries_of_a_block_are_spread_over_tasks(spark):
    draw = np.random.default_rng(2)
    x, q = draw.normal(size=(50, 3)), draw.normal(size=(200, 3))
    members = table(spark, x, id_="member", vector="vector").withColumns({"block": F.lit(5).cast("long"), "order": F.col("member")})
    visits = table(spark, q, id_="key", vector="vector").withColumn("block", F.lit(5).cast("long"))
    want = {(i, int(j), round(float(np.sqrt(((x[j] - v) ** 2).sum())), 9)) for i, v in enumerate(q) for j in np.argsort(((x - v) ** 2).sum(axis=1))[:4]}
    for settings in ({}, {"bucket": 9}, {"size": 6}, {"bucket": 50, "size": 20}):
        found = blocked.best_in_blocks(members, visits, 4, True, **settings).collect()
        best = {}
        for r in found:
            best.setdefault(r.key, []).append((r.value, r.member))
        assert {(k, m, round(v, 9)) for k, rows in best.items() for v, m in sorted(rows)[:4]} == want


def clusters(n, seed=0):
    draw = np.random.default_rng(seed)
    centres = draw.uniform(-50, 50, size=(25, 4))
    return centres[draw.integers(0, 25, n)] + draw.normal(size=(n, 4))


@pytest.mark.parametrize("block,ring_rows", [(16, 12), (4096, 1024), (4096, 100)])
def test_nearest_for_every_row_as_a_seed(spark, block, ring_rows):
    points = clusters(600)
    points[:40] = points[0]
    df = table(spark, points, id_="track_id")
    got = {}
    for r in neighbours.nearest(df, df, 8, block=block, ring_rows=ring_rows).orderBy("seed_id", "rk").collect():
        got.setdefault(r.seed_id, []).append((r.track_id, r.dist))
    for s in range(600):
        dist = np.round(np.sqrt(((points - points[s]) ** 2).sum(axis=1)), 9)
        assert got[s] == [(i, dist[i]) for i in sorted(range(600), key=lambda i: (dist[i], i))[:8]]


def test_bounds_leave_out_most_rows(spark):
    points = clusters(3000, 1)
    df = table(spark, points, id_="track_id")
    seeds = df.filter("track_id % 50 = 0").cache()
    compared = neighbours.rows_compared(df, seeds, 10, ring_rows=30)
    assert compared.count() == 60 and compared.agg(F.avg("n_compared")).first()[0] < 900


def test_seeds_outside_the_catalogue_and_repeated(spark):
    points = clusters(100, 2)
    df = table(spark, points, id_="track_id")
    far = [(7_000, [900.0] * 4), (7_001, [float(x) for x in points[3]]), (7_001, [float(x) for x in points[3]])]
    seeds = spark.createDataFrame(far, "track_id long, features array<double>")
    rows = neighbours.nearest(df, seeds, 150).collect()
    assert sorted((r.seed_id, r.rk) for r in rows) == [(s, k) for s in (7_000, 7_001) for k in range(1, 101)]
    assert neighbours.nearest(df.limit(0), seeds, 3).count() == 0
