"""The trie of conversation prefixes against a plain dictionary trie; scans and list ranks against loops."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackloom.llm import prefix_tree, scans

TURNS = "conv_id long, turn long, role string, text string"
COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def plain(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), (role or "").encode(), (text or "").encode()))
    own = {c: [t[1:] for t in sorted(ts)] for c, ts in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        path = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    out, sums = [], {}
    for node in sorted(members, key=len, reverse=True):
        below = [sums[k] for k in kids[node]]
        saved = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        sums[node] = (sum(x for x, _ in below) or 1, saved + sum(x for _, x in below))
        digest = hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest()
        parent = members[node[:-1]][0] if node else None
        out.append((members[node][0], len(node), parent, len(members[node]), len(kids[node]), *sums[node], digest))
    return sorted(map(str, out))


def found(df):
    return sorted(str(tuple(r[c] for c in COLUMNS)) for r in df.collect())


def talk(n, seed, turns=12, words=3):
    draw = random.Random(seed)
    return [
        (c, t, draw.choice(["user", "assistant"]), draw.choice(["é", "b", "", "ccc"][:words]))
        for c in draw.sample(range(3 * n), n)
        for t in range(draw.randint(1, turns))
    ]


EDGES = [
    (None, 0, "user", "nobody's"), (3, None, None, None), (3, None, "", ""), (3, 0, "user", "x"), (3, 0, "user", "x"),
    (3, 0, "assistant", "x"), (5, 1, "user", "a\nb"), (6, 1, "user\n", "a"), (-7, 0, "user", "a"), (-4, 3, "user", "z"),
    (0, 0, "user", "long " * 20_000), (1, 0, "user", "q"), (2, 7, "user", "q"), (2**60, 1, "user", "q"), (10, 0, None, "é"),
]


@pytest.mark.parametrize(
    "rows",
    [EDGES, talk(40, 1) + [(1000 + c, *t) for c, *t in talk(120, 2, 3, 1)], [(c, t, "user", "same") for c in range(60) for t in range(4)],
     [(5, t, "user", str(t)) for t in range(1500)] + [(6, t, "user", str(t)) for t in range(900)]],
    ids=["edges", "mixed", "copies", "deep"],
)
def test_against_a_plain_trie(spark, monkeypatch, rows):
    monkeypatch.setattr(prefix_tree, "CHUNK", 7)
    monkeypatch.setattr(scans, "SMALL", 50)
    df = spark.createDataFrame(rows, TURNS).repartition(5).withColumn("depth", F.lit("clash")).withColumn("hi", F.lit(1))
    assert found(prefix_tree.prefix_trie(df)) == plain(rows)


def test_empty_tables(spark):
    assert prefix_tree.prefix_trie(spark.createDataFrame([], TURNS)).count() == 0
    assert prefix_tree.prefix_trie(spark.createDataFrame([(None, 1, "user", "x")], TURNS)).count() == 0


def test_the_whole_query(spark, folder):
    table = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    assert found(prefix_tree.prefix_trie(table)) == plain([tuple(r) for r in table.collect()])


@pytest.mark.parametrize("n,rulers", [(1, 8), (40, 2), (3000, 8)])
def test_list_ranks(spark, n, rulers):
    order = random.Random(n).sample(range(10 * n), n)
    arcs = spark.createDataFrame([(a, b) for a, b in zip(order, [*order[1:], None])], "arc long, to long")
    got = scans.list_ranks(arcs, order[-1], rulers=rulers, small=16)
    assert {r.arc: r.ahead for r in got.collect()} == {a: n - 1 - i for i, a in enumerate(order)}


@pytest.mark.parametrize("group,xor", [(None, False), (None, True), ("g", False), ("g", True)])
def test_running_over_any_partitions(spark, group, xor):
    draw = random.Random(7)
    rows = [(g, i, draw.randint(-5, 1 << 40), draw.randint(0, 9)) for g, n in ((0, 1), (3, 400), (4, 1), (-9, 90), (8, 3)) for i in range(n)]
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, "g long, i long, x long, y long").repartition(7)
    got = scans.running(df, ["g", "i"], ["x", "y"], group=group, xor=xor).collect()
    want, sums = set(), defaultdict(lambda: (0, 0))
    for g, i, x, y in sorted(rows):
        a, b = sums[g if group else None]
        sums[g if group else None] = (a ^ x, b ^ y) if xor else (a + x, b + y)
        want.add((g, i, x, y, *sums[g if group else None]))
    assert set(map(tuple, got)) == want and len(got) == len(rows)
