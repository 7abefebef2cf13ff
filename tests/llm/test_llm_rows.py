"""Repeated and null ids, and vectors of very different lengths, against brute force."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackloom.llm import chat, decontaminate, fixity, hilbert, jaccard_join, language, learning, suffix_dedup

DRAW = random.Random(11)
DOCS = "doc_id long, text string"


def words(n, draw=DRAW):
    return ["".join(draw.choice("abcdefgh") for _ in range(draw.randint(3, 8))) for _ in range(n)]


def shingles(text):
    w = text.split()
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def plain_groups(rows):
    """(doc_id, text) -> class_id, n_links, with one document per (doc_id, set)."""
    nodes = sorted({(i, frozenset(shingles(t))) for i, t in rows if i is not None and t and shingles(t)}, key=lambda n: (n[0], sorted(n[1])))
    parent = list(range(len(nodes)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [0] * len(nodes)
    for a in range(len(nodes)):
        for b in range(a):
            x, y = nodes[a][1], nodes[b][1]
            if len(x & y) >= 0.8 * len(x | y) - 1e-9:
                links[a], links[b] = links[a] + 1, links[b] + 1
                parent[find(a)] = find(b)
    least = defaultdict(lambda: 1 << 60)
    for k, (i, _) in enumerate(nodes):
        least[find(k)] = min(least[find(k)], i)
    return {n: (least[find(k)], links[k]) for k, n in enumerate(nodes)}


def test_two_texts_under_one_id_are_two_classes(spark):
    a, b = words(100), words(100)
    near = lambda t, k: " ".join([*t[:k], "zzz", *t[k + 1 :]])
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, near(a, 50)), (3, near(b, 3)), (4, near(b, 3)), (5, near(a, 9)), (5, near(b, 8)),
            (6, " ".join(a)), (None, " ".join(a)), (7, "x  y"), (7, "x y"), (8, None)]
    want = plain_groups(rows)
    for block in (1 << 17, 100):
        got = jaccard_join.grouped(spark.createDataFrame(rows * 2, DOCS).repartition(3), block=block).collect()
        texts = {(i, hashlib.md5((t or "").encode()).hexdigest()): t for i, t in rows}
        assert len(got) == 2 * (len(rows) - 1)
        for r in got:
            key = r.doc_id, frozenset(shingles(texts[r.doc_id, r.text_md5] or ""))
            assert (r.class_id, r.n_links) == want.get(key, (r.doc_id, 0)), r


def plain_removed(rows, span=50):
    least = {}
    for i, t in rows:
        body = (t or "").encode()
        for at in range(len(body) - span + 1):
            window = body[at : at + span]
            least[window] = min(least.get(window, i), i)
    out = []
    for i, t in rows:
        body = (t or "").encode()
        gone = np.zeros(len(body), bool)
        for at in range(len(body) - span + 1):
            if least[body[at : at + span]] < i:
                gone[at : at + span] = True
        kept = bytes(b for b, g in zip(body, gone) if not g)
        out.append((i, len(body), int(gone.sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_passages_of_a_text_are_not_cut_from_another_of_its_id(spark):
    passage = " ".join(words(20))
    rows = [(1, passage), (2, "head " + passage + " tail " + " ".join(words(9))), (2, " ".join(words(30))), (2, passage),
            (3, " ".join(words(12)) + passage[5:90]), (3, passage), (3, passage + passage), (4, passage), (4, passage)]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, DOCS).repartition(3), range_=1 << 10)
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.kept_sha256) for r in got.collect()) == plain_removed(rows)


def test_records_without_an_id_are_found_intact(spark, monkeypatch):
    from trackloom.llm import queries

    pages = [(None, "http://a/1", "one"), (None, "http://a/1", "one"), (None, "http://b/2", "two"), (5, None, None), (5, "u", "x"), (6, "v", "y" * 90_000)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    monkeypatch.setattr(queries, "read", lambda *_: df)
    monkeypatch.setattr(queries, "damaged_replica", lambda records: records)
    assert queries.warc_fixity(spark, "").count() == 0
    monkeypatch.setattr(queries, "damaged_replica", lambda records: records.where("record NOT LIKE '%two%'"))
    (lost,) = queries.warc_fixity(spark, "").collect()
    assert lost.page_id is None and lost.found is None
    empty = df.limit(0)
    monkeypatch.setattr(queries, "read", lambda *_: empty)
    assert queries.warc_fixity(spark, "").count() == 0


def test_a_sample_is_bounded_whatever_repeats(spark):
    docs = spark.range(400).select((F.col("id") % 4).alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"), F.lit("en").alias("lang"))
    labels = spark.range(40).select((F.col("id") % 4).alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    got = learning.sample_texts(docs, labels, "quality", F.lit(True), 2, "x").collect()
    assert len(got) == 2 and all(r.label == min(0, 1) or r.label in (0, 1) for r in got)
    again = learning.sample_texts(docs.repartition(7), labels.repartition(5), "quality", F.lit(True), 2, "x").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    assert language.predict(docs, language.fit(docs, F.lit(True), 2)).count() == 400


VECTORS = "vec_id long, embedding array<double>"


def recall(spark, x, k=20, **settings):
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], VECTORS).repartition(8)
    queries = df.where("vec_id % 20 = 0")
    got = defaultdict(list)
    for r in hilbert.search(queries, df, k, **settings).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    shares = []
    for q in range(0, len(x), 20):
        scores = x @ x[q]
        scores[q] = -np.inf
        best = set(np.argsort(-scores, kind="stable")[:k].tolist())
        found = got[q]
        assert all(abs(s - scores[i]) <= 1e-9 * (1 + abs(s)) for i, s in found) and len(found) == k
        assert [s for _, s in found] == sorted((s for _, s in found), reverse=True)
        shares.append(len(best & {i for i, _ in found}) / k)
    return float(np.mean(shares))


@pytest.mark.parametrize("kind", ["one long", "log-normal"])
def test_lengths_do_not_cost_recall(spark, kind):
    draw = np.random.default_rng(3)
    x = draw.normal(size=(20_000, 32))
    if kind == "one long":
        x[777] *= 1000
    if kind == "log-normal":
        x *= np.exp(draw.normal(size=(len(x), 1)) * 1.5)
    assert recall(spark, x) >= 0.9


def test_what_a_query_costs(spark):
    draw = np.random.default_rng(4)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(draw.normal(size=(20_000, 32)))], VECTORS)
    cost = hilbert.rows_scored(df.where("vec_id % 200 = 0"), df)
    assert cost.count() == 100 and cost.agg(F.avg("n_scored")).first()[0] < 1.15 * 20_000


def test_odd_vectors_change_nothing_else(spark):
    draw = np.random.default_rng(5)
    x = draw.normal(size=(300, 8))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(1000, [1.0] * 9), (1001, [0.0] * 8), (1002, None), (1003, [None] * 8), (1004, [float("nan")] * 8), (1005, []), (None, [9.0] * 8)]

    def found(table):
        df = spark.createDataFrame(table, VECTORS).withColumn("query", F.lit("clash"))
        return sorted(map(tuple, hilbert.search(df.where("vec_id % 20 = 0"), df).collect()))

    plain = found(rows)
    assert len(plain) == 15 * 20 and found(rows + odd) == plain
    # Of two vectors under one id the smaller stands for both, whatever the order of the rows.
    twice = [(17, [-9.0] * 8), (40, [50.0] * 8)]
    least = [(i, min([v, *(w for j, w in twice if j == i)])) for i, v in rows]
    assert found(rows + twice) == found(twice + rows) == found(least)


def test_long_and_short_benchmark_items(spark):
    draw = random.Random(6)
    long = " ".join(words(400, draw))  # above 2,000 bytes
    other = " ".join(words(400, draw))
    edited = list(long)
    for _ in range(len(long) // 40):
        edited[draw.randrange(len(edited))] = "#"
    items = [(1, long), (2, "四字成語"), (3, "kurz"), (4, ""), (None, "null item here"), (5, None)]
    rows = [(10, "x" + long + "y"), (11, "in " + "".join(edited)), (12, other + long[-79:]), (13, long[:1500] + other), (14, "這是四字成語嗎"),
            (15, "zu kurz"), (16, "四字"), (17, None), (18, ""), (None, long), (19, "kur"), (19, "kurz"), (20, other)]
    df = spark.createDataFrame(rows, DOCS).withColumn("item_id", F.lit("clash")).repartition(3)
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    got = {(r.doc_id, r.item_id): r.distance for r in decontaminate.leaks(df, benchmark).collect()}
    assert set(got) == {(10, 1), (11, 1), (14, 2), (15, 3), (19, 3)} and got[10, 1] == 0 < got[11, 1] <= 0.05 * len(long)
    kept = decontaminate.clean(df, benchmark)
    assert kept.columns == df.columns
    left = sorted((str(r.doc_id), r.text) for r in kept.collect())
    assert left == sorted((str(i), t) for i, t in rows if (i, t) in [r for r in rows if r[0] in (12, 13, 16, 17, 18, 20, None)] or (i, t) == (19, "kur"))


def test_leaks_against_edit_distance(spark):
    """All parts of all texts by the plain recurrence."""
    draw = random.Random(9)
    items = [(i, " ".join(words(12, draw))) for i in range(6)]
    rows = []
    for d in range(40):
        name, text = draw.choice(items)
        body = list(text)
        for _ in range(draw.randint(0, 9)):
            at = draw.randrange(len(body))
            body[at : at + draw.randint(0, 1)] = draw.choice(["", "#", "##"])
        rows.append((d, " ".join(words(8, draw)) + draw.choice(["", " ", "("]) + "".join(body) + " ".join(words(8, draw))))
    want = {}
    for d, text in rows:
        for name, item in items:
            found, _ = decontaminate.fitting_distance(np.frombuffer(item.encode(), np.uint8), np.frombuffer(text.encode(), np.uint8))
            if found <= decontaminate.edits(len(item), 0.95):
                want[d, name] = found
    got = decontaminate.leaks(spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id): r.distance for r in got} == want and len(want) > 12


def test_embedding_alone_finds_edited_items():
    """Share of planted items that share a key with a window, by place and share of edits."""
    draw = random.Random(12)
    letters = lambda n: "".join(draw.choice("abcdefghij ") for _ in range(n))
    items = [(i, letters(draw.randint(80, 400)).encode(), 0) for i in range(30)]
    probe = decontaminate.Probe(items, 0.95, decontaminate.WALKS, decontaminate.SAMPLES, decontaminate.BITS)
    for before in ("", "half", "の" * 200):
        for share in (0.0, 0.04):
            found = 0
            for name, text, _ in items:
                body = bytearray(text)
                for _ in range(int(len(text) * share)):
                    at = draw.randrange(len(body))
                    body[at : at + draw.randint(0, 1)] = draw.choice([b"", b"#"])
                data = np.frombuffer((letters(40) + before).encode() + bytes(body) + letters(40).encode(), np.uint8)
                found += any(n == name for _, n, *_ in probe.leaks(data, np.array([0, len(data)])))
            assert found >= 0.96 * len(items), (before, share, found)


def test_what_is_broadcast_is_small():
    import pickle

    draw = random.Random(1)
    items = [(i, bytes(draw.choices(range(97, 123), k=draw.randint(12, 2000))), 0) for i in range(2000)]
    probe = decontaminate.Probe(items, 0.95, 3, 16, 5)
    assert len(pickle.dumps(probe)) < 5e6


def test_events_that_come_twice_late_or_together(spark):
    def event(seq, kind, text=None, at=None, cut=None, message="m", turn=0):
        return (1, turn, message, seq, kind, "assistant" if kind == "open" else None, at, cut, text)

    log = [event(0, "open"), event(1, "delta", "ab"), event(1, "delta", "ab"), event(2, "delta", "c"), event(2, "delta", "ab"),
           event(3, "edit", "X", 0, 1), event(3, "edit", "X", 0, 1), event(4, "mystery", "?"),
           event(0, "open", message="n", turn=1), event(1, "delta", "old", message="n", turn=1),
           event(2, "regenerate", message="n", turn=1), event(3, "delta", "new", message="n", turn=1),
           event(None, "delta", "w", message="o", turn=2), event(None, "delta", "w", message="o", turn=2), event(5, "delta", "y", message="o", turn=2)]
    for seed in range(3):
        random.Random(seed).shuffle(log)
        got = chat.reconstruct(spark.createDataFrame(log, chat.EVENTS).repartition(4)).orderBy("turn").collect()
        assert [chat.read_back(r.formatted) for r in got] == [("assistant", "Xbabc"), ("assistant", "new"), ("", "wwy")]
