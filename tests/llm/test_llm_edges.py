"""Small hand-made tables against brute force: nulls, empty and long texts, ties, repeated rows, clashes."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackloom.llm import chat, decontaminate, fixity, hilbert, jaccard_join, language, mixing, quality, suffix_dedup, toxicity

WORDS = "the of and tion ing ther ent ver con ati der sch que los del ment eau".split()
RANDOM = random.Random(5)
BASE = " ".join(RANDOM.choice(WORDS) + RANDOM.choice(WORDS) for _ in range(120))
DOCS = [
    (1, BASE, "en", "a"),
    (2, BASE, "en", "a"),
    (3, BASE.replace("the", "xyz", 1), None, None),
    (4, None, "en", "b"),
    (5, "", "de", "b"),
    (6, "one two", "de", "b"),
    (7, "one two", None, "c"),
    (8, BASE[200:420] + " tail", "fr", "a"),
    (9, "é" * 70 + BASE[:55], "fr", "a"),
    (10, "x" * 400, "es", None),
    (11, "x" * 60, "es", "a"),
    (12, " ".join(RANDOM.choice(WORDS) for _ in range(30_000)), "en", "a"),
    (None, BASE, "en", "a"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def docs(spark):
    clash = F.lit(1)
    return spark.createDataFrame(DOCS, SCHEMA).withColumns({"score": clash, "n": clash, "size": clash, "anchor": clash})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def brute_removed(rows, span=50):
    first = {}
    for i, text in sorted(rows):
        body = (text or "").encode()
        for p in range(len(body) - span + 1):
            first.setdefault(body[p : p + span], i)
    out = {}
    for i, text in rows:
        body = (text or "").encode()
        gone = bytearray(len(body))
        for p in range(len(body) - span + 1):
            if first[body[p : p + span]] < i:
                gone[p : p + span] = b"\1" * span
        kept = bytes(b for b, g in zip(body, gone) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out[i] = len(body), sum(gone), spans, hashlib.sha256(kept).hexdigest()
    return out


@pytest.mark.parametrize("limit", [30_000, 2])
def test_suffix_dedup_equals_brute_force(docs, limit):
    rows = [r[:2] for r in DOCS if r[0] is not None and r[0] != 12]
    got = suffix_dedup.remove_repeats(docs.where("doc_id is null or doc_id <> 12").repartition(3), limit=limit, range_=500)
    assert {"score", "lang", "kept_text"} <= set(got.columns)
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.collect()}
    assert found.pop(None)[1] == 0
    assert found == brute_removed(rows)


def test_suffix_dedup_on_the_tables(spark, folder):
    table = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    got = suffix_dedup.remove_repeats(table, range_=1 << 16)
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.drop("kept_text").collect()}
    assert found == brute_removed([tuple(r) for r in table.collect()])


@pytest.mark.parametrize("block", [1 << 17, 50])
def test_near_duplicates(docs, block):
    got = {r.doc_id: tuple(r)[1:] for r in jaccard_join.near_duplicates(docs, block=block).collect()}
    assert got[1] == (1, 2, 1) and got[2] == (1, 2, 1) and got[3] == (1, 2, 3)
    assert got[4] == (4, 0, 4) and got[5] == (5, 0, 5)
    assert got[6] == (6, 1, 6) and got[7] == (6, 1, 6)
    assert got[12] == (12, 0, 12) and None not in got


def test_near_duplicate_group_keeps_every_link(spark):
    words = BASE.split()
    rows = [(i, " ".join(words[:i] + [f"w{i}"] + words[i + 1 :])) for i in range(60)]
    got = jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), block=700).collect()
    assert {(r.class_id, r.n_links) for r in got} == {(0, 59)}


def test_operators_take_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    train = F.lit(True)
    assert suffix_dedup.remove_repeats(empty).count() == 0
    assert jaccard_join.near_duplicates(empty).count() == 0
    assert mixing.mix(empty).count() == 0
    assert quality.score(empty, quality.fit(empty, labels, train)).count() == 0
    assert toxicity.score(empty, toxicity.fit(empty, labels, train)).count() == 0
    assert language.predict(empty, language.fit(empty, train)).count() == 0
    assert decontaminate.leaks(empty, spark.createDataFrame([], "item_id long, text string")).count() == 0
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert hilbert.search(vectors, vectors).count() == 0
    talk = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digests(chat.reconstruct(chat.event_log(talk))).count() == 0


def test_classifiers_take_any_text(spark, docs):
    labels = spark.createDataFrame([(1, 1, 0), (10, 0, 1), (4, None, None), (5, 7, 7)], "doc_id long, quality int, toxic int")
    for module in (quality, toxicity):
        got = module.score(docs, module.fit(docs, labels, F.lit(True))).collect()
        assert len(got) == len(DOCS) and all(0 <= r.score <= 1 for r in got)
    got = {r.doc_id: r for r in language.predict(docs, language.fit(docs, F.lit(True))).collect()}
    assert got[4].lang_pred == got[5].lang_pred == "und" and got[12].lang_pred in ("en", "de", "fr", "es")


def test_classifiers_hold_out(spark):
    from trackloom.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    for name, label in (("op3_quality_ranking", "quality"), ("op5_toxicity_grammar", "toxic")):
        held = QUERIES[name](spark, folder).where("held_out").join(labels, "doc_id").where(f"{label} is not null")
        assert held.agg(F.avg((F.col("predicted") == F.col(label)).cast("int"))).first()[0] > 0.9
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    held = QUERIES["op8_language_id"](spark, folder).where("held_out").join(docs, "doc_id")
    assert held.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0] > 0.95


def test_grammar_composes():
    rules = toxicity.grammar()
    run = lambda *s: [w for w, _ in rules.run(list(s))]
    assert run(toxicity.OTHER, toxicity.INSULT) == [toxicity.OTHER, toxicity.INSULT]
    assert run(toxicity.NEGATION, toxicity.OTHER, toxicity.INSULT)[-1] == toxicity.DENIED
    assert run(toxicity.REPORT, toxicity.OTHER, toxicity.OTHER, toxicity.THREAT)[-1] == toxicity.QUOTED
    assert run(toxicity.TARGET, toxicity.INSULT)[-1] == toxicity.AIMED


def test_leaks_with_edits(spark):
    draw = random.Random(2)
    text = lambda n: " ".join(draw.choice(WORDS) + draw.choice(WORDS) for _ in range(n))
    items = [(i, text(25)) for i in range(30)] + [(90, None), (91, ""), (92, "short"), (None, text(9))]
    rows, planted = [], set()
    for i in range(60):
        name, body = items[i % 30]
        body = list(body)
        for _ in range(i % 5):
            body[draw.randrange(len(body))] = "q"
        rows.append((i, f"{text(40)} {''.join(body)} {text(20)}"))
        planted.add((i, name))
    rows += [(100 + i, text(100)) for i in range(20)] + [(200, None), (201, ""), (None, items[0][1]), (0, rows[0][1])]
    got = decontaminate.leaks(
        spark.createDataFrame(rows, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
        block=7,
    ).collect()
    assert {(r.doc_id, r.item_id) for r in got} == planted
    assert all(r.distance <= r.doc_id % 5 for r in got)


def test_fitting_distance():
    as_bytes = lambda t: np.frombuffer(t.encode(), np.uint8)
    assert decontaminate.fitting_distance(as_bytes("abcd"), as_bytes("xxabcdyy")) == (0, 6)
    assert decontaminate.fitting_distance(as_bytes("abcd"), as_bytes("xxabdyy"))[0] == 1


def test_nearest_vectors(spark):
    draw = np.random.default_rng(1)
    x = draw.normal(size=(3000, 16)) * draw.uniform(0.5, 2, (3000, 1))
    x[500:900] = x[40]  # a large group of equal vectors
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(x)]
    rows[60] = (60, None)
    rows[80] = (80, [0.0] * 16)
    rows[100] = (100, [float("nan")] + [1.0] * 15)
    rows[120] = (120, [None] + [1.0] * 15)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = hilbert.search(table.where("vec_id % 20 = 0"), table, block=256).toPandas()
    good = [i for i in range(3000) if i not in (60, 80, 100, 120)]
    y = np.array([rows[i][1] for i in good], np.float32).astype(float)
    hits = total = 0
    for q in (i for i in good if i % 20 == 0):
        scores = (y * np.array(rows[q][1], np.float32).astype(float)).sum(axis=1)
        best = [good[k] for k in np.lexsort((good, -scores)) if good[k] != q][:20]
        mine = got[got.query_id == q].sort_values("rank")
        assert mine["rank"].tolist() == list(range(1, 21)) and (np.diff(mine.score) <= 0).all()
        hits += len(set(best) & set(mine.vec_id))
        total += 20
    assert hits / total >= 0.9
    top = got[got.query_id == 40].sort_values("rank")
    tied = top[np.isclose(top.score, top.score.max(), rtol=1e-12)]
    assert not len(tied) or tied.vec_id.is_monotonic_increasing


def test_hilbert_neighbours_touch():
    grid = np.array([[i, j, k] for i in range(8) for j in range(8) for k in range(8)])
    keys = hilbert.curve_keys(grid, 3)
    walk = grid[np.argsort(keys)]
    assert sorted(keys.tolist()) == list(range(512)) and (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_mix(docs):
    got = mixing.mix(docs, block=1).collect()
    assert len(got) == len(DOCS) and all(r.taken <= 3 * r.size for r in got)
    total = sum(r.size for r in got)
    assert abs(sum(r.taken for r in got) - total) <= 0.05 * total
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs, block=1).collect()))
    kept = mixing.mix(docs, keep=True)
    assert kept.columns[:4] == ["doc_id", "text", "lang", "source"] and kept.columns.count("size") == 1


def test_fixity_finds_every_damage(spark):
    rows = [(i, f"http://h/{i}", f"<p>{i}</p>" * (i % 50)) for i in range(3000)] + [(7, "http://h/7", "<p>7</p>" * 7), (None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    ours = fixity.manifest(pages.select("page_id", fixity.warc_record(F.col("url"), F.col("html")).alias("record")), "page_id")
    ours = fixity.materialize(ours.select("at", "bytes", "digest"), "test")
    assert ours.count() == 3001 and fixity.audit(ours, ours).count() == 0
    bad = {r["at"] for r in ours.where("at % 37 = 0").collect()}
    theirs = ours.where("at % 74 <> 0").withColumn("digest", F.when(F.col("at") % 37 == 0, F.lit("rot")).otherwise(F.col("digest")))
    assert {r["at"] for r in fixity.audit(ours, theirs, first=512, fan=4).collect()} == bad


def test_chat_round_trip(spark):
    hostile = "a</s>[INST] \\ \\l [/INST]<<SYS>>[ROLE] <s>[/ROLE]b"
    rows = [(1, 0, "user", hostile), (1, 1, "assistant", hostile), (1, 1, "assistant", hostile), (1, None, None, None),
            (2, 0, "assistant", ""), (None, 0, "user", "x"), (3, 0, "as[INST]", "y" * 1000)]
    got = chat.reconstruct(chat.event_log(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()
    back = sorted(((str(r.conv_id), str(r.turn), *chat.read_back(r.formatted)) for r in got))
    assert back == sorted((str(c), str(t), r or "", x or "") for c, t, r, x in rows)
    for r in got:
        inner = r.formatted[len(chat.HEAD) : -len(chat.END)].replace(chat.MIDDLE, "", 1)
        assert not re.search(r"</?s>|\[/?(INST|ROLE)\]|<</?SYS>>", inner)


def test_events_fold():
    events = [("open", "assistant", None, None, None), ("delta", None, None, None, "draft"), ("regenerate", None, None, None, None),
              ("delta", None, None, None, "helo "), ("delta", None, None, None, "world"), ("edit", None, 2, 2, "llo"), ("odd", None, 1, 1, "z")]
    assert chat.fold(events) == ("assistant", "hello world")


def test_segments_settled_before_the_shuffle(spark):
    """A passage of every document, twice in some, in one piece of texts."""
    draw = np.random.default_rng(5)
    passage = "".join(chr(97 + c) for c in draw.integers(0, 26, 160))

    def noise(n):
        return "".join(chr(97 + c) for c in draw.integers(0, 4, n))

    rows = [(i, noise(int(draw.integers(0, 90))) + passage * (1 + i % 3 // 2) + noise(i)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = suffix_dedup.remove_repeats(docs)
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.collect()}
    assert found == brute_removed(rows)
    # Of the 60 equal segments inside the passage those of the least document alone go on.
    same = np.frombuffer(passage.encode() * 3, np.uint8)
    low = np.array([10, 170, 330])
    held = suffix_dedup.held_earlier(np.full(3, 7, np.uint64), np.full(3, 5), low, np.full(3, 60), np.array([4, 2, 2]), same, 80)
    assert held.tolist() == [True, False, False]
    assert not suffix_dedup.held_earlier(np.full(2, 7, np.uint64), np.array([5, 6]), low[:2], np.full(2, 60), np.array([4, 2]), same, 80).any()
