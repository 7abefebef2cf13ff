"""Every stage of the corpus pipeline, and the whole, against plain versions on the stage's own input."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm_rows import plain_groups, plain_removed, shingles

import corpus_pipeline
from trackloom.llm import decontaminate, quality
from trackloom.llm.tables import held_out

DOCS = "doc_id long, text string, lang string, source string, n_chars long, extra string"
DRAW = random.Random(21)


def words(n):
    return " ".join("".join(DRAW.choice("abcdefgh") for _ in range(DRAW.randint(3, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def fixture(spark, tmp_path_factory):
    """Good and bad texts, copies, near copies, repeated passages, leaks, repeated ids and nulls."""
    item, passage = words(15), words(25)
    rows = []
    for i in range(80):
        text = words(60) if i % 3 else " ".join(["!!! $$$"] * 30 + [words(10)])
        if i % 8 == 1:
            text = text[:80] + " " + passage + " " + text[80:]
        if i % 20 == 7:
            text += " " + item
        rows.append((i, text, "en", "abc"[i % 3] if i % 5 else None, len(text), "x"))
    rows += [(100 + i, rows[i][1], "de", "b", None, None) for i in (1, 2, 4)]
    rows += [(110, rows[1][1] + " more", None, "c", 5, None), (111, None, "en", "a", None, None), (112, "", None, None, 0, ""),
             (2, words(50), "en", "a", 7, "second text"), (None, words(40), "en", "a", 1, None), (None, rows[1][1], "en", "a", 1, None)]
    folder = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None), (None, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    labels = [(i, int(i % 3 > 0), 0) for i in range(0, 80)] + [(None, 1, 0), (111, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def read(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_quality_stage(spark, fixture):
    docs, labels = read(spark, fixture, "documents"), read(spark, fixture, "labels")
    kept = corpus_pipeline.keep_good(spark, docs, fixture)
    scores = quality.score(docs, quality.fit(docs, labels, ~held_out("doc_id", 4, 2)))
    want = rows_of(scores.where("score >= 0.7").select(docs.columns))
    assert kept.columns == docs.columns and rows_of(kept) == want
    good = {r.doc_id for r in kept.collect()}
    assert good >= {i for i in range(80) if i % 3} and not good & {i for i in range(80) if i % 3 == 0}


def test_copies_stage(spark, fixture):
    docs = read(spark, fixture, "documents")
    rows = rows_of(docs)
    groups = plain_groups([r[:2] for r in rows])
    classes = {key: found[0] for key, found in groups.items()}

    def stays(row):
        key = row[0], frozenset(shingles(row[1] or ""))
        return row[0] is None or classes.get(key, row[0]) == row[0]

    kept = corpus_pipeline.keep_one_of_each(spark, docs, fixture)
    assert kept.columns == docs.columns and rows_of(kept) == [r for r in rows if stays(r)]
    assert len([r for r in rows if stays(r)]) == len(rows) - 4
    assert any(r.doc_id == 2 and r.extra == "second text" for r in kept.collect())


def test_passages_stage(spark, fixture):
    docs = read(spark, fixture, "documents").where("doc_id IS NOT NULL")
    cut = corpus_pipeline.cut_repeats(spark, docs, fixture)
    assert cut.columns == docs.columns
    left = {(i, n - gone) for i, n, gone, _ in plain_removed([(r.doc_id, r.text) for r in docs.collect()])}
    got = cut.collect()
    assert {(r.doc_id, len((r.text or "").encode())) for r in got} == left and len(got) == docs.count()
    assert all(r.text is None for r in got if r.doc_id == 111)


def test_leaks_stage(spark, fixture):
    docs = read(spark, fixture, "documents")
    (item,) = {r.text for r in read(spark, fixture, "benchmark").collect() if r.text}
    body = np.frombuffer(item.encode(), np.uint8)

    def leaky(row):
        if row[0] is None or not row[1]:
            return False
        found, _ = decontaminate.fitting_distance(body, np.frombuffer(row[1].encode(), np.uint8))
        return found <= decontaminate.edits(len(body), decontaminate.SIMILARITY)

    rows = rows_of(docs)
    kept = corpus_pipeline.drop_leaks(spark, docs, fixture)
    assert kept.columns == docs.columns and rows_of(kept) == [r for r in rows if not leaky(r)]
    assert sum(map(leaky, rows)) >= 4


def test_the_whole_pipeline(spark, fixture):
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
    got = corpus_pipeline.run(spark, fixture)
    # What each stage is tested to drop is gone, and what is good, single and clean is there.
    ids = {r.doc_id for r in got.collect()}
    # Of the documents with the benchmark item, the later ones had it cut as a repeat before.
    assert {2, 4, 5, 8, 67} <= ids and not ids & {0, 3, 7, 101, 102, 104, 110}
    sources = defaultdict(list)
    for r in got.collect():
        assert r.size == len((r.text or "").split()) and 0 <= r.taken <= 3 * r.size
        sources[r.source].append(r)
    for rows in sources.values():
        assert {r.source_size for r in rows} == {sum(r.size for r in rows)}
        assert abs(sum(r.taken for r in rows) - rows[0].target) <= 16 * (1 + len(rows))


def test_an_empty_corpus(spark, fixture, tmp_path):
    for name in ("documents", "benchmark", "labels"):
        read(spark, fixture, name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    docs = read(spark, fixture, "documents").withColumn("doc_id", F.lit(None).cast("long"))
    assert corpus_pipeline.keep_one_of_each(spark, docs, fixture).count() == docs.count()
