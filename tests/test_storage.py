"""Scratch, replaced tables, packed record files and fitted preparations."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackloom.operators import evaluate, factors, profile, scale
from trackloom.session import expire_scratch, materialize, run_scope, scratch_path, shared_folder
from trackloom.sinks import tables as sinks
from trackloom.sources import packed, records


def files_below(path):
    return [os.path.join(d, f) for d, _, names in os.walk(path) for f in names]


def test_a_run_removes_its_scratch(spark):
    before = set(files_below(shared_folder(spark)))
    with run_scope(spark) as outer:
        first = materialize(spark.range(10), "a")
        with run_scope(spark) as inner:
            materialize(first, "b")
            assert scratch_path(spark, "x").startswith(inner) and files_below(inner)
        assert not files_below(inner) and first.count() == 10 and files_below(outer)
    assert set(files_below(shared_folder(spark))) == before
    assert not scratch_path(spark, "x").startswith(outer)
    with pytest.raises(ZeroDivisionError), run_scope(spark):
        materialize(spark.range(3), "c")
        1 / 0
    assert set(files_below(shared_folder(spark))) == before


def test_old_scratch_expires(spark, tmp_path, monkeypatch):
    import trackloom.session as session

    monkeypatch.setattr(session, "shared_folder", lambda _: str(tmp_path))
    assert expire_scratch(spark, 0) == 0
    materialize(spark.range(3), "old")
    assert expire_scratch(spark, 3600) == 0 and files_below(tmp_path)
    assert expire_scratch(spark, -5) == 1 and not files_below(tmp_path)


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_parquet(spark.range(5), path)
    broken = spark.range(9).withColumn("id", F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("no"))))
    with pytest.raises(Exception, match="no"):
        sinks.write_parquet(broken, path)
    assert spark.read.parquet(path).count() == 5 and os.listdir(tmp_path) == ["t"]
    table = spark.read.parquet(path)
    sinks.write_parquet(table.union(table), path)  # from itself
    assert spark.read.parquet(path).count() == 10 and os.listdir(tmp_path) == ["t"]


def test_only_partitions_with_rows_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    parts = spark.range(30).withColumn("p", F.col("id") % 3)
    sinks.write_partitions(parts, path, ("p",))
    sinks.write_partitions(spark.range(2).withColumn("p", F.lit(1).cast("long")), path, ("p",))
    counts = {r.p: r["count"] for r in spark.read.parquet(path).groupBy("p").count().collect()}
    assert counts == {0: 10, 1: 2, 2: 10}


TRACK = dict(zip(packed.TEXTS + packed.NUMBERS, ["T1", "  Náme ", "", 60.0, 1.5, None, float("inf"), 0.0, -2.0]))


def test_binary_layout():
    content = packed.encode_track(TRACK)
    back = packed.decode_track(content)
    assert back["track_name"] == "  Náme " and back["tempo"] == 1.5 and np.isnan(back["loudness"])
    for bad in (b"", b"TRK2" + content[4:], content[:9], content[:-1], content + b"x"):
        with pytest.raises(Exception):
            packed.decode_track(bad)


def test_packed_files_are_read_where_they_are_decoded(spark, tmp_path):
    folder = str(tmp_path / "in")
    rows = [(f"{i % 3}/{i}.trk", packed.encode_track(TRACK | {"track_id": f"T{i}"})[: 20 if i == 7 else None]) for i in range(40)]
    packed.write_records(spark.createDataFrame(rows, "name string, content binary").repartition(5), folder)
    assert len(files_below(folder)) == 40 and os.listdir(tmp_path) == ["in"]
    (tmp_path / "in" / "other.txt").write_text("x")
    df = packed.read_records(spark, folder, packed.decode_track, records.RECORD_SCHEMA.fieldNames(), "*.trk", partition_bytes=8 << 20)
    assert df.rdd.getNumPartitions() == 6  # forty files that count as a megabyte each, eight a task
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    typed = records.typed_records(df).collect()
    good = [r for r in typed if r.error is None]
    assert len(good) == 39 and {r.track_id for r in good} == {f"T{i}" for i in range(40) if i != 7}
    assert good[0].artist_name is None and good[0].loudness is None and good[0].artist_familiarity is None
    (bad,) = (r for r in typed if r.error)
    assert bad.path.endswith("1/7.trk") and "cut short" in bad.error
    texts = packed.read_texts(spark, folder, "*.txt").collect()
    assert [(r.content, r.error) for r in texts] == [("x", None)]


def test_packing_by_size():
    files = [(f"f{i}", size) for i, size in enumerate([900, 10, 10, 10, 500, 400, 20])]
    parts = packed.packed(files, 1000, opening=0)
    assert sorted(p for part in parts for p in part) == [f for f, _ in files]
    loads = [sum(dict(files)[p] for p in part) for part in parts]
    assert len(parts) == 2 and max(loads) <= 950
    assert packed.packed([], 1000) == []


def test_a_failed_sink_leaves_nothing(spark, tmp_path):
    bad = spark.createDataFrame([("a", b"1"), (None, b"2")], "name string, content binary").coalesce(1)
    with pytest.raises(Exception):
        packed.write_records(bad, str(tmp_path / "out"))
    assert files_below(tmp_path) == []


@pytest.mark.parametrize("outside,want", [("clip", [0.0, 1.0, 0.5, 0.5]), ("null", [None, None, 0.5, 0.5]), ("keep", [-0.5, 1.5, 0.5, 0.5])])
def test_a_stored_preparation_meets_other_rows(spark, tmp_path, outside, want):
    fit = spark.createDataFrame([(0.0, 7), (10.0, 7), (None, 7), (float("nan"), 7)], "a double, c int")
    scale.save_preparation(scale.fit_preparation(fit, ["a", "c"]), str(tmp_path / "m"))
    other = spark.createDataFrame([(0, -5.0, 7), (1, 15.0, 9), (2, None, 7), (3, float("nan"), None)], "i int, a double, c int")
    got = scale.apply_preparation(scale.load_preparation(str(tmp_path / "m")), other, ["a", "c"], outside).orderBy("i")
    assert got.columns == ["i", "a", "c"]
    assert [r.a for r in got.collect()] == want and {r.c for r in got.collect()} == {0.5}
    with pytest.raises(ValueError):
        scale.apply_preparation(None, other, ["a"], "no")


def test_residuals_tell_a_solution_from_another(spark):
    draw = np.random.default_rng(1)
    plays = [(u, i, float(draw.integers(1, 4))) for u in range(60) for i in draw.choice(40, 6, replace=False).tolist()]
    train = spark.createDataFrame(plays, "user_id int, song_id int, interaction double")
    model = factors.fit_als(train, 4, rank=5, alpha=3.0)
    found = factors.user_residuals(model.userFactors, model.itemFactors, train, alpha=3.0)
    assert found.count() == 60 and found.agg(F.max("residual")).first()[0] < 1e-4
    for wrong in (
        factors.user_residuals(model.userFactors, model.itemFactors, train, alpha=1.0),
        factors.user_residuals(model.userFactors.withColumn("features", F.reverse("features")), model.itemFactors, train, alpha=3.0),
    ):
        assert wrong.agg(F.min("residual")).first()[0] > 1e-3


def test_bundles_give_the_metrics_again(spark, tmp_path):
    users = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.5, 0.5])], "id int, features array<float>")
    items = spark.createDataFrame([(i, [float(i % 4), 1.0]) for i in range(9)], "id int, features array<float>")
    rows = [(u, s, d, c) for u in (1, 2, 3) for s in (4, 7, 30) for d, c in enumerate([s, 0, 1, 2, 3, 5, 6, 8])]
    candidates = spark.createDataFrame(rows, "user_id int, song_id int, draw int, candidate int")
    evaluate.write_bundle(str(tmp_path / "b"), users, items, candidates)
    for k in (1, 3, 10):
        want = evaluate.evaluate_factors(users, items, candidates, k).first()
        assert tuple(evaluate.bundle_metrics(spark, str(tmp_path / "b"), k).first()) == pytest.approx(tuple(want))


@pytest.mark.parametrize("values", [
    [1.0], [2.0, 1.0], [5.0, 1.0, 3.0], [1.0, 1.0, 1.0, 9.0], list(range(1000)), [0.0] * 700 + list(range(300)),
    [1e300, -1e300, 0.0, 5.0], [None, float("nan"), 4.0, 8.0], [None, float("nan")], [],
])
def test_selected_medians(spark, values, monkeypatch):
    import statistics as plain

    rows = [(None if v is None else float(v),) for v in values]
    df = spark.createDataFrame(rows, "x double").repartition(3)
    clean = sorted(v for (v,) in rows if v is not None and v == v)
    for sketch in (10_000, 7):  # a coarse sketch brackets more, or misses and is widened
        monkeypatch.setattr(profile, "SKETCH", sketch)
        (row,) = profile.statistics(df, ["x"]).collect()
        assert row.median == (plain.median(clean) if clean else None)
        assert row["mode"] == (min(clean, key=lambda v: (-clean.count(v), v)) if clean else None)
