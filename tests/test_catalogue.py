"""Hand cases of the catalogue and record lanes, and MLlib against the SQL forms."""

import json
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType, StructField, StructType

from trackloom.functions import names, values
from trackloom.operators import clean, conform, dedupe, report, scale
from trackloom.operators.conform import AUDIO_FEATURES, TARGET_TYPES
from trackloom.plans import catalogue, records
from trackloom.plans.catalogue import Source
from trackloom.sinks import tables as sinks
from trackloom.sources import records as record_source
from trackloom.sources import tables

FEATURE_VALUES = [0.1] * len(AUDIO_FEATURES)
TARGET_DDL = ", ".join(f"{n} {t}" for n, t in TARGET_TYPES.items())


def songs(spark, rows):
    return spark.createDataFrame([(*row, *FEATURE_VALUES) for row in rows], TARGET_DDL)


def test_conform_casts_and_fills(spark):
    raw = spark.createDataFrame([("1", "abc", "5.5"), (None, "7", "x")], "key string, ms string, t string")
    out = conform.conform(raw, {"track_id": "key", "duration_ms": "ms", "tempo": "t"})
    assert out.columns == list(TARGET_TYPES)
    assert [(r.track_id, r.duration_ms, r.tempo, r.artist_name) for r in out.collect()] == [
        ("1", None, 5.5, None),
        (None, 7.0, None, None),
    ]


def test_best_record_prefers_artist_then_completeness_then_source(spark):
    a = songs(spark, [("1", "n", None, 5.0), ("2", "n", "x", None), ("3", "n", "x", 5.0)])
    b = songs(spark, [("1", None, "y", None), ("2", "n", "y", 5.0), ("3", "n", "y", 5.0)])
    best = dedupe.best_record(conform.stack_sources([a, b]))
    assert {r.track_id: r.artist_name for r in best.collect()} == {"1": "y", "2": "y", "3": "x"}


def test_null_ids_count_as_one_track(spark):
    rows = conform.stack_sources([songs(spark, [(None, "a", "x", 1.0), (None, "b", "x", 1.0), ("1", "c", "x", 1.0)])])
    assert dedupe.best_record(rows).count() == 2


def test_same_title_without_artist_collapses(spark):
    rows = songs(spark, [("2", "a", None, 1.0), ("1", "a", None, 1.0), ("3", "A", None, 1.0)])
    kept = dedupe.dedupe(rows, ["track_name", "artist_name"], ["track_id"])
    assert sorted(r.track_id for r in kept.collect()) == ["1", "3"]


def test_unknown_artist(spark):
    df = spark.createDataFrame([(None,), ("",), (" ",), ("  ",), (" Bob ",)], "artist_name string")
    out = df.select(names.normalized(names.or_unknown(F.col("artist_name"))).alias("a"))
    assert [r.a for r in out.collect()] == ["unknown artist"] * 4 + ["bob"]


def test_duration_bounds_are_inclusive(spark):
    df = spark.createDataFrame([(29_999.0,), (30_000.0,), (900_000.0,), (900_001.0,), (None,)], "d double")
    assert [r.d for r in clean.in_range(df, "d", 30_000, 900_000).collect()] == [30_000.0, 900_000.0]


def test_clean_catalog_names_before_or_after(spark):
    rows = songs(spark, [("1", "Song", "Bob", 40_000.0), ("2", " song", "bob", 40_000.0)])
    assert catalogue.clean_catalog(rows).count() == 2
    assert catalogue.clean_catalog(rows, normalize_first=True).count() == 1


def test_sanitize(spark):
    df = spark.createDataFrame(
        [(" a ", 1.0), ("  ", float("nan")), ("", float("inf")), (None, float("-inf")), ("b", None)], "t string, x double"
    )
    out = clean.sanitize(df, ["t"], ["x"]).collect()
    assert [tuple(r) for r in out] == [("a", 1.0), (None, None), (None, None), (None, None), ("b", None)]


def test_decoded_bytes(spark):
    df = spark.createDataFrame([(bytearray(b" caf\xc3\xa9 "),), (bytearray(b"a\xffb"),), (bytearray(b" "),)], "b binary")
    assert [r.t for r in df.select(names.decoded(F.col("b")).alias("t")).collect()] == ["café", "a�b", None]


NUMBERS = [(1.0, 10.0), (2.0, None), (4.0, float("nan")), (None, 40.0), (9.0, 20.0)]


def test_impute_matches_mllib(spark):
    df = spark.createDataFrame(NUMBERS, "a double, b double").coalesce(1)
    ours = [tuple(r) for r in scale.impute_mean(df, ["a", "b"]).collect()]
    theirs = [tuple(r) for r in scale.fit_imputer(df, ["a", "b"]).transform(df).collect()]
    assert ours == [pytest.approx(t) for t in theirs]


def test_impute_flags_and_empty_column(spark):
    df = spark.createDataFrame([(None, 1.0), (None, None)], "a double, b double")
    out = scale.impute_mean(df, ["a", "b"], flags=True).orderBy("b_was_null").collect()
    assert [(r.a, r.b, r.a_was_null, r.b_was_null) for r in out] == [(None, 1.0, True, False), (None, 1.0, True, True)]


def test_scale_matches_mllib(spark):
    df = spark.createDataFrame([(1.0, 7.0, -3.0), (2.0, 7.0, 8.0), (5.0, 7.0, 0.5)], "a double, c double, b double")
    columns = ["a", "c", "b"]
    ours = [tuple(r) for r in scale.scale_minmax(df, columns).collect()]
    model = scale.fit_scaler(df, columns)
    theirs = scale.apply_scaler(model, df, columns)
    assert theirs.columns == columns
    assert ours == [pytest.approx(tuple(r)) for r in theirs.collect()]
    assert all(r[1] == 0.5 for r in ours)


def test_scale_single_row_and_null(spark):
    df = spark.createDataFrame([(1.0, None)], "a double, b double")
    assert [tuple(r) for r in scale.scale_minmax(df, ["a", "b"]).collect()] == [(0.5, None)]


def test_completeness(spark):
    df = spark.createDataFrame([(1, None, "x"), (None, None, None)], "a int, b int, c string")
    assert [r.n for r in df.select(values.filled_count(["a", "b", "c"]).alias("n")).collect()] == [2, 0]


def test_build_catalog(spark):
    raw = songs(spark, [(str(i), f"Song {i}", "Bob" if i % 2 else "", 30_000.0 + i) for i in range(20)])
    raw = raw.withColumn("tempo", F.col("track_id").cast("double"))
    scaled, report = catalogue.build_catalog([Source(raw, {c: c for c in TARGET_TYPES})])
    rows = scaled.collect()
    assert len(rows) == 20 and {r.artist_name for r in rows} == {"bob", "unknown artist"}
    assert min(r.tempo for r in rows) == 0.0 and max(r.duration for r in rows) == 1.0
    assert all(r.energy == 0.5 for r in rows)
    assert [(r.stage, r.n_rows, r.n_removed) for r in report.orderBy("stage_no").collect()] == [
        ("merged", 20, 0),
        ("cleaned", 20, 0),
    ]


def test_csv_round_trip(spark, tmp_path):
    """Values come back as written; an empty text comes back as NULL, as CSV cannot tell them apart."""
    rows = [("a,b", 'say "hi"', 1.5), ("", "x", None), ("ü", "y", -2.0)]
    df = spark.createDataFrame(rows, "a string, b string, x double")
    sinks.write_csv(df, str(tmp_path / "csv"))
    back = tables.scan_csv(spark, str(tmp_path / "csv"), df.schema)
    assert {tuple(r) for r in back.collect()} == {rows[0], (None, "x", None), rows[2]}


def test_csv_types_can_be_inferred(spark, tmp_path):
    (tmp_path / "in.csv").write_text("a,b,c\n1,x,2.5\n2,,3\n")
    assert tables.scan_csv(spark, str(tmp_path / "in.csv")).dtypes == [("a", "int"), ("b", "string"), ("c", "double")]


def test_playlist_with_and_without_ids(spark, tmp_path):
    (tmp_path / "a.csv").write_text("track_id,track_name,artist_name\n,n,a\n007,m,b\n")
    (tmp_path / "b.csv").write_text("track_name,artist_name\nn,a\n")
    with_ids = tables.scan_playlist(spark, str(tmp_path / "a.csv"))
    assert {r.track_id for r in with_ids.collect()} == {None, "007"}
    assert tables.scan_playlist(spark, str(tmp_path / "b.csv")).columns == ["track_name", "artist_name"]


DIRTY = '''user_id, "artistname", "trackname", "playlistname"
u1, "A, B", "T1", "P"
u2, "A", "T2"
u3, "A", "T3", "P", "more"
u4, "A", "T4", "Q"
u5, "A ""x""", "T5", "Q"
'''


def test_dirty_csv(spark, tmp_path):
    (tmp_path / "in.csv").write_text(DIRTY)
    df = tables.scan_dirty_csv(spark, str(tmp_path / "in.csv"))
    assert df.columns == ["user_id", "artistname", "trackname", "playlistname"]
    assert df.count() == 3
    assert {r.user_id for r in df.select("user_id").distinct().collect()} == {"u1", "u4", "u5"}
    # Doubled quotes are not the escape of these files: the field stays as it is.
    assert {r.artistname for r in df.collect()} == {"A, B", "A", '"A ""x"""'}
    rejects = tables.scan_csv_rejects(spark, str(tmp_path / "in.csv"))
    assert {r[0].split(",")[0] for r in rejects.collect()} == {"u2", "u3"}


def test_record_files(spark, tmp_path):
    good = {"track_id": "T1", "track_name": " A ", "artist_name": "B", "duration": 40, "tempo": "x", "loudness": -1.5}
    for sub, text in (("a/b", json.dumps(good)), ("a/c", "{broken"), ("d", "[1]"), ("e", json.dumps({"track_id": ""}))):
        (tmp_path / sub).mkdir(parents=True)
        (tmp_path / sub / "r.json").write_text(text)
    (tmp_path / "d" / "other.txt").write_text("no record")
    files = record_source.file_manifest(spark, str(tmp_path), "*.json")
    assert files.count() == 4
    rows = record_source.extract_records(files, partitions=3)
    found = {r.track_id: r for r in record_source.good_records(rows).collect()}
    assert set(found) == {"T1", None}
    first = found["T1"]
    assert (first.track_name, first.duration, first.tempo, first.loudness) == ("A", 40.0, None, -1.5)
    assert record_source.rejected_records(rows).count() == 2


def test_records_have_the_types_of_their_schema(spark):
    schema = StructType(
        [StructField("track_id", StringType()), StructField("year", LongType()), StructField("live", BooleanType()), StructField("tempo", DoubleType())]
    )
    good = '{"track_id": "\\t A\\n", "year": 1999, "live": true, "tempo": "7.5", "other": {"x": [1]}}'
    texts = [good, '{"track_id": 5, "year": "soon", "live": "x", "tempo": NaN}', "{}", "", "null", "[{}]", '"a"', "{bad"]
    files = spark.createDataFrame([(i, t.encode()) for i, t in enumerate(texts)], "path int, content binary")
    files = files.union(spark.createDataFrame([(8, None), (9, b'{"track_id": "\xff"}')], files.schema))
    plain = {r.path: r for r in record_source.extract_records(files, schema).collect()}
    coded = {r.path: r for r in record_source.extract_records(files, schema, decode=lambda b: json.loads(b.decode("utf-8", "replace"))).collect()}
    for rows in (plain, coded):
        assert tuple(rows[0])[1:] == ("A", 1999, True, 7.5, None)
        assert tuple(rows[1])[1:] == ("5", None, None, None, None)
        assert tuple(rows[2])[1:] == (None,) * 5 and rows[9].track_id == "\ufffd"
        assert all(rows[i].error and tuple(rows[i])[1:5] == (None,) * 4 for i in range(3, 9))
    none = record_source.extract_records(files.limit(0), schema, decode=json.loads)
    assert none.count() == 0 and none.columns == ["path", *schema.fieldNames(), "error"]


def test_stage_report_follows(spark):
    stages = {"a": spark.range(9), "b": spark.range(4), "c": spark.range(3)}
    found = {r.stage: (r.stage_no, r.n_rows, r.n_removed) for r in report.stage_report(stages, {"c": "a"}).collect()}
    assert found == {"a": (0, 9, 0), "b": (1, 4, 0), "c": (2, 3, 6)}
    assert [r.n_removed for r in report.stage_report(stages).orderBy("stage_no").collect()] == [0, 5, 1]


def test_records_lane_keeps_one_per_name(spark):
    rows = [(f"T{i}", "Same" if i < 5 else f"n{i}", "a", 100.0 + i, None if i % 2 else 1.0 * i) for i in range(12)]
    df = spark.createDataFrame(rows, "track_id string, track_name string, artist_name string, duration double, tempo double")
    df = df.withColumns({c: F.col("tempo") for c in records.RECORD_NUMBERS if c not in df.columns})
    out = records.build_records(df).collect()
    assert len(out) == 8 and all(0.0 <= r.tempo <= 1.0 and not math.isnan(r.tempo) for r in out)
