"""Profiles against pandas and numpy."""

import numpy as np
import pandas as pd
import pytest

from trackloom.operators import profile

FEATURES = ["tempo", "energy", "loudness"]


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame(
        {
            "tempo": rng.integers(0, 7, 501).astype(float),
            "energy": rng.random(501),
            "loudness": np.full(501, 2.5),
        }
    )
    pdf.loc[::10, "tempo"] = np.nan
    pdf.loc[::7, "energy"] = np.nan
    return pdf


@pytest.fixture(scope="module")
def df(spark, frame):
    return spark.createDataFrame(frame).repartition(5)


def test_statistics(df, frame):
    got = {r.feature: r for r in profile.statistics(df, FEATURES).collect()}
    for f in FEATURES:
        data = frame[f].dropna()
        want = (data.mean(), data.mode()[0], data.median(), data.std(), data.min(), data.max())
        assert tuple(got[f])[1:] == pytest.approx(want)


def test_histogram(df, frame):
    rows = profile.histogram(df, FEATURES).collect()
    for f in FEATURES:
        counts, edges = np.histogram(frame[f].dropna(), bins=50)
        part = sorted((r for r in rows if r.feature == f), key=lambda r: r.bin)
        assert [r.n for r in part] == list(counts)
        assert [r.lower for r in part] == pytest.approx(list(edges[:-1]))
        assert part[-1].upper == pytest.approx(edges[-1])


def test_correlations(df, frame):
    got = {(r.feature_a, r.feature_b): r["corr"] for r in profile.correlations(df, ["tempo", "energy"]).collect()}
    assert got == {("energy", "tempo"): pytest.approx(frame["energy"].corr(frame["tempo"]))}


def test_missing(df, frame):
    got = [tuple(r) for r in profile.missing(df).collect()]
    share = (frame.isnull().sum() / len(frame) * 100).sort_values(ascending=False)
    want = [(c, frame[c].isnull().sum(), pytest.approx(p)) for c, p in share.items() if p > 0]
    assert got == want


def test_duplicates(spark):
    long = "x" * 100
    rows = [(1, "a"), (1, "a"), (1, None), (1, None), (None, None), (1, long), (1, long), (1, long + "y"), (1, "x" * 64)]
    row = profile.duplicates(spark.createDataFrame(rows, "a int, t string")).first()
    assert (row.n_rows, row.n_duplicates, row.pct) == (9, 3, pytest.approx(100 / 3))
    empty = profile.duplicates(spark.createDataFrame([], "a int, t string")).first()
    assert tuple(empty) == (0, 0, 0.0)


def test_shape_schema_and_features(spark, df):
    assert [tuple(r) for r in profile.shape({"d": df}).collect()] == [("d", 501, 3)]
    assert [r.type for r in profile.schema(spark, {"d": df}).collect()] == ["double"] * 3
    assert profile.available_features(df) == ["energy", "loudness", "tempo"]
