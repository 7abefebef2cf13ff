"""Dataset profiles as relations, each computed by distributed aggregates.

The mode comes from distributed value counts and the median from a selection between
two quantiles of a sketch: the built-in exact aggregates keep every distinct value of a
column in one task.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, FloatType, StringType

from trackloom.operators.ordering import with_running_total

# The features that are profiled where a dataset has them.
PROFILE_FEATURES = [
    "danceability",
    "energy",
    "loudness",
    "speechiness",
    "acousticness",
    "instrumentalness",
    "liveness",
    "valence",
    "tempo",
]

# The sketch's ranks are off by less than this part of the rows.
SKETCH = 10_000


def available_features(df: DataFrame, features: list[str] = PROFILE_FEATURES) -> list[str]:
    return [f for f in features if f in df.columns]


def _missing(df: DataFrame, name: str) -> Column:
    test = F.col(name).isNull()
    return test | F.isnan(name) if isinstance(df.schema[name].dataType, (DoubleType, FloatType)) else test


def _present(name: str) -> Column:
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value)


def _rows(structs: list[Column]) -> Column:
    return F.inline(F.array(*structs))


def shape(datasets: dict[str, DataFrame]) -> DataFrame:
    """dataset, n_rows, n_columns."""
    parts = [
        df.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("dataset"), "n_rows", F.lit(len(df.columns)).alias("n_columns")
        )
        for name, df in datasets.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def schema(spark: SparkSession, datasets: dict[str, DataFrame]) -> DataFrame:
    """dataset, position, column, type: metadata only, no job."""
    rows = [
        (name, i, field.name, field.dataType.simpleString())
        for name, df in datasets.items()
        for i, field in enumerate(df.schema.fields)
    ]
    return spark.createDataFrame(rows, "dataset string, position int, column string, type string")


def missing(df: DataFrame) -> DataFrame:
    """column, n_missing, pct of the columns that lack values, worst first. One pass."""
    counts = df.agg(
        F.count("*").alias("_all"), *[F.count_if(_missing(df, c)).alias(c) for c in df.columns]
    )
    rows = counts.select(
        "_all", _rows([F.struct(F.lit(c).alias("column"), F.col(c).alias("n_missing")) for c in df.columns])
    )
    return (
        rows.filter(F.col("n_missing") > 0)
        .select("column", "n_missing", (F.col("n_missing") * 100.0 / F.col("_all")).alias("pct"))
        .orderBy(F.col("pct").desc(), F.col("column").asc())
    )


def _comparable(df: DataFrame, name: str) -> Column:
    """The value itself, of texts the SHA-256: no row of the grouping holds a text."""
    if isinstance(df.schema[name].dataType, (StringType, BinaryType)):
        return F.unhex(F.sha2(F.col(name).cast("binary"), 256)).alias(name)
    return F.col(name)


def duplicates(df: DataFrame) -> DataFrame:
    """n_rows, n_duplicates, pct: rows beyond the first of each group of equal rows."""
    groups = df.select(*[_comparable(df, c) for c in df.columns]).groupBy(*df.columns).agg(
        F.count("*").alias("_copies")
    )
    totals = groups.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("n_duplicates"),
    )
    pct = F.coalesce(F.try_divide(F.col("n_duplicates") * 100.0, F.col("n_rows")), F.lit(0.0))
    return totals.withColumn("pct", pct)


def _long(df: DataFrame, features: list[str]) -> DataFrame:
    """feature, value: one row per present value."""
    long = df.select(*[_present(f).alias(f) for f in features]).unpivot([], features, "feature", "value")
    return long.filter(F.col("value").isNotNull())


def _bracket(share: float) -> Column:
    """The shares between which a quantile sketch brackets the middle ranks."""
    return F.lit([0.5 - share, 0.5 + share])


def _middle(df: DataFrame, open_: dict[str, tuple[float, float, int, int]]) -> dict[str, float]:
    """Exact medians by selection: ``open_`` has for each feature the bracket, the values below it and all values.

    Only values inside the brackets are counted and sorted.
    """
    inside = [
        F.struct(F.lit(f).alias("feature"), F.when(_present(f).between(low, high), _present(f)).alias("value"))
        for f, (low, high, _, _) in open_.items()
    ]
    counts = df.select(_rows(inside)).filter(F.col("value").isNotNull()).groupBy("feature", "value").agg(F.count("*").alias("n"))
    placed = with_running_total(counts, ["feature", "value"], "n", "reached")
    start = placed.groupBy("feature").agg(F.min(F.col("reached") - F.col("n")).alias("start"))
    # One row per feature.
    wanted = df.sparkSession.createDataFrame(
        [(f, (n - 1) // 2 - below, n // 2 - below) for f, (_, _, below, n) in open_.items()], "feature string, low bigint, high bigint"
    )
    before = F.col("reached") - F.col("n") - F.col("start")

    def holds(position: str) -> Column:
        return (before <= F.col(position)) & (F.col(position) < before + F.col("n"))

    found = (
        placed.join(F.broadcast(start.join(wanted, "feature")), "feature")
        .groupBy("feature")
        .agg(F.min(F.when(holds("low"), F.col("value"))).alias("a"), F.min(F.when(holds("high"), F.col("value"))).alias("b"))
    )
    return {row["feature"]: (row["a"] + row["b"]) / 2 for row in found.collect()}


def statistics(df: DataFrame, features: list[str]) -> DataFrame:
    """feature, mean, mode, median, std, min, max; missing values are left out.

    Two passes and, for the medians, a selection: the first pass takes moments and a quantile sketch
    that brackets the middle ranks, the second counts values for the mode and how many lie
    below and inside the bracket; only those inside are sorted. A bracket that turns out to miss
    the middle is widened. The driver sees a few numbers per feature.
    """
    present = df.select(*[_present(f).alias(f) for f in features])
    basics = present.agg(
        *[
            F.struct(
                F.count(f).alias("n"),
                F.avg(f).alias("mean"),
                F.stddev_samp(f).alias("std"),
                F.min(f).alias("min"),
                F.max(f).alias("max"),
                F.percentile_approx(f, _bracket(2 / SKETCH), SKETCH).alias("bracket"),
            ).alias(f)
            for f in features
        ]
    ).first()
    brackets = {f: tuple(basics[f]["bracket"]) for f in features if basics[f]["n"]}
    columns = "feature string, mean double, mode double, median double, std double, min double, max double"
    if not brackets:
        return df.sparkSession.createDataFrame([(f, *[None] * 6) for f in features], columns)

    def sided(f: str) -> Column:
        low, high = brackets[f]
        side = F.when(F.col(f) < low, -1).when(F.col(f) > high, 1).otherwise(0)
        return F.struct(F.lit(f).alias("feature"), F.col(f).alias("value"), side.alias("side"))

    counts = present.select(_rows([sided(f) for f in brackets])).filter(F.col("value").isNotNull())
    counts = counts.groupBy("feature", "value", "side").agg(F.count("*").alias("n"))
    rarest = F.min(F.struct((-F.col("n")).alias("rarity"), "value"))
    held = counts.groupBy("feature").agg(
        rarest["value"].alias("mode"),
        F.sum(F.when(F.col("side") < 0, F.col("n")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("side") == 0, F.col("n")).otherwise(0)).alias("inside"),
    )
    seen = {row["feature"]: row for row in held.collect()}
    medians, open_ = {}, {}
    for f, (low, high) in brackets.items():
        n, below = basics[f]["n"], seen[f]["below"]
        if not below <= (n - 1) // 2 <= n // 2 < below + seen[f]["inside"]:
            low, high, below = basics[f]["min"], basics[f]["max"], 0
        if low == high:
            medians[f] = low
        else:
            open_[f] = (low, high, below, n)
    medians |= _middle(df, open_) if open_ else {}
    rows = []
    for f in features:
        b = basics[f]
        rows.append((f, b["mean"], seen[f]["mode"] if f in seen else None, medians.get(f), b["std"], b["min"], b["max"]))
    return df.sparkSession.createDataFrame(rows, columns)


def histogram(df: DataFrame, features: list[str], bins: int = 50) -> DataFrame:
    """feature, bin, lower, upper, n: equal-width bins over [min, max], the last one closed.

    A constant feature is spread over a range of width one around its value.
    """
    bounds = df.select(*[_present(f).alias(f) for f in features]).agg(
        *[
            F.struct(F.lit(f).alias("feature"), F.min(f).alias("low"), F.max(f).alias("high")).alias(f)
            for f in features
        ]
    )
    pad = F.when(F.col("low") == F.col("high"), F.lit(0.5)).otherwise(F.lit(0.0))
    ranges = (
        bounds.select(_rows([F.col(f) for f in features]))
        .filter(F.col("low").isNotNull())
        .withColumns({"low": F.col("low") - pad, "high": F.col("high") + pad})
    )

    def edge(number: Column) -> Column:
        return F.col("low") + number * ((F.col("high") - F.col("low")) / bins)

    # One row per feature. The division can land one bin off at an edge, so the
    # edges themselves decide.
    scale = F.lit(float(bins)) / (F.col("high") - F.col("low"))
    guess = F.least(F.floor((F.col("value") - F.col("low")) * scale), F.lit(bins - 1))
    counts = (
        _long(df, features)
        .join(F.broadcast(ranges), "feature")
        .withColumn("bin", guess)
        .withColumn("under", F.col("value") < edge(F.col("bin")))
        .withColumn("over", (F.col("bin") < bins - 1) & (F.col("value") >= edge(F.col("bin") + 1)))
        .groupBy("feature", (F.col("bin") - F.col("under").cast("int") + F.col("over").cast("int")).alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    frame = ranges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return frame.join(counts.withColumn("bin", F.col("bin").cast("int")), ["feature", "bin"], "left").select(
        "feature",
        "bin",
        edge(F.col("bin")).alias("lower"),
        edge(F.col("bin") + 1).alias("upper"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def correlations(df: DataFrame, features: list[str]) -> DataFrame:
    """feature_a, feature_b, corr for each pair: Pearson, rows missing either value left out. One pass."""
    pairs = list(combinations(features, 2))
    row = df.select(*[_present(f).alias(f) for f in features]).agg(
        *[
            F.struct(F.lit(b).alias("feature_a"), F.lit(a).alias("feature_b"), F.corr(a, b).alias("corr")).alias(f"_{i}")
            for i, (a, b) in enumerate(pairs)
        ]
    )
    return row.select(_rows([F.col(f"_{i}") for i in range(len(pairs))]))


def profile(datasets: dict[str, DataFrame], features: list[str] = PROFILE_FEATURES) -> DataFrame:
    """dataset, subject, measure, value: the profile of several datasets in one relation.

    The subject is a column, or empty for the dataset itself. Each dataset gives n_rows,
    n_columns and n_duplicates, n_missing of the columns that lack values, and the
    statistics of those ``features`` it has. Its column types are in :func:`schema`.
    """

    def long(df: DataFrame, name: str, subject: Column, measures: list[str]) -> DataFrame:
        rows = [F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in measures]
        return df.select(F.lit(name).alias("dataset"), subject.alias("subject"), _rows(rows))

    parts = []
    for name, df in datasets.items():
        parts.append(long(shape({name: df}), name, F.lit(""), ["n_rows", "n_columns"]))
        parts.append(long(duplicates(df), name, F.lit(""), ["n_duplicates"]))
        parts.append(long(missing(df), name, F.col("column"), ["n_missing"]))
        if found := available_features(df, features):
            measures = ["mean", "mode", "median", "std", "min", "max"]
            parts.append(long(statistics(df, found), name, F.col("feature"), measures))
    return reduce(DataFrame.unionByName, parts)
