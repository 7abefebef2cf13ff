"""Mean imputation and min-max scaling.

The statistics are one aggregate row that reaches the projection as a scalar
subquery: no join, no broadcast, no value on the Python side, and all columns in
one pass.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, ImputerModel, MinMaxScaler, MinMaxScalerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_STATS = "_stats"


def _with_stats(df: DataFrame, stats: DataFrame) -> DataFrame:
    return df.withColumn(_STATS, stats.scalar())


def _valid(name: str) -> Column:
    return F.when(~F.isnan(F.col(name)), F.col(name))


def impute_mean(df: DataFrame, columns: list[str], flags: bool = False) -> DataFrame:
    """Replace NULL and NaN by the mean of the other values of the column.

    With ``flags`` a ``<column>_was_null`` column keeps what was missing. A column
    without any value stays NULL.
    """
    stats = df.agg(F.struct(*[F.avg(_valid(c)).alias(c) for c in columns]).alias(_STATS))
    extra = {f"{c}_was_null": _valid(c).isNull() for c in columns} if flags else {}
    filled = {c: F.coalesce(_valid(c), F.col(_STATS)[c]) for c in columns}
    return _with_stats(df, stats).withColumns(extra | filled).drop(_STATS)


def scale_minmax(df: DataFrame, columns: list[str]) -> DataFrame:
    """Scale each column to [0, 1] by its own minimum and maximum; a constant column gives 0.5."""
    bounds = [F.struct(F.min(c).alias("low"), F.max(c).alias("high")).alias(c) for c in columns]
    stats = df.agg(F.struct(*bounds).alias(_STATS))

    def scaled(name: str) -> Column:
        low, high = F.col(_STATS)[name]["low"], F.col(_STATS)[name]["high"]
        return (
            F.when(F.col(name).isNull(), None)
            .when(low == high, F.lit(0.5))
            .otherwise(F.try_divide(F.col(name) - low, high - low))
        )

    return _with_stats(df, stats).withColumns({c: scaled(c) for c in columns}).drop(_STATS)


def fit_imputer(df: DataFrame, columns: list[str]) -> ImputerModel:
    """The MLlib imputer, for jobs that keep a fitted model."""
    return Imputer(strategy="mean", inputCols=columns, outputCols=columns).fit(df)


def fit_scaler(df: DataFrame, columns: list[str]) -> MinMaxScalerModel:
    """The MLlib scaler, for jobs that keep a fitted model. NULL features are an error."""
    return MinMaxScaler(inputCol="_vector", outputCol="_scaled").fit(assemble(df, columns))


def assemble(df: DataFrame, columns: list[str], output: str = "_vector") -> DataFrame:
    return VectorAssembler(inputCols=columns, outputCol=output).transform(df)


def apply_scaler(model: MinMaxScalerModel, df: DataFrame, columns: list[str]) -> DataFrame:
    """Scale with a fitted model and unpack the vector into the named columns at once."""
    scaled = model.transform(assemble(df, columns, model.getInputCol()))
    array = vector_to_array(F.col(model.getOutputCol()))
    unpacked = scaled.withColumns({c: array[i] for i, c in enumerate(columns)})
    return unpacked.drop(model.getInputCol(), model.getOutputCol())


def fit_preparation(df: DataFrame, columns: list[str]) -> PipelineModel:
    """Mean imputation and min-max scaling of ``columns`` as one fitted, storable model.

    NULL and NaN take no part in the fit; a column without any value is an error.
    """
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    filled = [f"_filled_{c}" for c in columns]
    stages = [
        Imputer(strategy="mean", inputCols=columns, outputCols=filled),
        VectorAssembler(inputCols=filled, outputCol="_vector"),
        MinMaxScaler(inputCol="_vector", outputCol="_scaled"),
    ]
    return Pipeline(stages=stages).fit(numbers)


def save_preparation(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_preparation(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def apply_preparation(model: PipelineModel, df: DataFrame, columns: list[str], outside: str = "clip") -> DataFrame:
    """``df`` with ``columns`` imputed and scaled by a model fitted on other rows.

    Values beyond the fitted range are moved to its ends (``clip``), become NULL (``null``) or
    go beyond 0 and 1 (``keep``).
    """
    if outside not in ("clip", "null", "keep"):
        raise ValueError(f"unknown policy {outside!r}")
    numbers = df.withColumns({c: F.col(c).cast("double") for c in columns})
    scaled = model.transform(numbers).withColumn("_unit", vector_to_array(F.col("_scaled")))

    def unit(i: int) -> Column:
        value = F.col("_unit")[i]
        if outside == "clip":
            return F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0))
        return F.when(value.between(0.0, 1.0), value) if outside == "null" else value

    done = scaled.withColumns({c: unit(i) for i, c in enumerate(columns)})
    return done.drop("_vector", "_scaled", "_unit", *[f"_filled_{c}" for c in columns])
