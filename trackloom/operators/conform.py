"""One catalogue schema for sources whose columns differ."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The audio features and the schema every source is brought to.
AUDIO_FEATURES = [
    "danceability",
    "energy",
    "speechiness",
    "acousticness",
    "instrumentalness",
    "liveness",
    "valence",
    "tempo",
]
TARGET_TYPES = {
    "track_id": "string",
    "track_name": "string",
    "artist_name": "string",
    "duration_ms": "double",
    **dict.fromkeys(AUDIO_FEATURES, "double"),
}


def conform(df: DataFrame, mapping: dict[str, str], target: dict[str, str] = TARGET_TYPES) -> DataFrame:
    """Project ``df`` onto ``target``; ``mapping`` is target name -> source name.

    A value that does not fit its type becomes NULL, an unmapped column is a typed NULL.
    """

    known = df.select([df[source].alias(name) for name, source in mapping.items() if name in target])
    absent = {name: F.lit(None) for name in target.keys() - mapping.keys()}
    return known.withColumns(absent).select([F.col(name).try_cast(kind).alias(name) for name, kind in target.items()])


def left_enrich(base: DataFrame, details: DataFrame, base_key: str, details_key: str) -> DataFrame:
    """Every row of ``base`` with the columns of ``details``, NULL where the key is unknown."""
    return base.join(details.withColumnRenamed(details_key, base_key), base_key, "left")


def stack_sources(sources: list[DataFrame], rank_column: str = "source_rank") -> DataFrame:
    """Union by name; ``rank_column`` holds the position of the source in the list."""
    ranked = [df.withColumn(rank_column, F.lit(i)) for i, df in enumerate(sources)]
    return reduce(DataFrame.unionByName, ranked)
