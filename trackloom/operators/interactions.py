"""User-item records to implicit feedback with dense integer ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom.functions import names
from trackloom.operators.dedupe import top_per_group
from trackloom.operators.ordering import dense_ids


def count_interactions(df: DataFrame, keys: list[str], output: str = "play_count") -> DataFrame:
    """How many rows each key combination has; repeated rows count."""
    return df.groupBy(*keys).agg(F.count("*").alias(output))


def encode_ids(counts: DataFrame) -> DataFrame:
    """Replace user and (track, artist) by dense ids and keep the names.

    ``counts`` has user_id, trackname, artistname and play_count, and is read
    three times: hand in a stored relation. Songs are numbered in the order of
    their display key; two songs whose keys coincide still get two ids.
    """
    keyed = counts.withColumn("track_key", names.song_key(F.col("trackname"), F.col("artistname")))
    users = dense_ids(counts, ["user_id"], "user_code")
    songs = dense_ids(keyed, ["track_key", "trackname", "artistname"], "song_code").drop("track_key")
    return (
        counts.join(users, "user_id")
        .join(songs, ["trackname", "artistname"])
        .select(
            F.col("user_code").alias("user_id"),
            F.col("song_code").alias("song_id"),
            F.col("play_count").cast("double").alias("interaction"),
            F.col("user_id").alias("user_id_original"),
            F.col("trackname").alias("track_name"),
            F.col("artistname").alias("artist_name"),
        )
    )


def distinct_ids(interactions: DataFrame, column: str) -> DataFrame:
    return interactions.select(column).distinct()


def user_history(interactions: DataFrame, n: int = 15, users: DataFrame | None = None) -> DataFrame:
    """Each user's ``n`` most played songs, most played first; only ``users`` when given."""
    if users is not None:
        interactions = interactions.join(users.select("user_id").distinct(), "user_id", "left_semi")
    order = [F.col("interaction").desc(), F.col("song_id").asc()]
    return top_per_group(interactions, ["user_id"], order, n, rank="rk")
