"""Playlist matching, candidate pools and the content-based blend."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackloom.functions import names, vectors
from trackloom.operators.dedupe import top_per_group
from trackloom.operators.neighbours import DIGITS, nearest
from trackloom.session import materialize

SCORE = "mean_cosine_score"


def normalize_playlist(playlist: DataFrame) -> DataFrame:
    """track_id ("" when absent), and names as the catalogue writes them."""
    has_id = "track_id" in playlist.columns
    track_id = F.coalesce(names.stripped(F.col("track_id").cast("string")), F.lit("")) if has_id else F.lit("")
    return playlist.select(
        track_id.alias("track_id"),
        F.lower(names.stripped(F.col("track_name"))).alias("track_name"),
        F.lower(names.stripped(F.col("artist_name"))).alias("artist_name"),
    )


def match_seeds(catalog: DataFrame, playlist: DataFrame) -> DataFrame:
    """The catalogue rows a normalised playlist names: by id where it has one, else by names.

    Two semi joins with the small playlist; no match gives an empty relation.
    """
    pair = ["track_name", "artist_name"]
    by_id = playlist.filter(F.col("track_id") != "").select(
        F.col("track_id").cast(catalog.schema["track_id"].dataType)
    )
    by_name = playlist.filter(F.col("track_id") == "").select(*pair)
    found = catalog.join(by_id, "track_id", "left_semi").select(*catalog.columns)
    found = found.union(catalog.join(by_name, pair, "left_semi").select(*catalog.columns))
    # Of rows that share an id the smallest values stay, so that reruns agree.
    return top_per_group(found, ["track_id"], [F.col(c).asc_nulls_last() for c in catalog.columns], 1)


def exclude(df: DataFrame, ids: DataFrame, id_column: str = "track_id") -> DataFrame:
    """Rows whose id is not in ``ids``."""
    return df.join(ids.select(id_column).distinct(), id_column, "left_anti")


def same_group_pool(
    catalog: DataFrame, groups: DataFrame, excluded: DataFrame, group_column: str = "artist_name"
) -> DataFrame:
    """Catalogue rows whose group (artist) is in ``groups``, without the excluded ids."""
    return exclude(catalog.join(groups.select(group_column).distinct(), group_column, "left_semi"), excluded)


def candidate_pool(near: DataFrame, group_pool: DataFrame, excluded: DataFrame) -> DataFrame:
    """Neighbours and same-group rows together, one row per id.

    Only the neighbours (at most k per seed) are grouped, and stored so that their
    search runs once; the larger side is filtered against them.
    """
    columns = group_pool.columns
    unique = exclude(near.select(*columns).dropDuplicates(["track_id"]), excluded)
    unique = materialize(unique, "near")
    return unique.unionByName(exclude(group_pool, unique))


def mean_direction(seeds: DataFrame, vector_column: str = "features") -> list[float]:
    """The mean of the seeds' unit vectors (zero vectors count as zero): one number per dimension."""
    length = vectors.norm(F.col(vector_column))
    parts = seeds.select(length.alias("_n"), F.posexplode(vector_column).alias("i", "x"))
    unit = F.coalesce(F.try_divide(F.col("x").cast("double"), F.col("_n")), F.lit(0.0))
    rows = parts.groupBy("i").agg(F.avg(unit).alias("m")).collect()
    return [row["m"] for row in sorted(rows, key=lambda row: row["i"])]


def mean_cosine(direction: list[float], vector_column: str = "features") -> Column:
    """The mean cosine of a row with all seeds.

    The mean over the seeds of c.s / (|c||s|) is c / |c| times the seeds' mean unit
    vector, so the cost of a row does not grow with the number of seeds.
    """
    vector = F.col(vector_column)
    score = F.try_divide(vectors.dot(vector, F.lit(direction)), vectors.norm(vector))
    return F.round(F.coalesce(score, F.lit(0.0)), DIGITS)


def blend(
    pool: DataFrame, groups: DataFrame, size: int, slots: int, group_column: str = "artist_name"
) -> DataFrame:
    """``size - slots`` rows by score, then up to ``slots`` more of the seeds' groups.

    ``pool`` has unique track_id, track_name, ``group_column`` and the score, and is
    computed once: the ``size`` best rows of the groups and the ``size`` best of the
    others hold both parts. Repeated (name, group) pairs are dropped after the cut,
    the first stays, so the list can be shorter than ``size``.
    """
    best_first = [F.col(SCORE).desc(), F.col("track_id").asc()]
    known = groups.select(group_column).distinct().withColumn("_grouped", F.lit(True))
    marked = pool.join(known, group_column, "left").withColumn("_grouped", F.coalesce("_grouped", F.lit(False)))
    # At most ``2 * size`` rows from here on.
    best = top_per_group(marked, ["_grouped"], best_first, size)
    placed = best.withColumn("_place", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*best_first)))
    placed = placed.withColumn("section", F.when(F.col("_place") <= size - slots, 0).when(F.col("_grouped"), 1))
    order = Window.partitionBy("section").orderBy(*best_first)
    first = Window.partitionBy("track_name", group_column).orderBy("section", "rk")
    listed = placed.filter("section is not null").withColumn("rk", F.row_number().over(order))
    return (
        listed.filter((F.col("section") == 0) | (F.col("rk") <= slots))
        .withColumn("_copy", F.row_number().over(first))
        .filter(F.col("_copy") == 1)
        .select(
            F.when(F.col("section") == 0, "similar").otherwise("same_group").alias("section"),
            "track_id",
            "track_name",
            group_column,
            SCORE,
            "rk",
        )
    )


def recommend_content(
    catalog: DataFrame,
    playlist: DataFrame,
    size: int = 50,
    slots: int = 10,
    k: int = 50,
    search=nearest,
) -> DataFrame:
    """Songs for a playlist: section, rk, track_id, track_name, artist_name, mean_cosine_score.

    ``catalog`` has track_id, track_name, artist_name and ``features`` (an array).
    ``search`` is :func:`nearest` or :func:`nearest_lsh`.
    """
    listed = normalize_playlist(playlist)
    seeds = materialize(match_seeds(catalog, listed), "seeds")
    columns = ["track_id", "track_name", "artist_name"]
    id_type = catalog.schema["track_id"].dataType
    given = listed.filter(F.col("track_id") != "").select(F.col("track_id").cast(id_type))
    excluded = seeds.select("track_id").unionByName(given)
    score = mean_cosine(mean_direction(seeds)).alias(SCORE)
    near = search(catalog, seeds, k, keep=("track_name", "artist_name", "features"))
    # The list takes at most ``size`` rows in score order, so no same-group row
    # beyond the best ``size`` can be on it.
    group = same_group_pool(catalog, listed, excluded).select(*columns, score)
    group = group.orderBy(F.col(SCORE).desc(), F.col("track_id").asc()).limit(size)
    found = near.select(*columns, score).unionByName(group).dropDuplicates(["track_id"])
    return blend(exclude(found, excluded), listed, size, slots)
