"""The given tables in the roles of the recommender's inputs.

The tables hold no NULL, blank, NaN or duplicate, so those are put in by a rule
on the key; no row is left out. ``workload/oracles.py`` states the same rules in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.operators import sampling
from trackloom.plans.catalogue import Source
from trackloom.session import materialize, scratch_path
from trackloom.sources import packed

# Catalogue feature -> aggregate over the line items of a part. A mean is cut to six
# digits in whole numbers, so that the order of a floating-point sum cannot show.
FEATURE_AGGREGATES = {
    "danceability": ("avg", "l_discount"),
    "energy": ("avg", "l_tax"),
    "speechiness": ("min", "l_quantity"),
    "acousticness": ("max", "l_quantity"),
    "instrumentalness": ("min", "l_extendedprice"),
    "liveness": ("max", "l_extendedprice"),
    "valence": ("avg", "l_quantity"),
    "tempo": ("avg", "l_extendedprice"),
}
FEATURES = list(FEATURE_AGGREGATES)
PLAYLIST_SIZE = 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def every(column: str, n: int) -> Column:
    return F.col(column) % n == 0


def item_features(spark: SparkSession, folder: str) -> DataFrame:
    """l_partkey and the eight features."""

    def feature(how: str, column: str) -> Column:
        if how != "avg":
            return getattr(F, how)(column)
        hundredths = F.sum(F.round(F.col(column) * 100.0).cast("bigint"))
        return F.call_function("div", hundredths * 10_000, F.count(column)) / 1e6

    aggregates = [feature(how, column).alias(name) for name, (how, column) in FEATURE_AGGREGATES.items()]
    return table(spark, folder, "lineitem").groupBy("l_partkey").agg(*aggregates)


def part_features(spark: SparkSession, folder: str) -> DataFrame:
    """Every part with its features, NULL where it was never ordered."""
    parts = table(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_retailprice")
    return parts.join(item_features(spark, folder).withColumnRenamed("l_partkey", "p_partkey"), "p_partkey", "left")


def sources(spark: SparkSession, folder: str) -> list[Source]:
    """Five catalogues of the parts under different column names.

    1 has no artist; 2 has names with blanks and capitals and text durations, some
    not numbers; 3 lacks one feature at times; 4 has NULL and blank artists; 5 has
    rows without an id and other durations.
    """
    base = part_features(spark, folder)
    key = F.col("p_partkey")
    text_id = key.cast("string")
    duration = F.round(F.col("p_retailprice") * 700.0, 2)
    features = {f: f for f in FEATURES}

    first = base.select(text_id.alias("id"), F.col("p_name").alias("song_name"), duration.alias("ms"), *FEATURES)
    second = base.select(
        text_id.alias("track_id"),
        F.when(every("p_partkey", 2), F.concat(F.lit("  "), F.upper("p_name"), F.lit(" ")))
        .otherwise(F.col("p_name"))
        .alias("track_name"),
        F.col("p_brand").alias("artist_0"),
        F.when(every("p_partkey", 5), F.lit("abc")).otherwise(duration.cast("string")).alias("duration_ms"),
        *FEATURES,
    )
    third = base.select(
        text_id.alias("track_id"),
        F.col("p_name").alias("track_name"),
        F.col("p_brand").alias("artist_name"),
        duration.alias("duration_ms"),
        *[f for f in FEATURES if f != "tempo"],
        F.when(~every("p_partkey", 4), F.col("tempo")).alias("tempo"),
    )
    fourth = base.select(
        text_id.alias("track_id"),
        F.when(every("p_partkey", 7), F.lit(None))
        .when(every("p_partkey", 11), F.lit(" "))
        .otherwise(F.col("p_brand"))
        .alias("artists"),
        F.col("p_name").alias("track_name"),
        duration.alias("duration_ms"),
        *FEATURES,
    )
    fifth = base.select(
        F.when(~every("p_partkey", 9), text_id).alias("track_id"),
        F.col("p_brand").alias("artist_name"),
        F.col("p_type").alias("track_name"),
        (duration + 1000.0).alias("duration_ms"),
        *FEATURES,
    )
    named = {"track_id": "track_id", "track_name": "track_name", "duration_ms": "duration_ms"}
    return [
        Source(first, {"track_id": "id", "track_name": "song_name", "duration_ms": "ms", **features}),
        Source(second, {**named, "artist_name": "artist_0", **features}),
        Source(third, {**named, "artist_name": "artist_name", **features}),
        Source(fourth, {**named, "artist_name": "artists", **features}),
        Source(fifth, {**named, "artist_name": "artist_name", **features}),
    ]


def playlist_rows(spark: SparkSession, folder: str) -> DataFrame:
    """One row per line item: who ordered which part, with names that may be NULL."""
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    parts = table(spark, folder, "part").select("p_partkey", "p_name", "p_brand")
    joined = items.join(orders, items["l_orderkey"] == orders["o_orderkey"]).join(
        parts, items["l_partkey"] == parts["p_partkey"]
    )
    return joined.select(
        F.col("o_custkey").cast("string").alias("user_id"),
        F.concat_ws(" ", "p_name", "p_partkey").alias("trackname"),
        F.when(~every("p_partkey", 17), F.col("p_brand")).alias("artistname"),
        F.col("o_orderpriority").alias("playlistname"),
    )


def plays(spark: SparkSession, folder: str) -> DataFrame:
    """user_id, song_id, interaction with the table keys as ids."""
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    counts = (
        items.join(orders, items["l_orderkey"] == orders["o_orderkey"])
        .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("song_id"))
        .agg(F.count("*").cast("double").alias("interaction"))
    )
    return counts


def split_plays(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.train_test_validation(plays(spark, folder), ["user_id", "song_id"])


def part_of(split: DataFrame, name: str) -> DataFrame:
    return split.filter(F.col("split") == name).drop("split")


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    """The embeddings as a catalogue; the label plays the artist."""
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("track_id"),
        F.concat(F.lit("song "), F.col("vec_id").cast("string")).alias("track_name"),
        F.concat(F.lit("artist "), F.col("label").cast("string")).alias("artist_name"),
        F.col("embedding").alias("features"),
    )


def vector_playlist(spark: SparkSession, folder: str) -> DataFrame:
    """A stored playlist drawn from the catalogue."""
    return materialize(sampling.sample_playlist(vectors(spark, folder), PLAYLIST_SIZE), "playlist")


def vector_seeds(spark: SparkSession, folder: str) -> DataFrame:
    """The playlist's rows of the catalogue, stored."""
    ids = sampling.sample_playlist(vectors(spark, folder), PLAYLIST_SIZE).select("track_id")
    return materialize(vectors(spark, folder).join(ids, "track_id", "left_semi"), "seeds")


def factor_table(ids: DataFrame, rank: int) -> DataFrame:
    """A factor table of ``rank`` dimensions by a rule on the id: 4,096ths, so that any order of sums is exact."""
    k = F.col("id") % 8191 + 1
    parts = F.transform(
        F.sequence(F.lit(1).cast("bigint"), F.lit(rank).cast("bigint")),
        lambda i: (k * (k + i + rank) * (i * 2 + 3) % 8191 - 4095) / F.lit(4096.0),
    )
    return ids.select("id", parts.alias("features"))


def factors(spark: SparkSession, folder: str, rank: int = 64) -> tuple[DataFrame, DataFrame]:
    """Factors of every user and of every item but each fiftieth, which stands for the unseen items."""
    users = table(spark, folder, "customer").select(F.col("c_custkey").alias("id"))
    items = table(spark, folder, "part").select(F.col("p_partkey").alias("id")).filter(~every("id", 50))
    return factor_table(users, rank), factor_table(items, rank)


def long_tail_factors(spark: SparkSession, folder: str, rank: int = 16) -> tuple[DataFrame, DataFrame]:
    """Factors of every user and item, where the items' lengths fall by halves: few are heard much.

    One item in two has a 32nd of the length, one in four a 16th, and so on; halves keep sums exact.
    """
    users = factor_table(table(spark, folder, "customer").select(F.col("c_custkey").alias("id")), rank)
    items = factor_table(table(spark, folder, "part").select(F.col("p_partkey").alias("id")), rank)
    rare = F.least(F.length(F.regexp_extract(F.bin("id"), "0*$", 0)), F.lit(5))
    scale = F.pow(F.lit(2.0), rare - 5)
    return users, items.withColumn("features", F.transform("features", lambda x: x * scale))


def candidates(spark: SparkSession, folder: str, pairs: int | None = 5000) -> DataFrame:
    """Up to ``pairs`` held-out pairs (None: all), each with 99 negatives, from the stored splits."""
    split = materialize(split_plays(spark, folder), "splits")
    pairs = sampling.eval_pairs(part_of(split, "validation"), pairs)
    return sampling.negative_samples(pairs, part_of(split, "train"))


def record_files(spark: SparkSession, folder: str) -> DataFrame:
    """path and content: each event as one JSON record, some of them cut short."""
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type", "value", "props")
    number = F.col("value").cast("string")
    text = F.concat(
        F.lit('{"track_id": "T'), F.col("event_id").cast("string"),
        F.lit('", "track_name": "  '), F.upper("event_type"), F.lit(" "), F.col("props").substr(7, 1),
        F.lit(' ", "artist_name": "'),
        F.when(every("event_id", 19), F.lit(" ")).otherwise(F.concat(F.lit("User "), F.col("user_id").cast("string"))),
        F.lit('", "duration": '), (F.col("value") * 10.0).cast("string"),
        F.lit(', "tempo": '), F.when(every("event_id", 5), F.lit("NaN")).otherwise(number),
        F.lit(', "loudness": '), F.when(every("event_id", 3), F.lit("null")).otherwise(number),
        F.lit(', "artist_familiarity": "'), F.when(every("event_id", 4), F.lit("none")).otherwise(number),
        F.lit('", "artist_hotttnesss": '), F.when(every("event_id", 6), F.lit("-Infinity")).otherwise(number),
        F.lit(', "song_hotttnesss": '), F.when(every("event_id", 3), F.lit("null")).otherwise((F.col("value") * 2.0).cast("string")),
        F.when(every("event_id", 13), F.lit("")).otherwise(F.lit("}")),
    )
    return events.select(F.col("event_id").alias("path"), F.encode(text, "UTF-8").alias("content"))


def binary_folder(spark: SparkSession, folder: str) -> str:
    """Write every customer as a file in the binary layout of track records; return the folder."""
    path = scratch_path(spark, "binary")
    rows = table(spark, folder, "customer").select(
        F.concat(F.pmod("c_custkey", F.lit(16)).cast("string"), F.lit("/"), F.col("c_custkey").cast("string"), F.lit(".trk")).alias("name"),
        F.when(every("c_custkey", 13), F.lit(7)).when(every("c_custkey", 17), F.lit(-3)).alias("cut"),
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("track_id"),
        F.col("c_name").alias("track_name"),
        F.when(~every("c_custkey", 19), F.concat(F.lit("Nation "), F.col("c_nationkey").cast("string"))).alias("artist_name"),
        F.col("c_acctbal").alias("duration"),
        F.when(~every("c_custkey", 5), F.col("c_acctbal")).alias("tempo"),
        F.when(every("c_custkey", 3), F.lit(float("inf"))).otherwise(F.col("c_acctbal")).alias("loudness"),
        F.col("c_nationkey").cast("double").alias("artist_familiarity"),
        F.lit(None).cast("double").alias("artist_hotttnesss"),
        (F.col("c_acctbal") * 2.0).alias("song_hotttnesss"),
    )

    def encoded(batches):
        import pyarrow as pa

        for batch in batches:
            made = batch.to_pylist()
            contents = [packed.encode_track(r)[: r["cut"]] for r in made]
            yield pa.RecordBatch.from_arrays([batch.column("name"), pa.array(contents, pa.binary())], names=["name", "content"])

    packed.write_records(rows.mapInArrow(encoded, "name string, content binary"), path)
    return path


def record_folder(spark: SparkSession, folder: str) -> str:
    """Write every supplier as a file of one JSON record, below a folder per nation; return the folder."""
    path = scratch_path(spark, "records")
    number = F.col("s_acctbal").cast("string")
    text = F.concat(
        F.lit('{"track_id": "S'), F.col("s_suppkey").cast("string"),
        F.lit('", "track_name": "\\t'), F.upper("s_name"), F.lit(' \\n", "artist_name": "'),
        F.when(every("s_suppkey", 19), F.lit(" \\t")).otherwise(F.concat(F.lit("Nation "), F.col("s_nationkey").cast("string"))),
        F.lit('", "duration": '), (F.col("s_suppkey") % 1000 + 25).cast("string"),
        F.lit(', "tempo": '), F.when(every("s_suppkey", 5), F.lit("NaN")).otherwise(number),
        F.lit(', "loudness": '), F.when(every("s_suppkey", 3), F.lit("null")).otherwise(number),
        F.lit(', "artist_familiarity": "'), F.when(every("s_suppkey", 4), F.lit("none")).otherwise(number),
        F.lit('", "artist_hotttnesss": '), F.when(every("s_suppkey", 6), F.lit("-Infinity")).otherwise(number),
        F.lit(', "song_hotttnesss": '), F.col("s_nationkey").cast("string"),
        F.when(every("s_suppkey", 13), F.lit("")).otherwise(F.lit("}")),
    )
    nation = F.concat(F.lit("nation="), F.coalesce(F.col("s_nationkey").cast("string"), F.lit("none")))
    # Keys may repeat or lack; files have names of their own.
    name = F.concat(nation, F.lit("/part-"), F.monotonically_increasing_id().cast("string"), F.lit(".txt"))
    line = F.encode(F.concat(F.coalesce(text, F.lit("")), F.lit("\n")), "UTF-8")
    packed.write_records(table(spark, folder, "supplier").select(name.alias("name"), line.alias("content")), path)
    return path
