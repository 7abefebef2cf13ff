"""One query per operator, each over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackloom.functions import values, vectors
from trackloom.operators import (
    clean,
    conform,
    content,
    dedupe,
    evaluate,
    factors,
    interactions,
    neighbours,
    ordering,
    profile,
    report,
    sampling,
    scale,
)
from trackloom.plans import catalogue, collaborative, records
from trackloom.plans import interactions as interaction_plan
from trackloom.session import materialize, scratch_path
from trackloom.sinks import tables as sinks
from trackloom.sources import packed
from trackloom.sources import records as record_source
from trackloom.sources import tables as table_source
from workload import roles
from workload.roles import table

PROFILED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
ROUNDED = 6


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Round for the comparison with another engine's order of summation."""
    return df.withColumns({c: F.round(F.col(c), ROUNDED) for c in columns})


# --- sources and sinks ---------------------------------------------------------


def scan_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """Write the parts as CSV files and scan them with an explicit schema."""
    path = scratch_path(spark, "catalog-csv")
    parts = table(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_retailprice")
    sinks.write_csv(parts, path)
    return table_source.scan_csv(spark, path, parts.schema)


def scan_playlist(spark: SparkSession, folder: str) -> DataFrame:
    """Write the drawn playlist as CSV and load it."""
    path = scratch_path(spark, "playlist-csv")
    sinks.write_csv(roles.vector_playlist(spark, folder), path)
    return table_source.scan_playlist(spark, path)


def suggestions_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Write the suggestion list as CSV and read it back."""
    path = scratch_path(spark, "suggestions-csv")
    songs = content_recs(spark, folder).select("track_name", "artist_name", content.SCORE)
    sinks.write_csv(songs, path)
    return table_source.scan_csv(spark, path, songs.schema)


def tolerant_rows(spark: SparkSession, folder: str) -> str:
    """Write line items as a CSV with a dirty header and malformed rows; return its path.

    Line 6 of an order lacks the last field, line 7 has one too many.
    """
    path = scratch_path(spark, "dirty-csv")
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_returnflag")
    parts = table(spark, folder, "part").select("p_partkey", "p_name", "p_brand")
    joined = items.join(parts, items["l_partkey"] == parts["p_partkey"])
    line = F.concat(
        F.col("l_orderkey").cast("string"), F.lit(', "'), F.col("p_brand"), F.lit(', '), F.col("p_name"),
        F.lit('", "'), F.col("p_name"), F.lit('"'),
        F.when(F.col("l_linenumber") == 6, F.lit(""))
        .when(F.col("l_linenumber") == 7, F.concat(F.lit(", "), F.col("l_returnflag"), F.lit(", more")))
        .otherwise(F.concat(F.lit(", "), F.col("l_returnflag"))),
    )
    # Written as one unquoted field, so the text reaches the file as it is.
    writer = joined.select(line.alias('user_id, "artistname", "trackname", "playlistname"')).write
    writer.option("header", True).option("quote", "\u0000").option("sep", "\u0001").csv(path)
    return path


def tolerant_csv(spark: SparkSession, folder: str) -> DataFrame:
    return table_source.scan_dirty_csv(spark, tolerant_rows(spark, folder))


def csv_rejects(spark: SparkSession, folder: str) -> DataFrame:
    rejected = table_source.scan_csv_rejects(spark, tolerant_rows(spark, folder))
    return rejected.groupBy(F.col(table_source.CORRUPT_RECORD).alias("line")).agg(F.count("*").alias("n"))


def file_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Write the event records below one folder per type; list the files without reading them."""
    path = scratch_path(spark, "events")
    events = table(spark, folder, "events").select("event_type", "props")
    events.write.partitionBy("event_type").text(path)
    files = record_source.file_manifest(spark, path, "*.txt").select("path", "length")
    kind = F.regexp_extract("path", "event_type=([^/]+)/", 1)
    return files.groupBy(kind.alias("event_type")).agg(F.sum("length").alias("n_bytes"))


def extracted(spark: SparkSession, folder: str) -> DataFrame:
    return record_source.extract_records(roles.record_files(spark, folder), id_column="path")


def extract_records(spark: SparkSession, folder: str) -> DataFrame:
    return record_source.good_records(extracted(spark, folder))


def rejected_records(spark: SparkSession, folder: str) -> DataFrame:
    return record_source.rejected_records(extracted(spark, folder)).select("path")


def records_lane(spark: SparkSession, folder: str) -> DataFrame:
    good = record_source.good_records(extracted(spark, folder))
    return rounded(records.build_records(good, flags=True), *records.RECORD_NUMBERS)


def records_from_files(spark: SparkSession, folder: str) -> DataFrame:
    """One file per record: packed by size, read, parsed, cleaned, imputed and scaled."""
    files = packed.read_texts(spark, roles.record_folder(spark, folder), "*.txt")
    lane = records.build_records(record_source.good_records(record_source.extract_records(files)), flags=True)
    return rounded(lane, *records.RECORD_NUMBERS)


def binary_extracted(spark: SparkSession, folder: str) -> DataFrame:
    rows = packed.read_records(
        spark, roles.binary_folder(spark, folder), packed.decode_track, record_source.RECORD_SCHEMA.fieldNames(), "*.trk"
    )
    return record_source.typed_records(rows)


def binary_records(spark: SparkSession, folder: str) -> DataFrame:
    """Every customer as a file of a binary layout, some cut short: written, read and decoded in the tasks."""
    return record_source.good_records(binary_extracted(spark, folder))


def binary_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """The files that could not be decoded, and why."""
    name = F.regexp_extract("path", "([^/]+)$", 1).alias("name")
    return record_source.rejected_records(binary_extracted(spark, folder)).select(name, "error")


def sink_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Write the split interactions partitioned by split and read them back."""
    path = scratch_path(spark, "splits")
    sinks.write_parquet(roles.split_plays(spark, folder), path, ("split",))
    return table_source.scan_parquet(spark, path)


def model_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Fit, save and load a model; count its factors and their largest difference after the trip."""
    model = factors.fit_als(roles.plays(spark, folder))
    path = scratch_path(spark, "model")
    factors.save_model(model, path)
    loaded = factors.load_model(path)
    pairs = model.itemFactors.alias("a").join(loaded.itemFactors.alias("b"), "id", "full")
    gap = F.array_max(F.zip_with("a.features", "b.features", lambda x, y: F.abs(x - y)))
    return pairs.agg(
        F.count("a.features").alias("n_saved"),
        F.count("b.features").alias("n_loaded"),
        F.max(gap).cast("double").alias("max_gap"),
    )


def stage_report(spark: SparkSession, folder: str) -> DataFrame:
    return catalogue.build_catalog(roles.sources(spark, folder))[1]


def catalog_report(spark: SparkSession, folder: str) -> DataFrame:
    return catalogue.catalog_report(roles.sources(spark, folder))


# --- catalogue -----------------------------------------------------------------


def left_enrich(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part").select("p_partkey", "p_name", "p_brand")
    return conform.left_enrich(parts, roles.item_features(spark, folder), "p_partkey", "l_partkey")


def conform_sources(spark: SparkSession, folder: str) -> DataFrame:
    return catalogue.conform_sources(roles.sources(spark, folder))


def best_record(spark: SparkSession, folder: str) -> DataFrame:
    return catalogue.merge_sources(roles.sources(spark, folder))


def drop_incomplete(spark: SparkSession, folder: str) -> DataFrame:
    return clean.drop_incomplete(conform_sources(spark, folder), ["artist_name", "duration_ms", *roles.FEATURES])


def dedupe_by_name(spark: SparkSession, folder: str) -> DataFrame:
    return dedupe.dedupe(best_record(spark, folder), ["track_name", "artist_name"], ["track_id"])


def clean_catalog(spark: SparkSession, folder: str) -> DataFrame:
    return catalogue.clean_catalog(best_record(spark, folder))


def catalog_lane(spark: SparkSession, folder: str) -> DataFrame:
    scaled, _ = catalogue.build_catalog(roles.sources(spark, folder))
    return rounded(scaled, *catalogue.SCALED_COLUMNS)


def sanitize_values(spark: SparkSession, folder: str) -> DataFrame:
    """Blank and padded texts, NaN and infinities by key, over all line items."""
    items = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_linenumber") == 1, F.lit("  "))
        .otherwise(F.concat(F.lit("  "), F.col("l_returnflag"), F.lit(" ")))
        .alias("flag"),
        F.when(roles.every("l_orderkey", 3), F.lit(float("nan")))
        .when(roles.every("l_orderkey", 5), F.lit(float("inf")))
        .when(roles.every("l_orderkey", 7), F.lit(float("-inf")))
        .otherwise(F.col("l_quantity"))
        .alias("quantity"),
    )
    return clean.sanitize(items, text=["flag"], numbers=["quantity"])


def minmax_scale(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "constant"]
    items = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", *columns[:-1], F.lit(7.0).alias("constant")
    )
    return rounded(scale.scale_minmax(items, columns), *columns)


def mean_impute(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.when(F.col("l_linenumber") != 3, F.col("l_quantity")).alias("l_quantity"),
        F.when(F.col("l_linenumber") == 5, F.lit(float("nan"))).otherwise(F.col("l_tax")).alias("l_tax"),
    )
    return rounded(scale.impute_mean(items, ["l_quantity", "l_tax"], flags=True), "l_quantity", "l_tax")


# --- profiles ------------------------------------------------------------------


def datasets(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    names = ("part", "lineitem", "orders", "events", "documents", "embeddings")
    return {name: table(spark, folder, name) for name in names}


def profile_shape(spark: SparkSession, folder: str) -> DataFrame:
    return profile.shape(datasets(spark, folder))


def profile_schema(spark: SparkSession, folder: str) -> DataFrame:
    return profile.schema(spark, datasets(spark, folder))


def profile_missing(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.missing(conform_sources(spark, folder)), "pct")


def profile_dups(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without their id: the exact copies among them are duplicate rows."""
    documents = table(spark, folder, "documents").drop("doc_id")
    return rounded(profile.duplicates(documents), "pct")


def profile_stats(spark: SparkSession, folder: str) -> DataFrame:
    stats = profile.statistics(table(spark, folder, "lineitem"), PROFILED)
    return rounded(stats, "mean", "mode", "median", "std", "min", "max")


def profile_hist(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.histogram(table(spark, folder, "lineitem"), PROFILED), "lower", "upper")


def profile_corr(spark: SparkSession, folder: str) -> DataFrame:
    """Pairwise over the conformed sources, where features are missing in places."""
    return rounded(profile.correlations(conform_sources(spark, folder), roles.FEATURES), "corr")


def profile_datasets(spark: SparkSession, folder: str) -> DataFrame:
    """The profile of the merged catalogue and of the records, each with the features it has."""
    merged = materialize(best_record(spark, folder), "merged")
    good = materialize(extract_records(spark, folder), "records")
    return rounded(profile.profile({"merged": merged, "records": good}), "value")


# --- interactions --------------------------------------------------------------


def interaction_counts(spark: SparkSession, folder: str) -> DataFrame:
    rows = clean.drop_incomplete(roles.playlist_rows(spark, folder), interaction_plan.RAW_KEYS)
    return interactions.count_interactions(rows, interaction_plan.RAW_KEYS)


def distinct_ids(spark: SparkSession, folder: str) -> DataFrame:
    return interactions.distinct_ids(roles.plays(spark, folder), "song_id")


def dense_ids(spark: SparkSession, folder: str) -> DataFrame:
    return ordering.dense_ids(roles.playlist_rows(spark, folder), ["trackname"], "song_code")


def encode_ids(spark: SparkSession, folder: str) -> DataFrame:
    return interaction_plan.build_interactions(roles.playlist_rows(spark, folder))


def user_lane(spark: SparkSession, folder: str) -> DataFrame:
    """From the tolerant CSV to encoded interactions, written by part and read back."""
    raw = table_source.scan_dirty_csv(spark, tolerant_rows(spark, folder))
    path = scratch_path(spark, "user-lane")
    encoded = interaction_plan.build_interactions(raw)
    sinks.write_parquet(interaction_plan.split_interactions(encoded), path, ("split",))
    return table_source.scan_parquet(spark, path)


def interaction_report(spark: SparkSession, folder: str) -> DataFrame:
    """The row counts of the stages of :func:`user_lane`'s plan over the joined tables."""
    raw = roles.playlist_rows(spark, folder)
    split = interaction_plan.split_interactions(interaction_plan.build_interactions(raw))
    return interaction_plan.interaction_report(raw, materialize(split, "splits"))


def user_history(spark: SparkSession, folder: str) -> DataFrame:
    return interactions.user_history(roles.plays(spark, folder))


def hash_split(spark: SparkSession, folder: str) -> DataFrame:
    return roles.split_plays(spark, folder)


def sample_playlist(spark: SparkSession, folder: str) -> DataFrame:
    return roles.vector_playlist(spark, folder)


def eval_pairs(spark: SparkSession, folder: str) -> DataFrame:
    split = materialize(roles.split_plays(spark, folder), "splits")
    return sampling.eval_pairs(roles.part_of(split, "validation"))


def negative_samples(spark: SparkSession, folder: str) -> DataFrame:
    return roles.candidates(spark, folder)


# --- neighbours and content ----------------------------------------------------


def knn_exact(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(roles.vectors(spark, folder), roles.vector_seeds(spark, folder))


# Buckets this wide part the vectors by sign only, so that with so many tables no neighbour is missed.
WIDE = {"bucket_length": 50.0, "tables": 24}
NARROW = {"bucket_length": 0.1}


def knn_lsh(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest_lsh(roles.vectors(spark, folder), roles.vector_seeds(spark, folder), **WIDE)


def knn_lsh_checks(spark: SparkSession, folder: str) -> DataFrame:
    """Narrow buckets: per seed the rows whose distance, place or uniqueness is wrong."""
    catalog, seeds = roles.vectors(spark, folder), roles.vector_seeds(spark, folder)
    found = neighbours.nearest_lsh(catalog, seeds, keep=("features",), **NARROW)
    origin = seeds.select(F.col("track_id").alias("seed_id"), F.col("features").alias("_seed"))
    order = Window.partitionBy("seed_id").orderBy("dist", "track_id")
    own = F.round(vectors.euclidean(F.col("features"), F.col("_seed")), 6)
    return (
        found.join(origin, "seed_id")
        .withColumns({"wrong": F.abs(own - F.col("dist")) > 1e-5, "place": F.row_number().over(order)})
        .groupBy("seed_id")
        .agg(
            F.count_if("wrong").alias("n_wrong"),
            F.count_if(F.col("place") != F.col("rk")).alias("n_misplaced"),
            (F.count("*") - F.countDistinct("track_id")).alias("n_repeated"),
            F.max((F.col("track_id") == F.col("seed_id")).cast("int")).alias("finds_itself"),
        )
    )


def knn_recall(spark: SparkSession, folder: str) -> DataFrame:
    """The recall of wide buckets, which is complete."""
    catalog, seeds = roles.vectors(spark, folder), roles.vector_seeds(spark, folder)
    return neighbours.recall(neighbours.nearest(catalog, seeds), neighbours.nearest_lsh(catalog, seeds, **WIDE))


def mean_cosine(spark: SparkSession, folder: str) -> DataFrame:
    direction = content.mean_direction(roles.vector_seeds(spark, folder))
    return roles.vectors(spark, folder).select("track_id", content.mean_cosine(direction).alias("mean_cosine"))


def same_group_pool(spark: SparkSession, folder: str) -> DataFrame:
    seeds = roles.vector_seeds(spark, folder)
    return content.same_group_pool(roles.vectors(spark, folder), seeds, seeds).select("track_id", "artist_name")


def candidate_pool(spark: SparkSession, folder: str) -> DataFrame:
    catalog, seeds = roles.vectors(spark, folder), roles.vector_seeds(spark, folder)
    near = neighbours.nearest(catalog, seeds, keep=("artist_name",))
    group = content.same_group_pool(catalog, seeds, seeds).select("track_id", "artist_name")
    return content.candidate_pool(near, group, seeds)


def match_seeds(spark: SparkSession, folder: str) -> DataFrame:
    """A playlist drawn from the parts, a part of its ids left blank, matched by id or by names."""
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("track_id"),
        F.lower("p_name").alias("track_name"),
        F.lower("p_brand").alias("artist_name"),
    )
    listed = sampling.sample_playlist(parts, roles.PLAYLIST_SIZE).select(
        F.when(F.col("track_id").cast("bigint") % 2 == 0, F.lit(" ")).otherwise(F.col("track_id")).alias("track_id"),
        F.concat(F.lit(" "), F.upper("track_name")).alias("track_name"),
        F.upper("artist_name").alias("artist_name"),
    )
    return content.match_seeds(parts, content.normalize_playlist(listed))


def content_recs(spark: SparkSession, folder: str) -> DataFrame:
    return content.recommend_content(roles.vectors(spark, folder), roles.vector_playlist(spark, folder))


def catalog_recs(spark: SparkSession, folder: str) -> DataFrame:
    """Recommendations from the scaled catalogue of the five sources: nine columns as one vector."""
    scaled, _ = catalogue.build_catalog(roles.sources(spark, folder))
    features = vectors.assembled(catalogue.SCALED_COLUMNS).alias("features")
    songs = scaled.filter("track_id is not null").select("track_id", "track_name", "artist_name", features)
    songs = materialize(songs, "songs")
    playlist = materialize(sampling.sample_playlist(songs, roles.PLAYLIST_SIZE), "playlist")
    return content.recommend_content(songs, playlist)


# --- factor models and evaluation ----------------------------------------------


def scored(spark: SparkSession, folder: str) -> DataFrame:
    return factors.score_candidates(roles.candidates(spark, folder), *roles.factors(spark, folder))


def score_candidates(spark: SparkSession, folder: str) -> DataFrame:
    return scored(spark, folder)


def rank_positive(spark: SparkSession, folder: str) -> DataFrame:
    """The ranks of all held-out pairs."""
    candidates = roles.candidates(spark, folder, pairs=None)
    return evaluate.rank_positive(factors.score_candidates(candidates, *roles.factors(spark, folder), dense=True))


def rank_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(evaluate.rank_metrics(evaluate.rank_positive(scored(spark, folder))), "hr", "mrr")


def rank_results(spark: SparkSession, folder: str) -> DataFrame:
    """Three factorisations, of 16, 32 and 64 dimensions, on the same candidates."""
    candidates = materialize(roles.candidates(spark, folder), "candidates")
    results = []
    for size in (16, 32, 64):
        users, items = roles.factors(spark, folder, size)
        results.append(({"rank": size}, evaluate.evaluate_factors(users, items, candidates)))
    return evaluate.stack_results(results)


def select_best(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(evaluate.select_best(rank_results(spark, folder)), "hr", "mrr")


def als_fit(spark: SparkSession, folder: str) -> DataFrame:
    """The factor tables of a fit on the training split: how many ids, how long the vectors.

    Of the users, whose factors a fit solves last, also how many do not solve their equations.
    """
    train = materialize(roles.part_of(roles.split_plays(spark, folder), "train"), "train")
    model = factors.fit_als(train)
    sides = {"user": model.userFactors, "item": model.itemFactors}
    parts = [
        df.groupBy(F.lit(side).alias("side"), F.size("features").alias("rank")).agg(F.count("*").alias("n_ids"))
        for side, df in sides.items()
    ]
    residuals = factors.user_residuals(model.userFactors, model.itemFactors, train)
    unsolved = residuals.agg(F.count_if(~(F.col("residual") <= RESIDUAL)).alias("n_unsolved"), F.count("*").alias("n_checked"))
    none = [F.lit(None).cast("bigint").alias(c) for c in ("n_unsolved", "n_checked")]
    return parts[0].crossJoin(unsolved).unionByName(parts[1].select("*", *none))


# What single precision leaves of a solved system is far below, and an unsolved one far above.
RESIDUAL = 1e-3


def rechecked(metrics: DataFrame, again: DataFrame, *columns: str) -> DataFrame:
    """How far hr and mrr are from those that SQL finds in the stored factors and candidates."""
    both = metrics.join(again.select(*[F.col(c).alias(f"_{c}") for c in again.columns]), metrics["grid_index"] == F.col("_grid_index"))
    gaps = [F.round(F.abs(F.col(c) - F.col(f"_{c}")), ROUNDED).alias(f"{c}_gap") for c in ("hr", "mrr")]
    return both.select(*columns, "n", (F.col("n") - F.col("_n")).alias("n_gap"), *gaps)


def bundle_results(spark: SparkSession, folder: str, count: int) -> DataFrame:
    parts = [
        evaluate.bundle_metrics(spark, f"{folder}/{i}").withColumn("grid_index", F.lit(i)) for i in range(count)
    ]
    return reduce(DataFrame.unionByName, parts)


def als_grid(spark: SparkSession, folder: str) -> DataFrame:
    """The tuned points; their metrics against those of the stored bundles."""
    split = materialize(roles.split_plays(spark, folder), "splits")
    train, validation = (roles.part_of(split, name) for name in ("train", "validation"))
    path = scratch_path(spark, "bundles")
    results = collaborative.tune_als(train, validation, parallelism=3, bundles=path)
    again = bundle_results(spark, path, len(factors.GRID))
    return rechecked(results, again, "grid_index", "rank", "regParam", "alpha")


def als_final(spark: SparkSession, folder: str) -> DataFrame:
    """The test metrics of the refitted winner against those of its stored bundle."""
    split = materialize(roles.split_plays(spark, folder), "splits")
    parts = [roles.part_of(split, name) for name in ("train", "validation", "test")]
    path = scratch_path(spark, "bundles")
    final = collaborative.train_final(*parts, parallelism=3, bundle=f"{path}/0")
    return rechecked(final.test.withColumn("grid_index", F.lit(0)), bundle_results(spark, path, 1))


def list_checks(songs: DataFrame, heard: DataFrame, *users: str) -> DataFrame:
    """What must hold of each user's list: its length, repeats, songs played already, rows out of order."""
    played = heard.select("user_id", "song_id", F.lit(1).alias("played"))
    before = F.lag("confidence_score").over(Window.partitionBy("user_id").orderBy("rk"))
    return (
        songs.withColumn("rises", F.col("confidence_score") > before)
        .join(played, ["user_id", "song_id"], "left")
        .groupBy("user_id", *users)
        .agg(
            F.count("*").alias("n_songs"),
            F.countDistinct("song_id").alias("n_distinct"),
            F.count("played").alias("n_played"),
            F.count_if("rises").alias("n_rises"),
            F.count_if(F.col("track_name").isNull()).alias("n_nameless"),
        )
    )


def recs_coverage(spark: SparkSession, folder: str) -> DataFrame:
    """The lists of all users, checked."""
    encoded = materialize(encode_ids(spark, folder), "encoded")
    return list_checks(factors.recommend_new(factors.fit_als(encoded), encoded), encoded)


def requested(encoded: DataFrame) -> DataFrame:
    """The users a caller asks for, by their original ids: each seventh."""
    known = encoded.select("user_id", "user_id_original").distinct()
    return known.filter(F.col("user_id_original").cast("bigint") % 7 == 0)


def recs_for_users(spark: SparkSession, folder: str) -> DataFrame:
    """The lists of requested users with their original ids, checked."""
    encoded = materialize(encode_ids(spark, folder), "encoded")
    users = requested(encoded)
    songs = factors.recommend_new(factors.fit_als(encoded), encoded, users=users.select("user_id"))
    return list_checks(songs.join(users, "user_id"), encoded, "user_id_original")


def history_for_users(spark: SparkSession, folder: str) -> DataFrame:
    """The most played songs of requested users, with the original ids and the names."""
    encoded = materialize(encode_ids(spark, folder), "encoded")
    return interactions.user_history(encoded, users=requested(encoded))


def score_table(spark: SparkSession, folder: str) -> DataFrame:
    """A score for every play, a pure function of the pair."""
    score = (values.row_hash(["user_id", "song_id"], 7) / F.lit(float(1 << 32))).alias("confidence_score")
    return roles.split_plays(spark, folder).select("user_id", "song_id", "split", score)


# Items that are compared at a time: few enough that the small tables have many blocks.
ITEMS_AT_A_TIME = 200


def long_tail_search(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The ten songs of largest product for every user among those not played, from factors by a rule."""
    users, items = roles.long_tail_factors(spark, folder)
    return factors.search_products(users, items, 10, roles.plays(spark, folder), block=ITEMS_AT_A_TIME)


def top_new_songs(spark: SparkSession, folder: str) -> DataFrame:
    """The lists of all users."""
    return factors.best_per_user(long_tail_search(spark, folder)[0], 10)


def top_new_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """How many blocks of items each user was compared with."""
    return long_tail_search(spark, folder)[1]


def fitted_scale(spark: SparkSession, folder: str) -> DataFrame:
    """Imputer and scaler fitted on one source, stored, loaded and applied to another, whose durations reach beyond."""
    sources = conform_sources(spark, folder)
    columns = ["duration_ms", *roles.FEATURES]
    model = scale.fit_preparation(sources.filter("source_rank = 2"), columns)
    path = scratch_path(spark, "preparation")
    scale.save_preparation(model, path)
    prepared = scale.apply_preparation(scale.load_preparation(path), sources.filter("source_rank = 4"), columns)
    return rounded(prepared.select("track_id", "track_name", *columns), *columns)


def knn_all(spark: SparkSession, folder: str) -> DataFrame:
    """The ten nearest vectors of every vector: as many seeds as catalogue rows."""
    catalog = roles.vectors(spark, folder)
    return neighbours.nearest(catalog, catalog, 10)


def explode_recs(spark: SparkSession, folder: str) -> DataFrame:
    """Each user's 50 best as an array of structs, taken apart again."""
    best = factors.best_per_user(score_table(spark, folder).drop("split"), 50)
    arrays = best.groupBy("user_id").agg(
        F.collect_list(F.struct("song_id", F.col("confidence_score").alias("rating"))).alias("recommendations")
    )
    return rounded(factors.explode_recommendations(arrays), "confidence_score")


def anti_heard(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best per user among the plays that are not in the training split."""
    plays = score_table(spark, folder)
    fresh = factors.drop_heard(plays.drop("split"), roles.part_of(plays, "train"))
    return rounded(factors.best_per_user(fresh, 10), "confidence_score")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        content_recs,
        scan_catalog,
        scan_playlist,
        suggestions_csv,
        tolerant_csv,
        csv_rejects,
        file_manifest,
        extract_records,
        rejected_records,
        records_lane,
        records_from_files,
        binary_records,
        binary_rejects,
        sink_roundtrip,
        model_roundtrip,
        stage_report,
        catalog_report,
        left_enrich,
        conform_sources,
        best_record,
        drop_incomplete,
        dedupe_by_name,
        clean_catalog,
        catalog_lane,
        sanitize_values,
        minmax_scale,
        mean_impute,
        fitted_scale,
        profile_shape,
        profile_schema,
        profile_missing,
        profile_dups,
        profile_stats,
        profile_hist,
        profile_corr,
        profile_datasets,
        interaction_counts,
        distinct_ids,
        dense_ids,
        encode_ids,
        user_lane,
        interaction_report,
        user_history,
        hash_split,
        sample_playlist,
        eval_pairs,
        negative_samples,
        knn_exact,
        knn_all,
        knn_lsh,
        knn_lsh_checks,
        knn_recall,
        mean_cosine,
        same_group_pool,
        candidate_pool,
        match_seeds,
        catalog_recs,
        score_candidates,
        rank_positive,
        rank_metrics,
        select_best,
        als_fit,
        als_grid,
        als_final,
        top_new_songs,
        top_new_blocks,
        recs_for_users,
        recs_coverage,
        history_for_users,
        explode_recs,
        anti_heard,
    )
}
