"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

Every stage is a function of (spark, docs, sf_dir). All but the last return the columns of
documents; the last adds size, source_size, target and taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.llm import decontaminate, jaccard_join, mixing, quality, suffix_dedup
from trackloom.llm.tables import held_out, read
from trackloom.session import materialize


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts. It learns as ``op3`` does."""
    model = quality.fit(docs, read(spark, sf_dir, "labels"), ~held_out("doc_id", 4, 2))
    return quality.score(docs, model).where("predicted = 1").select(docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each group of near-duplicates; rows without an id stay.

    Texts under one id are judged each by its own group.
    """
    dropped = jaccard_join.grouped(docs).where("class_id <> doc_id").select("doc_id", "text_md5").distinct()
    digest = F.md5(F.coalesce(docs["text"], F.lit("")).cast("binary"))
    return docs.join(dropped, (docs["doc_id"] == dropped["doc_id"]) & (digest == dropped["text_md5"]), "left_anti").select(docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that a document of smaller id holds too."""
    cut = suffix_dedup.remove_repeats(docs)
    cut = cut.withColumn("text", F.col("kept_text"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        size = F.when(F.col("n_removed") > 0, F.length("kept_text")).otherwise(F.col("n_chars"))
        cut = cut.withColumn("n_chars", size.cast(kind))
    return cut.select(docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no benchmark item leaks."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the words that the mix takes of each."""
    return mixing.mix(docs, keep=True)


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", keep_one_of_each),
    ("suffix-array dedup", cut_repeats),
    ("benchmark decontamination", drop_leaks),
    ("mixing sources", mix_sources),
]

# A trained model, suffix order and edit distances are beyond SQL: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
