"""Typed scans: CSV and Parquet with explicit schemas, tolerant CSV, header repair."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from trackloom.session import materialize

CORRUPT_RECORD = "_corrupt_record"


def scan_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """CSV with a header. Give the schema where it is known: inferring the types reads the file once more."""
    if schema is None:
        return spark.read.csv(path, header=True, inferSchema=True)
    return spark.read.schema(schema).option("enforceSchema", "false").csv(path, header=True)


def scan_playlist(spark: SparkSession, path: str) -> DataFrame:
    """A seed playlist: track_name, artist_name and, where the file has it, track_id; all text."""
    return repair_header(spark.read.csv(path, header=True))


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def repair_header(df: DataFrame) -> DataFrame:
    """Strip blanks and quotes from the column names."""
    return df.toDF(*[re.sub(r'^\s*"*|"*\s*$', "", name) for name in df.columns])


def _dirty_reader(spark: SparkSession):
    # Without column pruning every query parses whole rows, so the set of
    # malformed rows does not depend on which columns the query reads.
    return (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("ignoreLeadingWhiteSpace", True)
        .option("columnPruning", False)
    )


def scan_dirty_csv(spark: SparkSession, path: str) -> DataFrame:
    """All-string CSV scan that leaves malformed rows out and repairs the header."""
    return repair_header(_dirty_reader(spark).option("mode", "DROPMALFORMED").csv(path))


def scan_csv_rejects(spark: SparkSession, path: str) -> DataFrame:
    """The raw text of the rows that :func:`scan_dirty_csv` leaves out, as a stored relation.

    Stored because Spark does not answer queries on the raw text alone from the file.
    """
    parsed = _dirty_reader(spark).csv(path).schema
    reader = _dirty_reader(spark).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT_RECORD)
    rows = reader.schema(parsed.add(CORRUPT_RECORD, "string")).csv(path)
    rejected = rows.filter(rows[CORRUPT_RECORD].isNotNull())
    return materialize(repair_header(rejected), "rejects").select(CORRUPT_RECORD)
