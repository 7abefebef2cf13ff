"""Files that hold one nested record each: manifest and tolerant extraction."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType, StructField, StructType

from trackloom.functions import names, values

# The flat columns of one track record.
RECORD_SCHEMA = StructType(
    [StructField(c, StringType()) for c in ("track_id", "track_name", "artist_name")]
    + [
        StructField(c, DoubleType())
        for c in (
            "duration",
            "tempo",
            "loudness",
            "artist_familiarity",
            "artist_hotttnesss",
            "song_hotttnesss",
        )
    ]
)


def file_manifest(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Every matching file below ``folder``: path, modificationTime, length, content.

    Listing and reading are Spark's; a query that leaves ``content`` out reads no file.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(folder)
    )


def _parsed(files: DataFrame, columns: list[str], id_column: str) -> DataFrame:
    """JSON objects: one text per column, and what could not be parsed as ``error``."""
    texts = StructType([StructField(c, StringType()) for c in [*columns, "_bad"]])
    raw = F.make_valid_utf8(F.col("content").cast("string"))
    record = F.from_json(raw, texts, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    # A generator's rows are made once; the plan would else repeat the parse for every use of its result.
    rows = files.select(id_column, F.explode(F.array(record)).alias("_record"))
    # Of a record that is not an object nothing is known but that.
    bad = F.col("_record").isNull() | F.col("_record._bad").isNotNull()
    error = F.when(bad, F.concat(F.lit("no JSON object: "), F.coalesce(F.substring("_record._bad", 1, 100), F.lit(""))))
    return rows.select(id_column, *[F.when(~bad, F.col(f"_record.`{c}`")).alias(c) for c in columns], error.alias("error"))


def _decoded(files: DataFrame, columns: list[str], id_column: str, decode: Callable[[bytes], dict]) -> DataFrame:
    """As :func:`_parsed`, by a function of the bytes of one file."""
    key = files.schema[id_column]
    output = StructType([key, *[StructField(c, StringType()) for c in [*columns, "error"]]])

    def as_text(value):
        if value is None or isinstance(value, str):
            return value
        return value.decode("utf-8", errors="replace") if isinstance(value, bytes) else str(value)

    def task(batches):
        import pyarrow as pa

        for batch in batches:
            rows = []
            for content in batch.column(1).to_pylist():
                try:
                    record = decode(content)
                    rows.append([*(as_text(record.get(c)) for c in columns), None])
                except Exception as problem:
                    rows.append([None] * len(columns) + [f"{type(problem).__name__}: {problem}"])
            made = [pa.array(c, pa.string()) for c in zip(*rows)] or [pa.array([], pa.string())] * (len(columns) + 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=output.fieldNames())

    return files.mapInArrow(task, output)


def typed_records(rows: DataFrame, schema: StructType = RECORD_SCHEMA, id_column: str = "path") -> DataFrame:
    """Texts of decoded fields in their types, beside ``id_column`` and ``error``.

    A value that does not fit its type becomes NULL, and so do blank text, NaN and infinities.
    """

    def typed(field: StructField) -> Column:
        if isinstance(field.dataType, StringType):
            return names.blank_to_null(F.col(field.name))
        value = F.col(field.name).try_cast(field.dataType)
        return values.finite_or_null(value) if isinstance(field.dataType, (DoubleType, FloatType)) else value

    return rows.select(id_column, *[typed(f).alias(f.name) for f in schema.fields], "error")


def extract_records(
    files: DataFrame,
    schema: StructType = RECORD_SCHEMA,
    decode: Callable[[bytes], dict] | None = None,
    id_column: str = "path",
    partitions: int | None = None,
) -> DataFrame:
    """One flat row per file; a file that cannot be decoded becomes a row with ``error`` set.

    ``files`` has ``id_column`` and ``content``. Records are JSON objects, parsed in the JVM;
    for other formats ``decode`` turns the bytes of one file into a dict. Nothing
    aborts the job and no file is lost: good rows have ``error`` NULL, see
    :func:`good_records` and :func:`rejected_records`. ``partitions`` spreads contents that
    few tasks hold, at the cost of moving them; files are better opened where they are
    decoded, see :mod:`trackloom.sources.packed`.
    """
    columns = schema.fieldNames()
    source = files.select(id_column, "content")
    if partitions:
        source = source.repartition(partitions)
    rows = _decoded(source, columns, id_column, decode) if decode else _parsed(source, columns, id_column)
    return typed_records(rows, schema, id_column)


def good_records(extracted: DataFrame, schema: StructType = RECORD_SCHEMA) -> DataFrame:
    return extracted.filter(extracted["error"].isNull()).select(*schema.fieldNames())


def rejected_records(extracted: DataFrame) -> DataFrame:
    return extracted.filter(extracted["error"].isNotNull()).select(extracted.columns[0], "error")
