"""Landing files: CSV by header name, JSON by field name, schemas that only widen."""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.operators.unions import same_types, union_all
from marlstone.schemas import INGEST_METADATA, RESCUED, merge_schemas
from marlstone.sources import files


def with_ingest_metadata(df: DataFrame) -> DataFrame:
    """Add the file a row came from, that file's time and the time of ingest."""
    return df.select(
        "*",
        F.col("_metadata.file_name").alias("_source_file"),
        F.col("_metadata.file_modification_time").alias("_source_file_ts"),
        F.current_timestamp().alias("_ingested_at"),
    )


def infer_landing_schema(spark: SparkSession, path: str, format: str) -> T.StructType:
    """Column names and types as found in the files (one pass over them)."""
    reader = spark.read
    if format == "csv":
        reader = reader.option("header", True).option("inferSchema", True)
    return reader.format(format).load(path).schema


def _literal_path(path: str) -> str:
    """The path with characters a glob would interpret taken literally."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def keeping_raw(reader, schema: T.StructType):
    """A batch or stream reader that keeps lines which do not fit the schema in ``_rescued_data``."""
    return reader.schema(T.StructType([*schema.fields, T.StructField(RESCUED, T.StringType())])).option(
        "columnNameOfCorruptRecord", RESCUED)


def csv_headers(spark: SparkSession, paths: Sequence[str], threads: int = 16) -> dict[tuple[str, ...], list[str]]:
    """Group CSV files by their header line.

    Each lookup opens one file and reads its first line, without a Spark job.  The
    caller bounds the number of files (one micro-batch of a file stream).
    """
    def header(path: str) -> tuple[str, ...]:
        line = files.first_line(spark, path).removeprefix("\ufeff")
        return tuple(name or f"_c{i}" for i, name in enumerate(next(csv.reader([line]), [])))

    groups: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(threads) as pool:
        for path, columns in zip(paths, pool.map(header, paths)):
            groups.setdefault(columns, []).append(path)
    return groups


def csv_schema(header: Sequence[str], known: T.StructType) -> T.StructType:
    """Types for one header: known columns as known, new ones as text."""
    types = {field.name.lower(): field for field in known.fields}
    return T.StructType([
        T.StructField(
            types[c.lower()].name if c.lower() in types else c,
            types[c.lower()].dataType if c.lower() in types else T.StringType(),
            True,
        )
        for c in header
    ])


def read_landing_files(
    spark: SparkSession, paths: Sequence[str], format: str, known: T.StructType
) -> tuple[DataFrame, T.StructType]:
    """Rows of these files with ingest metadata, and the widened landing schema.

    CSV columns are matched by header name: files are read in groups of equal
    headers, so reordered or added columns end up where they belong.  A value that
    does not fit its column's type becomes NULL and is left to the quality rules; the
    whole line then stays in ``_rescued_data``, as do lines with too many or too few fields.
    """
    literal = [_literal_path(p) for p in paths]
    if format == "json":
        seen = spark.read.option("columnNameOfCorruptRecord", RESCUED).json(literal).schema
        seen = T.StructType([field for field in seen.fields if field.name != RESCUED])
        widened = merge_schemas(known, seen)
        return with_ingest_metadata(keeping_raw(spark.read, widened).json(literal)), widened
    by_header = csv_headers(spark, paths)
    schemas = {header: csv_schema(header, known) for header in by_header}
    widened = known
    for schema in schemas.values():
        widened = merge_schemas(widened, schema)
    target = T.StructType(widened.fields + INGEST_METADATA.fields)
    parts = [
        with_ingest_metadata(
            keeping_raw(spark.read, schema).option("header", True)
            .csv([_literal_path(p) for p in by_header[header]])
        )
        for header, schema in schemas.items()
    ]
    return union_all(*[same_types(part, target) for part in parts]), widened
