"""Incremental and one-off scans of landing folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

FILES_PER_TRIGGER = 10


def _options(fmt: str) -> dict[str, str]:
    return {"csv": {"header": "true"}, "parquet": {"mergeSchema": "true"}}.get(fmt, {})


def infer_schema(spark: SparkSession, path: str, fmt: str) -> StructType:
    """Schema of what is in the folder now: all rows of CSV and JSON, the footers of all Parquet files.

    Infer it once and pass it on where a folder is read more than once.
    """
    reader = spark.read.format(fmt).options(**_options(fmt))
    if fmt == "csv":
        reader = reader.option("inferSchema", "true")
    return reader.load(path).schema


def stream_files(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema: StructType | str | None = None,
    files_per_trigger: int | None = FILES_PER_TRIGGER,
) -> DataFrame:
    """New files of a folder as they arrive, with the file each row came from in `_source_file`."""
    reader = spark.readStream.format(fmt).schema(schema or infer_schema(spark, path, fmt))
    reader = reader.options(**_options(fmt))
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return with_source_file(reader.load(path))


def read_files(spark: SparkSession, path: str, fmt: str, schema: StructType | str | None = None) -> DataFrame:
    reader = spark.read.format(fmt).options(**_options(fmt))
    if schema is not None:
        reader = reader.schema(schema)
    elif fmt == "csv":
        reader = reader.option("inferSchema", "true")
    return with_source_file(reader.load(path))


def with_source_file(scan: DataFrame) -> DataFrame:
    return scan.withColumn("_source_file", F.col("_metadata.file_path"))
