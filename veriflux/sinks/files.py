"""File and table writers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

RECORDS_PER_FILE = 5_000_000


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header. `single_file` funnels the rows through one task: for small extracts only."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", "true").csv(path)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Parquet laid out by the `by` columns.

    The rebalance hint gathers each partition value and lets AQE cut values that are too large for one
    task, so one big day becomes several files rather than one straggler. Re-runs replace only the
    partitions they write.
    """
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .partitionBy(*by)
        .parquet(path)
    )


# The three layers and their descriptions.
LAYERS = {
    "bronze": "Raw ingested data",
    "silver": "Cleaned and CDC-processed data",
    "gold": "Fraud analytics aggregates",
}


def create_layers(spark: SparkSession, layers: Mapping[str, str] = LAYERS) -> DataFrame:
    """Creates the layer databases and returns the list of databases."""
    for name, comment in layers.items():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} COMMENT '{comment}'")
    return spark.sql("SHOW DATABASES")


def save_table(df: DataFrame, name: str, by: Sequence[str] = ()) -> DataFrame:
    """Materializes a dataset as a Parquet table and returns it as stored."""
    rows = df.hint("rebalance", *by) if by else df
    writer = rows.write.mode("overwrite").format("parquet").option("maxRecordsPerFile", RECORDS_PER_FILE)
    (writer.partitionBy(*by) if by else writer).saveAsTable(name)
    return df.sparkSession.table(name)
