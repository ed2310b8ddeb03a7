"""Tables that several steps of one operator read."""

from __future__ import annotations

from pyspark.sql import DataFrame

from veriflux.session import shared_dir


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Writes a frame below spark.checkpoint.dir and reads it back; its lineage ends there."""
    folder = shared_dir(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
