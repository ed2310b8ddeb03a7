"""Pipeline health and volume anomalies."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veriflux.functions import bands
from veriflux.functions.times import minutes_between
from veriflux.params import RiskParams, now_like


def layer_health(layer: str, rows: DataFrame, time_column: str, params: RiskParams = RiskParams()) -> DataFrame:
    """Row count, age range and lag of one layer; no row when the layer is empty."""
    return (
        rows.groupBy(F.lit(layer).alias("layer_table"))
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.min(time_column).alias("oldest_record"),
            F.max(time_column).alias("newest_record"),
        )
        .withColumn("lag_minutes", minutes_between(F.col("newest_record"), now_like(rows, time_column, params)))
    )


def pipeline_health(
    bronze: DataFrame,
    silver: DataFrame,
    alerts: DataFrame,
    params: RiskParams = RiskParams(),
    bronze_time: str = "_ingested_at",
    silver_time: str = "_processed_at",
    alert_time: str = "alert_generated_at",
) -> DataFrame:
    layers = [
        layer_health("bronze_transactions", bronze, bronze_time, params),
        layer_health("silver_transactions", silver, silver_time, params),
        layer_health("gold_fraud_alerts", alerts, alert_time, params),
    ]
    lag_steps = ((params.lag_critical_minutes, "CRITICAL"), (params.lag_warning_minutes, "WARNING"))
    return reduce(DataFrame.unionByName, layers).withColumns({
        "computed_at": F.current_timestamp(),
        "health_status": bands.above(F.col("lag_minutes"), lag_steps, "HEALTHY"),
    })


FOOTERS = {"spark.sql.parquet.aggregatePushdown": "true", "spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text"}
MICROS = "_event_us"


def with_micros(rows: DataFrame, time_column: str) -> DataFrame:
    """Adds the time as microseconds. Parquet footers hold least and greatest values of numbers, not of times."""
    return rows.withColumn(MICROS, F.unix_micros(F.col(time_column).cast("timestamp")))


@contextmanager
def from_footers(spark: SparkSession) -> Iterator[None]:
    """Counts, least and greatest values of Parquet scans come from the footers alone."""
    before = {key: spark.conf.get(key) for key in FOOTERS}
    try:
        for key, value in FOOTERS.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def footer_counts(spark: SparkSession, path: str) -> DataFrame:
    """Rows, oldest and newest time of a stored layer (with `with_micros`). Plan and run it within `from_footers`."""
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("row_count"), F.min(MICROS).alias("oldest"), F.max(MICROS).alias("newest"))


def stored_health(spark: SparkSession, layers: Mapping[str, str], params: RiskParams = RiskParams()) -> DataFrame:
    """The columns of `pipeline_health` for stored layers (name to path), from file metadata: no row is read. One row per layer
    reaches the driver; an empty layer has none."""
    with from_footers(spark):
        found = [(name, *footer_counts(spark, path).first()) for name, path in layers.items()]
    rows = spark.createDataFrame([r for r in found if r[1]], "layer_table string, row_count bigint, oldest bigint, newest bigint")
    timed = rows.select("layer_table", "row_count", F.timestamp_micros("oldest").alias("oldest_record"), F.timestamp_micros("newest").alias("newest_record"))
    lag = minutes_between(F.col("newest_record"), now_like(timed, "newest_record", params))
    lag_steps = ((params.lag_critical_minutes, "CRITICAL"), (params.lag_warning_minutes, "WARNING"))
    return timed.withColumn("lag_minutes", lag).withColumns({
        "computed_at": F.current_timestamp(), "health_status": bands.above(F.col("lag_minutes"), lag_steps, "HEALTHY"),
    })


def daily_totals(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy("transaction_date").agg(
        F.count(F.lit(1)).alias("txn_count"),
        F.sum("amount").alias("total_amount"),
        F.avg("amount").alias("avg_amount"),
        F.countDistinct("customer_id").alias("unique_customers"),
    )


def rolling(daily: DataFrame, params: RiskParams = RiskParams()) -> DataFrame:
    """Rolling mean and deviation over calendar rows.

    The window has no partition key, which is safe here only: its input has one row per day.
    """
    days = params.rolling_days
    frame = (-days, -1) if params.trailing_frame else (1 - days, 0)
    window = Window.orderBy("transaction_date").rowsBetween(*frame)
    return daily.withColumns({
        f"rolling_{name}_{measure}": aggregate(measure).over(window)
        for measure in ("txn_count", "total_amount")
        for name, aggregate in (("avg", F.avg), ("stddev", F.stddev_samp))
    })


def daily_anomalies(transactions: DataFrame, params: RiskParams = RiskParams()) -> DataFrame:
    """Days whose volume or value is far from the rolling mean."""

    def z_score(measure: str):
        # A frame without spread counts as spread 1, like a frame of a single day.
        spread = F.coalesce(F.nullif(f"rolling_stddev_{measure}", F.lit(0.0)), F.lit(1.0))
        return (F.col(measure) - F.col(f"rolling_avg_{measure}")) / spread

    count_z, amount_z = F.abs("txn_count_z_score"), F.abs("total_amount_z_score")
    return (
        rolling(daily_totals(transactions), params)
        .withColumns({
            "txn_count_z_score": z_score("txn_count"),
            "total_amount_z_score": z_score("total_amount"),
        })
        .withColumns({
            "is_anomaly": (count_z > params.anomaly_z) | (amount_z > params.anomaly_z),
            "anomaly_severity": bands.above(
                count_z, ((params.critical_z, "CRITICAL"), (params.anomaly_z, "HIGH")), "NORMAL"
            ),
            "computed_at": F.current_timestamp(),
        })
    )
