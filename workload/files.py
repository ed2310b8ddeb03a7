"""Source and sink queries: the inputs are written to a fresh shared folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veriflux import schemas
from veriflux.operators import quality
from veriflux.plans import bronze
from veriflux.session import shared_dir
from veriflux.sinks.files import write_csv, write_partitioned
from veriflux.sinks.publish import GatedTable
from veriflux.sources import bus, drift
from veriflux.sources.files import read_files, stream_files
from veriflux.streaming.run import drain, to_files
from workload import inputs
from workload.present import present

# Differs from run to run.
RUN_COLUMNS = (
    "_ingested_at", "_ingested_date", "_processed_at", "_processed_date", "_record_hash", "_source_file",
    "_quarantined_at",
)


def streamed(stream: DataFrame, folder: str) -> DataFrame:
    """Runs the stream over what is there and reads its output."""
    drain(to_files(stream, f"{folder}/out", f"{folder}/checkpoint"))
    return stream.sparkSession.read.parquet(f"{folder}/out")


def src_envelope_parse(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_dir(spark, "envelopes")
    inputs.envelopes(spark, sf).write.parquet(f"{folder}/in")
    rows = streamed(bronze.transactions_raw(bus.replay(spark, f"{folder}/in")), folder)
    return present(rows, drop=RUN_COLUMNS)


def src_parquet_incremental(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_dir(spark, "landing")
    inputs.landing(spark, sf).write.parquet(f"{folder}/in")
    rows = streamed(bronze.transactions_landed(stream_files(spark, f"{folder}/in", "parquet")), folder)
    return present(rows, drop=RUN_COLUMNS)


def src_csv_customers(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_dir(spark, "customers")
    write_csv(inputs.customer_files(spark, sf), f"{folder}/in")
    scan = stream_files(spark, f"{folder}/in", "csv", schemas.CUSTOMER)
    return present(streamed(bronze.customers(scan), folder), drop=RUN_COLUMNS)


def src_csv_merchants(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_dir(spark, "merchants")
    write_csv(inputs.merchant_files(spark, sf), f"{folder}/in")
    scan = stream_files(spark, f"{folder}/in", "csv", schemas.MERCHANT)
    return present(streamed(bronze.merchants(scan), folder), drop=RUN_COLUMNS)


def src_csv_fx(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_dir(spark, "fx")
    records = inputs.fx_records(spark, sf).drop("_ingested_at")
    # A record without a currency is dropped on the way in.
    nameless = records.filter(F.col("currency_code") == "USD").withColumn("currency_code", F.lit(None).cast("string"))
    write_csv(records.unionByName(nameless), f"{folder}/in")
    scan = stream_files(spark, f"{folder}/in", "csv", schemas.FX_RATE)
    return present(streamed(bronze.fx_rates(scan), folder), drop=RUN_COLUMNS)


def src_json_schema(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_dir(spark, "json")
    inputs.messy(spark, sf).select(*inputs.TXN_COLUMNS).write.json(f"{folder}/in")
    scan = stream_files(spark, f"{folder}/in", "json", schemas.TRANSACTION)
    rows = streamed(bronze.dead_letter(scan), folder)
    return present(rows.select("transaction_id", "merchant_id", "amount", "timestamp", "_quarantine_reason"))


def src_schema_drift(spark: SparkSession, sf: str) -> DataFrame:
    """The second file brings two fields that the schema does not name, and some cut-off lines."""
    folder = shared_dir(spark, "drift")
    rows = inputs.transactions(spark, sf)
    first = F.col("offset") % 2 == 0
    rows.filter(first).select(*inputs.TXN_COLUMNS).coalesce(1).write.mode("append").json(f"{folder}/in")
    more = F.struct((F.col("offset") % 7).alias("points"), F.concat(F.lit("T"), (F.col("offset") % 3).cast("string")).alias("tier"))
    wider = rows.filter(~first).select(F.col("offset"), F.to_json(F.struct(
        *inputs.TXN_COLUMNS, (F.col("offset") / F.lit(4.0)).alias("fee"), F.when(F.col("offset") % 5 == 0, more).alias("loyalty"))).alias("value"))
    cut = F.when(F.col("offset") % 50 == 1, F.substring("value", 1, 20)).otherwise(F.col("value"))
    wider.select(cut.alias("value")).coalesce(1).write.mode("append").text(f"{folder}/in")
    found = streamed(drift.stream_json(spark, f"{folder}/in", schemas.TRANSACTION, 1), folder)
    return found.select(
        "transaction_id", "amount", drift.unknown("fee", "double").alias("fee"), drift.unknown("loyalty.points", "bigint").alias("points"),
        drift.unknown("loyalty.tier", "string").alias("tier"), F.col("_corrupt_record"),
    )


def gate_publish(spark: SparkSession, sf: str) -> DataFrame:
    """Two of the days hold too many bad amounts; a second delivery mends one of them."""
    folder = shared_dir(spark, "gate")
    rows = inputs.transactions(spark, sf).select(*inputs.TXN_COLUMNS, "offset")
    day = F.dayofmonth("transaction_date")
    damaged = rows.withColumn("amount", F.when(day.isin(5, 12) & (F.col("offset") % 3 == 0), F.lit(-1.0)).otherwise(F.col("amount") + 1))
    table = GatedTable(spark, folder.rsplit("/", 1)[-1].replace("-", "_"), folder)
    rules = {"amount_positive": quality.BRONZE_RULES["amount_positive"]}
    table.publish(damaged.drop("offset"), "first", rules, 5.0)
    table.publish(rows.filter(day == 12).drop("offset"), "second", rules, 5.0)
    kept = table.staged("first").filter(day == 5)
    columns = ["transaction_id", "transaction_date", "amount"]
    return present(table.table().select(*columns, F.lit(True).alias("published")).unionByName(kept.select(*columns, F.lit(False).alias("published"))))


def src_file_lineage(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_dir(spark, "lineage")
    write_partitioned(inputs.landing(spark, sf), f"{folder}/in", ["currency"])
    rows = read_files(spark, f"{folder}/in", "parquet")
    return rows.select(
        "transaction_id", F.regexp_extract("_source_file", "currency=([A-Z]+)/", 1).alias("folder_currency")
    )


def src_partition_pruned(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_dir(spark, "pruned")
    write_partitioned(inputs.landing(spark, sf), f"{folder}/in", ["transaction_date"])
    rows = spark.read.parquet(f"{folder}/in").filter(F.col("transaction_date") >= F.lit("2024-01-20").cast("date"))
    return present(rows.select("transaction_id", "transaction_date", "amount"))


def sink_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_dir(spark, "csv")
    rows = inputs.merchant_files(spark, sf)
    write_csv(rows, f"{folder}/out")
    return present(read_files(spark, f"{folder}/out", "csv", schemas.MERCHANT), drop=RUN_COLUMNS)


def sink_parquet_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_dir(spark, "parquet")
    rows = inputs.landing(spark, sf)
    # Written twice: a re-run replaces its partitions instead of adding to them.
    for _ in range(2):
        write_partitioned(rows, f"{folder}/out", ["transaction_date"])
    return present(spark.read.parquet(f"{folder}/out"))


def sink_envelope_encode(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_dir(spark, "messages")
    bus.pack(inputs.landing(spark, sf)).write.parquet(f"{folder}/out")
    body = F.from_json(F.col("value").cast("string"), schemas.TRANSACTION)
    rows = spark.read.parquet(f"{folder}/out").select(F.col("key").cast("string").alias("message_key"), body.alias("b"))
    return rows.select("message_key", "b.transaction_id", "b.customer_id", "b.amount", "b.timestamp", "b.is_fraud")


QUERIES = {
    f.__name__: f
    for f in (
        src_envelope_parse, src_parquet_incremental, src_csv_customers, src_csv_merchants, src_csv_fx,
        src_json_schema, src_schema_drift, gate_publish, src_file_lineage, src_partition_pruned, sink_csv_roundtrip, sink_parquet_partitioned,
        sink_envelope_encode,
    )
}
