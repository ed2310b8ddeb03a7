"""Batch queries: one function per key, (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veriflux.functions import bands, geo, times
from veriflux.functions.hashing import null_safe_hash
from veriflux.operators import audit, cdc, quality
from veriflux.operators.merge import Scd1Table, Scd2Table, buckets_for
from veriflux.operators.ordered import OrderedRows, SkewPolicy
from veriflux.params import RiskParams
from veriflux.plans import bronze, gold, monitoring, partials, silver
from veriflux.plans.refresh import name_views
from veriflux.session import shared_dir
from workload import inputs
from workload.inputs import AS_OF, LATER
from workload.present import present

PARAMS = RiskParams(as_of=AS_OF)
TRANSACTION_TABLE_COLUMNS = (
    "transaction_id", "customer_id", "amount", "currency", "transaction_date", "transaction_status",
    "device_id", "fraud_score", "event_timestamp",
)


# ---- scalar functions ---------------------------------------------------------------------------


def risk_band(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.messy(spark, sf).select("offset", bands.risk_band(F.col("fraud_score")).alias("risk_band"))


def amount_band(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.messy(spark, sf).select("offset", bands.amount_band(F.col("amount")).alias("amount_band"))


def high_risk_merchant(spark: SparkSession, sf: str) -> DataFrame:
    flag = bands.is_high_risk_category(F.col("merchant_category"))
    return inputs.transactions(spark, sf).select("transaction_id", flag.alias("is_high_risk_merchant"))


def scalar_json(spark: SparkSession, sf: str) -> DataFrame:
    events = inputs.table(spark, sf, "events")
    return events.select(
        "event_id",
        F.from_json("props", "k INT")["k"].cast("bigint").alias("k"),
        F.to_json(F.struct("event_id", "event_type")).alias("body"),
        F.from_json(F.concat(F.lit("{{"), "props"), "k INT")["k"].isNull().alias("malformed_is_null"),
    )


def scalar_string(spark: SparkSession, sf: str) -> DataFrame:
    rows = inputs.messy(spark, sf)
    return rows.select(
        "offset",
        F.concat(F.lit("ALERT_"), "transaction_id").alias("concat"),
        F.concat_ws(" | ", "transaction_id", "customer_id", "location_city").alias("concat_ws"),
        F.upper("currency").alias("upper"),
        F.concat_ws("|", F.array("device_id", "device_type", "ip_address")).alias("joined_list"),
        F.get(F.split(F.concat_ws("|", F.array("device_id", "ip_address")), r"\|"), F.lit(1)).alias("second_item"),
    )


def scalar_cast(spark: SparkSession, sf: str) -> DataFrame:
    rows = inputs.transactions(spark, sf)
    return present(rows.select(
        "transaction_id",
        F.col("amount").cast("string").alias("to_string"),
        times.parse_timestamp(F.col("timestamp")).alias("to_timestamp"),
        times.parse_date(F.col("transaction_date").cast("string")).alias("to_date"),
        F.col("offset").cast("string").cast("long").alias("to_long"),
        F.col("fraud_score").cast("string").cast("double").alias("to_double"),
        times.parse_timestamp(F.col("device_id")).isNull().alias("bad_timestamp_is_null"),
    ))


def scalar_date(spark: SparkSession, sf: str) -> DataFrame:
    rows = inputs.transactions(spark, sf).withColumn("ts", F.to_timestamp("timestamp"))
    ts = F.col("ts")
    parts = times.calendar_parts(ts)
    window = F.window("ts", "60 minutes")
    as_of = F.lit(AS_OF).cast("timestamp")
    return present(rows.select(
        "transaction_id", "ts",
        F.date_trunc("hour", ts).alias("hour_start"),
        times.minutes_between(ts, as_of).alias("minutes_to_as_of"),
        F.unix_timestamp(ts).alias("epoch_seconds"),
        (ts + F.expr("INTERVAL 6 HOURS")).alias("plus_6h"),
        window["start"].alias("window_start"), window["end"].alias("window_end"),
        *[column.alias(name) for name, column in parts.items()],
        (F.current_timestamp() >= ts).alias("in_the_past"),
        (F.current_date() >= ts.cast("date")).alias("not_after_today"),
    ))


def scalar_math(spark: SparkSession, sf: str) -> DataFrame:
    rows = inputs.transactions(spark, sf)
    lat, lon = F.col("latitude"), F.col("longitude")
    pune = (F.lit(18.52), F.lit(73.86))
    return present(rows.select(
        "transaction_id",
        F.radians(lat).alias("radians"),
        F.sin(F.radians(lat)).alias("sin"),
        F.cos(F.radians(lat)).alias("cos"),
        F.asin(F.col("fraud_score")).alias("asin"),
        F.sqrt("amount").alias("sqrt"),
        F.pow("fraud_score", F.lit(2)).alias("pow"),
        geo.haversine_km(*pune, lat, lon).alias("km_asin"),
        geo.haversine_km_atan2(*pune, lat, lon).alias("km_atan2"),
        F.abs(F.lit(5000) - F.col("amount")).alias("abs"),
        F.round(F.col("amount") / 7, 2).alias("round"),
        F.least(F.lit(1.0), F.col("fraud_score") * 2, F.lit(None).cast("double")).alias("least"),
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col("amount") - 3000) / 4096)).alias("clamped"),
    ), digits={c: 9 for c in ("radians", "sin", "cos", "asin", "sqrt")} | {"km_asin": 4, "km_atan2": 4})


def scalar_conditional(spark: SparkSession, sf: str) -> DataFrame:
    rows = inputs.messy(spark, sf)
    return rows.select(
        "offset",
        F.when(F.col("amount") > 1000, "big").when(F.col("amount").isNull(), "none").otherwise("small").alias("case"),
        F.coalesce("amount", F.lit(0.0)).alias("coalesce"),
        F.nullif("currency", F.lit("INR")).alias("nullif"),
        F.col("transaction_id").isNull().alias("is_null"),
        F.col("device_type").isNotNull().alias("is_not_null"),
        F.col("currency").isin("INR", "USD").alias("in_set"),
        F.col("amount").between(9000, 9999).alias("between"),
    )


def scalar_array(spark: SparkSession, sf: str) -> DataFrame:
    rows = inputs.messy(spark, sf)
    marks = F.array(
        F.when(F.col("amount") > 5000, F.lit("BIG")),
        F.when(F.col("fraud_score") > 0.5, F.concat(F.lit("SCORE:"), F.col("fraud_score").cast("string"))),
        F.col("device_type"),
    )
    return present(rows.select("offset", marks.alias("marks"), F.size(marks).alias("n_marks")))


# ---- ingestion and quality ----------------------------------------------------------------------


def bronze_enrich(spark: SparkSession, sf: str) -> DataFrame:
    rows = audit.type_event_time(audit.stamp_ingestion(inputs.landing(spark, sf), "S3_AUTO_LOADER"))
    return present(rows, drop=("_ingested_at", "_ingested_date"))


def audit_columns(spark: SparkSession, sf: str) -> DataFrame:
    rows = audit.add_audit_columns(inputs.landing(spark, sf), "BRONZE", bronze.PIPELINE)
    return rows.groupBy("_layer", "_pipeline_name").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.countDistinct("_record_hash").alias("distinct_hashes"),
        F.count_if(F.col("_processed_at").isNull() | F.col("_processed_date").isNull()).alias("missing_times"),
    )


def change_hash(spark: SparkSession, sf: str) -> DataFrame:
    changes = inputs.customer_changes(spark, sf).select(
        "customer_id", "changed_at", "change_id", null_safe_hash("kyc_status", "city", "risk_score").alias("hash"),
    )
    rows = OrderedRows(changes, ["customer_id"], ["changed_at", "change_id"]).previous(["hash"]).result()
    return rows.select("customer_id", "change_id", cdc.changed(F.col("prev_hash"), F.col("hash")).alias("changed"))


def dead_letter(spark: SparkSession, sf: str) -> DataFrame:
    rejected = bronze.dead_letter(inputs.messy(spark, sf))
    return rejected.select("offset", "transaction_id", "customer_id", "amount", "_quarantine_reason", "_layer")


def expect_track(spark: SparkSession, sf: str) -> DataFrame:
    tracked, _ = quality.track(inputs.messy(spark, sf), quality.BRONZE_RULES)
    return present(quality.annotate(tracked, quality.BRONZE_RULES).select("offset", "_violations"))


def expect_drop(spark: SparkSession, sf: str) -> DataFrame:
    rules = {**quality.CUSTOMER_DROP_RULES, **quality.BRONZE_RULES}
    return quality.drop_violations(inputs.messy(spark, sf), rules).select("offset", "transaction_id", "amount")


def expect_fail(spark: SparkSession, sf: str) -> DataFrame:
    checked = quality.fail_on_violation(inputs.transactions(spark, sf), quality.ALERT_FAIL_RULES)
    return checked.select("transaction_id", "fraud_score")


def silver_rules(spark: SparkSession, sf: str) -> DataFrame:
    rows = quality.annotate(inputs.messy(spark, sf), quality.silver_rules(AS_OF))
    return present(rows.select("offset", "_violations"))


def gold_rules(spark: SparkSession, sf: str) -> DataFrame:
    rows = quality.annotate(customer_profiles(spark, sf), quality.gold_rules())
    return present(rows.select("customer_id", "_violations"))


def dq_report(spark: SparkSession, sf: str) -> DataFrame:
    return quality.report(inputs.messy(spark, sf), {**quality.BRONZE_RULES, **quality.silver_rules(AS_OF)})


def null_rate_gate(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["transaction_id", "customer_id", "amount", "timestamp", "device_type", "fraud_type", "currency"]
    return quality.null_rates(inputs.messy(spark, sf), columns, PARAMS.max_null_pct)


# ---- change data --------------------------------------------------------------------------------


def scd1_transactions(spark: SparkSession, sf: str) -> DataFrame:
    table = silver.transactions_cleaned(inputs.transaction_changes(spark, sf), ["offset"], unique_sequence=True)
    return present(table.select(*TRANSACTION_TABLE_COLUMNS))


def scd1_merchants(spark: SparkSession, sf: str) -> DataFrame:
    return present(silver.merchants_current(inputs.merchant_changes(spark, sf), ["seq"]))


def _customer_history(spark: SparkSession, sf: str) -> DataFrame:
    return silver.customers_history(inputs.customer_changes(spark, sf), ["changed_at", "change_id"])


def scd2_customers(spark: SparkSession, sf: str) -> DataFrame:
    return present(_customer_history(spark, sf))


def scd2_current(spark: SparkSession, sf: str) -> DataFrame:
    return present(cdc.current_versions(_customer_history(spark, sf)))


def dedup_exact(spark: SparkSession, sf: str) -> DataFrame:
    lines = inputs.table(spark, sf, "lineitem")
    order = [
        "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus",
    ]
    return present(cdc.drop_duplicates(lines, ["l_orderkey", "l_linenumber"], first_by=order))


def unified(spark: SparkSession, sf: str) -> DataFrame:
    live = silver.transactions_cleaned(inputs.transaction_changes(spark, sf), ["offset"], unique_sequence=True)
    both = silver.transactions_unified(live, _landed_cleaned(spark, sf))
    return present(both.select(
        "transaction_id", "amount", "amount_usd", "transaction_status", "event_timestamp", "risk_band",
        "_processing_path",
    ))


# ---- silver -------------------------------------------------------------------------------------


def fx_join(spark: SparkSession, sf: str) -> DataFrame:
    rates = silver.exchange_rates(inputs.fx_records(spark, sf))
    rows = silver.with_usd_amount(inputs.transactions(spark, sf), rates)
    return rows.select("transaction_id", "currency", "amount", "amount_usd")


def fx_join_salted(spark: SparkSession, sf: str) -> DataFrame:
    """The same with a rate table that is too large to broadcast: currencies with most rows are spread over several tasks."""
    rates = silver.exchange_rates(inputs.fx_records(spark, sf))
    rows = silver.with_usd_amount(inputs.transactions(spark, sf), rates, max_broadcast_rows=0, rows_per_task=100)
    return rows.select("transaction_id", "currency", "amount", "amount_usd")


def silver_enriched(spark: SparkSession, sf: str) -> DataFrame:
    rates = silver.exchange_rates(inputs.fx_records(spark, sf))
    rows = silver.transactions_enriched(inputs.transactions(spark, sf), rates)
    return present(rows.select(
        "transaction_id", "customer_id", "amount", "amount_usd", "risk_band", "amount_band",
        "is_high_risk_merchant", "event_timestamp", "_layer",
    ))


def _landed_cleaned(spark: SparkSession, sf: str) -> DataFrame:
    rows = inputs.messy(spark, sf)
    # Files that were delivered twice.
    return silver.transactions_landed_cleaned(rows.unionByName(rows), AS_OF, first_by=["offset"])


def silver_s3_cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return present(_landed_cleaned(spark, sf).select(
        "transaction_id", "customer_id", "amount_usd", "currency", "risk_band", "_processing_path",
        "event_timestamp", "_layer",
    ))


# ---- gold ---------------------------------------------------------------------------------------


def lookback_filter(spark: SparkSession, sf: str) -> DataFrame:
    rows = gold.recent(inputs.transactions(spark, sf), RiskParams(as_of=LATER))
    return present(rows.select("transaction_id", "event_timestamp"))


def _alerts(spark: SparkSession, sf: str) -> DataFrame:
    return gold.fraud_alerts(inputs.transactions(spark, sf), PARAMS)


def fraud_alerts(spark: SparkSession, sf: str) -> DataFrame:
    return present(_alerts(spark, sf))


def velocity_hourly(spark: SparkSession, sf: str) -> DataFrame:
    return present(gold.velocity(inputs.transactions(spark, sf), PARAMS))


def velocity_daily(spark: SparkSession, sf: str) -> DataFrame:
    """Busy groups: customers folded to fifteen, counted per day, so that every score step occurs."""
    number = F.substring_index("customer_id", "_", -1).cast("bigint")
    rows = inputs.transactions(spark, sf).withColumn("customer_group", number % 15)
    return present(gold.velocity(rows, PARAMS, unit="day", key="customer_group"))


def velocity_tumbling(spark: SparkSession, sf: str) -> DataFrame:
    number = F.substring_index("customer_id", "_", -1).cast("bigint")
    rows = inputs.transactions(spark, sf).withColumn("customer_id", number % 3)
    return present(gold.velocity_windows(rows, RiskParams(velocity_window="720 minutes", velocity_window_limit=6)))


def lag_previous_txn(spark: SparkSession, sf: str) -> DataFrame:
    rows = gold.with_previous(inputs.transactions(spark, sf).select("customer_id", *gold.TRAVEL_STATE))
    return present(rows.select("customer_id", "transaction_id", *[f"prev_{c}" for c in gold.TRAVEL_STATE]))


def impossible_travel(spark: SparkSession, sf: str) -> DataFrame:
    return present(gold.impossible_travel(inputs.transactions(spark, sf), PARAMS))


def merchant_scores(spark: SparkSession, sf: str) -> DataFrame:
    return present(gold.merchant_scores(inputs.transactions(spark, sf), inputs.merchants(spark, sf), PARAMS))


def top_merchants(spark: SparkSession, sf: str) -> DataFrame:
    return gold.top_merchants(merchant_scores(spark, sf), 20)


def customer_stats_30d(spark: SparkSession, sf: str) -> DataFrame:
    return present(gold.customer_stats(inputs.transactions(spark, sf), PARAMS), {"txn_amount_stddev": 6})


def customer_stats_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """From day partials: stored for all days, then, as if late rows had come, again for some. Distinct counts are estimates;
    listed is whether each lies within five percent of the exact count."""
    folder = shared_dir(spark, "partials")
    rows = inputs.transactions(spark, sf)
    late = (F.col("offset") % 9 == 4) & (F.dayofmonth("transaction_date") < 4)
    partials.refresh_days(rows.filter(~late), folder, PARAMS)
    partials.refresh_days(rows, folder, PARAMS, ["2024-01-01", "2024-01-02", "2024-01-03"])
    stats = partials.customer_stats(spark.read.parquet(folder), rows, PARAMS)
    exact = gold.customer_stats(rows, PARAMS).select(F.col("customer_id").alias("_customer"), *[F.col(c).alias(f"_{c}") for c in partials.DISTINCT])
    found = stats.join(exact, F.col("customer_id").eqNullSafe(F.col("_customer"))).drop("_customer")
    close = {c: F.abs(F.col(c) - F.col(f"_{c}")) <= F.col(f"_{c}") * 0.05 for c in partials.DISTINCT}
    return present(found.withColumns(close).drop(*[f"_{c}" for c in close]), {"txn_amount_stddev": 6})


def customer_profiles(spark: SparkSession, sf: str) -> DataFrame:
    current = cdc.current_versions(_customer_history(spark, sf))
    profiles = gold.customer_profiles(inputs.transactions(spark, sf), current, PARAMS)
    return present(profiles, {"txn_amount_stddev": 6})


def aml_structuring(spark: SparkSession, sf: str) -> DataFrame:
    return gold.aml_structuring(inputs.transactions(spark, sf), PARAMS)


def ops_kpis(spark: SparkSession, sf: str) -> DataFrame:
    return present(gold.ops_kpis(inputs.transactions(spark, sf)))


def fraud_hotspots(spark: SparkSession, sf: str) -> DataFrame:
    return gold.fraud_hotspots(_alerts(spark, sf))


def fraud_type_mix(spark: SparkSession, sf: str) -> DataFrame:
    return gold.fraud_type_mix(_alerts(spark, sf))


def fraud_clusters(spark: SparkSession, sf: str) -> DataFrame:
    params = RiskParams(as_of=AS_OF, velocity_fraud_types=("VELOCITY", "VELOCITY_FRAUD"))
    return present(gold.fraud_clusters(_alerts(spark, sf), params))


# ---- monitoring ---------------------------------------------------------------------------------

Z_COLUMNS = {
    "rolling_stddev_txn_count": 6, "rolling_stddev_total_amount": 6,
    "txn_count_z_score": 6, "total_amount_z_score": 6,
}
ROLLING_COLUMNS = {k: v for k, v in Z_COLUMNS.items() if k.startswith("rolling")}


def daily_totals(spark: SparkSession, sf: str) -> DataFrame:
    return present(monitoring.daily_totals(inputs.transactions(spark, sf)))


def rolling_7d(spark: SparkSession, sf: str) -> DataFrame:
    return present(monitoring.rolling(monitoring.daily_totals(inputs.transactions(spark, sf))), ROLLING_COLUMNS)


def daily_anomaly(spark: SparkSession, sf: str) -> DataFrame:
    params = RiskParams(anomaly_z=1.5, critical_z=2)
    return present(monitoring.daily_anomalies(inputs.transactions(spark, sf), params), Z_COLUMNS)


def pipeline_health(spark: SparkSession, sf: str) -> DataFrame:
    rows = inputs.transactions(spark, sf)
    health = monitoring.pipeline_health(
        rows, rows.filter(F.col("transaction_status") == "FAILED"), _alerts(spark, sf), PARAMS,
        bronze_time="event_timestamp", silver_time="event_timestamp", alert_time="event_timestamp",
    )
    return present(health)


# ---- edge cases of cleaning and merging ---------------------------------------------------------


def silver_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Landed rows once: the cleaned ones, and those without an id, which cleaning sets aside."""
    rows = inputs.messy(spark, sf)
    kept = silver.transactions_landed_cleaned(rows.unionByName(rows), AS_OF, first_by=["offset"], quarantine=True)
    aside = silver.unkeyed(rows)
    return kept.select("offset", F.lit(False).alias("quarantined")).unionByName(aside.select("offset", F.lit(True).alias("quarantined")))


def scd1_ties(spark: SparkSession, sf: str) -> DataFrame:
    """Two different records of a transaction share their sequence: all columns come from the same one."""
    rows = inputs.transactions(spark, sf)
    other = rows.withColumns({"amount": F.col("amount") + 1, "device_type": F.lit("POS")})
    both = rows.unionByName(other).withColumn("device_id", F.concat_ws(":", F.col("amount").cast("string"), "device_type"))
    table = silver.transactions_cleaned(both, ["offset"])
    whole = F.col("device_id") == F.concat_ws(":", F.col("amount").cast("string"), "device_type")
    return table.select("transaction_id", whole.alias("one_record"))


def scd1_two_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """The topic is partitioned anew before the last records come: their offsets are lower than those before."""
    o, step = F.floor(F.col("offset") / 3), F.col("offset") % 3
    rows = inputs.transaction_changes(spark, sf).withColumns({
        "_kafka_partition": (o % 3 + F.when(step == 2, 10).otherwise(0)).cast("int"),
        "_kafka_offset": F.when(step == 2, o).otherwise(100_000_000 + o * 2 + step),
    })
    before = rows.filter(step < 2)
    marks = silver.next_epoch(silver.first_epoch(before), before, fresh=[10, 11, 12])
    ordered = silver.topic_epochs(rows, marks).drop("offset")
    table = silver.transactions_cleaned(ordered, ["_epoch", "_kafka_offset"])
    return present(table.select(*TRANSACTION_TABLE_COLUMNS))


def scd1_deletes(spark: SparkSession, sf: str) -> DataFrame:
    """Some records delete their transaction; a later one brings it back with what is known since."""
    rows = inputs.transaction_changes(spark, sf).select("transaction_id", "amount", "device_id", "offset")
    return cdc.scd1(rows, ["transaction_id"], ["offset"], exclude=["offset"], delete_when=F.col("offset") % 11 == 5, unique_sequence=True)


def scd2_customers_hot(spark: SparkSession, sf: str) -> DataFrame:
    """Histories with most customers treated as hot keys, whose records are cut into slices."""
    rows = inputs.customer_changes(spark, sf)
    return present(silver.customers_history(rows, ["changed_at", "change_id"], SkewPolicy(hot_rows=8)))


def fx_ties(spark: SparkSession, sf: str) -> DataFrame:
    """All rates of a currency and day were ingested together."""
    rates = silver.exchange_rates(inputs.fx_records(spark, sf).withColumn("_ingested_at", F.lit(1)))
    return present(rates)


def bronze_zone(spark: SparkSession, sf: str) -> DataFrame:
    """Times with no offset, with Z, with an offset and with a named zone; the first are local times of the source."""
    behind = F.get(F.array(F.lit(""), F.lit("Z"), F.lit("+05:30"), F.lit(" Europe/Paris")), (F.col("offset") % 4).cast("int"))
    rows = inputs.transactions(spark, sf).withColumn("timestamp", F.concat("timestamp", behind)).drop("event_timestamp")
    return present(audit.type_event_time(rows, "Asia/Kolkata").select("transaction_id", "event_timestamp"))


def unified_travel(spark: SparkSession, sf: str) -> DataFrame:
    """Live and landed copies of each transaction differ in their amounts; their pairs are those of one copy."""
    rows = inputs.transactions(spark, sf)
    both = silver.transactions_unified(rows.withColumn("amount", F.col("amount") + 1), rows.drop("offset"))
    return present(gold.impossible_travel(both, PARAMS).drop("amount"))


def sql_over_layers(spark: SparkSession, sf: str) -> DataFrame:
    """SQL through the names of layers."""
    rates = silver.exchange_rates(inputs.fx_records(spark, sf))
    enriched = silver.transactions_enriched(inputs.transactions(spark, sf), rates)
    name_views({"transactions_enriched": enriched}, "layers_")
    return spark.sql("""SELECT currency, risk_band, count(*) AS txn_count, count_if(is_high_risk_merchant) AS high_risk
        FROM layers_transactions_enriched GROUP BY currency, risk_band""")


def refresh_health(spark: SparkSession, sf: str) -> DataFrame:
    """Health of stored layers, from the footers of their files."""
    folder = shared_dir(spark, "health")
    rows = inputs.messy(spark, sf)
    layers = {
        "bronze_transactions": rows,
        "silver_transactions": silver.transactions_landed_cleaned(rows, AS_OF, first_by=["offset"], quarantine=True),
        "gold_fraud_alerts": gold.fraud_alerts(inputs.transactions(spark, sf), PARAMS),
    }
    for name, layer in layers.items():
        monitoring.with_micros(layer, "event_timestamp").write.parquet(f"{folder}/{name}")
    return present(monitoring.stored_health(spark, {name: f"{folder}/{name}" for name in layers}, PARAMS))


# ---- tables that take deliveries ----------------------------------------------------------------


def _delivered(table: Scd1Table | Scd2Table, changes: DataFrame, number: str, deliveries: int = 4) -> None:
    """Applies the change records in parts that know no order; the first one creates the table."""
    rows = changes.withColumn("_part_no", F.pmod(F.xxhash64(number), F.lit(deliveries))).persist()
    for k in range(deliveries):
        table.apply(rows.filter(F.col("_part_no") == k).drop("_part_no"))
    rows.unpersist()


def _table_name(folder: str) -> str:
    return folder.rsplit("/", 1)[-1].replace("-", "_")


def scd2_merge_incremental(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_dir(spark, "history")
    changes = inputs.customer_changes(spark, sf)
    table = Scd2Table(
        spark, _table_name(folder), ["customer_id"], ["changed_at", "change_id"], silver.CUSTOMER_HISTORY, parts=4,
        buckets=buckets_for(spark, changes.count()), path=folder)
    _delivered(table, changes, "change_id")
    return present(table.history())


def scd1_merge_incremental(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_dir(spark, "current")
    exclude = [*silver.TRANSPORT_COLUMNS, "offset"]
    changes = inputs.transaction_changes(spark, sf)
    buckets = buckets_for(spark, changes.count())
    table = Scd1Table(spark, _table_name(folder), ["transaction_id"], ["offset"], exclude, unique_sequence=True, parts=4, buckets=buckets, path=folder)
    _delivered(table, changes, "offset")
    return present(table.table().select(*TRANSACTION_TABLE_COLUMNS))


QUERIES = {
    f.__name__: f
    for f in (
        impossible_travel, velocity_hourly, velocity_daily, velocity_tumbling, lag_previous_txn, fraud_alerts,
        merchant_scores, top_merchants, customer_stats_30d, customer_stats_incremental, customer_profiles, aml_structuring, fraud_clusters,
        ops_kpis, fraud_hotspots, fraud_type_mix, daily_totals, rolling_7d, daily_anomaly, pipeline_health,
        risk_band, amount_band, high_risk_merchant, lookback_filter, fx_join, fx_join_salted, silver_enriched,
        silver_s3_cleaned, unified, bronze_enrich, dead_letter, expect_track, expect_drop, expect_fail,
        silver_rules, gold_rules, dq_report, null_rate_gate, scd1_transactions, scd1_merchants,
        scd2_customers, scd2_current, scd1_merge_incremental, scd2_merge_incremental, dedup_exact,
        silver_quarantine, scd1_ties, scd1_two_partitions, scd1_deletes, scd2_customers_hot, fx_ties, bronze_zone, unified_travel,
        sql_over_layers, refresh_health, audit_columns, change_hash, scalar_json, scalar_string,
        scalar_cast, scalar_date, scalar_math, scalar_conditional, scalar_array,
    )
}
