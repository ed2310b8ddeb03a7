"""Currency conversion on a stream whose rates arrive meanwhile."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriflux.streaming.run import watermarked

SALTS = 16
DAY = "1 day"


def final_rates(rates: DataFrame, patience: str) -> DataFrame:
    """One rate per currency and day, the one ingested last, as soon as none can come any more: a rate is at most `patience` later than
    the rates of later days. Columns: currency_code, day (a window), usd_multiplier."""
    timed = rates.withColumn("_day", F.col("rate_date").cast("timestamp")).withWatermark("_day", patience)
    order = F.when(F.col("usd_multiplier").isNotNull(), F.struct("_ingested_at", "usd_multiplier"))
    final = timed.groupBy("currency_code", F.window("_day", DAY).alias("day"))
    return final.agg(F.max_by("usd_multiplier", order).alias("usd_multiplier"))


def with_usd_amount(transactions: DataFrame, rates: DataFrame, patience: str = "2 days", lateness: str = "30 minutes", salts: int = SALTS) -> DataFrame:
    """`amount_usd` and `rate_missing` for each transaction of a stream; both sides are streams.

    A transaction waits in the state of the join until its currency and day have their final rate. If there is none by the time
    both streams have passed that day, `amount_usd` is null and `rate_missing` true: a foreign amount never counts as
    dollars. Transactions without a time or a currency come out at once, marked in the same way. The rows of a currency and day are
    spread over `salts` keys, to each of which the rate is sent.
    """
    known = F.col("event_timestamp").isNotNull() & F.col("currency").isNotNull()
    timed = watermarked(transactions.filter(known), "event_timestamp", lateness, "_at")
    # The row travels as one column: a join of streams allows each side one column with a watermark, the day.
    salt = F.pmod(F.xxhash64("transaction_id", "event_timestamp"), F.lit(salts)).cast("int")
    timed = timed.select(F.struct(*transactions.columns).alias("_row"), "currency", F.window("_at", DAY).alias("_window"), salt.alias("_salt"))
    copies = final_rates(rates, patience).withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    same = [timed["currency"] == copies["currency_code"], timed["_window"] == copies["day"], timed["_salt"] == copies["_copy"]]
    priced = timed.join(copies, same, "left").select("_row.*", "usd_multiplier")
    unknown = transactions.filter(~known).withColumn("usd_multiplier", F.lit(None).cast("double"))
    return priced.unionByName(unknown).select(
        *transactions.columns, (F.col("amount") * F.col("usd_multiplier")).alias("amount_usd"), F.col("usd_multiplier").isNull().alias("rate_missing"))
