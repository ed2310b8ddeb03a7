"""Alerts on a change stream."""

from __future__ import annotations

from pyspark.sql import DataFrame

from veriflux.operators.cdc import drop_duplicates
from veriflux.params import RiskParams
from veriflux.plans.gold import fraud_alerts


def alerts_once(changes: DataFrame, params: RiskParams = RiskParams()) -> DataFrame:
    """One alert per transaction, from the first of its change records that calls for one.

    Later records of the transaction are recognized as long as the watermark of the bronze layer has not
    passed them, which keeps the state bounded.
    """
    return drop_duplicates(fraud_alerts(changes, params), ["transaction_id"], watermark=True)
