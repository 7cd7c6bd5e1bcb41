"""Deposits and refunds of the in-range payments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settlekit.functions.money import Parts, minor_parts, parts_sum

# Fixed values (must equal the reference): action types.
DEPOSIT_ACTIONS = ("D", "S")
REFUND_ACTIONS = ("T", "R")

GROUP7 = ["merchant_id", "merchant_name", "organization_id", "organization_name",
          "settlement_currency_code", "settlement_currency_desc", "method_of_payment_code"]
GROUP4 = ["merchant_id", "settlement_currency_code", "settlement_currency_desc", "method_of_payment_code"]
GROUP3 = ["merchant_id", "settlement_currency_code", "method_of_payment_code"]


def deposits(in_range: DataFrame) -> DataFrame:
    """Deposits (D, S), completed or not."""
    return in_range.where(F.col("action_type").isin(*DEPOSIT_ACTIONS))


def refunds(in_range: DataFrame) -> DataFrame:
    """Completed refunds (T, R)."""
    return in_range.where(F.col("action_type").isin(*REFUND_ACTIONS) & F.col("complete_date").isNotNull())


def amount_parts(payments: DataFrame) -> Parts:
    """The settlement amount in exact parts, by the type of its column."""
    return minor_parts("settlement_amount", "settlement_rpt_precision", payments.schema["settlement_amount"].dataType)


def deposit_volume(dep: DataFrame) -> DataFrame:
    """Count and major-unit sum of completed deposits per merchant, organization,
    currency and method (7 keys)."""
    return (dep.where(F.col("complete_date").isNotNull())
            .groupBy(*GROUP7)
            .agg(F.count("payment_id").alias("vol_deposit_count"),
                 parts_sum(amount_parts(dep)).alias("vol_deposit_settlement_amount")))
