"""Deposit, refund, chargeback and refund-match summaries per merchant.

Refunds and chargebacks are pre-aggregated per deposit id *before* they meet
the deposits: a key shared by a large share of the rows (unmatched refunds
with parent 0, say) collapses to one row per map task instead of landing whole
on one reducer, and the deposit side -- the preserved side of each left join --
can still be split by adaptive skew handling. All measures are sums and counts,
so pre-aggregation gives exactly the per-row results, NULLs included.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settlekit.functions.fraud import fraud_flag
from settlekit.functions.keys import null_as_empty_join
from settlekit.functions.money import from_parts, parts_sum
from settlekit.operators.payments import GROUP3, GROUP4, GROUP7, amount_parts, deposit_volume


def refund_totals_by_parent(ref: DataFrame) -> DataFrame:
    """(ref_parent_id, ref_n, ref_whole, ref_rest): refunds counted and summed, in exact parts, per parent deposit."""
    amount = amount_parts(ref)
    return (ref.where(F.col("parent_id").isNotNull())
            .groupBy(F.col("parent_id").alias("ref_parent_id"))
            .agg(F.count("payment_id").alias("ref_n"), F.sum(amount.whole).alias("ref_whole"),
                 F.sum(amount.rest).alias("ref_rest")))


def chargeback_totals_by_deposit(cbk: DataFrame) -> DataFrame:
    """(cbk_deposit_id, cbk_n, cbk_s, cbk_fn, cbk_fs) per charged-back deposit."""
    fraud = fraud_flag("method_of_payment_code", "reason_code")
    return (cbk.where(F.col("deposit_id").isNotNull())
            .groupBy(F.col("deposit_id").alias("cbk_deposit_id"))
            .agg(F.count("deposit_id").alias("cbk_n"),
                 F.sum("chargeback_amount").alias("cbk_s"),
                 F.sum(fraud).cast("bigint").alias("cbk_fn"),
                 F.sum(F.when(fraud == 1, F.col("chargeback_amount")).otherwise(F.lit(0))).alias("cbk_fs")))


def refunds_by_deposit(dep: DataFrame, ref: DataFrame) -> DataFrame:
    """Refunds of completed deposits per merchant, method and currency code:
    count (0 when none) and major-unit sum (NULL when none)."""
    per_parent = refund_totals_by_parent(ref)
    joined = (dep.where(F.col("complete_date").isNotNull())
              .join(per_parent, F.col("payment_id") == F.col("ref_parent_id"), "left"))
    return (joined.groupBy(*GROUP3)
            .agg(F.coalesce(F.sum("ref_n"), F.lit(0)).cast("bigint").alias("excptn_refund_count"),
                 from_parts(F.sum("ref_whole"), F.sum("ref_rest")).alias("excptn_refund_settlement_amount")))


def deposit_refund_summary(dep: DataFrame, ref: DataFrame) -> DataFrame:
    """Deposit volume (7 keys) joined to refund totals (3 keys) on merchant,
    method and null-as-empty currency code."""
    return null_as_empty_join(deposit_volume(dep), refunds_by_deposit(dep, ref),
                              ["merchant_id", "method_of_payment_code"], ["settlement_currency_code"])


def chargeback_summary(dep: DataFrame, cbk: DataFrame) -> DataFrame:
    """Chargebacks of in-range deposits (completed or not) per merchant,
    currency code and description, and method."""
    per_deposit = chargeback_totals_by_deposit(cbk)
    joined = dep.join(per_deposit, F.col("payment_id") == F.col("cbk_deposit_id"), "inner")
    return (joined.groupBy(*GROUP4)
            .agg(F.sum("cbk_n").cast("bigint").alias("excptn_cbks_count"),
                 F.sum("cbk_s").alias("excptn_cbks_amount"),
                 F.sum("cbk_fn").cast("bigint").alias("excptn_fraud_cbks_count"),
                 F.sum("cbk_fs").alias("excptn_fraud_cbks_amount")))


def refund_match_summary(ref: DataFrame) -> DataFrame:
    """Completed refunds per merchant, currency and method: all, and those
    matched to a deposit (``parent_id > 0``)."""
    amount = amount_parts(ref)
    matched = F.col("parent_id") > 0
    return (ref.groupBy(*GROUP4)
            .agg(F.count(F.lit(1)).alias("excptn_refund_mtch_count"),
                 F.sum(F.when(matched, F.lit(1)).otherwise(F.lit(0))).cast("bigint")
                 .alias("excptn_refund_mtch_count_mtchd"),
                 parts_sum(amount).alias("excptn_refund_mtch_amount"),
                 parts_sum(amount.map(lambda x: F.when(matched, x).otherwise(F.lit(0)))).alias("excptn_refund_mtch_amount_mtchd")))


@dataclass
class DepositSummaries:
    volume_refunds: DataFrame   # 7 keys + volume + refunds (the report's driving rows)
    chargebacks: DataFrame      # 4 keys + chargeback measures


def deposit_summaries(dep: DataFrame, ref: DataFrame, cbk: DataFrame,
                      keep: Callable[[DataFrame], DataFrame] | None = None) -> DepositSummaries:
    """Volume, refund and chargeback summaries from one pass over the deposits.

    Deposits meet refund and chargeback totals in two left joins on the same
    key (one shuffle of the deposits), are aggregated once by the 7 report keys,
    and the 3-key refund and 4-key chargeback totals are rolled up from that
    small aggregate. Equal to ``deposit_refund_summary`` and
    ``chargeback_summary`` row for row.

    Each consumer of the aggregate is optimized on its own, and Spark prunes
    the join whose columns that consumer does not need, so three consumers
    would re-read and re-shuffle the deposits. ``keep`` (``Intermediates.table`` of
    a job) writes the aggregate, one row per merchant key group, once and every
    consumer reads that; without it the result is a lazy plan and nothing runs here.
    """
    per_parent = refund_totals_by_parent(ref)
    per_deposit = chargeback_totals_by_deposit(cbk)
    completed = F.col("complete_date").isNotNull()
    amount = amount_parts(dep)
    act = (dep.join(per_parent, F.col("payment_id") == F.col("ref_parent_id"), "left")
              .join(per_deposit, F.col("payment_id") == F.col("cbk_deposit_id"), "left"))
    agg7 = (act.groupBy(*GROUP7)
            .agg(F.count(F.when(completed, F.lit(1))).alias("n_completed"),
                 F.count(F.when(completed, F.col("payment_id"))).alias("vol_deposit_count"),
                 parts_sum(amount.map(lambda x: F.when(completed, x))).alias("vol_deposit_settlement_amount"),
                 F.sum(F.when(completed, F.col("ref_n"))).alias("ref_n"),
                 F.sum(F.when(completed, F.col("ref_whole"))).alias("ref_whole"),
                 F.sum(F.when(completed, F.col("ref_rest"))).alias("ref_rest"),
                 F.sum("cbk_n").alias("cbk_n"),
                 F.sum("cbk_s").alias("cbk_s"),
                 F.sum("cbk_fn").alias("cbk_fn"),
                 F.sum("cbk_fs").alias("cbk_fs")))
    if keep is not None:
        agg7 = keep(agg7)
    with_completed = agg7.where(F.col("n_completed") > 0)
    volume = with_completed.select(*GROUP7, "vol_deposit_count", "vol_deposit_settlement_amount")
    refunds3 = (with_completed.groupBy(*GROUP3)
                .agg(F.coalesce(F.sum("ref_n"), F.lit(0)).cast("bigint").alias("excptn_refund_count"),
                     from_parts(F.sum("ref_whole"), F.sum("ref_rest")).alias("excptn_refund_settlement_amount")))
    volume_refunds = null_as_empty_join(volume, refunds3, ["merchant_id", "method_of_payment_code"],
                                        ["settlement_currency_code"])
    chargebacks = (agg7.where(F.col("cbk_n") > 0).groupBy(*GROUP4)
                   .agg(F.sum("cbk_n").cast("bigint").alias("excptn_cbks_count"),
                        F.sum("cbk_s").alias("excptn_cbks_amount"),
                        F.sum("cbk_fn").cast("bigint").alias("excptn_fraud_cbks_count"),
                        F.sum("cbk_fs").alias("excptn_fraud_cbks_amount")))
    return DepositSummaries(volume_refunds, chargebacks)
