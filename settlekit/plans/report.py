"""The monthly exception report: deposits, refunds, chargebacks, refund
matching and fraud-advice timing per merchant, method and currency (146
columns), plus its publication as one idempotent partition."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settlekit.functions.keys import null_as_empty
from settlekit.functions.money import REPORT_AMOUNT
from settlekit.functions.periods import ReportWindow, report_window
from settlekit.intermediates import Intermediates
from settlekit.operators.advice import advice_metrics, select_measures
from settlekit.operators.payments import deposits, refunds
from settlekit.operators.summaries import deposit_summaries, refund_match_summary
from settlekit.sources.scans import chargebacks_in_window, payments_in_range
from settlekit.sources.sinks import write_report

# Fixed values (must equal the reference): report key columns as the report names them.
REPORT_KEYS = [
    ("merchant_id", "MERCHANT_ID"), ("merchant_name", "MERCHANT_NAME"),
    ("organization_id", "ORGANIZATION_ID"), ("organization_name", "ORGANIZATION_NAME"),
    ("method_of_payment_code", "METHOD_OF_PAYMENT_CODE"),
    ("settlement_currency_code", "SETTLEMENT_CURRENCY_CODE"),
    ("settlement_currency_desc", "SETTLEMENT_CURRENCY_DESC"),
]
HEADLINE = [
    "vol_deposit_count", "excptn_refund_count", "vol_deposit_settlement_amount", "excptn_refund_settlement_amount",
    "excptn_cbks_count", "excptn_cbks_amount", "excptn_fraud_cbks_count", "excptn_fraud_cbks_amount",
    "excptn_refund_mtch_count", "excptn_refund_mtch_amount", "excptn_refund_mtch_count_mtchd",
    "excptn_refund_mtch_amount_mtchd",
]
JOIN_KEYS = ["merchant_id", "method_of_payment_code", "settlement_currency_code"]


def is_count(name: str) -> bool:
    return "count" in name or name.startswith("cnt_") or "_cnt_" in name


def report_columns(row_counts: bool = False) -> list[str]:
    return [alias for _, alias in REPORT_KEYS] + ["reporting_month_day"] + HEADLINE + [
        m.name for m in select_measures(row_counts=row_counts)]


def _measures_only(df: DataFrame, prefix: str) -> DataFrame:
    """Right side of an assembly join: join keys renamed, measures kept."""
    keep = [c for c in df.columns if c not in ("merchant_id", "method_of_payment_code",
                                               "settlement_currency_code", "settlement_currency_desc")]
    return df.select(*[F.col(k).alias(f"{prefix}{k}") for k in JOIN_KEYS], *keep)


def _assemble(dep: DataFrame, right: DataFrame, prefix: str) -> DataFrame:
    r = _measures_only(right, prefix)
    cond = ((dep["merchant_id"] == r[f"{prefix}merchant_id"])
            & (dep["method_of_payment_code"] == r[f"{prefix}method_of_payment_code"])
            & (null_as_empty(dep["settlement_currency_code"]) == null_as_empty(r[f"{prefix}settlement_currency_code"])))
    return dep.join(r, cond, "left").drop(*[f"{prefix}{k}" for k in JOIN_KEYS])


def monthly_exception_report(payments: DataFrame, chargebacks: DataFrame, advice: DataFrame, run_date,
                             period: int, row_counts: bool = False) -> DataFrame:
    """The report for the month before ``run_date`` (146 columns).

    Row multiplication of the reference is kept: several currency
    descriptions or NULL and '' currency codes under one key fan out, exactly
    as the reference's joins do. Amounts are exact decimals. Lazy: no job runs and
    nothing is written while the report is built.
    """
    w = report_window(run_date, period)
    rng = payments_in_range(payments, w)
    return _report(deposits(rng), refunds(rng), chargebacks_in_window(chargebacks, w), advice, w, row_counts)


def _report(dep: DataFrame, ref: DataFrame, cbk: DataFrame, advice: DataFrame, w: ReportWindow,
            row_counts: bool = False, keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    sums = deposit_summaries(dep, ref, cbk, keep)
    report = _assemble(sums.volume_refunds, sums.chargebacks, "c_")
    report = _assemble(report, refund_match_summary(ref), "m_")
    report = _assemble(report, advice_metrics(advice, dep, ref, cbk, w, row_counts=row_counts), "a_")
    return finish_report(report, w, row_counts)


def finish_report(report: DataFrame, w: ReportWindow, row_counts: bool = False) -> DataFrame:
    measures = HEADLINE + [m.name for m in select_measures(row_counts=row_counts)]
    cols = [f"`{src}` AS `{alias}`" for src, alias in REPORT_KEYS]
    cols.append(f"CAST('{w.month}-01 00:00:00' AS TIMESTAMP_NTZ) AS reporting_month_day")
    for name in measures:
        kind = "BIGINT" if is_count(name) else REPORT_AMOUNT
        cols.append(f"COALESCE(CAST({name} AS {kind}), CAST(0 AS {kind})) AS {name}")
    return report.selectExpr(*cols)


def publish_monthly_report(payments: DataFrame, chargebacks: DataFrame, advice: DataFrame, run_date, period: int,
                           base: str, persist_payments: bool = True) -> ReportWindow:
    """Build the report and overwrite its (month, period) partition under
    ``base``. The filtered payments are cached for the duration of the write
    (four branches read them); lost cache blocks are recomputed from the scan. The
    deposit aggregate, which three branches read, is written once to the shared
    folder and removed when the job ends, also by an error."""
    w = report_window(run_date, period)
    rng = payments_in_range(payments, w)
    if persist_payments:
        rng = rng.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        with Intermediates(payments.sparkSession) as own:
            report = _report(deposits(rng), refunds(rng), chargebacks_in_window(chargebacks, w), advice, w, keep=own.table)
            write_report(report, base, w.month, period)
    finally:
        if persist_payments:
            rng.unpersist()
    return w
