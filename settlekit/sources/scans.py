"""Scans of the settlement inputs, with the reporting-window filters.

Filters compare typed date columns with typed date literals so they reach the
Parquet scan as pushed filters (and partition filters where the tables are
partitioned by those columns); only the named columns are read.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from settlekit.functions.money import REPORT_AMOUNT
from settlekit.functions.periods import ReportWindow

# Fixed values (must equal the reference): scan filters.
SETTLED_STATUS = "1"
CARD_METHODS = ("VI", "MC")
CHARGEBACK_TYPE = "D"
CHARGEBACK_CYCLES = ("FIRST_CHARGEBACK", "REPRESENTMENT")

RANGE_COLUMNS = [
    "merchant_id", "merchant_name", "organization_id", "organization_name", "method_of_payment_code",
    "settlement_currency_code", "settlement_currency_desc", "payment_id", "settlement_amount",
    "settlement_rpt_precision", "parent_id", "complete_date", "action_type", "ot_start_ts",
    "ot_start_ts_ts", "amount", "txn_reference_number",
]

CHARGEBACK_COLUMNS = [
    "deposit_id", "chargeback_amount", "method_of_payment_code", "reason_code",
    "issuing_bank_day", "issuing_bank_day_ts",
]


def _between(df: DataFrame, col: str, lo, hi):
    """Inclusive day window. DATE columns compare directly (and reach the scan
    as pushed filters), timestamps as a half-open range that keeps the last day
    whole (pushed too), date-time strings by their calendar day."""
    c, kind = F.col(col), df.schema[col].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        after = hi + dt.timedelta(days=1)
        return (c >= F.lit(lo.isoformat()).cast(kind)) & (c < F.lit(after.isoformat()).cast(kind))
    if not isinstance(kind, T.DateType):
        c = F.to_date(c)
    return c.between(F.lit(lo), F.lit(hi))


def payments_in_range(payments: DataFrame, w: ReportWindow) -> DataFrame:
    """Settled card payments created and posted inside the window (17 columns)."""
    return (payments
            .where(_between(payments, "created_date", w.from_created, w.to)
                   & _between(payments, "batch_post_day", w.from_post, w.to)
                   & (F.col("transaction_status") == SETTLED_STATUS)
                   & F.col("method_of_payment_code").isin(*CARD_METHODS))
            .select(*RANGE_COLUMNS))


def chargebacks_in_window(chargebacks: DataFrame, w: ReportWindow) -> DataFrame:
    """First chargebacks and representments of deposits opened in the window."""
    return (chargebacks
            .where(_between(chargebacks, "open_date", w.from_post, w.to)
                   & (F.col("type") == CHARGEBACK_TYPE)
                   & F.col("current_cycle").isin(*CHARGEBACK_CYCLES))
            .select(*[_exact(chargebacks, c) for c in CHARGEBACK_COLUMNS]))


def _exact(df: DataFrame, col: str):
    """Binary floating-point amounts become decimals at the scan; other columns stay."""
    if isinstance(df.schema[col].dataType, (T.FloatType, T.DoubleType)):
        return F.col(col).cast(REPORT_AMOUNT).alias(col)
    return F.col(col)


def advice_in_window(advice: DataFrame, w: ReportWindow) -> DataFrame:
    """Fraud advice created in the window."""
    return (advice.where(_between(advice, "create_date", w.from_post, w.to))
            .select("acquirer_ref_number", "create_date", "create_date_ts"))
