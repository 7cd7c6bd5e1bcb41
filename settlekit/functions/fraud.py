"""Fraud classification of a chargeback by card scheme and reason code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference): fraud reason codes per payment method.
FRAUD_REASON_CODES = {
    "VI": ("0057", "0075", "0081", "0083"),
    "MC": ("4837", "4840", "4847", "4862", "4863"),
}


def is_fraud(method: Column | str, reason: Column | str) -> Column:
    """Boolean column, never NULL: true when (method, reason) is a fraud code."""
    method = F.col(method) if isinstance(method, str) else method
    reason = F.col(reason) if isinstance(reason, str) else reason
    cond = None
    for scheme, codes in FRAUD_REASON_CODES.items():
        term = (method == scheme) & reason.isin(*codes)
        cond = term if cond is None else (cond | term)
    return F.coalesce(cond, F.lit(False))


def fraud_flag(method: Column | str, reason: Column | str) -> Column:
    """``is_fraud`` as 1 / 0 (the reference's ``is_fraud_cbk``)."""
    return F.when(is_fraud(method, reason), F.lit(1)).otherwise(F.lit(0))
