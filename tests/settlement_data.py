"""Schemas and row builders of the settlement tests."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

PAYMENT_SCHEMA = T.StructType([
    T.StructField("merchant_id", T.LongType()),
    T.StructField("merchant_name", T.StringType()),
    T.StructField("organization_id", T.LongType()),
    T.StructField("organization_name", T.StringType()),
    T.StructField("method_of_payment_code", T.StringType()),
    T.StructField("settlement_currency_code", T.StringType()),
    T.StructField("settlement_currency_desc", T.StringType()),
    T.StructField("payment_id", T.LongType()),
    T.StructField("settlement_amount", T.LongType()),
    T.StructField("settlement_rpt_precision", T.IntegerType()),
    T.StructField("parent_id", T.LongType()),
    T.StructField("complete_date", T.DateType()),
    T.StructField("action_type", T.StringType()),
    T.StructField("ot_start_ts", T.DateType()),
    T.StructField("ot_start_ts_ts", T.TimestampNTZType()),
    T.StructField("amount", T.LongType()),
    T.StructField("txn_reference_number", T.StringType()),
    T.StructField("created_date", T.DateType()),
    T.StructField("batch_post_day", T.DateType()),
    T.StructField("transaction_status", T.StringType()),
])

CHARGEBACK_SCHEMA = T.StructType([
    T.StructField("deposit_id", T.LongType()),
    T.StructField("chargeback_amount", T.DecimalType(18, 2)),
    T.StructField("method_of_payment_code", T.StringType()),
    T.StructField("reason_code", T.StringType()),
    T.StructField("issuing_bank_day", T.DateType()),
    T.StructField("issuing_bank_day_ts", T.TimestampNTZType()),
    T.StructField("open_date", T.DateType()),
    T.StructField("type", T.StringType()),
    T.StructField("current_cycle", T.StringType()),
])

ADVICE_SCHEMA = T.StructType([
    T.StructField("acquirer_ref_number", T.StringType()),
    T.StructField("create_date", T.DateType()),
    T.StructField("create_date_ts", T.TimestampNTZType()),
])

D = dt.date


def at(d: dt.date | None, hour: int = 8) -> dt.datetime | None:
    return None if d is None else dt.datetime(d.year, d.month, d.day, hour)


def deposit(pid: int, day: dt.date = D(2019, 9, 1), **kw) -> dict:
    row = dict(merchant_id=1, merchant_name="M1", organization_id=1, organization_name="O1",
               method_of_payment_code="VI", settlement_currency_code="USD", settlement_currency_desc="US Dollar",
               payment_id=pid, settlement_amount=10000, settlement_rpt_precision=2, parent_id=None,
               complete_date=day, action_type="D", ot_start_ts=day, ot_start_ts_ts=at(day), amount=10000,
               txn_reference_number=f"ARN{pid}", created_date=day, batch_post_day=day, transaction_status="1")
    row.update(kw)
    return row


def refund(pid: int, parent: int | None, day: dt.date, **kw) -> dict:
    row = deposit(pid, day, action_type="R", parent_id=parent, txn_reference_number=None)
    row.update(kw)
    return row


def chargeback(deposit_id: int, day: dt.date | None, amount="40.00", method="VI", reason="0057", **kw) -> dict:
    import decimal
    row = dict(deposit_id=deposit_id, chargeback_amount=None if amount is None else decimal.Decimal(amount),
               method_of_payment_code=method, reason_code=reason, issuing_bank_day=day,
               issuing_bank_day_ts=at(day, 10), open_date=day or D(2019, 9, 1), type="D",
               current_cycle="FIRST_CHARGEBACK")
    row.update(kw)
    return row


def advice(ref: str, day: dt.date, hour: int = 21) -> dict:
    return dict(acquirer_ref_number=ref, create_date=day, create_date_ts=at(day, hour))


def frame(spark, rows: list[dict], schema: T.StructType):
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)
