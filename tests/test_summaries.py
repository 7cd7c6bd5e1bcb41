from decimal import Decimal

from settlement_data import CHARGEBACK_SCHEMA, PAYMENT_SCHEMA, D, chargeback, deposit, frame, refund
from settlekit.functions.periods import report_window
from settlekit.operators.payments import deposit_volume, deposits, refunds
from settlekit.operators.summaries import (chargeback_summary, deposit_refund_summary, deposit_summaries,
                                           refund_match_summary, refunds_by_deposit)
from settlekit.sources.scans import chargebacks_in_window, payments_in_range

W = report_window("2019-10-05", 12)


def split(spark, pays, cbks=()):
    rng = payments_in_range(frame(spark, pays, PAYMENT_SCHEMA), W)
    cbk = chargebacks_in_window(frame(spark, list(cbks), CHARGEBACK_SCHEMA), W)
    return deposits(rng), refunds(rng), cbk


def test_c8_null_and_empty_currency_fan_out(spark):
    dep, ref, _ = split(spark, [deposit(1, settlement_currency_code=None), deposit(2, settlement_currency_code="")])
    assert deposit_volume(dep).count() == 2
    assert refunds_by_deposit(dep, ref).count() == 2
    assert deposit_refund_summary(dep, ref).count() == 4


def test_c10_incomplete_deposit_counts_in_chargebacks_only(spark):
    dep, ref, cbk = split(spark, [deposit(1, complete_date=None)], [chargeback(1, D(2019, 9, 8))])
    assert deposit_volume(dep).count() == 0
    rows = chargeback_summary(dep, cbk).collect()
    assert len(rows) == 1 and rows[0]["excptn_cbks_count"] == 1 and rows[0]["excptn_fraud_cbks_count"] == 1


def test_c11_refund_match_counts(spark):
    dep, ref, _ = split(spark, [refund(11, 0, D(2019, 9, 2)), refund(12, 5, D(2019, 9, 2)),
                                refund(13, None, D(2019, 9, 2))])
    r = refund_match_summary(ref).collect()[0]
    assert (r["excptn_refund_mtch_count"], r["excptn_refund_mtch_count_mtchd"]) == (3, 1)
    assert r["excptn_refund_mtch_amount"] == Decimal("300") and r["excptn_refund_mtch_amount_mtchd"] == Decimal("100")


def test_refunds_by_deposit_zero_count_null_sum(spark):
    dep, ref, _ = split(spark, [deposit(1), deposit(2, merchant_id=2), refund(11, 1, D(2019, 9, 3)),
                                refund(12, 1, D(2019, 9, 4), settlement_amount=250)])
    rows = {r["merchant_id"]: r for r in refunds_by_deposit(dep, ref).collect()}
    assert rows[1]["excptn_refund_count"] == 2 and rows[1]["excptn_refund_settlement_amount"] == Decimal("102.5")
    assert rows[2]["excptn_refund_count"] == 0 and rows[2]["excptn_refund_settlement_amount"] is None


def _sorted(df, cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_fused_summaries_equal_separate(spark):
    from settlekit.sources.fixtures import settlement_inputs
    inp = settlement_inputs(spark, "/root/testdata/sf0.001")
    w = report_window("1998-10-05", 12)
    rng = payments_in_range(inp.payments, w)
    dep, ref = deposits(rng), refunds(rng)
    cbk = chargebacks_in_window(inp.chargebacks, w)
    fused = deposit_summaries(dep, ref, cbk)
    a, b = fused.volume_refunds, deposit_refund_summary(dep, ref)
    assert _sorted(a, b.columns) == _sorted(b, b.columns)
    a, b = fused.chargebacks, chargeback_summary(dep, cbk)
    assert _sorted(a, b.columns) == _sorted(b, b.columns)


def test_q9_timestamp_window_keeps_last_day(spark):
    from pyspark.sql import functions as F
    pays = frame(spark, [deposit(1, D(2019, 9, 30)), deposit(2, D(2019, 10, 1))], PAYMENT_SCHEMA)
    as_ts = pays.withColumn("created_date", F.col("created_date").cast("timestamp_ntz") + F.expr("INTERVAL 13 HOURS"))
    got = sorted(r.payment_id for r in payments_in_range(as_ts, W).collect())
    assert got == [1]
    # C13: last day kept; created day 14 of the month before the window dropped, day 15 kept
    rows = [deposit(3, D(2019, 9, 30)), deposit(4, D(2018, 8, 14), batch_post_day=D(2018, 9, 3)),
            deposit(5, D(2018, 8, 15), batch_post_day=D(2018, 9, 3))]
    got = sorted(r.payment_id for r in payments_in_range(frame(spark, rows, PAYMENT_SCHEMA), W).collect())
    assert got == [3, 5]
