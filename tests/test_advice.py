"""Fraud-advice measures: hand-worked cases and the factorized computation
against the reference formulation (aggregating the detail join)."""

import datetime as dt
import random
from decimal import Decimal

import pytest

from settlement_data import (ADVICE_SCHEMA, CHARGEBACK_SCHEMA, PAYMENT_SCHEMA, D, advice, at, chargeback, deposit, frame,
                      refund)
from settlekit.functions.periods import report_window
from settlekit.operators import advice as A
from settlekit.operators.payments import deposits, refunds
from settlekit.sources.scans import chargebacks_in_window, payments_in_range

W = report_window("2019-10-05", 12)


def metrics(spark, pays, cbks, advs, row_counts=False, detail=False):
    rng = payments_in_range(frame(spark, pays, PAYMENT_SCHEMA), W)
    dep, ref = deposits(rng), refunds(rng)
    cbk = chargebacks_in_window(frame(spark, cbks, CHARGEBACK_SCHEMA), W)
    adv = frame(spark, advs, ADVICE_SCHEMA)
    if detail:
        return A.advice_metrics_from_detail(A.advice_detail(adv, dep, ref, cbk, W), row_counts=row_counts)
    return A.advice_metrics(adv, dep, ref, cbk, W, row_counts=row_counts)


def one(spark, *args, **kw):
    rows = metrics(spark, *args, **kw).collect()
    assert len(rows) == 1
    return rows[0].asDict()


def nonzero(row):
    return {k: v for k, v in row.items() if k.startswith(("cnt_", "amnt_", "excptn_")) and v not in (0, None)}


def test_c2_advice_without_chargeback_or_refund(spark):
    r = one(spark, [deposit(1)], [], [advice("ARN1", D(2019, 9, 10))])
    assert nonzero(r) == {"cnt_all_total": 1, "amnt_all_total": Decimal("100")}


def test_c3_chargeback_before_advice(spark):
    r = one(spark, [deposit(1)], [chargeback(1, D(2019, 9, 8))], [advice("ARN1", D(2019, 9, 10))])
    assert r["cnt_cbk_prior_total"] == r["cnt_cbk_prior_cbks"] == r["cnt_cbk_prior_frd_cbks"] == 1
    assert r["amnt_cbk_prior_total"] == Decimal("100") and r["amnt_cbk_prior_cbks"] == Decimal("40")
    assert r["excptn_cnt_prior_cbks"] == 1 and r["excptn_amnt_prior_cbks"] == Decimal("40")
    assert r["cnt_not_ref_full_total"] == 0


def test_c4_full_refund_before_advice(spark):
    r = one(spark, [deposit(1), refund(11, 1, D(2019, 9, 9))], [chargeback(1, D(2019, 9, 10))],
            [advice("ARN1", D(2019, 9, 10))])
    assert r["cnt_ref_full_prior_total"] == 1 and r["cnt_ref_full_after_total"] == 0
    assert r["excptn_cnt_0_cbks"] == 1 and r["excptn_cnt_prior_refunds"] == 1
    assert r["excptn_amnt_prior_refunds"] == Decimal("100")


def test_c5_day_buckets_add_the_day_number(spark):
    args = ([deposit(1), refund(11, 1, D(2019, 9, 10))], [chargeback(1, D(2019, 9, 13))],
            [advice("ARN1", D(2019, 9, 10))])
    r = one(spark, *args)
    assert r["cnt_ref_full_after_total"] == 1
    assert r["excptn_cnt_3_cbks"] == 3 and r["excptn_amnt_3_cbks"] == Decimal("40")
    assert one(spark, *args, row_counts=True)["excptn_cnt_3_cbks"] == 1


def test_c6_day_21_and_above(spark):
    r = one(spark, [deposit(1)], [chargeback(1, D(2019, 9, 22)), chargeback(1, D(2019, 9, 23))],
            [advice("ARN1", D(2019, 9, 1))])
    assert r["excptn_cnt_21_cbks"] == 21 and r["excptn_cnt_above_21_cbks"] == 1


def test_c7_refunds_times_chargebacks(spark):
    r = one(spark, [deposit(1), refund(11, 1, D(2019, 9, 5)), refund(12, 1, D(2019, 9, 6))],
            [chargeback(1, D(2019, 9, 8)), chargeback(1, D(2019, 9, 9))], [advice("ARN1", D(2019, 9, 10))])
    assert r["cnt_all_total"] == 4 and r["amnt_all_total"] == Decimal("400")
    detail = metrics(spark, [deposit(1), refund(11, 1, D(2019, 9, 5)), refund(12, 1, D(2019, 9, 6))],
                     [chargeback(1, D(2019, 9, 8)), chargeback(1, D(2019, 9, 9))],
                     [advice("ARN1", D(2019, 9, 10))], detail=True).collect()[0].asDict()
    assert r == detail


def test_c10_incomplete_deposit_not_in_advice(spark):
    rows = metrics(spark, [deposit(1, complete_date=None)], [chargeback(1, D(2019, 9, 8))],
                   [advice("ARN1", D(2019, 9, 10))]).collect()
    assert rows == []


def _random_case(seed: int):
    rnd = random.Random(seed)
    base = D(2019, 8, 1)

    def day(lo=-30, hi=60, null=0.08):
        return None if rnd.random() < null else base + dt.timedelta(days=rnd.randint(lo, hi))

    pays, cbks, advs = [], [], []
    n_dep = rnd.randint(3, 12)
    for i in range(n_dep):
        pid = rnd.randint(1, 6)                      # repeated payment ids: duplicate deposits
        d = base + dt.timedelta(days=rnd.randint(0, 40))
        amt = rnd.choice([10000, 10000, 2500, None])
        pays.append(deposit(pid, d, merchant_id=rnd.choice([1, 2]), amount=amt,
                            settlement_currency_code=rnd.choice(["USD", None, ""]),
                            settlement_currency_desc=rnd.choice(["US Dollar", "Dollar"]),
                            settlement_amount=rnd.choice([10000, 123456, None]),
                            settlement_rpt_precision=rnd.choice([2, 0, 3, 9]),
                            txn_reference_number=rnd.choice([f"ARN{pid}", f"ARN{pid}", "ARNX", None]),
                            complete_date=None if rnd.random() < 0.1 else d))
    for j in range(rnd.randint(0, 14)):
        parent = rnd.choice([1, 2, 3, 4, 5, 6, 0, None])
        rd = day(-10, 70)
        pays.append(refund(100 + j, parent, rd or base, ot_start_ts=rd, ot_start_ts_ts=at(day(-10, 70, 0.1)),
                           amount=rnd.choice([10000, 2500, None]), settlement_amount=rnd.choice([10000, 777, None]),
                           settlement_rpt_precision=rnd.choice([2, 0, 9])))
    for _ in range(rnd.randint(0, 14)):
        cd = day()
        cbks.append(chargeback(rnd.choice([1, 2, 3, 4, 5, 6, None]), cd,
                               amount=rnd.choice(["40.00", "12.34", None]),
                               method=rnd.choice(["VI", "MC", None]), reason=rnd.choice(["0057", "4837", "9999"]),
                               issuing_bank_day_ts=at(day(null=0.1), rnd.choice([0, 10, 23]))))
    for _ in range(rnd.randint(1, 8)):
        ad = base + dt.timedelta(days=rnd.randint(0, 45))
        ts = None if rnd.random() < 0.1 else at(ad + dt.timedelta(days=rnd.choice([0, 0, 1, -1])), rnd.choice([1, 21]))
        refs = [p["txn_reference_number"] for p in pays if p["txn_reference_number"]] or ["ARN1"]
        advs.append(dict(acquirer_ref_number=rnd.choice(refs + ["ARNZ", None]), create_date=ad,
                         create_date_ts=ts))
    return pays, cbks, advs


@pytest.mark.parametrize("seed", range(8))
def test_factorized_equals_detail_aggregate(spark, seed):
    pays, cbks, advs = _random_case(seed)
    for row_counts in (False, True):
        fast = metrics(spark, pays, cbks, advs, row_counts=row_counts)
        slow = metrics(spark, pays, cbks, advs, row_counts=row_counts, detail=True)
        cols = slow.columns
        assert sorted(fast.columns) == sorted(cols)
        a = sorted((tuple(r[c] for c in cols) for r in fast.collect()), key=repr)
        b = sorted((tuple(r[c] for c in cols) for r in slow.collect()), key=repr)
        assert a == b


def test_invariants_on_fixture(spark):
    from settlekit.sources.fixtures import settlement_inputs
    inp = settlement_inputs(spark, "/root/testdata/sf0.001")
    w = report_window("1998-10-05", 12)
    rng = payments_in_range(inp.payments, w)
    dep, ref = deposits(rng), refunds(rng)
    cbk = chargebacks_in_window(inp.chargebacks, w)
    rows = A.advice_metrics(inp.advice, dep, ref, cbk, w).collect()
    rc = A.advice_metrics(inp.advice, dep, ref, cbk, w, families=("day",), row_counts=True).collect()
    assert rows
    for r in rows:
        assert r["cnt_all_cbks"] == sum(r[f"cnt_{c}_cbks"] for c in A.CLASSES)
        for c in A.CLASSES:
            assert r[f"cnt_{c}_total"] == r[f"cnt_{c}_cbks"]
        day_amt = sum(r[f"excptn_amnt_{b}_cbks"] for b in A.DAY_BUCKETS)
        assert day_amt == r["amnt_all_cbks"]
    for r, base in zip(sorted(rc, key=lambda x: tuple(map(str, x[:4]))), sorted(rows, key=lambda x: tuple(map(str, x[:4])))):
        assert sum(r[f"excptn_cnt_{b}_cbks"] for b in A.DAY_BUCKETS) == base["cnt_all_cbks"]


def test_hot_deposit_matches_detail(spark):
    """One deposit holding most events: many refunds x chargebacks x advice."""
    rnd = random.Random(7)
    base = D(2019, 8, 20)
    pays = [deposit(1), deposit(2, merchant_id=2)]
    pays += [refund(100 + i, 1, base + dt.timedelta(days=rnd.randint(-5, 40))) for i in range(25)]
    cbks = [chargeback(1, base + dt.timedelta(days=rnd.randint(-5, 40)), amount=rnd.choice(["1.00", "2.50", None]),
                       reason=rnd.choice(["0057", "9999"])) for _ in range(30)]
    cbks.append(chargeback(2, base))
    advs = [advice("ARN1", base + dt.timedelta(days=rnd.randint(0, 20)), rnd.choice([1, 21])) for _ in range(6)]
    advs.append(advice("ARN2", base))
    fast = metrics(spark, pays, cbks, advs)
    slow = metrics(spark, pays, cbks, advs, detail=True)
    cols = slow.columns
    a = sorted((tuple(r[c] for c in cols) for r in fast.collect()), key=repr)
    b = sorted((tuple(r[c] for c in cols) for r in slow.collect()), key=repr)
    assert a == b
    assert max(r["cnt_all_total"] for r in slow.collect()) == 6 * 25 * 30


def test_hot_deposit_at_scale_matches_closed_form(spark):
    """5,000 full refunds x 5,000 chargebacks x 4 advice rows on one deposit:
    10^8 detail rows in the reference formulation, computed here without
    pairing; measures checked against counts worked out directly."""
    rnd = random.Random(11)
    base = D(2019, 3, 1)
    n = 5000
    ref_days = [base + dt.timedelta(days=rnd.randint(0, 200)) for _ in range(n)]
    cbk_days = [base + dt.timedelta(days=rnd.randint(0, 200)) for _ in range(n)]
    adv_days = [base + dt.timedelta(days=d) for d in (20, 75, 130, 190)]
    pays = [deposit(1, D(2019, 2, 1))] + [refund(100 + i, 1, d) for i, d in enumerate(ref_days)]
    cbks = [chargeback(1, d, amount="1.00") for d in cbk_days]
    advs = [advice("ARN1", d) for d in adv_days]
    r = one(spark, pays, cbks, advs)
    assert r["cnt_all_total"] == 4 * n * n
    assert r["cnt_all_cbks"] == 4 * n * n
    assert r["cnt_cbk_prior_cbks"] == sum(n * sum(c < a for c in cbk_days) for a in adv_days)
    assert r["cnt_ref_full_prior_cbks"] == sum(sum(c >= a for c in cbk_days) * sum(f < a for f in ref_days)
                                               for a in adv_days)
    assert r["cnt_ref_full_after_cbks"] == sum(sum(c >= a for c in cbk_days) * sum(f >= a for f in ref_days)
                                               for a in adv_days)
    for k in (0, 1, 5, 21):
        w = k if k >= 2 else 1
        assert r[f"excptn_cnt_{k}_cbks"] == sum(w * n * sum((c - a).days == k for c in cbk_days) for a in adv_days)
        assert r[f"excptn_cnt_{k}_refunds"] == sum(w * n * sum((f - a).days == k for f in ref_days) for a in adv_days)
    assert r["excptn_amnt_above_21_cbks"] == Decimal(sum(n * sum((c - a).days > 21 for c in cbk_days)
                                                         for a in adv_days))
    assert r["amnt_all_total"] == Decimal(100) * 4 * n * n


def test_one_reference_on_a_third_of_the_deposits(spark):
    """A placeholder reference: right measures, its deposits dealt over many tasks, and deposits
    without events never paired with advice dates."""
    rnd = random.Random(4)
    base = D(2019, 8, 1)
    pays = [deposit(i, base + dt.timedelta(days=i % 30), merchant_id=i % 3, txn_reference_number="0" if i % 3 == 0 else f"ARN{i}")
            for i in range(1, 601)]
    pays += [refund(10_000 + i, i, base + dt.timedelta(days=rnd.randint(0, 50))) for i in range(1, 601) if i % 7 == 0]
    cbks = [chargeback(i, base + dt.timedelta(days=rnd.randint(0, 50))) for i in range(1, 601) if i % 5 == 0]
    advs = [advice("0", base + dt.timedelta(days=d)) for d in (0, 3, 3, 9, 20)] + [advice(f"ARN{i}", base) for i in range(1, 200)]
    rng = payments_in_range(frame(spark, pays, PAYMENT_SCHEMA), W)
    dep, ref = deposits(rng), refunds(rng)
    cbk, adv = chargebacks_in_window(frame(spark, cbks, CHARGEBACK_SCHEMA), W), frame(spark, advs, ADVICE_SCHEMA)
    fast = A.advice_metrics(adv, dep, ref, cbk, W, hot_rows=10)
    slow = A.advice_metrics_from_detail(A.advice_detail(adv, dep, ref, cbk, W))
    cols = slow.columns
    assert sorted((tuple(r[c] for c in cols) for r in fast.collect()), key=repr) == \
        sorted((tuple(r[c] for c in cols) for r in slow.collect()), key=repr)

    from pyspark.sql import functions as F
    told = A.advice_dates(adv, W)
    narrow = dep.select("payment_id", "amount", "txn_reference_number")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = {n: sorted(r["count"] for r in A.join_on_reference(narrow, told, n).groupBy(F.spark_partition_id()).count().collect())
                 for n in (10, 10 ** 6)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes[10]) == sum(sizes[10 ** 6]) == 200 + 133
    assert max(sizes[10]) <= 3 * sizes[10][len(sizes[10]) // 2] < max(sizes[10 ** 6])

    advised = A.advised_deposits(adv, dep, ref, cbk, W)
    rows = A.slot_sums(advised)
    assert "Window" not in rows._jdf.queryExecution().executedPlan().toString()
    plain = advised.where("cbks IS NULL AND refs IS NULL")
    paired = advised.select(F.when(F.col("cbks").isNull() & F.col("refs").isNull(), 1).otherwise(F.size("told")).alias("n"))
    assert plain.count() > 150 and paired.agg(F.sum("n")).first()[0] < 200 * 4 + 133


def test_advice_on_every_day_adds_rows_by_event(spark):
    """A reference advised on 300 days: right measures, and a deposit adds at most 24 day buckets
    an event date and 16 slots per span between its event dates (300 dates times that before)."""
    rnd = random.Random(9)
    base = D(2018, 10, 1)
    pays = [deposit(i, base + dt.timedelta(days=rnd.randint(0, 300)), merchant_id=i % 2, txn_reference_number="0") for i in range(1, 25)]
    pays += [refund(1000 + 10 * i + k, i, base + dt.timedelta(days=rnd.randint(0, 330))) for i in range(1, 25) for k in range(i % 3)]
    cbks = [chargeback(i, base + dt.timedelta(days=rnd.randint(0, 330))) for i in range(1, 25) for _ in range(i % 4)]
    advs = [advice("0", base + dt.timedelta(days=d)) for d in range(300) for _ in range(1 + d % 2)]
    rng = payments_in_range(frame(spark, pays, PAYMENT_SCHEMA), W)
    dep, ref = deposits(rng), refunds(rng)
    cbk, adv = chargebacks_in_window(frame(spark, cbks, CHARGEBACK_SCHEMA), W), frame(spark, advs, ADVICE_SCHEMA)
    fast = A.advice_metrics(adv, dep, ref, cbk, W)
    slow = A.advice_metrics_from_detail(A.advice_detail(adv, dep, ref, cbk, W))
    assert sorted((tuple(r[c] for c in slow.columns) for r in fast.collect()), key=repr) == \
        sorted((tuple(r) for r in slow.collect()), key=repr)

    advised = A.advised_deposits(adv, dep, ref, cbk, W)
    dates = "COALESCE(size(cbks), 0) + COALESCE(size(refs), 0)"
    advised = advised.selectExpr("*", f"{dates} AS n_dates").localCheckpoint()
    most = advised.selectExpr("SUM(24 * n_dates + 16 * (n_dates + 1))").first()[0]
    assert advised.count() == 24 and 0 < A.slot_rows(advised).count() <= most
