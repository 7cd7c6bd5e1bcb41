import pytest
from pyspark.sql import types as T

from settlement_data import ADVICE_SCHEMA, CHARGEBACK_SCHEMA, PAYMENT_SCHEMA, D, advice, chargeback, deposit, frame
from settlekit.plans.report import monthly_exception_report, report_columns


def test_schema_146_columns(spark):
    rep = monthly_exception_report(frame(spark, [deposit(1)], PAYMENT_SCHEMA), frame(spark, [], CHARGEBACK_SCHEMA),
                                   frame(spark, [advice("ARN1", D(2019, 9, 10))], ADVICE_SCHEMA), "2019-10-05", 12)
    assert rep.columns == report_columns() and len(rep.columns) == 146
    types = {f.name: f.dataType for f in rep.schema.fields}
    assert types["vol_deposit_count"] == T.LongType() and types["excptn_cnt_5_refunds"] == T.LongType()
    assert types["amnt_all_total"] == T.DecimalType(38, 18)
    assert types["reporting_month_day"] == T.TimestampNTZType()
    (row,) = rep.collect()
    assert row["vol_deposit_count"] == 1 and row["cnt_all_total"] == 1 and row["excptn_cbks_count"] == 0
    assert str(row["reporting_month_day"]) == "2019-09-01 00:00:00"


def test_c9_two_descriptions_duplicate_report_rows(spark):
    pays = [deposit(1), deposit(2)]
    cbks = [chargeback(1, D(2019, 9, 8)), chargeback(2, D(2019, 9, 8))]
    pays[1]["settlement_currency_desc"] = "Dollar"
    rep = monthly_exception_report(frame(spark, pays, PAYMENT_SCHEMA), frame(spark, cbks, CHARGEBACK_SCHEMA),
                                   frame(spark, [], ADVICE_SCHEMA), "2019-10-05", 12)
    # two volume rows (one per description) x two chargeback rows under the same join key
    assert rep.count() == 4


def test_deposit_without_refunds_still_reported(spark):
    rep = monthly_exception_report(frame(spark, [deposit(1)], PAYMENT_SCHEMA), frame(spark, [], CHARGEBACK_SCHEMA),
                                   frame(spark, [], ADVICE_SCHEMA), "2019-10-05", 3)
    (row,) = rep.collect()
    assert row["excptn_refund_count"] == 0 and row["excptn_refund_settlement_amount"] == 0


@pytest.mark.parametrize("seed", [1, 4])
def test_report_equals_reference_composition(spark, seed):
    """Fused summaries + factorized measures vs separate summaries + detail-join measures."""
    from test_advice import W, _random_case
    from settlekit.operators import advice as A
    from settlekit.operators.payments import deposits, refunds
    from settlekit.operators.summaries import chargeback_summary, deposit_refund_summary, refund_match_summary
    from settlekit.plans.report import _assemble, finish_report
    from settlekit.sources.scans import chargebacks_in_window, payments_in_range

    pays, cbks, advs = _random_case(seed)
    p, c, a = frame(spark, pays, PAYMENT_SCHEMA), frame(spark, cbks, CHARGEBACK_SCHEMA), frame(spark, advs, ADVICE_SCHEMA)
    fast = monthly_exception_report(p, c, a, "2019-10-05", 12)
    rng = payments_in_range(p, W)
    dep, ref = deposits(rng), refunds(rng)
    cbk = chargebacks_in_window(c, W)
    slow = _assemble(deposit_refund_summary(dep, ref), chargeback_summary(dep, cbk), "c_")
    slow = _assemble(slow, refund_match_summary(ref), "m_")
    slow = _assemble(slow, A.advice_metrics_from_detail(A.advice_detail(a, dep, ref, cbk, W)), "a_")
    slow = finish_report(slow, W)
    cols = fast.columns
    assert fast.count() > 0
    assert sorted((tuple(r[x] for x in cols) for r in fast.collect()), key=repr) == \
        sorted((tuple(r[x] for x in cols) for r in slow.collect()), key=repr)


def _jobs(spark, run):
    """What ``run`` returns, and the number of jobs it started."""
    group = f"count-jobs-{run.__name__}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = run()
        return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_building_runs_no_job_and_publishing_leaves_nothing(spark, tmp_path):
    from settlekit.plans.report import publish_monthly_report
    from settlekit.session import shared_dir

    inputs = (frame(spark, [deposit(1)], PAYMENT_SCHEMA), frame(spark, [chargeback(1, D(2019, 9, 11))], CHARGEBACK_SCHEMA),
              frame(spark, [advice("ARN1", D(2019, 9, 10))], ADVICE_SCHEMA))

    def build():
        return monthly_exception_report(*inputs, "2019-10-05", 12)

    report, jobs = _jobs(spark, build)
    assert jobs == 0
    folder = spark._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    held = lambda: sorted(f.getPath().getName() for f in fs.listStatus(folder) if f.getPath().getName().startswith("settlekit-job-"))
    before = held()
    publish_monthly_report(*inputs, "2019-10-05", 12, str(tmp_path / "r"))
    assert held() == before
    got = spark.read.parquet(str(tmp_path / "r")).drop("reporting_month", "reporting_period")
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in report.collect()]
    # an error while publishing clears up too
    with pytest.raises(Exception):
        publish_monthly_report(*inputs, "2019-10-05", 12, "nosuchscheme://x/y")
    assert held() == before
