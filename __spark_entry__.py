"""

Every query reads the driver's tables (through the derivations of FIXTURES.md
section B) over their whole extent. Standard parameters: run date 1998-10-05,
period 12 (period 3 as a second case), reconciliation ``as_of`` 1998-10-31,
35 replay days. Amounts are reported as decimal(38,18), counts as bigint.
"""

from __future__ import annotations

import datetime as dt
import sys
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

import duckdb_oracle as O  # noqa: E402
from settlekit.functions.money import minor_to_major  # noqa: E402
from settlekit.functions.periods import report_window, report_window_columns  # noqa: E402
from settlekit.operators import advice as A  # noqa: E402
from settlekit.operators import recon as R  # noqa: E402
from settlekit.operators.latest import latest_per_key  # noqa: E402
from settlekit.operators.payments import deposit_volume, deposits, refunds  # noqa: E402
from settlekit.operators.summaries import (  # noqa: E402
    chargeback_summary, deposit_refund_summary, refund_match_summary, refunds_by_deposit,
)
from settlekit.plans.reconciliation import run_reconciliation  # noqa: E402
from settlekit.plans.report import monthly_exception_report, publish_monthly_report  # noqa: E402
from settlekit.sources.fixtures import settlement_inputs  # noqa: E402
from settlekit.sources.scans import chargebacks_in_window, payments_in_range  # noqa: E402
from settlekit.sources.sinks import append_results, scratch_path, write_report  # noqa: E402

# The training-data subpackage and its pipeline may be absent; their own import errors are not hidden.
training_data = corpus_pipeline = None
try:
    from settlekit.llm import queries as training_data
    import corpus_pipeline
except ModuleNotFoundError as missing:
    if missing.name not in ("settlekit.llm", "corpus_pipeline"):
        raise

RUN_DATE, AS_OF, REPLAY_DAYS = O.RUN_DATE, O.AS_OF, O.REPLAY_DAYS
INSERTED_AT, APP_ID = O.INSERTED_AT, O.APP_ID


def _std(df: DataFrame) -> DataFrame:
    """Decimals as decimal(38,18), as the report types its amounts."""
    return df.select(*[F.col(f.name).cast("decimal(38,18)").alias(f.name) if isinstance(f.dataType, T.DecimalType)
                       else F.col(f.name) for f in df.schema.fields])


def _views(spark: SparkSession, sf_dir: str, period: int = 12, shared_references: bool = False):
    inp = settlement_inputs(spark, sf_dir, shared_references)
    w = report_window(RUN_DATE, period)
    rng = payments_in_range(inp.payments, w)
    return inp, w, deposits(rng), refunds(rng), chargebacks_in_window(inp.chargebacks, w)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the monthly exception report (period 12) at sf0.001."""
    return q_report_p12(spark, "/root/testdata/sf0.001")


# ---------------------------------------------------------------- report side

def q_report_window(spark, sf_dir):
    days = (spark.read.parquet(f"{sf_dir}/orders.parquet")
            .select(F.col("o_orderdate").cast("date").alias("run_date")).distinct())
    parts = []
    for period in (3, 12):
        c = report_window_columns("run_date", period)
        parts.append(days.select("run_date", F.lit(period).alias("period"), c["from_post"].alias("from_post"),
                                 c["from_created"].alias("from_created"), c["to"].alias("window_to"),
                                 c["month"].alias("month")))
    return parts[0].unionByName(parts[1])


def _major_amounts(shared_references=False):
    def run(spark, sf_dir):
        p = settlement_inputs(spark, sf_dir, shared_references).payments
        return p.select("payment_id", "action_type", "settlement_amount", "settlement_rpt_precision",
                        minor_to_major("settlement_amount", "settlement_rpt_precision", p.schema["settlement_amount"].dataType)
                        .alias("major_amount"))
    return run


def q_payments_in_range(spark, sf_dir):
    inp, w, *_ = _views(spark, sf_dir)
    return payments_in_range(inp.payments, w)


def q_deposits(spark, sf_dir):
    return _views(spark, sf_dir)[2]


def q_refunds(spark, sf_dir):
    return _views(spark, sf_dir)[3]


def q_chargebacks_in_window(spark, sf_dir):
    return _std(_views(spark, sf_dir)[4])


def q_deposit_volume(spark, sf_dir):
    return _std(deposit_volume(_views(spark, sf_dir)[2]))


def q_refunds_by_deposit(spark, sf_dir):
    _, _, dep, ref, _ = _views(spark, sf_dir)
    return _std(refunds_by_deposit(dep, ref))


def q_deposit_refund_summary(spark, sf_dir):
    _, _, dep, ref, _ = _views(spark, sf_dir)
    return _std(deposit_refund_summary(dep, ref))


def q_chargeback_summary(spark, sf_dir):
    _, _, dep, _, cbk = _views(spark, sf_dir)
    return _std(chargeback_summary(dep, cbk))


def q_refund_match_summary(spark, sf_dir):
    return _std(refund_match_summary(_views(spark, sf_dir)[3]))


def q_advice_detail(spark, sf_dir):
    inp, w, dep, ref, cbk = _views(spark, sf_dir)
    return _std(A.advice_detail(inp.advice, dep, ref, cbk, w))


def _advice(families, row_counts=False, period=12, shared_references=False):
    def run(spark, sf_dir):
        inp, w, dep, ref, cbk = _views(spark, sf_dir, period, shared_references)
        return _std(A.advice_metrics(inp.advice, dep, ref, cbk, w, families=families, row_counts=row_counts))
    return run


def q_report_p12(spark, sf_dir):
    inp = settlement_inputs(spark, sf_dir)
    return monthly_exception_report(inp.payments, inp.chargebacks, inp.advice, RUN_DATE, 12)


def q_report_shared_references(spark, sf_dir):
    inp = settlement_inputs(spark, sf_dir, shared_references=True)
    return monthly_exception_report(inp.payments, inp.chargebacks, inp.advice, RUN_DATE, 12)


def q_report_p3(spark, sf_dir):
    inp = settlement_inputs(spark, sf_dir)
    return monthly_exception_report(inp.payments, inp.chargebacks, inp.advice, RUN_DATE, 3)


def q_report_roundtrip(spark, sf_dir):
    """Publish periods 12 and 3 (12 twice: the rewrite replaces only its own
    partition) and read the table back."""
    base = scratch_path(spark, "report")
    inp = settlement_inputs(spark, sf_dir)
    for period in (12, 3, 12):
        w = publish_monthly_report(inp.payments, inp.chargebacks, inp.advice, RUN_DATE, period, base)
        done = spark.read.parquet(f"{base}/reporting_month={w.month}/reporting_period={period}")
        write_report(done, base, "1998-08", period)
        write_report(done.limit(0), base, "1998-08", period)     # an empty rerun clears its partition
    return spark.read.parquet(base)


# ---------------------------------------------------------------- reconciliation side

def _recon_inputs(spark, sf_dir):
    inp = settlement_inputs(spark, sf_dir)
    return inp, inp.countable_tables()


def q_latest_history(spark, sf_dir):
    h = settlement_inputs(spark, sf_dir).history.withColumn("table_name", F.upper("table_name"))
    return latest_per_key(h, ["table_name", "count_date"], ["extract_date", "inserted_date"]).select(
        "table_name", "count_date", "bda_count", "vap_count", "matched", "extract_date", "inserted_date")


def q_latest_audit(spark, sf_dir):
    a = settlement_inputs(spark, sf_dir).audit
    return latest_per_key(a, ["table_name", "target_date"], ["extract_date", "inserted_date"]).select(
        "table_name", "target_date", "record_count", "extract_date", "inserted_date")


def q_table_counts(spark, sf_dir):
    inp, tables = _recon_inputs(spark, sf_dir)
    reqs = R.requests_from_control(inp.control, RUN_DATE)
    counts, failed = R.own_counts(spark, reqs, tables)
    meta = spark.createDataFrame(
        [(i, r.table_id, r.table_name, r.count_date.isoformat()) for i, r in enumerate(reqs) if i not in failed],
        "request_id int, id bigint, table_name string, count_date string")
    return meta.join(counts, "request_id").select("id", "table_name", "count_date", "bda_count")


def _reconcile(keep_null_audit=False):
    def run(spark, sf_dir):
        inp, tables = _recon_inputs(spark, sf_dir)
        reqs = R.requests_from_control(inp.control, RUN_DATE)
        return R.reconcile(spark, reqs, inp.audit, AS_OF, tables, inserted_at=INSERTED_AT, app_id=APP_ID,
                           keep_null_audit=keep_null_audit)
    return run


def _replay_candidates(only_failed=True):
    def run(spark, sf_dir):
        inp = settlement_inputs(spark, sf_dir)
        return R.replay_candidates(inp.history, inp.control, RUN_DATE, REPLAY_DAYS, only_failed=only_failed)
    return run


def q_replay_counts(spark, sf_dir):
    inp, tables = _recon_inputs(spark, sf_dir)
    cands = R.replay_candidates(inp.history, inp.control, RUN_DATE, REPLAY_DAYS)
    reqs = R.requests_from_candidates(cands)
    return R.reconcile(spark, reqs, inp.audit, AS_OF, tables, inserted_at=INSERTED_AT, app_id=APP_ID)


def q_reconcile_stored_sql(spark, sf_dir):
    """Control rows read from Parquet, counted by their stored queries; a bad query and a NULL id end as F."""
    inp, tables = _recon_inputs(spark, sf_dir)
    for name, df in tables.items():
        df.createOrReplaceTempView(f"counted_{name.lower()}")
    path = scratch_path(spark, "control")
    spark.createDataFrame([(*r[:4], "Y", r[4]) for r in O.STORED],
                          "table_id int, table_name string, date_column_name string, num_days int, count_ind string, sql string"
                          ).write.parquet(path)
    reqs = R.requests_from_control(spark.read.parquet(path), RUN_DATE)
    return R.reconcile(spark, reqs, inp.audit, AS_OF, tables, inserted_at=INSERTED_AT, app_id=APP_ID)


def q_templates_many_days(spark, sf_dir):
    """Stored queries asked for the last 30 days: one plan and one scan per query; a bad query ends as F for each day."""
    inp, tables = _recon_inputs(spark, sf_dir)
    for name, df in tables.items():
        df.createOrReplaceTempView(f"counted_{name.lower()}")
    reqs = [R.CountRequest(i, t.upper(), c, RUN_DATE - dt.timedelta(days=k), sql)
            for i, t, c, sql in O.TEMPLATES for k in range(1, O.TEMPLATE_DAYS + 1)]
    return R.reconcile(spark, reqs, inp.audit, AS_OF, tables, inserted_at=INSERTED_AT, app_id=APP_ID)


def q_replay_recorded_history(spark, sf_dir):
    """History written by the job on three days, then replayed whole through its recorded queries, failed rows included."""
    inp, tables = _recon_inputs(spark, sf_dir)
    for name, df in tables.items():
        df.createOrReplaceTempView(f"counted_{name.lower()}")
    control = spark.createDataFrame([(*r[:4], "Y", "Y", "TRAN", r[4]) for r in O.RECORDED], inp.control.schema)
    history, base = scratch_path(spark, "recorded"), scratch_path(spark, "recorded-replay")
    none = spark.createDataFrame([], R.RESULT_SCHEMA).withColumn("extract_date", F.lit(None).cast("date"))
    job = dict(tables=tables, inserted_at=INSERTED_AT, app_id=APP_ID, only_failed=False)
    for back in O.RECORDED_RUNS:
        run_reconciliation(spark, control, inp.audit, none, RUN_DATE - dt.timedelta(days=back), AS_OF, 0, history, **job)
    run_reconciliation(spark, control, inp.audit, spark.read.parquet(history), RUN_DATE, AS_OF, REPLAY_DAYS, base, **job)
    return spark.read.parquet(base).drop("extract_date")


def q_replay_counts_history_sql(spark, sf_dir):
    """Replay of every latest day of the library's own history through its recorded queries (first column)."""
    inp, tables = _recon_inputs(spark, sf_dir)
    for name, df in tables.items():
        df.createOrReplaceTempView(name.lower())
    cands = R.replay_candidates(inp.history, inp.control, RUN_DATE, REPLAY_DAYS, only_failed=True).withColumn(
        "runtime_sql", F.expr("concat('SELECT COUNT(*) FROM ', lower(table_name), ' WHERE CAST(', date_column_name, "
                              "' AS DATE) = \\'', count_date, '\\'')"))
    reqs = R.requests_from_candidates(cands, use_history_sql=True)
    return R.reconcile(spark, reqs, inp.audit, AS_OF, tables, inserted_at=INSERTED_AT, app_id=APP_ID, count_column=0)


def q_select_control(spark, sf_dir):
    inp = settlement_inputs(spark, sf_dir)
    return R.select_control(inp.control, inp.audit, RUN_DATE)


def q_results_append_roundtrip(spark, sf_dir):
    """Append today's results twice (a rerun appends) and read them back."""
    base = scratch_path(spark, "recon")
    res = _reconcile()(spark, sf_dir)
    append_results(res, base, RUN_DATE)
    append_results(res, base, RUN_DATE)
    return spark.read.parquet(base)


def q_reconciliation_job(spark, sf_dir):
    """The daily job: today's counts, replay of unmatched days, append; read back."""
    inp, tables = _recon_inputs(spark, sf_dir)
    base = scratch_path(spark, "recon-job")
    run_reconciliation(spark, inp.control, inp.audit, inp.history, RUN_DATE, AS_OF, REPLAY_DAYS, base, tables,
                       inserted_at=INSERTED_AT, app_id=APP_ID)
    return spark.read.parquet(base)


def q_reconciliation_job_selected(spark, sf_dir):
    """The daily job with Part I taken from the selected control rows."""
    inp, tables = _recon_inputs(spark, sf_dir)
    base = scratch_path(spark, "recon-selected")
    run_reconciliation(spark, inp.control, inp.audit, inp.history, RUN_DATE, AS_OF, REPLAY_DAYS, base, tables,
                       inserted_at=INSERTED_AT, app_id=APP_ID, selected_control=True)
    return spark.read.parquet(base)


def q_results_in_catalog(spark, sf_dir):
    """The job appends to a partitioned catalog table, registers its partition, refreshes and
    prints; SQL reads the registered partition and not the one whose folder only exists."""
    inp, tables = _recon_inputs(spark, sf_dir)
    base = scratch_path(spark, "recon-catalog")
    name = "settlekit_" + base.rsplit("-", 1)[1]
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in R.RESULT_SCHEMA.fields)
    spark.sql(f"CREATE TABLE {name} ({columns}, extract_date DATE) USING parquet PARTITIONED BY (extract_date) LOCATION '{base}'")
    rows = run_reconciliation(spark, inp.control, inp.audit, inp.history, RUN_DATE, AS_OF, REPLAY_DAYS, base, tables, table=name,
                              inserted_at=INSERTED_AT, app_id=APP_ID, show=True)
    append_results(rows, base, RUN_DATE + dt.timedelta(days=1))
    return spark.sql(f"SELECT * FROM {name}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "report_window": q_report_window,
        "minor_to_major": _major_amounts(),
        "minor_to_major_wide": _major_amounts(shared_references=True),
        "payments_in_range": q_payments_in_range,
        "deposits": q_deposits,
        "refunds_completed": q_refunds,
        "chargebacks_in_window": q_chargebacks_in_window,
        "deposit_volume": q_deposit_volume,
        "refunds_by_deposit": q_refunds_by_deposit,
        "deposit_refund_summary": q_deposit_refund_summary,
        "chargeback_summary": q_chargeback_summary,
        "refund_match_summary": q_refund_match_summary,
        "advice_detail": q_advice_detail,
        "advice_timing_classes": _advice(("all", "class")),
        "advice_day_buckets": _advice(("day",)),
        "advice_day_buckets_row_counts": _advice(("day",), row_counts=True),
        "advice_metrics_p3": _advice(("all", "class", "day"), period=3),
        "advice_metrics_shared_references": _advice(("all", "class", "day"), shared_references=True),
        "monthly_exception_report_p12": q_report_p12,
        "monthly_exception_report_shared_references": q_report_shared_references,
        "monthly_exception_report_p3": q_report_p3,
        "report_roundtrip": q_report_roundtrip,
        "latest_history": q_latest_history,
        "latest_audit": q_latest_audit,
        "table_counts": q_table_counts,
        "reconcile_counts": _reconcile(),
        "reconcile_counts_null_audit": _reconcile(keep_null_audit=True),
        "replay_candidates": _replay_candidates(),
        "replay_candidates_all": _replay_candidates(only_failed=False),
        "replay_counts": q_replay_counts,
        "reconcile_counts_stored_sql": q_reconcile_stored_sql,
        "reconcile_templates_many_days": q_templates_many_days,
        "replay_recorded_history": q_replay_recorded_history,
        "replay_counts_history_sql": q_replay_counts_history_sql,
        "select_control": q_select_control,
        "results_append_roundtrip": q_results_append_roundtrip,
        "reconciliation_job": q_reconciliation_job,
        "reconciliation_job_selected_control": q_reconciliation_job_selected,
        "results_in_catalog": q_results_in_catalog,
        **(training_data.queries() if training_data else {}),
        **({"pipeline": corpus_pipeline.run} if corpus_pipeline else {}),
    }


# ---------------------------------------------------------------- oracle SQL

def _summary(view: str, cols: str, period: int = 12) -> str:
    return f"{O.with_views(period)}\nSELECT {cols} FROM {view}"


def oracle_sql() -> dict[str, str]:
    amt = "CAST({0} AS DECIMAL(38,18)) AS {0}".format
    cnt = "CAST({0} AS BIGINT) AS {0}".format
    keys7 = ("merchant_id, merchant_name, organization_id, organization_name, settlement_currency_code, "
             "settlement_currency_desc, method_of_payment_code")
    keys4 = "merchant_id, settlement_currency_code, settlement_currency_desc, method_of_payment_code"
    range_cols = ("merchant_id, merchant_name, organization_id, organization_name, method_of_payment_code, "
                  "settlement_currency_code, settlement_currency_desc, payment_id, settlement_amount, "
                  "settlement_rpt_precision, parent_id, complete_date, action_type, ot_start_ts, ot_start_ts_ts, "
                  "amount, txn_reference_number")
    detail_cols = ("merchant_id, payment_id, settlement_currency_code, settlement_currency_desc, method_of_payment_code, "
                   + amt("frd_deposit_settlement_amount") + ", frd_advice_date, frd_refund_date, "
                   + amt("frd_refund_settlement_amount") + ", frd_cbk_date, " + amt("frd_cbk_amount")
                   + ", is_fraud_cbk, cbk_days_after_cps_reported, ref_days_after_cps_reported, frd_cbk_prior, "
                   "frd_refund_prior")
    windows = """WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS run_date FROM orders),
p AS (SELECT 3 AS period, 3 AS post_m, 4 AS created_m UNION ALL SELECT 12, 13, 14),
m AS (SELECT run_date, period, post_m, created_m, CAST(date_trunc('month', run_date) AS DATE) AS m1 FROM d CROSS JOIN p)
SELECT run_date, period,
  CAST(m1 - post_m * INTERVAL '1' MONTH AS DATE) AS from_post,
  CAST(m1 - created_m * INTERVAL '1' MONTH + INTERVAL '14' DAY AS DATE) AS from_created,
  CAST(m1 - INTERVAL '1' DAY AS DATE) AS window_to,
  strftime(CAST(m1 - INTERVAL '1' DAY AS DATE), '%Y-%m') AS month
FROM m"""
    report12 = O.report_select(12)
    report3 = O.report_select(3)
    roundtrip = ("SELECT * FROM (" + O.report_select(12, ",\n  '1998-09' AS reporting_month, "
                                                     "CAST(12 AS INTEGER) AS reporting_period") + ") a\nUNION ALL\n"
                 + "SELECT * FROM (" + O.report_select(3, ",\n  '1998-09' AS reporting_month, "
                                                       "CAST(3 AS INTEGER) AS reporting_period") + ") b")
    recon = O.reconcile_sql()
    lo_h = "WITH " + O.FIXTURE_CTES
    return {
        "report_window": windows,
        "minor_to_major": f"WITH {O.FIXTURE_CTES}\nSELECT payment_id, action_type, settlement_amount, "
                          f"settlement_rpt_precision, CAST({O.major('settlement_amount', 'settlement_rpt_precision')} "
                          f"AS DECIMAL(38,18)) AS major_amount FROM fx_payments",
        "minor_to_major_wide": O.wide_amounts_sql(),
        "payments_in_range": _summary("pay_win", range_cols),
        "deposits": _summary("dep_win", "*"),
        "refunds_completed": _summary("ref_win", "*"),
        "chargebacks_in_window": _summary(
            "cbk_win", "deposit_id, " + amt("chargeback_amount")
            + ", method_of_payment_code, reason_code, issuing_bank_day, issuing_bank_day_ts"),
        "deposit_volume": _summary("dep_volume", f"{keys7}, {cnt('vol_deposit_count')}, "
                                   f"{amt('vol_deposit_settlement_amount')}"),
        "refunds_by_deposit": _summary("dep_refund_totals", "merchant_id, settlement_currency_code, "
                                       f"method_of_payment_code, {cnt('excptn_refund_count')}, "
                                       f"{amt('excptn_refund_settlement_amount')}"),
        "deposit_refund_summary": _summary("volume_with_refunds", f"{keys7}, {cnt('vol_deposit_count')}, "
                                           f"{amt('vol_deposit_settlement_amount')}, {cnt('excptn_refund_count')}, "
                                           f"{amt('excptn_refund_settlement_amount')}"),
        "chargeback_summary": _summary("cbk_totals", f"{keys4}, {cnt('excptn_cbks_count')}, "
                                       f"{amt('excptn_cbks_amount')}, {cnt('excptn_fraud_cbks_count')}, "
                                       f"{amt('excptn_fraud_cbks_amount')}"),
        "refund_match_summary": _summary("refund_matching", f"{keys4}, {cnt('excptn_refund_mtch_count')}, "
                                         f"{cnt('excptn_refund_mtch_count_mtchd')}, "
                                         f"{amt('excptn_refund_mtch_amount')}, "
                                         f"{amt('excptn_refund_mtch_amount_mtchd')}"),
        "advice_detail": _summary("advice_rows", detail_cols),
        "advice_timing_classes": O.advice_metrics_sql(12, O.all_measures() + O.class_measures()),
        "advice_day_buckets": O.advice_metrics_sql(12, O.day_measures()),
        "advice_day_buckets_row_counts": O.advice_metrics_sql(12, O.day_measures(row_counts=True)),
        "advice_metrics_p3": O.advice_metrics_sql(3, O.all_measures() + O.class_measures() + O.day_measures()),
        "advice_metrics_shared_references": O.on_shared(O.advice_metrics_sql(12, O.all_measures() + O.class_measures() + O.day_measures())),
        "monthly_exception_report_p12": report12,
        "monthly_exception_report_shared_references": O.on_shared(report12),
        "monthly_exception_report_p3": report3,
        "report_roundtrip": roundtrip,
        "latest_history": f"""{lo_h}
SELECT table_name, count_date, bda_count, vap_count, matched, extract_date, inserted_date FROM (
  SELECT UPPER(table_name) AS table_name, count_date, bda_count, vap_count, matched, extract_date, inserted_date,
         ROW_NUMBER() OVER (PARTITION BY UPPER(table_name), count_date ORDER BY extract_date DESC, inserted_date DESC) AS rn
  FROM fx_history) x WHERE rn = 1""",
        "latest_audit": f"""{lo_h}
SELECT table_name, target_date, record_count, extract_date, inserted_date FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY table_name, target_date ORDER BY extract_date DESC, inserted_date DESC) AS rn
  FROM fx_audit) x WHERE rn = 1""",
        "table_counts": O.table_counts_sql(),
        "reconcile_counts": recon,
        "reconcile_counts_null_audit": O.reconcile_sql(keep_null_audit=True),
        "replay_candidates": O.replay_candidates_sql(True),
        "replay_candidates_all": O.replay_candidates_sql(False),
        "replay_counts": O.replay_counts_sql(),
        "reconcile_counts_stored_sql": O.stored_sql(),
        "replay_counts_history_sql": O.replay_counts_sql(),
        "select_control": O.select_control_sql(),
        "reconcile_templates_many_days": O.templates_sql(),
        "replay_recorded_history": O.recorded_replay_sql(),
        "reconciliation_job_selected_control": O.selected_job_sql(),
        "results_in_catalog": f"SELECT *, DATE '{RUN_DATE}' AS extract_date FROM ({recon}) r\nUNION ALL\n"
                              f"SELECT *, DATE '{RUN_DATE}' AS extract_date FROM ({O.replay_counts_sql()}) p",
        "results_append_roundtrip": f"SELECT *, DATE '{RUN_DATE}' AS extract_date FROM ({recon}) r\nUNION ALL\n"
                                    f"SELECT *, DATE '{RUN_DATE}' AS extract_date FROM ({recon}) r",
        "reconciliation_job": f"SELECT *, DATE '{RUN_DATE}' AS extract_date FROM ({recon}) r\nUNION ALL\n"
                              f"SELECT *, DATE '{RUN_DATE}' AS extract_date FROM ({O.replay_counts_sql()}) p",
        **(training_data.oracle_sql() if training_data else {}),
    }
