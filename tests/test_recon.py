import datetime as dt

import pytest
from pyspark.sql import functions as F

from settlekit.operators import recon as R
from settlekit.plans.reconciliation import run_reconciliation
from settlekit.sources.fixtures import CONTROL_SCHEMA
from settlekit.sources.sinks import scratch_path

AUDIT = "table_name string, target_date date, record_count bigint, extract_date date, inserted_date string"
HISTORY = ("table_name string, count_date string, matched string, vap_count bigint, runtime_sql string, "
           "extract_date date, inserted_date string")


@pytest.fixture()
def tables(spark):
    t = spark.createDataFrame([(dt.date(2019, 10, 5),)] * 10 + [(dt.date(2019, 10, 2),)] * 3, "d date")
    ts = spark.createDataFrame([(dt.datetime(2019, 10, 5, 23, 59),), (dt.datetime(2019, 10, 6, 0, 0),)], "ts timestamp_ntz")
    return {"T1": t, "TS": ts}


def control(spark, rows):
    full = [(i, n, c, d, "Y", "Y", "TRAN", sql) for i, n, c, d, sql in rows]
    return spark.createDataFrame(full, CONTROL_SCHEMA)


def reconcile(spark, ctl, audit_rows, tables, run="2019-10-05", as_of="2019-10-31", **kw):
    audit = spark.createDataFrame(audit_rows, AUDIT)
    reqs = R.requests_from_control(ctl, run)
    return {r["id"]: r for r in R.reconcile(spark, reqs, audit, as_of, tables, inserted_at="x", app_id="app",
                                            **kw).collect()}


def test_c15_empty_day_without_audit_matches(spark, tables):
    rows = reconcile(spark, control(spark, [(1, "t1", "d", 1, None)]), [], tables)
    r = rows[1]
    assert (r["bda_count"], r["vap_count"], r["matched"], r["count_diff"]) == (0, 0, "Y", 0)
    assert r["count_date"] == "2019-10-04" and r["table_name"] == "T1"


def test_c16_mismatch_and_latest_audit(spark, tables):
    audit = [("T1", dt.date(2019, 10, 5), 12, dt.date(2019, 10, 6), "2019-10-06 02:00:00"),
             ("T1", dt.date(2019, 10, 5), 99, dt.date(2019, 10, 6), "2019-10-06 01:00:00"),
             ("T1", dt.date(2019, 10, 5), 7, dt.date(2019, 11, 9), "2019-11-09 01:00:00")]   # after as_of
    r = reconcile(spark, control(spark, [(1, "t1", "d", None, None)]), audit, tables)[1]
    assert (r["bda_count"], r["vap_count"], r["matched"], r["count_diff"]) == (10, 12, "N", -2)


def test_c17_count_dates():
    assert R.count_date_for("2019-10-05", None) == dt.date(2019, 10, 5)
    assert R.count_date_for("2019-10-05", 3) == dt.date(2019, 10, 2)


def test_timestamp_column_counts_by_day(spark, tables):
    r = reconcile(spark, control(spark, [(1, "ts", "ts", 0, None)]), [], tables)[1]
    assert r["bda_count"] == 1


def test_failed_rows_and_null_audit_option(spark, tables):
    ctl = control(spark, [(1, "t1", "d", 0, None), (2, "missing", "d", 0, None), (3, "t1", "nope", 0, None)])
    rows = reconcile(spark, ctl, [], tables)
    assert (rows[1]["matched"], rows[1]["bda_count"], rows[1]["vap_count"]) == ("N", 10, 0)
    for i in (2, 3):
        assert rows[i]["matched"] == "F" and rows[i]["bda_count"] == 0 and rows[i]["count_diff"] == 0
        assert rows[i]["runtime_sql"].endswith(" has failed in app")
    kept = reconcile(spark, control(spark, [(1, "t1", "d", 0, None)]), [], tables, keep_null_audit=True)[1]
    assert kept["vap_count"] is None and kept["matched"] == "N" and kept["count_diff"] == 10


def test_stored_sql_template(spark, tables):
    tables["T1"].createOrReplaceTempView("recon_t1")
    sql = "SELECT 'T1' AS t, COUNT(*) AS n FROM recon_t1 WHERE d = {var1}"
    rows = reconcile(spark, control(spark, [(1, "t1", "d", 3, sql), (2, "t1", "d", 0, "SELECT COUNT(*) FROM recon_t1")]),
                     [], None)
    assert rows[1]["bda_count"] == 3 and rows[1]["runtime_sql"].endswith("d = '2019-10-02'")
    assert rows[2]["matched"] == "F"        # one column only: the count is read from the second


def test_runtime_failure_is_isolated(spark, tables):
    tables["T1"].createOrReplaceTempView("recon_t1")
    bad = "SELECT 'x', CAST('not a number' AS INT) FROM recon_t1 WHERE d = {var1}"
    ctl = control(spark, [(1, "t1", "d", 0, None), (2, "t1", "d", 0, bad)])
    hist = spark.createDataFrame([], HISTORY)
    audit = spark.createDataFrame([], AUDIT)
    base = scratch_path(spark, "test-recon")
    out = run_reconciliation(spark, ctl, audit, hist, "2019-10-05", "2019-10-31", 10, base, tables,
                             inserted_at="x", app_id="app")
    got = {r["id"]: r["matched"] for r in spark.read.parquet(base).collect()}
    assert got == {1: "N", 2: "F"}
    assert out.count() == 2


def test_c14_replay_upper_cases_before_latest(spark):
    hist = spark.createDataFrame([
        ("Abc", "2019-10-01", "N", 5, "q", dt.date(2019, 10, 2), "a"),
        ("ABC", "2019-10-01", "Y", 5, "q", dt.date(2019, 10, 3), "a"),
        ("ABC", "2019-10-02", "N", 5, "q", dt.date(2019, 10, 3), "a"),
        ("ABC", "2019-10-03", "N", 0, "q", dt.date(2019, 10, 4), "a"),
        ("ABC", "2019-09-03", "N", 3, "q", dt.date(2019, 9, 4), "a"),    # outside the window
    ], HISTORY)
    ctl = control(spark, [(7, "abc", "d", 0, None)])
    rows = R.replay_candidates(hist, ctl, "2019-10-05", 10).collect()
    assert [(r["table_id"], r["table_name"], r["count_date"]) for r in rows] == [(7, "ABC", "2019-10-02")]
    assert len(R.replay_candidates(hist, ctl, "2019-10-05", 10, only_failed=False).collect()) == 3


def test_select_control_exists(spark):
    ctl = spark.createDataFrame([(1, "A", "d", 0, "Y", "N", "TRAN", None), (2, "B", "d", 0, "Y", "N", "DIM", None),
                                 (3, "C", "d", 0, "Y", "N", "DIM", None), (4, "D", "d", 0, "N", "N", "TRAN", None)],
                                CONTROL_SCHEMA)
    audit = spark.createDataFrame([("B", dt.date(2019, 10, 4), 1, dt.date(2019, 10, 5), "x"),
                                   ("B", dt.date(2019, 10, 3), 1, dt.date(2019, 10, 5), "y")], AUDIT)
    got = sorted(r["table_id"] for r in R.select_control(ctl, audit, "2019-10-05").collect())
    assert got == [1, 2]


def test_one_job_for_all_counts(spark, tables):
    ctl = control(spark, [(1, "t1", "d", 0, None), (2, "t1", "d", 3, None), (3, "ts", "ts", 0, None)])
    reqs = R.requests_from_control(ctl, "2019-10-05")
    counts, failed = R.own_counts(spark, reqs, tables)
    assert not failed
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Union") == 1 and plan.count("count(1)") >= 2       # both tables in one plan
    assert sorted(tuple(r) for r in counts.collect()) == [(0, 10), (1, 3), (2, 1)]


def test_control_from_parquet_and_show(spark, tables, capsys):
    ctl_path = scratch_path(spark, "test-control")
    control(spark, [(1, "t1", "d", 0, None), (2, "ts", "ts", 0, None)]).write.parquet(ctl_path)
    ctl = spark.read.parquet(ctl_path)
    base = scratch_path(spark, "test-recon-show")
    out = run_reconciliation(spark, ctl, spark.createDataFrame([], AUDIT), spark.createDataFrame([], HISTORY),
                             "2019-10-05", "2019-10-31", 10, base, tables, inserted_at="x", app_id="app", show=True)
    assert sorted((r["id"], r["bda_count"]) for r in out.collect()) == [(1, 10), (2, 1)]
    assert "runtime_sql" in capsys.readouterr().out


def test_one_scan_per_table_for_all_days(spark):
    base = scratch_path(spark, "test-one-scan")
    spark.createDataFrame([(dt.datetime(2019, 10, d, 12),) for d in range(1, 6) for _ in range(d)],
                          "ts timestamp_ntz").write.parquet(base)
    tables = {"EVENTS": spark.read.parquet(base)}
    ctl = control(spark, [(1, "events", "ts", 0, None), (2, "events", "ts", 2, None), (3, "events", "ts", 4, None)])
    reqs = R.requests_from_control(ctl, "2019-10-05")
    counts, failed = R.own_counts(spark, reqs, tables)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert "GreaterThanOrEqual(ts,2019-10-01T00:00)" in plan and "LessThan(ts,2019-10-06T00:00)" in plan
    assert sorted(tuple(r) for r in counts.collect()) == [(0, 5), (1, 3), (2, 1)]


def _templates(spark, template, n=30):
    base = scratch_path(spark, "test-templates")
    spark.createDataFrame([(dt.datetime(2019, 9, 1) + dt.timedelta(days=i % 40, hours=i % 24), i) for i in range(500)],
                          "ts timestamp_ntz, v int").write.parquet(base)
    spark.read.parquet(base).createOrReplaceTempView("template_rows")
    days = [dt.date(2019, 9, 1) + dt.timedelta(days=i) for i in range(n)]
    reqs = [R.CountRequest(1, "T", "ts", d, template) for d in days]
    branches, failed = R.count_branches(spark, reqs)
    want = {d: spark.sql(template.replace("{var1}", f"'{d}'")).collect()[0][1] for d in days}
    got = {}
    for b in branches:
        got.update({r["day"]: r["n"] for r in b.frame.collect()})
    assert not failed and got == want
    return branches


def test_thirty_days_of_a_template_are_one_scan(spark):
    (branch,) = _templates(spark, "SELECT 'T' AS t, COUNT(*) AS n FROM template_rows WHERE CAST(ts AS DATE) = {var1}")
    plan = branch.frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 1 and "NestedLoop" not in plan and "Cartesian" not in plan
    daily, bad = branch.alone()
    assert len(daily) == 30 and not bad


def test_templates_that_take_no_table_of_days_are_counted_daily(spark):
    assert len(_templates(spark, "SELECT 'T', COUNT(*) AS n FROM template_rows WHERE ts >= {var1} AND ts < date_add({var1}, 1)", 4)) == 4
    assert len(_templates(spark, "SELECT v, 7 AS n FROM template_rows WHERE CAST(ts AS DATE) = {var1}", 4)) == 4      # several rows


def test_template_that_fails_at_run_time_fails_by_day(spark, tables):
    spark.createDataFrame([("2019-10-05", "x"), ("2019-10-03", "1")], "d string, v string").createOrReplaceTempView("some_bad")
    sql = "SELECT 'B' AS t, SUM(CAST(v AS INT)) AS n FROM some_bad WHERE d = {var1}"
    ctl = control(spark, [(1, "b", "d", 0, sql), (2, "b", "d", 2, sql), (3, "b", "d", 1, sql)])
    out = run_reconciliation(spark, ctl, spark.createDataFrame([], AUDIT), spark.createDataFrame([], HISTORY), "2019-10-05", "2019-10-31",
                             10, scratch_path(spark, "test-bad-day"), tables, inserted_at="x", app_id="app")
    assert {r["id"]: (r["matched"], r["bda_count"]) for r in out.collect()} == {1: ("F", 0), 2: ("N", 1), 3: ("Y", 0)}


def test_only_query_errors_mark_a_table(spark, tables):
    from settlekit.plans import reconciliation as P

    class Lost:
        def collect(self):
            raise RuntimeError("an executor is lost")

        unionByName = None

    with pytest.raises(RuntimeError):
        P._counted([R.CountBranch([0], Lost())], {})


def test_recorded_query_loses_one_failure(spark):
    from pyspark.sql import functions as F
    rows = [("SELECT 1 has failed in app-1", "F", "SELECT 1"), ("a has failed in b has failed in app", "F", "a has failed in b"),
            ("x has failed in y", "N", "x has failed in y"), (None, "F", None), ("line\ntwo has failed in z", "F", "line\ntwo")]
    got = spark.createDataFrame(rows, "q string, m string, want string").select(R.recorded_query(F.col("q"), F.col("m")), "want").collect()
    assert all(r[0] == r[1] for r in got)


def test_selected_control_in_the_job(spark, tables):
    ctl = spark.createDataFrame([(1, "t1", "d", 0, "Y", "N", "TRAN", None), (2, "T1", "d", 3, "Y", "N", "DIM", None),
                                 (3, "ts", "ts", 0, "Y", "N", "DIM", None)], CONTROL_SCHEMA)
    audit = spark.createDataFrame([("T1", dt.date(2019, 10, 2), 3, dt.date(2019, 10, 5), "x")], AUDIT)
    none = spark.createDataFrame([], HISTORY)
    for selected, want in ((True, {1, 2}), (False, {1, 2, 3})):
        out = run_reconciliation(spark, ctl, audit, none, "2019-10-05", "2019-10-31", 10, scratch_path(spark, "test-selected"), tables,
                                 inserted_at="x", app_id="app", selected_control=selected)
        assert {r["id"] for r in out.collect()} == want
