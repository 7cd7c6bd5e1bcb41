"""Publication: an empty rerun clears its partition, results are appended once whatever fails later."""

import datetime as dt

import pytest

from settlekit.operators.recon import requests_from_control
from settlekit.plans.reconciliation import run_reconciliation
from settlekit.sources.sinks import scratch_path, write_report

AUDIT = "table_name string, target_date date, record_count bigint, extract_date date, inserted_date string"
HISTORY = ("table_name string, count_date string, bda_count bigint, vap_count bigint, matched string, inserted_date string, "
           "runtime_sql string, extract_date date")
CONTROL = "table_id int, table_name string, date_column_name string, num_days int, count_ind string, failed_rerun string, sql string"
DAY = dt.date(2019, 10, 5)


def test_empty_rerun_clears_its_partition(spark):
    base = scratch_path(spark, "test-empty")
    rows = spark.createDataFrame([(1,)], "x int")
    write_report(rows, base, "2019-09", 12)
    write_report(rows, base, "2019-09", 3)
    write_report(rows.limit(0), base, "2019-09", 12)
    assert [(r.x, r.reporting_period) for r in spark.read.parquet(base).collect()] == [(1, 3)]


def job(spark, control_rows, base, **options):
    tables = {"T1": spark.createDataFrame([(DAY,), (DAY,), (dt.date(2019, 10, 4),)], "d date"),
              "T2": spark.createDataFrame([("2019-10-05 10:00:00",), ("2019-10-05",), ("no date",), (None,)], "d string")}
    return run_reconciliation(spark, spark.createDataFrame(control_rows, CONTROL), spark.createDataFrame([], AUDIT),
                              spark.createDataFrame([], HISTORY), DAY, DAY, 3, base, tables, inserted_at="x", app_id="a",
                              **options)


def test_appended_once_and_rows_isolated(spark):
    base = scratch_path(spark, "test-once")
    control = [(1, "t1", "d", 0, "Y", "N", None), (2, "t2", "d", 0, "Y", "N", None), (3, "missing", "d", 0, "Y", "N", None),
               (None, "t1", "d", 0, "Y", "N", None), (5, "t1", "nope", 0, "Y", "N", None)]
    with pytest.raises(Exception):
        job(spark, control, base, table="no_such_catalog_table")
    assert spark.read.parquet(base).count() == 5          # written once, although the catalog step failed
    got = {(r.id, r.bda_count, r.matched) for r in job(spark, control, scratch_path(spark, "test-again")).collect()}
    assert got == {(1, 2, "N"), (2, 2, "N"), (3, 0, "F"), (None, 0, "F"), (5, 0, "F")}


def test_run_time_failure_stays_alone(spark):
    spark.createDataFrame([("x",)], "v string").createOrReplaceTempView("bad_values")
    sql = "SELECT 'B' AS t, COUNT(*) FILTER (WHERE CAST(v AS INT) = 1 AND {var1} IS NOT NULL) AS n FROM bad_values"
    rows = job(spark, [(1, "t1", "d", 0, "Y", "N", None), (2, "b", "d", 0, "Y", "N", sql)], scratch_path(spark, "test-alone"))
    assert {(r.id, r.bda_count, r.matched) for r in rows.collect()} == {(1, 2, "N"), (2, 0, "F")}


def test_audit_scan_is_pruned(spark, tmp_path):
    from settlekit.operators.recon import latest_audit
    path = str(tmp_path / "audit")
    spark.createDataFrame([("T1", DAY, 2, DAY, "1")], AUDIT).write.partitionBy("extract_date").parquet(path)
    reqs = requests_from_control(spark.createDataFrame([(1, "t1", "d", 1, "Y", "N", None)], CONTROL), DAY)
    pairs = spark.createDataFrame([("T1", reqs[0].count_date)], "table_name string, count_date date")
    frame = latest_audit(spark.read.parquet(path), pairs, DAY, reqs)
    # the scan's own filters, not its printed form, which Spark cuts at spark.sql.maxMetadataStringLength
    leaves = frame._jdf.queryExecution().sparkPlan().collectLeaves()
    scans = [leaves.apply(i) for i in range(leaves.size()) if "FileScan" in leaves.apply(i).nodeName() or "Scan parquet" in leaves.apply(i).nodeName()]
    assert len(scans) == 1
    by_partition, by_row = (scans[0].partitionFilters().mkString(" ; "), scans[0].dataFilters().mkString(" ; "))
    assert "extract_date" in by_partition and ">= 2019-10-04" in by_partition and "target_date" in by_row
