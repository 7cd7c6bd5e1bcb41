from pyspark.sql import functions as F

from settlekit.sources.sinks import append_results, scratch_path, write_report


def test_report_partition_overwrite_is_idempotent(spark):
    base = scratch_path(spark, "test-report")
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([(2, "y"), (3, "z")], "k int, v string")
    write_report(a, base, "2019-09", 12)
    write_report(b, base, "2019-09", 3)
    write_report(b, base, "2019-09", 12)       # replaces only (2019-09, 12)
    rows = sorted((r.k, r.reporting_period) for r in spark.read.parquet(base).collect())
    assert rows == [(2, 3), (2, 12), (3, 3), (3, 12)]


def test_results_append(spark):
    base = scratch_path(spark, "test-append")
    df = spark.createDataFrame([(1,)], "id bigint")
    append_results(df, base, "2019-10-05")
    append_results(df, base, "2019-10-05")
    append_results(df, base, "2019-10-06")
    got = spark.read.parquet(base).groupBy(F.col("extract_date").cast("string").alias("d")).count().collect()
    assert sorted((r.d, r["count"]) for r in got) == [("2019-10-05", 2), ("2019-10-06", 1)]


def test_publish_report_round_trip(spark):
    from settlekit.plans.report import monthly_exception_report, publish_monthly_report
    from settlekit.sources.fixtures import settlement_inputs
    inp = settlement_inputs(spark, "/root/testdata/sf0.001")
    base = scratch_path(spark, "test-publish")
    publish_monthly_report(inp.payments, inp.chargebacks, inp.advice, "1998-10-05", 12, base)
    back = spark.read.parquet(base).drop("reporting_month", "reporting_period")
    direct = monthly_exception_report(inp.payments, inp.chargebacks, inp.advice, "1998-10-05", 12)
    assert back.count() == direct.count() and back.exceptAll(direct.select(*back.columns)).count() == 0
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_append_registers_partition_in_catalog(spark):
    base = scratch_path(spark, "test-catalog")
    df = spark.createDataFrame([(1, "x")], "id bigint, v string")
    spark.sql("DROP TABLE IF EXISTS settlekit_recon_results")
    spark.sql(f"CREATE TABLE settlekit_recon_results (id bigint, v string, extract_date date) USING parquet "
              f"PARTITIONED BY (extract_date) LOCATION '{base}'")
    try:
        append_results(df, base, "2019-10-06", table="settlekit_recon_results")
        append_results(df, base, "2019-10-07", table="settlekit_recon_results")
        parts = sorted(r[0] for r in spark.sql("SHOW PARTITIONS settlekit_recon_results").collect())
        assert parts == ["extract_date=2019-10-06", "extract_date=2019-10-07"]
        assert spark.table("settlekit_recon_results").count() == 2
    finally:
        spark.sql("DROP TABLE IF EXISTS settlekit_recon_results")
