"""Publication of results as partitioned Parquet.

The report is written to the folder of its own (month, period) partition and
replaces it, also by an empty result; every other partition stays as it is, so a
rerun is idempotent. Reconciliation results are appended under the run's
``extract_date``; they are one row per request, so one file per run.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from settlekit.functions.periods import as_date
from settlekit.session import shared_dir


def write_report(report: DataFrame, base: str, month: str, period: int) -> None:
    """Overwrite ``base/reporting_month=<month>/reporting_period=<period>``."""
    report.write.mode("overwrite").parquet(f"{base}/reporting_month={month}/reporting_period={int(period)}")


def append_results(results: DataFrame, base: str, run_date, table: str | None = None) -> None:
    """Append results under ``base/extract_date=<run date>``; when ``table``
    names a catalog table over ``base``, register the partition too."""
    day = as_date(run_date)
    (results.withColumn("extract_date", F.lit(day))
     .repartition(1)          # a handful of rows: one file, without collapsing the counting stages
     .write.mode("append")
     .partitionBy("extract_date")
     .parquet(base))
    if table is not None:
        register_partition(results.sparkSession, table, day)


def register_partition(spark: SparkSession, table: str, run_date) -> None:
    """Add the run date's partition to a catalog table and refresh its cached metadata."""
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION (extract_date='{as_date(run_date).isoformat()}')")
    spark.catalog.refreshTable(table)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return f"{shared_dir(spark)}/settlekit-{name}-{uuid.uuid4().hex[:12]}"
