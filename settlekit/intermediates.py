"""Intermediate tables with an owner.

A job that reads one result several times writes it once as Parquet under the
shared folder (``spark.checkpoint.dir``), so that it survives lost executors, and
removes it when the job ends, also by an error:

    with Intermediates(spark) as own:
        totals = own.table(totals)
        ...
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from settlekit.session import shared_dir


class Intermediates:
    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.base = f"{shared_dir(spark)}/settlekit-job-{uuid.uuid4().hex}"
        self._made = 0

    def table(self, df: DataFrame) -> DataFrame:
        """``df`` written now and read back."""
        path = f"{self.base}/{self._made}"
        self._made += 1
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        """Remove all tables; what was made from them must not be read any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.base)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def __enter__(self) -> "Intermediates":
        return self

    def __exit__(self, *_) -> None:
        self.close()
