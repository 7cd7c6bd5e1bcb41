"""Latest row per key (``ROW_NUMBER() ... = 1``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str | Column], newest_first: Sequence[str]) -> DataFrame:
    """Keep the first row of each key group ordered by ``newest_first``
    descending. Spark plans this as a window with a group limit, applied
    partially before the shuffle, so each task forwards at most one row per key.
    Ties on every ordering column are broken arbitrarily."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in newest_first])
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")
