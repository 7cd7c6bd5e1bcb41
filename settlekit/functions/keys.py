"""Join keys that treat NULL and the empty string as one value.

The reference joins on ``NVL(x, '')``: a NULL currency code on one side
matches both NULL and '' on the other. This is *not* null-safe equality
(``<=>`` keeps NULL and '' apart), so the helper coalesces explicitly. The key
is cast to string first: ``NVL(int, '')`` fails under ANSI mode.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_as_empty(col: Column | str) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return F.coalesce(col.cast("string"), F.lit(""))


def null_as_empty_join(left: DataFrame, right: DataFrame, plain: Sequence[str], empty_as_null: Sequence[str],
                       how: str = "inner", right_prefix: str = "r_") -> DataFrame:
    """Join on ``plain`` columns by equality and on ``empty_as_null`` columns by
    ``NVL(l, '') = NVL(r, '')``. Right-side key columns are dropped; other
    right-side columns that clash with the left are prefixed."""
    keys = list(plain) + list(empty_as_null)
    renamed = right
    for name in right.columns:
        if name in keys:
            renamed = renamed.withColumnRenamed(name, f"__k_{name}")
        elif name in left.columns:
            renamed = renamed.withColumnRenamed(name, f"{right_prefix}{name}")
    cond = [left[c] == renamed[f"__k_{c}"] for c in plain]
    cond += [null_as_empty(left[c]) == null_as_empty(renamed[f"__k_{c}"]) for c in empty_as_null]
    joined = left.join(renamed, cond, how)
    return joined.drop(*[f"__k_{c}" for c in keys])
