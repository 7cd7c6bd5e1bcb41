"""Embedding whitening by spectrum slicing.

An entry c becomes the integer x = floor(1024 c) + 100000. The covariance of the
x-vectors over all rows (divisor n, centred before multiplying) has a size fixed
by the dimension, so its leading eigenpairs are taken on the driver
(``inertia.py``: inertia counts isolate each eigenvalue, Rayleigh quotient
iteration finds it, counts certify its number). A row's whitened value of a
component is its centred x-vector along the eigenvector, over the root of the
eigenvalue.

How it runs: four passes over the table, none with a shuffle of rows. The first
sums x per dimension exactly (integers), the second the centred products, the third
the products of the whitened values (for ``identity_error``), the last writes the
rows. Every task adds up its own rows and emits one number per pair of dimensions;
Spark adds those. Only these sums reach the driver.

Defined results: rows whose vector is null, empty, holds null or non-finite
entries, or entries whose x no long holds, are dropped; so are vectors of another
length than most (ties: the shorter). Repeated rows and ids are all kept and all
counted; a null id stays null. Components stop where eigenvalues vanish against the
rounding of the covariance: fewer rows or dimensions than ``components``, or equal
rows, give fewer components, and no row where nothing varies; an empty table gives an
empty result. Equal eigenvalues get orthogonal vectors of their common space.
Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settlekit.llm.inertia import leading_eigenpairs

SCALE, SHIFT = 1024, 100000
STEP = 4096                         # vectors handled at once in a task
_LONG = float(2 ** 62)              # entries beyond have no x


@dataclass(frozen=True)
class Whitening:
    """What was fitted: row count, exact sums, eigenvalues (falling), unit vectors as columns, trace."""
    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float


def quantised(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(vec_id, x array<bigint>)`` of the rows that take part."""
    v = F.col(vec_col).cast("array<double>")
    held = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c * SCALE) < _LONG)
    # the optimizer may look at x before the filter, so x itself has to be safe
    x = F.transform(F.col("v"), lambda c: F.when(held(c), F.floor(c * SCALE) + SHIFT))
    fine = F.forall("v", held)
    good = rows.select(F.col(id_col).alias("vec_id"), v.alias("v")).where(
        F.col("v").isNotNull() & (F.size("v") > 0) & F.coalesce(fine, F.lit(False)))
    lengths = good.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return good.where(F.size("v") == (lengths[0]["d"] if lengths else -1)).select("vec_id", x.alias("x"))


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, x as int64 matrix) of runs of rows."""
    for lo in range(0, batch.num_rows, STEP):
        part = batch.column(batch.schema.get_field_index("x")).slice(lo, STEP)
        yield lo, part.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(part), -1)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - sums / n in double precision; the whole part is taken off in integers first."""
    whole = np.array([s // n for s in sums], np.int64)
    part = np.array([(s % n) / n for s in sums])
    return (x - whole).astype(np.float64) - part


def _products(batches: Iterator[pa.RecordBatch], n: int, sums: tuple, onto: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """(i, j, sum of products) over all rows of a task, of the centred or the whitened values."""
    total = None
    for batch in batches:
        for _, x in _matrices(batch):
            z = _centred(x, n, sums)
            z = z if onto is None else z @ onto
            total = z.T @ z if total is None else total + z.T @ z
    if total is not None:
        i, j = np.triu_indices(len(total))
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])],
                                         names=["i", "j", "s"])


def _second_moments(x: DataFrame, n: int, sums: tuple, onto: np.ndarray | None, d: int) -> np.ndarray:
    """The covariance with divisor n, added up by Spark."""
    rows = x.select("x").mapInArrow(lambda it: _products(it, n, sums, onto), "i int, j int, s double").groupBy("i", "j").agg(
        F.sum("s").alias("s")).collect()
    out = np.zeros((d, d))
    for i, j, s in rows:
        out[i, j] = out[j, i] = s / n
    return out


def fit_whitening(x: DataFrame, components: int = 8) -> Whitening | None:
    """The whitening of ``quantised`` rows; None of an empty table."""
    sums = x.select(F.posexplode("x").alias("i", "c")).groupBy("i").agg(
        F.sum(F.col("c").cast("decimal(38,0)")).alias("s"), F.count(F.lit(1)).alias("n")).orderBy("i").collect()
    if not sums:
        return None
    n, totals = sums[0]["n"], tuple(int(r["s"]) for r in sums)
    cov = _second_moments(x, n, totals, None, len(totals))
    values, vectors = leading_eigenpairs(cov, components)
    return Whitening(n, totals, values, vectors, float(np.trace(cov)))


def _deviations(x: np.ndarray, n: int, sums: tuple) -> list[Decimal]:
    """Exact sum over dimensions of (n x - sum)^2, in machine integers where they hold it."""
    far = max(int(np.abs(x).max(initial=0)) * n + max(abs(s) for s in sums), 1)
    if far * far * x.shape[1] < 1 << 62:
        y = x * n - np.array(sums, np.int64)
        return [Decimal(int(v)) for v in (y * y).sum(axis=1)]
    return [Decimal(sum((int(c) * n - s) ** 2 for c, s in zip(row, sums))) for row in x]


def _whiten(batches: Iterator[pa.RecordBatch], n: int, sums: tuple, onto: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(batch.schema.get_field_index("vec_id"))
        for lo, x in _matrices(batch):
            w = _centred(x, n, sums) @ onto
            yield pa.RecordBatch.from_arrays(
                [ids.slice(lo, len(x)), pa.array([str(v) for v in _deviations(x, n, sums)]),
                 pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * w.shape[1], pa.array(w.ravel()))],
                names=["vec_id", "deviation", "w"])


def whiten(rows: DataFrame, components: int = 8, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Per row and component: ``vec_id, component, n, deviation decimal(38,0), whitened,
    explained, identity_error``. A deviation beyond 38 digits is null."""
    x = quantised(rows, id_col, vec_col)
    kind = x.schema["vec_id"].dataType.simpleString()
    fit = fit_whitening(x, components)
    if fit is None or not len(fit.values):
        return rows.sparkSession.createDataFrame(
            [], f"vec_id {kind}, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double")
    n, sums, onto = fit.n, fit.sums, fit.vectors / np.sqrt(fit.values)
    gram = _second_moments(x, n, sums, onto, onto.shape[1])
    error = float(np.abs(gram - np.eye(len(gram))).max())
    made = x.mapInArrow(lambda it: _whiten(it, n, sums, onto), f"vec_id {kind}, deviation string, w array<double>")
    share = F.array(*[F.lit(float(e / fit.trace)) for e in fit.values])
    return made.select("vec_id", F.col("deviation").try_cast("decimal(38,0)").alias("deviation"), F.posexplode("w").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation", "whitened",
        F.get(share, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))
