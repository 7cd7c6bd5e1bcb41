"""Whitening against numpy's eigenvalues and Python's exact integers; spectrum slicing on its own."""

import math
from decimal import Decimal

import numpy as np
import pytest

from settlekit.llm import queries
from settlekit.llm.inertia import count_above, leading_eigenpairs
from settlekit.llm.whitening import whiten

SCHEMA = "vec_id bigint, embedding array<double>, component string, w string"


def brute(vectors, k):
    """(n, deviations, eigenvalues, explained, |whitened|) of clean vectors."""
    x = np.array([[math.floor(1024 * float(c)) + 100000 for c in v] for v in vectors], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    dev = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x]
    z = np.array([[float(n * c - s) / n for c, s in zip(row, sums)] for row in x])
    cov = z.T @ z / n
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1][:k], q[:, ::-1][:, :k]
    return n, dev, e, e / np.trace(cov), np.abs(z @ q / np.sqrt(e))


def test_matches_numpy(sc):
    rng = np.random.default_rng(5)
    good = [list(map(float, v)) for v in rng.normal(size=(300, 12)) * np.linspace(3, 0.5, 12)]
    good[7] = list(good[3])                                            # a repeated row
    bad = [None, [], [1.0] * 11 + [None], [1.0] * 11 + [float("nan")], [float("inf")] * 12, [1e300] * 12, [0.5] * 5]
    rows = [(i, v, "x", "y") for i, v in enumerate(good)] + [(1000 + i, v, "x", "y") for i, v in enumerate(bad)]
    rows[8] = (None, good[8], "x", "y")
    got = whiten(sc.createDataFrame(rows, SCHEMA).repartition(5), components=8).collect()
    n, dev, e, share, size = brute(good, 8)
    assert len(got) == 300 * 8 and {r["n"] for r in got} == {n}
    ids = {(None if i == 8 else i): i for i in range(300)}
    for r in got:
        i, c = ids[r["vec_id"]], r["component"] - 1
        assert r["deviation"] == Decimal(dev[i])
        assert abs(abs(r["whitened"]) - size[i, c]) < 1e-9
        assert abs(r["explained"] - share[c]) < 1e-12
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-10
    # one sign for all rows of a component
    z = np.zeros((300, 8))
    for r in got:
        z[ids[r["vec_id"]], r["component"] - 1] = r["whitened"]
    assert np.abs(z.T @ z / n - np.eye(8)).max() < 1e-10


def test_exact_beyond_machine_integers(sc):
    rows = [(1, [1e12, 0.0]), (2, [-1e12, 1.0]), (3, [3.0, -1e12])]
    got = {r["vec_id"]: r["deviation"] for r in whiten(sc.createDataFrame(rows, "vec_id int, embedding array<double>"), 1).collect()}
    _, dev, *_ = brute([v for _, v in rows], 1)
    assert got == {i + 1: Decimal(d) for i, d in enumerate(dev)}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(i, [0.5, 0.25]) for i in range(4)]])
def test_nothing_varies(sc, rows):
    out = whiten(sc.createDataFrame(rows, "vec_id bigint, embedding array<double>"))
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert out.count() == 0


def test_registered_query_is_whole(sc):
    sf = "/root/testdata/sf0.001"
    made = queries.q_whitening(sc, sf).collect()
    table = sc.read.parquet(f"{sf}/embeddings.parquet").collect()
    n, dev, e, share, size = brute([r["embedding"] for r in table], 8)
    at = {r["vec_id"]: i for i, r in enumerate(table)}
    assert len(made) == 8 * len(table)
    for r in made:
        assert r["deviation"] == dev[at[r["vec_id"]]] and r["n"] == n
        assert abs(abs(r["whitened"]) - size[at[r["vec_id"]], r["component"] - 1]) < 1e-8
        assert abs(r["explained"] / share[r["component"] - 1] - 1) < 1e-10
    assert made[0]["identity_error"] < 1e-8


def test_inertia_counts():
    rng = np.random.default_rng(1)
    for _ in range(300):
        n = int(rng.integers(1, 10))
        a = rng.integers(-3, 4, size=(n, n)).astype(float)
        a += a.T
        shift = rng.normal()
        assert count_above(a, shift) == int((np.linalg.eigvalsh(a) > shift).sum())
    assert count_above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1           # needs a two-row pivot


@pytest.mark.parametrize("gap", [1e-3, 1e-8, 1e-12, 0.0])
def test_close_eigenvalues(gap):
    rng = np.random.default_rng(2)
    q, _ = np.linalg.qr(rng.normal(size=(30, 30)))
    e = np.sort(np.r_[10 + gap * np.arange(5), rng.random(25)])[::-1]
    m = (q * e) @ q.T
    values, vectors = leading_eigenpairs(m, 8)
    assert np.abs(values - e[:8]).max() < 1e-13 * 10
    assert np.abs(vectors.T @ vectors - np.eye(8)).max() < 1e-11
    assert np.abs(m @ vectors - vectors * values).max() < 1e-12
