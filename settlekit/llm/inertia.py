"""Leading eigenpairs of a small symmetric matrix by spectrum slicing.

The number of eigenvalues above a shift is the number of positive pivots of the
LDL' factorisation of the shifted matrix (Sylvester's law of inertia). Bisection
on these counts isolates each leading eigenvalue, Rayleigh quotient iteration
from inside the isolating interval converges cubically, and the counts on both
sides of the result certify its number. The matrix is dimension x dimension of
the vectors, whatever the number of rows.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(np.float64).eps
_ALPHA = (1 + np.sqrt(17)) / 8      # fixed value: the Bunch-Kaufman pivot threshold


def count_above(matrix: np.ndarray, shift: float) -> int:
    """Eigenvalues of ``matrix`` above ``shift``: positive eigenvalues of D in LDL'
    with one- and two-row pivots (a zero pivot counts as not above)."""
    a = matrix - shift * np.eye(len(matrix))
    tiny = EPS * max(np.abs(a).max(initial=0.0), np.finfo(np.float64).tiny)
    positive, at, n = 0, 0, len(a)
    while at < n:
        rest = a[at:, at:]
        column = np.abs(rest[1:, 0])
        far = int(column.argmax()) + 1 if len(column) else 0
        most = column[far - 1] if far else 0.0
        first = abs(rest[0, 0])
        two = False
        if most > tiny and first < _ALPHA * most:
            other = np.abs(rest[far])
            other[far] = 0.0
            if first * other.max() < _ALPHA * most * most:
                if abs(rest[far, far]) >= _ALPHA * other.max():
                    _swap(rest, 0, far)
                else:
                    _swap(rest, 1, far)
                    two = True
        if two:
            block = rest[:2, :2].copy()
            positive += int((np.linalg.eigvalsh(block) > 0).sum())
            below = rest[2:, :2].copy()
            rest[2:, 2:] -= below @ np.linalg.solve(block, below.T)
            at += 2
            continue
        pivot = rest[0, 0]
        positive += int(pivot > 0)
        if abs(pivot) > tiny * EPS:
            below = rest[1:, 0].copy()
            rest[1:, 1:] -= np.outer(below, below / pivot)
        at += 1
    return positive


def _swap(a: np.ndarray, i: int, j: int) -> None:
    if i != j:
        a[[i, j]] = a[[j, i]]
        a[:, [i, j]] = a[:, [j, i]]


def _solve(matrix: np.ndarray, shift: float, vector: np.ndarray) -> np.ndarray:
    """(matrix - shift)^-1 vector, as a unit vector; off an exact eigenvalue by a few roundings."""
    off = 0.0
    while True:
        try:
            out = np.linalg.solve(matrix - (shift + off) * np.eye(len(matrix)), vector)
            if np.isfinite(out).all() and out.any():
                return out / np.abs(out).max()
        except np.linalg.LinAlgError:
            pass
        off = 2 * off if off else 4 * EPS * np.abs(matrix).max()


def _orthogonal(vector: np.ndarray, to: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for t in to:
            vector = vector - (t @ vector) * t
    return vector / np.linalg.norm(vector)


def _isolate(matrix: np.ndarray, k: int, lo: float, hi: float, width: float) -> tuple[float, float]:
    """An interval that holds eigenvalue ``k`` (from 1, falling) and no other, or is as
    narrow as ``width`` (then it holds a cluster that double precision does not part)."""
    above_lo, above_hi = count_above(matrix, lo), count_above(matrix, hi)
    while hi - lo > width and not (above_lo == k and above_hi == k - 1):
        middle = lo + (hi - lo) / 2
        if not lo < middle < hi:
            break
        n = count_above(matrix, middle)
        if n >= k:
            lo, above_lo = middle, n
        else:
            hi, above_hi = middle, n
    return lo, hi


def leading_eigenpairs(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors as columns) of the up to ``most`` largest eigenvalues that stand
    above the rounding of the matrix, falling. Equal eigenvalues get orthogonal vectors
    of their common space; a vector's largest entry (the first, on ties) is positive."""
    n = len(matrix)
    matrix = (matrix + matrix.T) / 2
    size = float(np.abs(matrix).sum(axis=1).max(initial=0.0))     # no eigenvalue is beyond
    if not size > 0:
        return np.zeros(0), np.zeros((n, 0))
    floor, width = 4 * n * EPS * size, 4 * EPS * size
    values: list[float] = []
    vectors: list[np.ndarray] = []
    seeds = np.random.default_rng(7)
    for k in range(1, min(most, n, count_above(matrix, floor)) + 1):
        lo, hi = _isolate(matrix, k, 0.0, size * (1 + 4 * EPS) + floor, width)
        while True:
            # vectors of a cluster are kept apart by orthogonality alone
            near = [v for v, e in zip(vectors, values) if e <= hi + 1e-6 * size]
            value, vector = lo + (hi - lo) / 2, _orthogonal(seeds.normal(size=n), near)
            for _ in range(2):      # inverse iteration at the middle, then the Rayleigh quotient
                vector = _orthogonal(_solve(matrix, value, vector), near)
            for _ in range(30):
                value = float(vector @ matrix @ vector)
                if np.linalg.norm(matrix @ vector - value * vector) <= 2 * EPS * size:
                    break
                vector = _orthogonal(_solve(matrix, value, vector), near)
            value = float(vector @ matrix @ vector)
            slack = 8 * n * EPS * size
            certain = count_above(matrix, value - slack) >= k > count_above(matrix, value + slack)
            if certain or hi - lo <= width:
                break
            middle = lo + (hi - lo) / 2     # it went to a neighbour: come closer
            lo, hi = (middle, hi) if count_above(matrix, middle) >= k else (lo, middle)
        if not certain:
            raise ArithmeticError(f"eigenvalue {k} could not be certified by its inertia counts")
        values.append(value)
        vectors.append(vector if vector[np.abs(vector).argmax()] > 0 else -vector)
    return np.array(values), np.array(vectors).T.reshape(n, len(vectors))
