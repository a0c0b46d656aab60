"""Leading eigenpairs of a symmetric matrix by spectrum slicing.

``inertia`` factors the shifted matrix as L D L' (Bunch-Kaufman pivoting; blocks of one or two rows
in D). By Sylvester's law the signs of D count the eigenvalues on either side of the shift.
Bisection on these counts isolates each of the leading eigenvalues (or a cluster that no shift can
part at working precision); Rayleigh quotient iteration started inside the interval converges
cubically, and is brought back by another count if it leaves the interval. Counts on both sides of
every value found certify its number.
"""

from __future__ import annotations

import numpy as np

_ALPHA = (1 + 17 ** 0.5) / 8  # Bunch-Kaufman: bounds the growth of either kind of step
_EPS = float(np.finfo(float).eps)


def inertia(matrix: np.ndarray, shift: float) -> tuple[int, int, int]:
    """How many eigenvalues are below, at and above ``shift``."""
    a = matrix - shift * np.eye(len(matrix))
    n, k = len(a), 0
    below = at = above = 0
    while k < n:
        column = np.abs(a[k + 1:, k])
        r = k + 1 + int(column.argmax()) if len(column) else k
        biggest = float(column.max()) if len(column) else 0.0
        size, pivot = 1, k
        if biggest > 0 and abs(a[k, k]) < _ALPHA * biggest:
            row = np.abs(a[r, k:])
            row[r - k] = 0
            other = float(row.max())
            if abs(a[k, k]) * other >= _ALPHA * biggest ** 2:
                pass
            elif abs(a[r, r]) >= _ALPHA * other:
                pivot = r
            else:
                size, pivot = 2, r
        to = k + size - 1
        if pivot != to:
            a[[to, pivot]] = a[[pivot, to]]
            a[:, [to, pivot]] = a[:, [pivot, to]]
        if size == 1:
            d = a[k, k]
            below, at, above = below + (d < 0), at + (d == 0), above + (d > 0)
            if d:
                left = a[k + 1:, k].copy()
                a[k + 1:, k + 1:] -= np.outer(left / d, left)
        else:  # such a block is indefinite: one eigenvalue on each side
            below, above = below + 1, above + 1
            left = a[k + 2:, k:k + 2].copy()
            a[k + 2:, k + 2:] -= left @ np.linalg.solve(a[k:k + 2, k:k + 2], left.T)
        k += size
    return below, at, above


def _isolate(matrix: np.ndarray, m: int, scale: float) -> list[tuple[float, float, int, int]]:
    """(low, high, above high, above low) of intervals with one leading eigenvalue, or a cluster, each."""
    radius = np.abs(matrix).sum(axis=1) - np.abs(np.diag(matrix))
    low = float((np.diag(matrix) - radius).min()) - scale * _EPS * 8 - 1e-300
    high = float((np.diag(matrix) + radius).max()) + scale * _EPS * 8 + 1e-300
    todo, done = [(low, high, 0, len(matrix))], []
    while todo:
        low, high, over, upto = todo.pop()
        if upto <= over or over >= m:
            continue
        middle = (low + high) / 2
        if upto - over == 1 and high - low < 0.25 * scale or high - low <= 4 * _EPS * scale * len(matrix) \
                or not low < middle < high:
            done.append((low, high, over, upto))
            continue
        count = inertia(matrix, middle)[2]
        todo += [(low, middle, count, upto), (middle, high, over, count)]
    return sorted(done, key=lambda x: x[2])


def _refine(matrix: np.ndarray, low: float, high: float, over: int, found: list[np.ndarray],
            scale: float) -> tuple[float, np.ndarray]:
    """Rayleigh quotient iteration for the eigenvalue between ``low`` and ``high``."""
    n = len(matrix)
    basis = np.array(found).T if found else np.zeros((n, 0))
    rng = np.random.default_rng(len(found))
    best = None
    for _ in range(80):
        x = rng.standard_normal(n)
        x -= basis @ (basis.T @ x)
        x /= np.linalg.norm(x)
        shift, before = (low + high) / 2, np.inf
        for step in range(12):
            try:
                y = np.linalg.solve(matrix - shift * np.eye(n), x)
            except np.linalg.LinAlgError:  # the shift is an eigenvalue: go off by a rounding error
                y = np.linalg.solve(matrix - (shift + scale * _EPS * 4) * np.eye(n), x)
            for _again in range(2):
                y -= basis @ (basis.T @ y)
            x = y / np.linalg.norm(y)
            value = float(x @ matrix @ x)
            residual = float(np.linalg.norm(matrix @ x - value * x))
            if low - scale * _EPS * n <= value <= high + scale * _EPS * n:
                if best is None or residual < best[0]:
                    best = (residual, value, x)
                if residual <= 4 * _EPS * scale or (step > 2 and residual >= before
                                                    and residual <= 64 * n * _EPS * scale):
                    return best[1], best[2]
                shift = value
            elif step > 2:
                break  # another eigenvalue's: cut the interval and begin anew
            before = residual
        middle = (low + high) / 2
        if not low < middle < high or high - low <= _EPS * scale:
            break
        if inertia(matrix, middle)[2] > over:
            low = middle
        else:
            high = middle
    if best is None:
        raise ArithmeticError("no eigenvector found in an interval that holds an eigenvalue")
    return best[1], best[2]


def leading(matrix: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``m`` largest eigenvalues (falling) and their unit eigenvectors as columns."""
    matrix = (matrix + matrix.T) / 2
    n = len(matrix)
    m = min(m, n)
    scale = float(np.abs(matrix).sum(axis=1).max()) if n else 0.0
    if m == 0 or scale == 0:
        return np.zeros(m), np.eye(n)[:, :m]
    values, vectors = [], []
    for low, high, over, upto in _isolate(matrix, m, scale):
        for _ in range(upto - over):
            value, x = _refine(matrix, low, high, over, vectors, scale)
            values.append(value)
            vectors.append(x)
    order = np.argsort(-np.array(values), kind="stable")[:m]
    values = np.array(values)[order]
    certify(matrix, values, scale)
    return values, np.array(vectors).T[:, order]


def certify(matrix: np.ndarray, values: np.ndarray, scale: float) -> None:
    """Counts on both sides of each value (a rounding error away) prove its number."""
    slack = 64 * len(matrix) * _EPS * scale
    for k, value in enumerate(values.tolist()):
        if inertia(matrix, value + slack)[2] > k or inertia(matrix, value - slack)[2] < k + 1:
            raise ArithmeticError(f"eigenvalue {k + 1} isn't where the counts say")
