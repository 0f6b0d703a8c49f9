"""Leading eigenvectors of a symmetric matrix by spectrum slicing.

The inertia of an LDLᵀ factorization of A - s I counts the eigenvalues above s (Sylvester's law). Counts
bisect the axis until an interval holds one eigenvalue, whose number is then known. Inverse iteration at
the interval's middle and Rayleigh quotient iteration, which converges cubically, give its vector, and
counts on both sides of the final quotient certify the number. Eigenvalues closer together than
``CLOSE`` times the matrix's norm are taken as a group: inverse iteration on a block gives its space, and
a Rayleigh-Ritz step in it the vectors.
"""

from __future__ import annotations

import numpy as np

ALPHA = (1 + 17**0.5) / 8  # fixed value: bounds the growth of Bunch-Kaufman pivots
CLOSE, ZERO = 1e-11, 1e-12
EPS = np.finfo(float).eps


def count_above(a: np.ndarray, shift: float) -> int:
    """The number of eigenvalues of ``a`` above ``shift``: the positive part of D in LDLᵀ, with symmetric pivoting."""
    m = a - shift * np.eye(len(a))
    n, k, above = len(m), 0, 0

    def swap(i: int, j: int) -> None:
        if i != j:
            m[[i, j]] = m[[j, i]]
            m[:, [i, j]] = m[:, [j, i]]

    while k < n:
        below = np.abs(m[k + 1 :, k])
        far = k + 1 + int(below.argmax()) if len(below) else k
        largest = below[far - k - 1] if len(below) else 0.0
        wide = False
        if abs(m[k, k]) < ALPHA * largest:
            row = np.abs(m[far, k:])
            row[far - k] = 0.0
            reach = row.max()
            if abs(m[k, k]) * reach < ALPHA * largest**2:
                if abs(m[far, far]) >= ALPHA * reach:
                    swap(k, far)
                else:
                    swap(k + 1, far)
                    wide = True
        if wide:
            block, side = m[k : k + 2, k : k + 2].copy(), m[k + 2 :, k : k + 2].copy()
            det = block[0, 0] * block[1, 1] - block[0, 1] ** 2
            above += 1 if det < 0 else 2 * int(block[0, 0] + block[1, 1] > 0)
            inverse = np.array([[block[1, 1], -block[0, 1]], [-block[0, 1], block[0, 0]]]) / det
            m[k + 2 :, k + 2 :] -= side @ inverse @ side.T
            k += 2
        else:
            pivot = m[k, k]
            above += int(pivot > 0)
            if pivot != 0 and k + 1 < n:
                side = m[k + 1 :, k].copy()
                m[k + 1 :, k + 1 :] -= np.outer(side, side / pivot)
            k += 1
    return above


def _solve(a: np.ndarray, shift: float, v: np.ndarray, norm: float) -> np.ndarray:
    """(a - shift I)^-1 v; a shift that is an eigenvalue to the last bit is moved by a rounding error."""
    eye = np.eye(len(a))
    for nudge in (0.0, EPS * norm, 8 * EPS * norm):
        try:
            out = np.linalg.solve(a - (shift + nudge) * eye, v)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(out).all():
            return out
    raise np.linalg.LinAlgError("no solution near an eigenvalue")


def _rayleigh(a: np.ndarray, low: float, high: float, v: np.ndarray, norm: float) -> tuple[float, np.ndarray] | None:
    """The eigenpair in (low, high], or None if the iteration left the interval."""
    for _ in range(2):
        v = _solve(a, (low + high) / 2, v, norm)
        v /= np.linalg.norm(v)
    for _ in range(12):
        value = float(v @ a @ v)
        if np.linalg.norm(a @ v - value * v) <= 8 * EPS * norm:
            break
        v = _solve(a, value, v, norm)
        v /= np.linalg.norm(v)
    value = float(v @ a @ v)
    settled = np.linalg.norm(a @ v - value * v) <= 64 * EPS * norm
    return (value, v) if settled and low < value <= high else None


def _apart(v: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """The vector without what rounding left of the others in it."""
    for _ in range(2):
        for other in others:
            v = v - (other @ v) * other
    return v / np.linalg.norm(v)


def leading(a: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors as columns) of the up to ``most`` largest eigenvalues, which have to be above zero."""
    norm = float(np.abs(a).sum(0).max()) if len(a) else 0.0
    if norm == 0.0:
        return np.zeros(0), np.zeros((len(a), 0))
    counts = {1.01 * norm: 0}

    def count(shift: float) -> int:
        if shift not in counts:
            counts[shift] = count_above(a, shift)
        return counts[shift]

    rng = np.random.default_rng(1)
    wanted = min(most, count(ZERO * norm))  # eigenvalues that rounding cannot tell from zero have no direction
    values, vectors = [], []
    while len(values) < wanted:
        number = len(values) + 1
        low = max(s for s, above in counts.items() if above >= number)
        high = min(s for s, above in counts.items() if above < number and s > low)
        while True:
            single = counts[low] == number and counts[high] == number - 1
            if single:
                start = rng.standard_normal(len(a))
                pair = _rayleigh(a, low, high, start / np.linalg.norm(start), norm)
                if pair is not None:
                    apart = 128 * EPS * norm
                    if count(pair[0] - apart) >= number > count(pair[0] + apart):  # the number is certified
                        values.append(pair[0]), vectors.append(_apart(pair[1], vectors))
                        break
            if high - low <= CLOSE * norm:
                size = counts[low] - number + 1
                block = np.linalg.qr(rng.standard_normal((len(a), size)))[0]
                for _ in range(6):
                    block = np.linalg.qr(_solve(a, (low + high) / 2, block, norm))[0]
                ritz, turn = np.linalg.eigh(block.T @ a @ block)
                values.extend(ritz[::-1].tolist()), vectors.extend((block @ turn[:, ::-1]).T)
                break
            middle = (low + high) / 2
            if count(middle) >= number:
                low = middle
            else:
                high = middle
    return np.array(values[:wanted]), np.array(vectors[:wanted]).T.reshape(len(a), wanted)
