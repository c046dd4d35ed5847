"""Leading eigenpairs of a symmetric matrix by spectrum slicing.

A shifted matrix ``A - s`` is factored as ``L D Lᵀ`` with symmetric pivoting.  By
Sylvester's law of inertia, the signs in ``D`` tell how many eigenvalues lie above
``s``.  Bisection with such counts closes in on the k-th eigenvalue until it is alone between two
shifts (or nothing but equal ones is left); Rayleigh quotient iteration, which converges
cubically, then gives the pair, and counts on both sides of it certify its number.

Wide intervals are halved in double precision; the rest is done in extended precision, where the machine has it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

WIDE = np.longdouble
EPS = np.finfo(WIDE).eps
#: Bunch and Parlett's bound for taking a single pivot.
SINGLE = (1 + 17 ** 0.5) / 8


@dataclass
class Factors:
    """``P A Pᵀ = L D Lᵀ``; ``D`` has blocks of one or two rows."""

    order: np.ndarray
    low: np.ndarray
    pivots: list[tuple[int, np.ndarray]]

    def positive(self) -> int:
        """How many eigenvalues of ``A`` are positive."""
        # A block of two rows is only taken where its determinant is negative.
        return sum(1 if len(d) == 2 else int(d[0, 0] > 0) for _, d in self.pivots)

    def solve(self, b: np.ndarray) -> np.ndarray:
        x = b[self.order].astype(WIDE)
        for at, d in self.pivots:
            n = len(d)
            x[at + n:] -= self.low[at + n:, at: at + n] @ x[at: at + n]
        for at, d in self.pivots:
            if len(d) == 1:
                x[at] /= d[0, 0]
            else:
                det = d[0, 0] * d[1, 1] - d[0, 1] * d[0, 1]
                u, v = x[at], x[at + 1]
                x[at], x[at + 1] = (d[1, 1] * u - d[0, 1] * v) / det, (d[0, 0] * v - d[0, 1] * u) / det
        for at, d in reversed(self.pivots):
            n = len(d)
            x[at: at + n] -= self.low[at + n:, at: at + n].T @ x[at + n:]
        out = np.empty_like(x)
        out[self.order] = x
        return out


def factor(a: np.ndarray, shift: float, scale: float, kind: type = WIDE) -> Factors:
    """Factor ``a - shift``; a pivot that vanishes becomes the least that ``scale`` can show."""
    m = a.astype(kind)
    n = len(m)
    m[np.arange(n), np.arange(n)] -= kind(shift)
    order, low, pivots, at = np.arange(n), np.eye(n, dtype=kind), [], 0
    tiny = kind(np.finfo(kind).eps * scale)

    def swap(i: int, j: int) -> None:
        if i != j:
            m[[i, j]] = m[[j, i]]
            m[:, [i, j]] = m[:, [j, i]]
            order[[i, j]] = order[[j, i]]
            low[[i, j], :at] = low[[j, i], :at]

    while at < n:
        rest = np.abs(m[at:, at:])
        diagonal = rest.diagonal().copy()
        r = int(diagonal.argmax())
        np.fill_diagonal(rest, 0)
        i, j = sorted(divmod(int(rest.argmax()), n - at))
        if n - at == 1 or diagonal[r] >= SINGLE * rest[i, j]:
            swap(at, at + r)
            if abs(m[at, at]) < tiny:
                m[at, at] = tiny
            size = 1
        else:
            swap(at, at + i)
            swap(at + 1, at + j)
            size = 2
        d = m[at: at + size, at: at + size].copy()
        b = m[at + size:, at: at + size]
        if size == 1:
            column = b / d[0, 0]
        else:
            det = d[0, 0] * d[1, 1] - d[0, 1] * d[0, 1]
            column = b @ (np.array([[d[1, 1], -d[0, 1]], [-d[0, 1], d[0, 0]]], kind) / det)
        low[at + size:, at: at + size] = column
        m[at + size:, at + size:] -= column @ b.T
        pivots.append((at, d))
        at += size
    return Factors(order, low, pivots)


@dataclass
class Pair:
    value: float
    vector: np.ndarray
    certified: bool


def _unit(v: np.ndarray, known: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for q in known:
            v = v - q * (q @ v)
        v = v / np.sqrt(v @ v)
    return v


def leading(a: np.ndarray, k: int, floor: float = 1e-15) -> list[Pair]:
    """The first ``k`` eigenpairs of a positive semidefinite ``a``, by falling eigenvalue.

    Fewer if fewer eigenvalues exceed ``floor`` times the trace.  Equal
    eigenvalues get orthogonal vectors.
    """
    a = np.asarray(a, WIDE)
    scale = a.trace() if len(a) else WIDE(0)
    if not scale > 0:
        return []
    out: list[Pair] = []
    counts: dict[float, int] = {}

    def count(shift, kind: type = WIDE) -> int:
        """How many eigenvalues are greater than ``shift``."""
        if shift not in counts:
            counts[shift] = factor(a, shift, scale, kind).positive()
        return counts[shift]

    rank = min(k, count(scale * WIDE(floor)))
    rng = np.random.default_rng(1)
    for number in range(1, rank + 1):
        known = [p.vector for p in out]
        # Of all shifts tried: the greatest below and the least above the eigenvalue.
        low = max((s for s, c in counts.items() if c >= number), default=scale * WIDE(floor))
        high = min((s for s, c in counts.items() if c < number), default=scale * (1 + 8 * EPS))
        while True:
            alone = count(low) == number and (high not in counts or counts[high] == number - 1)
            close = high - low <= 64 * EPS * scale
            if (alone and high - low <= 0.25 * high) or close:
                pair = _iterate(a, low, high, known, scale, rng, count, number, close)
                if pair:
                    out.append(pair)
                    break
            middle = (low + high) / 2
            if count(middle, np.float64 if high - low > 1e-6 * scale else WIDE) >= number:
                low = middle
            else:
                high = middle
    return out


def _iterate(a, low, high, known, scale, rng, count, number, close) -> Pair | None:
    """Rayleigh quotient iteration from the middle of an interval; nothing if it leaves the interval."""
    v = _unit(rng.normal(size=len(a)).astype(WIDE), known)
    shift, small = (low + high) / 2, False
    for step in range(12):
        v = _unit(factor(a, shift, scale).solve(v), known)
        rho = v @ (a @ v)
        rest = a @ v - rho * v
        if small:  # one step more leaves nothing but rounding
            break
        small = np.sqrt(rest @ rest) <= 32 * EPS * len(a) * scale
        # The first two steps keep the shift, so that the vector turns to the middle of the interval.
        if step >= 1:
            shift = rho
    else:
        if not close:
            return None
    slack = 64 * EPS * len(a) * scale
    if not low - slack <= rho <= high + slack:
        return None
    certified = count(rho - slack) >= number > count(rho + slack)
    return Pair(rho, v, certified) if certified or close else None
