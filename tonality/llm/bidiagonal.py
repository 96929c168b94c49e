"""Singular values and right singular vectors of a small matrix, accurately.

Householder reflections make R upper bidiagonal, the differential quotient-difference
algorithm with shifts (dqds) finds its singular values to high relative accuracy, and a
twisted factorisation of each shifted B'B gives the right singular vector by one solve.
Close values are kept orthogonal by Gram-Schmidt inside their cluster.
"""

from __future__ import annotations

import math

import numpy as np

EPS = float(np.finfo(float).eps)
#: Neighbours closer than this (relative to the larger) form a cluster.
CLUSTER = 1e-3


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, V): R = U B V' with B upper bidiagonal, diagonal a, superdiagonal b."""
    m = np.array(r, float)
    d = m.shape[1]
    v = np.eye(d)

    def reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
        top = np.abs(x).max(initial=0.0)
        u = x / top if top else x.copy()
        norm = math.sqrt(float(u @ u))
        if not norm:
            return u, 0.0
        u[0] += math.copysign(norm, u[0])
        return u, 2.0 / float(u @ u)

    for k in range(d):
        u, tau = reflector(m[k:, k])
        if tau:
            m[k:, k:] -= np.outer(tau * u, u @ m[k:, k:])
        if k < d - 2:
            u, tau = reflector(m[k, k + 1:])
            if tau:
                m[k:, k + 1:] -= np.outer(m[k:, k + 1:] @ u, tau * u)
                v[:, k + 1:] -= np.outer(v[:, k + 1:] @ u, tau * u)
    return np.diag(m).copy(), np.diag(m, 1).copy(), v


def _dqds_step(q: list[float], e: list[float], lo: int, hi: int, shift: float):
    """One dqds transform of q[lo..hi], e[lo..hi-1]; None when the shift was too large."""
    nq, ne = [0.0] * (hi - lo + 1), [0.0] * (hi - lo)
    d = q[lo] - shift
    least = d
    for i in range(lo, hi):
        if d < 0:
            return None
        nq[i - lo] = d + e[i]
        if nq[i - lo] == 0.0:
            t = 0.0 if q[i + 1] == 0.0 else math.inf
        else:
            t = q[i + 1] / nq[i - lo]
        if not math.isfinite(t):
            return None
        ne[i - lo] = e[i] * t
        d = d * t - shift
        least = min(least, d)
    if d < 0:
        return None
    nq[hi - lo] = d
    return nq, ne, least


def dqds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squares of the singular values of the bidiagonal (a, b), falling."""
    q, e = [float(x) ** 2 for x in a], [float(x) ** 2 for x in b]
    found: list[float] = []
    stack = [(0, len(q) - 1, 0.0)]
    while stack:
        lo, hi, sigma = stack.pop()
        shift = 0.0
        while True:
            if hi < lo:
                break
            if hi == lo:
                found.append(sigma + q[lo])
                break
            if e[hi - 1] <= EPS * EPS * (sigma + q[hi]):
                found.append(sigma + q[hi])
                hi -= 1
                shift = 0.0
                continue
            cut = next((i for i in range(hi - 2, lo - 1, -1)
                        if e[i] <= EPS * EPS * (sigma + min(q[i], q[i + 1]))), None)
            if cut is not None:
                stack.append((lo, cut, sigma))
                lo, shift = cut + 1, 0.0
                continue
            step = _dqds_step(q, e, lo, hi, shift)
            while step is None:
                # Too large a shift: a smaller one, at last none (which never fails).
                shift = shift / 4 if shift > 1e-3 * min(q[lo:hi + 1]) and shift > 0 else 0.0
                step = _dqds_step(q, e, lo, hi, shift)
                if step is None and shift == 0.0:
                    raise ArithmeticError("dqds: the values are not finite")
            q[lo:hi + 1], e[lo:hi], least = step
            sigma += shift
            # Smaller value of the last 2 x 2 block, kept below the least pivot seen.
            x, y, z = q[hi - 1] + (e[hi - 2] if hi - 2 >= lo else 0.0), q[hi], e[hi - 1]
            half = (x + y + z) / 2
            det = x * y
            small = det / (half + math.sqrt(max(half * half - det, 0.0))) if half else 0.0
            shift = 0.98 * min(small, least) if e[hi - 1] > 1e-6 * (q[hi] + EPS * sigma) else min(small, least) * (1 - 1e-6)
            shift = max(shift, 0.0)
    return np.array(sorted(found, reverse=True))


def _twisted(a: np.ndarray, b: np.ndarray, lam: float) -> np.ndarray:
    """Unit vector z with (B'B - lam I) z = gamma e_k, twisted where |gamma| is smallest."""
    n = len(a)
    if n == 1:
        return np.ones(1)
    diag, low = a * a, b / a[:-1]
    tiny = np.finfo(float).tiny
    # Stationary transform from the top, progressive one from the bottom.
    s, lp = np.empty(n), np.empty(n - 1)
    s[0] = -lam
    for i in range(n - 1):
        dp = s[i] + diag[i] or tiny
        lp[i] = diag[i] * low[i] / dp
        s[i + 1] = lp[i] * low[i] * s[i] - lam
    p, um = np.empty(n), np.empty(n - 1)
    p[n - 1] = diag[n - 1] - lam
    for i in range(n - 2, -1, -1):
        dm = diag[i] * low[i] * low[i] + p[i + 1] or tiny
        t = diag[i] / dm
        um[i] = low[i] * t
        p[i] = p[i + 1] * t - lam
    gamma = s + p + lam
    gamma = np.where(np.isfinite(gamma), gamma, math.inf)
    k = int(np.argmin(np.abs(gamma)))
    z = np.zeros(n)
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -lp[i] * z[i + 1]
    for i in range(k, n - 1):
        z[i + 1] = -um[i] * z[i]
    z[~np.isfinite(z)] = 0.0
    top = np.abs(z).max()
    z /= top
    return z / math.sqrt(float(z @ z))


def right_vectors(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(squared singular values, falling; right singular vectors of B as columns)."""
    n = len(a)
    scale = max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0))
    if not scale:
        return np.zeros(n), np.eye(n)
    # A zero on the diagonal moves no value by more than this and keeps all pivots defined.
    a = np.where(np.abs(a) < 1e-30 * scale, 1e-30 * scale, a)
    off = np.abs(b) <= 4 * EPS * (np.abs(a[:-1]) + np.abs(a[1:]))
    starts = [0, *(np.flatnonzero(off) + 1).tolist(), n]
    values, vectors = [], []
    for lo, hi in zip(starts, starts[1:], strict=False):
        ba, bb = a[lo:hi], b[lo:hi - 1]
        lams = dqds(ba, bb)
        block: list[np.ndarray] = []
        first = 0
        for i, lam in enumerate(lams):
            if i and lams[i - 1] - lam > CLUSTER * lams[i - 1]:
                first = i
            z = _twisted(ba, bb, lam)
            near = block[first:]
            for attempt in range(4):
                w = z.copy()
                for _ in range(2):
                    for other in near:
                        w -= (other @ w) * other
                left = math.sqrt(float(w @ w))
                if left > 0.1 or (attempt and left > 1e-8):
                    break
                # Inside a cluster: a new direction, drawn towards the invariant space.
                z = _solve(ba, bb, lam, np.random.default_rng(i * 7 + attempt).standard_normal(len(ba)), near)
            block.append(w / left)
        values += lams.tolist()
        for z in block:
            full = np.zeros(n)
            full[lo:hi] = z
            vectors.append(full)
    order = np.argsort(-np.array(values), kind="stable")
    return np.array(values)[order], np.array(vectors).T[:, order]


def _solve(a: np.ndarray, b: np.ndarray, lam: float, x: np.ndarray, near: list[np.ndarray]) -> np.ndarray:
    """Inverse iteration on B'B - lam I from ``x``, orthogonal to ``near`` (clusters only)."""
    t = np.diag(a * a) + np.diag(a[:-1] * b, 1) + np.diag(a[:-1] * b, -1)
    t[np.arange(1, len(a)), np.arange(1, len(a))] += b * b
    top = np.abs(t).max()
    shifted = t - (lam + 64 * EPS * top) * np.eye(len(a))
    for _ in range(3):
        for other in near:
            x = x - (other @ x) * other
        x = np.linalg.solve(shifted, x)
        x /= math.sqrt(float(x @ x))
    return x


def right_singular(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(squared singular values of R, falling; its right singular vectors as columns)."""
    a, b, v = bidiagonalise(r)
    values, z = right_vectors(a, b)
    return values, v @ z
