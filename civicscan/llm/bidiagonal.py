"""Singular values and right singular vectors of a small square matrix.

Householder reflections make the matrix upper bidiagonal; dqds (the qd
algorithm in differential form with shifts) finds its singular values to high
relative accuracy; a twisted factorisation gives the vector of each one, from
the place where the factorisations from both ends meet with the smallest
remainder.
"""

from __future__ import annotations

import math

import numpy as np

EPS = float(np.finfo(np.float64).eps)
TINY = float(np.finfo(np.float64).tiny)


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and the right factor V of ``r = U B V^T``."""
    a = np.array(r, np.float64)
    d = a.shape[0]
    v = np.eye(d)
    for k in range(d):
        x = a[k:, k].copy()
        if k < d - 1 and x[1:].any():
            x[0] += math.copysign(np.linalg.norm(x), x[0])
            x /= np.linalg.norm(x)
            a[k:, k:] -= 2 * np.outer(x, x @ a[k:, k:])
        if k < d - 2 and a[k, k + 2:].any():
            x = a[k, k + 1:].copy()
            x[0] += math.copysign(np.linalg.norm(x), x[0])
            x /= np.linalg.norm(x)
            a[k:, k + 1:] -= 2 * np.outer(a[k:, k + 1:] @ x, x)
            v[:, k + 1:] -= 2 * np.outer(v[:, k + 1:] @ x, x)
    return np.diagonal(a).copy(), np.diagonal(a, 1).copy(), v


def _sweep(q: list[float], e: list[float], s: float) -> tuple[list[float], list[float]] | None:
    """One dqds transform by the shift ``s``; None if the shift is above the smallest value."""
    qq, ee = [], []
    d = q[0] - s
    for k in range(len(e)):
        if d < 0:
            return None
        x = d + e[k]
        t = q[k + 1] / x if x > 0 else 0.0
        qq.append(x)
        ee.append(e[k] * t)
        d = d * t - s if x > 0 else q[k + 1] - s
    if d < 0:
        return None
    qq.append(d)
    return qq, ee


def dqds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squares of the singular values of the bidiagonal matrix, descending."""
    out: list[float] = []
    work = [((a * a).tolist(), (b * b).tolist(), 0.0)]
    small = (4 * EPS) ** 2
    while work:
        q, e, shift = work.pop()
        turns = 0
        while True:
            n = len(q)
            if n == 1:
                out.append(q[0] + shift)
                break
            # a superdiagonal that no longer counts splits the matrix, or ends it
            cut = next((k for k in range(n - 2, -1, -1) if e[k] <= small * (q[k + 1] + shift) + TINY), None)
            if cut is not None:
                work.append((q[:cut + 1], e[:cut], shift))
                q, e = q[cut + 1:], e[cut + 1:]
                turns = 0
                continue
            if q[0] < q[-1]:  # the small end comes last
                q, e = q[::-1], e[::-1]
            # the value nearest the last entry lies within the coupling of it
            s = max(0.0, q[-1] - math.sqrt(q[-1] * e[-1]))
            got = None
            for factor in (1.0, 0.5, 0.125, 0.01):
                got = _sweep(q, e, s * factor)
                if got or s == 0.0:
                    s *= factor
                    break
            if got is None:
                s, got = 0.0, _sweep(q, e, 0.0)
            q, e = got
            shift += s
            turns += 1
            if turns > 1000 + 30 * n:
                raise ArithmeticError("dqds: no convergence")
    return np.array(sorted(out, reverse=True))


def _twisted(d: np.ndarray, l: np.ndarray, value: float) -> np.ndarray:  # noqa: E741
    """The vector of ``L D L^T`` for an eigenvalue."""
    n = len(d)
    s, p = np.empty(n), np.empty(n)
    lower, upper = np.empty(n - 1), np.empty(n - 1)
    s[0] = -value
    for k in range(n - 1):
        x = s[k] + d[k]
        x = x if x else EPS * abs(value) + TINY
        lower[k] = d[k] * l[k] / x
        s[k + 1] = lower[k] * l[k] * s[k] - value
    p[-1] = d[-1] - value
    for k in range(n - 2, -1, -1):
        x = d[k] * l[k] * l[k] + p[k + 1]
        x = x if x else EPS * abs(value) + TINY
        t = d[k] / x
        upper[k] = l[k] * t
        p[k] = p[k + 1] * t - value
    at = int(np.argmin(np.abs(s + p + value)))
    z = np.zeros(n)
    z[at] = 1.0
    for i in range(at - 1, -1, -1):
        z[i] = -lower[i] * z[i + 1]
    for i in range(at, n - 1):
        z[i + 1] = -upper[i] * z[i]
    return z / np.linalg.norm(z)


def _beside(z: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """What is left of a vector at right angles to the others."""
    for _ in range(2):
        for o in others:
            z = z - o * (o @ z)
    return z


def _vectors(a: np.ndarray, b: np.ndarray, values: list[float]) -> list[np.ndarray]:
    """Orthonormal vectors of ``B^T B`` for the given values, largest first."""
    if len(a) == 1:
        return [np.ones(1) for _ in values]
    size = max(np.abs(a).max(), np.abs(b).max())
    a = np.where(np.abs(a) < EPS * EPS * size, EPS * EPS * size, a)
    d, l = a * a, b / a[:-1]  # noqa: E741
    full = np.diag(a) + np.diag(b, 1)
    full = full.T @ full
    rng = np.random.default_rng(3)
    out: list[np.ndarray] = []
    for value in values:
        z = _beside(_twisted(d, l, value), out)
        left = np.linalg.norm(z)
        while left < 0.5:
            # equal values give one vector twice: inverse iteration, off the value by
            # more than rounding, finds another one of their space
            z = _beside(rng.standard_normal(len(z)), out)
            for _ in range(3):
                z = np.linalg.solve(full - (value + 1e-10 * size * size) * np.eye(len(z)), z / np.linalg.norm(z))
                z = _beside(z / np.linalg.norm(z), out)
            left = np.linalg.norm(z)
        z = z / left
        out.append(z)
    return out


def right_singular(r: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest squared singular values of ``r`` that rounding does
    not hide (descending) and their unit right vectors as columns.  The sign
    makes each vector's largest entry positive."""
    d = r.shape[1]
    square = np.zeros((d, d))
    square[:min(len(r), d)] = r[:d]
    scale = float(np.abs(square).max(initial=0.0))
    if not d or not scale > 0:
        return np.zeros(0), np.zeros((d, 0))
    a, b, v = bidiagonalise(square / scale)
    # blocks without coupling are solved by themselves
    bound = EPS * np.maximum(np.abs(a[:-1]), np.abs(a[1:])) * 0.5
    cuts = [0, *(int(i) + 1 for i in np.flatnonzero(np.abs(b) <= bound)), d]
    found = [(float(x), i, j) for i, (lo, hi) in enumerate(zip(cuts, cuts[1:])) for j, x in enumerate(dqds(a[lo:hi], b[lo:hi - 1]))]
    found.sort(key=lambda f: (-f[0], f[1], f[2]))
    top = [f for f in found if f[0] > (d * EPS) ** 2 * found[0][0]][:most]
    out = np.zeros((d, len(top)))
    for i, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
        at = [k for k, f in enumerate(top) if f[1] == i]
        for k, z in zip(at, _vectors(a[lo:hi], b[lo:hi - 1], [top[k][0] for k in at])):
            out[lo:hi, k] = z
    out = v @ out
    out *= np.where(out[np.abs(out).argmax(axis=0), np.arange(len(top))] < 0, -1.0, 1.0)
    return np.array([f[0] for f in top]) * scale * scale, out
