"""Largest eigenpairs of a symmetric matrix by contour integration (FEAST), with inertia counts as proof that none is missed.

* Inertia.  The matrix is brought to tridiagonal form by reflections once; the signs
  of the pivots of T - s I say how many eigenvalues lie below s (Sylvester).
* Intervals.  Bisection on these counts finds the cut below the wanted eigenvalues
  and divides what is above it into intervals of at most ``IN_ONE`` eigenvalues (more
  only where they agree to working precision).
* Contour.  For an interval the spectral projector is the integral of (z I - A)^-1 over
  the circle on it, by Gauss-Legendre nodes on the upper half: one complex shifted
  solve a node, applied to a block of vectors.  Rayleigh-Ritz on the projected block
  gives eigenpairs; the block goes round again until the residuals are at working
  precision and as many Ritz values lie in the interval as the inertia says.  A block
  that falls short is doubled; as wide as the matrix it is exact.
* A last Rayleigh-Ritz over all intervals makes vectors of neighbouring intervals
  orthogonal to working precision.
"""

from __future__ import annotations

import numpy as np

NODES = 8
IN_ONE = 8
ROUNDS = 12
_EPS = np.finfo(float).eps


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a tridiagonal matrix with the same eigenvalues."""
    a = np.array(a, float)
    d = len(a)
    for k in range(d - 2):
        x = a[k + 1:, k].copy()
        length = np.linalg.norm(x)
        if length == 0 or not x[1:].any():
            continue
        x[0] += np.copysign(length, x[0])
        x /= np.linalg.norm(x)
        rest = a[k + 1:, k + 1:]
        p = rest @ x
        q = p - (x @ p) * x
        rest -= 2 * (np.outer(x, q) + np.outer(q, x))
        a[k + 1, k] = a[k, k + 1] = -np.copysign(length, a[k + 1, k])
        a[k + 2:, k] = a[k, k + 2:] = 0
    return np.diag(a).copy(), np.diag(a, 1).copy()


class Inertia:
    """``above(s)``: the number of eigenvalues greater than s."""

    def __init__(self, a: np.ndarray):
        self.diagonal, off = tridiagonal(a)
        self.off2 = off * off
        reach = np.abs(np.concatenate([off, [0]])) + np.abs(np.concatenate([[0], off]))
        self.low, self.high = float((self.diagonal - reach).min()), float((self.diagonal + reach).max())
        self.scale = max(abs(self.low), abs(self.high), np.finfo(float).tiny)

    def above(self, s: float) -> int:
        tiny = _EPS * self.scale * 1e-3
        n, pivot = 0, 0.0
        for k, x in enumerate(self.diagonal):
            pivot = x - s - (self.off2[k - 1] / pivot if k else 0.0)
            if abs(pivot) < tiny:
                pivot = -tiny
            n += pivot > 0
        return n


def cut(inertia: Inertia, wanted: int, low: float, high: float, fine: float) -> float:
    """A point in (low, high) with at least ``wanted`` eigenvalues above it, exactly that many if two eigenvalues can be told apart there."""
    while high - low > fine:
        mid = (low + high) / 2
        n = inertia.above(mid)
        if n == wanted:
            return mid
        low, high = (mid, high) if n > wanted else (low, mid)
    return low


def clear(inertia: Inertia, s: float, bound: float, near: float) -> float | None:
    """The first point from s towards ``bound`` (not beyond) without an eigenvalue within ``near``; None if there is none."""
    step = np.copysign(near, bound - s)
    while (bound - s) * step > 0:
        if inertia.above(s - near) == inertia.above(s + near):
            return s
        s += step
        step *= 1.5  # through a long chain of eigenvalues in few steps
    return None


def intervals(inertia: Inertia, wanted: int) -> list[tuple[float, float, int]]:
    """(low, high, number of eigenvalues), highest first, which hold the ``wanted`` largest eigenvalues or a few more.

    No end of an interval lies within ``near`` of an eigenvalue, so that eigenvalues which agree are never parted.
    """
    fine, near = 64 * _EPS * inertia.scale, 1e4 * _EPS * inertia.scale
    bottom, top = inertia.low - 1e-3 * inertia.scale, inertia.high + 1e-3 * inertia.scale
    low = bottom
    if wanted < len(inertia.diagonal):
        low = clear(inertia, cut(inertia, wanted, bottom, top, fine), bottom, near)
        low = bottom if low is None else low
    todo, out = [(low, top, inertia.above(low))], []
    while todo:
        a, b, n = todo.pop()
        if n > IN_ONE:
            over = inertia.above(b)
            mid = cut(inertia, over + n // 2, a, b, fine)
            for end in (a, b):
                at = clear(inertia, mid, end, near)
                upper = inertia.above(at) - over if at is not None else 0
                if 0 < upper < n:
                    todo += [(a, at, n - upper), (at, b, upper)]
                    break
            else:
                out.append((a, b, n))
        elif n:
            out.append((a, b, n))
    return sorted(out, reverse=True)


def in_interval(a: np.ndarray, low: float, high: float, count: int, scale: float, seed: int = 13) -> np.ndarray:
    """An orthonormal block that holds the eigenvectors of the ``count`` eigenvalues in (low, high)."""
    d = len(a)
    x, w = np.polynomial.legendre.leggauss(NODES)
    turn = np.exp(0.5j * np.pi * (x + 1))
    centre, radius = (low + high) / 2, max((high - low) / 2, 1e3 * _EPS * scale)
    solved = [np.linalg.inv((centre + radius * t) * np.eye(d) - a) for t in turn]
    width = min(d, 2 * count + 4)
    while True:
        block = np.random.default_rng(seed).standard_normal((d, width))
        for _ in range(ROUNDS):
            if width < d:
                block = sum(0.5 * g * (radius * t * (s @ block)).real for g, t, s in zip(w, turn, solved))
            block, _ = np.linalg.qr(block)
            values, turned = np.linalg.eigh(block.T @ a @ block)
            block = block @ turned
            residual = np.linalg.norm(a @ block - block * values, axis=0)
            slack = 1e2 * _EPS * scale
            inside = np.flatnonzero((values > low - slack) & (values < high + slack))
            good = inside[np.argsort(residual[inside], kind="stable")][:count]
            if len(good) == count and residual[good].max(initial=0) <= 1e2 * _EPS * scale * np.sqrt(d):
                return block[:, np.sort(good)]
            if width == d:
                raise ArithmeticError(f"{len(good)} of {count} eigenpairs between {low} and {high}")
        width = min(d, 2 * width)


def largest(a: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, falling; unit eigenvectors as columns) of the ``wanted`` largest eigenvalues of a symmetric matrix."""
    a = np.asarray(a, float)
    d, wanted = len(a), min(wanted, len(a))
    size = float(np.abs(a).max(initial=0))
    if not wanted or not size:
        return np.zeros(0), np.zeros((d, 0))
    a = (a + a.T) / (2 * size)
    inertia = Inertia(a)
    parts = intervals(inertia, wanted)
    if sum(n for _, _, n in parts) < wanted:
        raise ArithmeticError("the intervals hold fewer eigenvalues than are wanted")
    block, _ = np.linalg.qr(np.hstack([in_interval(a, low, high, n, inertia.scale) for low, high, n in parts]))
    values, turned = np.linalg.eigh(block.T @ a @ block)
    order = np.argsort(-values, kind="stable")[:wanted]
    return values[order] * size, block @ turned[:, order]
