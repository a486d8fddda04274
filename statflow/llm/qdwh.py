"""Symmetric eigenproblems by spectral divide and conquer over QDWH polar factors.

The orthogonal polar factor of ``A - shift * I`` is its matrix sign, so half of sign plus
identity projects on the eigenvectors above the shift. An orthonormal basis of that
subspace and of its complement splits ``A`` into two smaller problems, until blocks
are single numbers or multiples of the identity.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
#: A start for the smallest singular value that is never too large in double precision.
LEAST = 1e-18
#: Shifts that are tried in turn, in standard deviations of the spectrum about its mean.
NUDGES = (0.0, 0.173, -0.173, 0.391, -0.391, 0.617, -0.617, 0.871, -0.871, 0.057, -0.057)


def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix, by dynamically weighted Halley steps."""
    n = len(a)
    eye = np.eye(n)
    size = np.linalg.norm(a)
    x = a / size if size else eye.copy()
    low = LEAST
    for _ in range(20):
        d = np.cbrt(4 * (1 - low * low) / low**4)
        root = np.sqrt(1 + d)
        wa = root + 0.5 * np.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - low * low) / (low * low * root)))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:  # the QR form, stable for any conditioning
            q = np.linalg.qr(np.concatenate([np.sqrt(wc) * x, eye]))[0]
            new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        else:
            new = wb / wc * x + (wa - wb / wc) * np.linalg.solve(eye + wc * (x.T @ x), x.T).T
        new = (new + new.T) / 2
        low = min(1.0, low * (wa + wb * low * low) / (1 + wc * low * low))
        step = np.linalg.norm(new - x)
        x = new
        if low > 1 - 1e-14 and step < np.cbrt(EPS):
            break
    return x


def split(a: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of two invariant subspaces of ``a``, that of the larger eigenvalues
    first; none if ``a`` is a multiple of the identity up to rounding."""
    n = len(a)
    mean = np.trace(a) / n
    spread = np.linalg.norm(a - mean * np.eye(n)) / np.sqrt(n)
    scale = np.linalg.norm(a)
    if spread <= 4 * EPS * scale:
        return None
    start = np.random.default_rng(n).standard_normal((n, n))
    best = (np.inf, None)
    for shift in [float(np.median(np.diag(a))), *(mean + s * spread for s in NUDGES)]:
        projector = (polar_factor(a - shift * np.eye(n)) + np.eye(n)) / 2
        k = int(round(np.trace(projector)))
        if not 0 < k < n or not np.isfinite(projector).all():
            continue
        q = np.linalg.qr(projector @ start[:, :k], mode="complete")[0]
        for _ in range(2):  # subspace iteration: the projector is the identity on its range
            q = np.linalg.qr(projector @ q[:, :k], mode="complete")[0]
        left = float(np.linalg.norm(q[:, :k].T @ a @ q[:, k:]))
        best = min(best, (left, (q[:, :k], q[:, k:])), key=lambda x: x[0])
        if left <= 8 * n * EPS * scale:
            break
    return best[1]


def _solve(a: np.ndarray, basis: np.ndarray, out: list[np.ndarray]) -> None:
    parts = split(a) if len(a) > 1 else None
    if parts is None:
        out.append(basis)
        return
    for part in parts:
        inner = part.T @ a @ part
        _solve((inner + inner.T) / 2, basis @ part, out)


def _refine(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One step of simultaneous refinement of all eigenvectors, in extended precision."""
    a, x = a.astype(np.longdouble), x.astype(np.longdouble)
    r = np.eye(len(a), dtype=np.longdouble) - x.T @ x
    s = x.T @ a @ x
    values = np.diag(s) / (1 - np.diag(r))
    off = s - np.diag(values)
    tied = 2 * (np.linalg.norm(off.astype(float)) + np.linalg.norm(a.astype(float)) * np.linalg.norm(r.astype(float)))
    gap = values[None, :] - values[:, None]
    apart = np.abs(gap) > max(tied, 1e5 * EPS * float(np.abs(values).max(initial=0.0)))
    e = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
    x = x + x @ e
    for _ in range(2):  # close values leave second-order terms: make the columns orthonormal again
        x = x @ (1.5 * np.eye(len(a), dtype=np.longdouble) - 0.5 * (x.T @ x))
    return values, x / np.sqrt((x * x).sum(0))


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns; the largest entry is positive)."""
    n = len(a)
    if not n:
        return np.zeros(0), np.zeros((0, 0))
    size = float(np.abs(a).max())
    scaled = a / size if size else a
    found: list[np.ndarray] = []
    _solve((scaled + scaled.T) / 2, np.eye(n), found)
    x = np.concatenate(found, axis=1)
    values, x = _refine(scaled, _refine(scaled, x)[1])
    order = np.argsort(-values, kind="stable")
    values, x = values[order].astype(float) * size, x[:, order].astype(float)
    signs = np.sign(x[np.abs(x).argmax(0), np.arange(n)])
    return values, x * np.where(signs == 0, 1, signs)
