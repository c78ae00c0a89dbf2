"""Largest eigenpairs of a symmetric operator by a block Jacobi-Davidson iteration.

The operator is only ever multiplied by a block of columns (``product``); everything else
works on matrices of ``dimension`` rows and a bounded number of columns.

Each outer step takes the Ritz pairs of the search space (Rayleigh-Ritz), locks the
converged ones from the top, and expands the space by approximate solutions t of the
correction equations ``(I - QQ')(A - theta I)(I - QQ') t = -r`` of all others, where Q holds
the locked and the current Ritz vectors.  The equations are solved by MINRES, all columns
in step, so that an inner step is one product.  A full search space is restarted from its
best Ritz vectors.  A pair has converged when its residual is at rounding level.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

#: Residuals up to this many units of rounding of the largest eigenvalue are converged.
ROUNDING, INNER_STEPS, OUTER_STEPS = 64, 6, 200
_EPS = np.finfo(float).eps
Product = Callable[[np.ndarray], np.ndarray]


def orthonormal(x: np.ndarray, against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what the columns add to the orthonormal ``against``."""
    kept = np.zeros((len(x), 0))
    for column in x.T:
        size = np.linalg.norm(column)
        if not size:
            continue
        column = column / size
        for _ in range(3):
            column = column - against @ (against.T @ column)
            column = column - kept @ (kept.T @ column)
            size = np.linalg.norm(column)
            if size < 1e-8:  # in the span already, but for rounding
                break
            column = column / size
        else:
            kept = np.column_stack([kept, column])
    return kept


def block_minres(product: Product, rhs: np.ndarray, shift: np.ndarray, away: np.ndarray, steps: int, enough: float) -> np.ndarray:
    """Approximate solutions of ``P (A - shift) P t = rhs`` with P the projection off ``away``,
    one column per shift; stops when every residual fell to ``enough`` of its start."""

    def project(x: np.ndarray) -> np.ndarray:
        return x - away @ (away.T @ x)

    def inverse(x: np.ndarray) -> np.ndarray:
        return np.divide(1.0, x, out=np.zeros_like(x), where=np.abs(x) > 1e-300)

    v = project(rhs)
    beta = np.linalg.norm(v, axis=0)
    start = beta.copy()
    v, v_old = v * inverse(beta), np.zeros_like(v)
    solution, residual = np.zeros_like(v), beta.copy()
    d, d_old = np.zeros_like(v), np.zeros_like(v)
    c = c_old = np.ones_like(beta)
    s = s_old = np.zeros_like(beta)
    beta = np.zeros_like(beta)
    for _ in range(steps):
        w = project(product(v)) - shift * v - beta * v_old
        alpha = (w * v).sum(0)
        w = project(w - alpha * v)
        beta_next = np.linalg.norm(w, axis=0)
        # the new column of the tridiagonal matrix under the two rotations before it
        far, near = s_old * beta, c_old * c * beta + s * alpha
        own = c * alpha - s * c_old * beta
        size = np.hypot(own, beta_next)
        c_old, s_old = c, s
        c, s = np.where(size > 0, own * inverse(size), 1.0), beta_next * inverse(size)
        d, d_old = (v - near * d - far * d_old) * inverse(size), d
        solution = solution + c * residual * d
        residual = -s * residual
        v, v_old, beta = w * inverse(beta_next), v, beta_next
        if (np.abs(residual) <= enough * start).all():
            break
    return solution


def largest_eigenpairs(product: Product, dimension: int, wanted: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns); ``wanted`` of them, or all."""
    wanted = min(wanted, dimension)
    room = min(dimension, 3 * wanted + 8)
    rng = np.random.default_rng(seed)
    locked, values = np.zeros((dimension, 0)), np.zeros(0)
    space = orthonormal(rng.standard_normal((dimension, min(dimension, wanted + 8))), locked)
    image = product(space)
    scale = 0.0
    for outer in range(OUTER_STEPS):
        small = space.T @ image
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        space, image = space @ turn, image @ turn
        scale = max(scale, float(np.abs(theta).max(initial=0)))
        left = wanted - locked.shape[1]
        residual = image[:, :left] - space[:, :left] * theta[:left]
        residual -= locked @ (locked.T @ residual)
        done = np.linalg.norm(residual, axis=0) <= ROUNDING * _EPS * scale
        if space.shape[1] + locked.shape[1] == dimension:
            done[:] = True  # the Ritz pairs of the whole space are eigenpairs
        lock = int(np.argmin(done)) if not done.all() else len(done)  # from the top, without gaps
        locked, values = np.column_stack([locked, space[:, :lock]]), np.append(values, theta[:lock])
        space, image, theta, residual = space[:, lock:], image[:, lock:], theta[lock:], residual[:, lock:]
        if locked.shape[1] >= wanted:
            order = np.argsort(-values, kind="stable")
            return values[order], locked[:, order]
        open_ones = ~done[lock:]
        keep = min(space.shape[1], max(wanted - len(values) + 8, room // 3))
        if space.shape[1] + int(open_ones.sum()) > room:
            space, image = space[:, :keep], image[:, :keep]
        ritz = space[:, : wanted - len(values)]
        steps = block_minres(
            product, -residual[:, open_ones], theta[: len(open_ones)][open_ones], np.column_stack([locked, ritz]), INNER_STEPS, 0.5 ** (outer + 1)
        )
        fresh = orthonormal(steps, np.column_stack([locked, space]))
        if not fresh.shape[1]:
            fresh = orthonormal(rng.standard_normal((dimension, 8)), np.column_stack([locked, space]))
        space, image = np.column_stack([space, fresh]), np.column_stack([image, product(fresh)])
    raise RuntimeError(f"{wanted - len(values)} of {wanted} eigenpairs did not converge in {OUTER_STEPS} steps")
