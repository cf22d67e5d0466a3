"""Small solvers for linear models on bounded samples, on the driver."""

from __future__ import annotations

import numpy as np


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def minimise(objective, start: np.ndarray, tolerance: float = 1e-5, most: int = 2000, memory: int = 12) -> np.ndarray:
    """Minimise a convex function by L-BFGS until the gradient's largest entry is at most ``tolerance``.

    objective: parameters -> (value, gradient). Steps are halved until they decrease enough
    (Armijo); the search also ends when no step along the gradient decreases the value any more,
    that is at the precision of the numbers. RuntimeError if ``most`` steps did not suffice.
    """
    x = start.astype(np.float64)
    value, g = objective(x)
    pairs: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(most):
        if np.abs(g).max(initial=0.0) <= tolerance:
            return x
        d, back = -g, []
        for s, y, r in reversed(pairs):
            a = r * (s @ d)
            back.append(a)
            d = d - a * y
        if pairs:
            s, y, _ = pairs[-1]
            d = d * ((s @ y) / (y @ y))
        else:
            d = d / max(1.0, np.linalg.norm(g))
        for (s, y, r), a in zip(pairs, reversed(back), strict=True):
            d = d + s * (a - r * (y @ d))
        slope = g @ d
        if slope >= 0:
            d, slope, pairs = -g, -(g @ g), []
        size = 1.0
        while True:
            to, gt = objective(x + size * d)
            if to <= value + 1e-4 * size * slope:
                break
            size /= 2
            if size < 1e-10:
                break
        if size < 1e-10:
            if not pairs:
                return x
            pairs = []
            continue
        s, y = size * d, gt - g
        if s @ y > 1e-12 * (y @ y):
            pairs = [*pairs[1 - memory :], (s, y, 1 / (s @ y))]
        x, value, g = x + s, to, gt
    raise RuntimeError(f"the fit has not converged after {most} steps")


def logistic(x: np.ndarray, target: np.ndarray, l2: float) -> np.ndarray:
    """Weights, then the intercept, for soft targets in 0..1."""
    n = max(len(x), 1)

    def objective(p):
        z = np.clip(x @ p[:-1].astype(x.dtype) + p[-1], -35, 35).astype(np.float64)
        value = (np.logaddexp(0, z) - target * z).sum() / n + l2 / 2 * (p[:-1] @ p[:-1])
        error = sigmoid(z) - target
        return value, np.append(x.T @ error.astype(x.dtype) / n + l2 * p[:-1], error.sum() / n)

    base = np.clip(target.mean() if len(target) else 0.5, 1e-3, 1 - 1e-3)
    return minimise(objective, np.append(np.zeros(x.shape[1]), np.log(base / (1 - base))))


def cumulative_link(x: np.ndarray, grade: np.ndarray, grades: int, l2: float) -> tuple[np.ndarray, np.ndarray]:
    """Ordinal regression: P(y <= k) = sigmoid(theta_k - w.x) with theta_0 < theta_1 < ...; gives w and theta.

    The thresholds are a first one and logarithms of the steps between them, so they stay ordered.
    """
    n, d = max(len(x), 1), x.shape[1]
    share = np.clip([(grade <= k).mean() if len(grade) else 0.5 for k in range(grades - 1)], 1e-3, 1 - 1e-3)
    start = np.log(share / (1 - share))
    steps_ = np.log(np.maximum(np.diff(start), 1e-2))

    def thresholds(p):
        return p[d] + np.concatenate([[0.0], np.cumsum(np.exp(np.clip(p[d + 1 :], -20, 20)))])

    def objective(p):
        z = (x @ p[:d].astype(x.dtype)).astype(np.float64)
        theta = np.concatenate([[-np.inf], thresholds(p), [np.inf]])
        hi, lo = sigmoid(theta[grade + 1] - z), sigmoid(theta[grade] - z)
        dz = (1 - hi - lo) / n  # of minus log(hi - lo) by z
        prob = np.maximum(hi - lo, 1e-12)
        up, down = hi * (1 - hi) / prob / n, lo * (1 - lo) / prob / n
        dt = np.array([-up[grade == k].sum() + down[grade == k + 1].sum() for k in range(grades - 1)])
        steep = np.exp(np.clip(p[d + 1 :], -20, 20))
        value = -np.log(prob).sum() / n + l2 / 2 * (p[:d] @ p[:d])
        return value, np.concatenate([x.T @ dz.astype(x.dtype) + l2 * p[:d], [dt.sum()], [dt[k + 1 :].sum() * steep[k] for k in range(grades - 2)]])

    p = minimise(objective, np.concatenate([np.zeros(d), start[:1], steps_]))
    return p[:d], thresholds(p)
