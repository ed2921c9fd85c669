"""Linear support vector machines for bounded training samples."""

from __future__ import annotations

import numpy as np


def train_svm(
    rows: np.ndarray,
    labels: np.ndarray,
    penalty: float = 10.0,
    weights: np.ndarray | None = None,
    rounds: int = 12,
) -> tuple[np.ndarray, float]:
    """Weights and bias of the squared-hinge machine; ``labels`` are booleans.

    Newton steps on 0.5 |w|^2 + 0.5 * penalty * weighted squared hinge: the rows short of
    their margin make a least-squares problem, solved by conjugate gradients.  Both
    classes weigh the same in all, within them rows weigh by ``weights``.  With one class
    only, the sign is its own.
    """
    signs = np.where(labels, 1.0, -1.0)
    if labels.all() or not labels.any():
        return np.zeros(rows.shape[1]), float(signs[0]) if len(signs) else 0.0
    each = np.ones(len(signs)) if weights is None else np.asarray(weights, float)
    each = penalty * len(signs) / 2 * np.where(labels, each / each[labels].sum(), each / each[~labels].sum())
    rows = np.concatenate([rows, np.ones((len(rows), 1), rows.dtype)], axis=1)
    each = each.astype(rows.dtype)  # so that no product makes a wider copy of the rows
    found = np.zeros(rows.shape[1], rows.dtype)

    def loss(w: np.ndarray) -> float:
        return 0.5 * w @ w + 0.5 * each @ np.square(np.maximum(0, 1 - signs * (rows @ w)))

    now = loss(found)
    for _ in range(rounds):
        short = signs * (rows @ found) < 1
        some, weight = rows[short], each[short]
        aim = _solve(some, weight, weight * signs[short], found)
        step = 1.0
        while (new := loss(found + step * (aim - found))) > now and step > 1e-3:
            step /= 2
        if new >= now - 1e-6 * abs(now):
            break
        found, now = found + step * (aim - found), new
    return found[:-1], float(found[-1])


def _solve(rows: np.ndarray, weight: np.ndarray, target: np.ndarray, start: np.ndarray) -> np.ndarray:
    """w of (I + rows' weight rows) w = rows' target, by conjugate gradients."""
    w = start.copy()
    rest = target @ rows - w - (weight * (rows @ w)) @ rows
    way, size = rest.copy(), rest @ rest
    first = size
    for _ in range(60):
        if size <= 1e-5 * first:
            break
        moved = way + (weight * (rows @ way)) @ rows
        length = size / (way @ moved)
        w += length * way
        rest -= length * moved
        new = rest @ rest
        way, size = rest + new / size * way, new
    return w


def fit_logistic(scores: np.ndarray, labels: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Scale (not negative) and shift that turn decision values into chances, by Newton's
    method with Platt's softened targets."""
    good, bad = labels.sum(), (~labels).sum()
    target = np.where(labels, (good + 1) / (good + 2), 1 / (bad + 2))
    scale, shift = 1.0, 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(scale * scores + shift, -30, 30)))
        grad = np.array([((p - target) * scores).sum() + 1e-3 * scale, (p - target).sum()])
        w = p * (1 - p) + 1e-9
        hess = np.array([[(w * scores * scores).sum() + 1e-3, (w * scores).sum()], [(w * scores).sum(), w.sum()]])
        change = np.linalg.solve(hess + 1e-9 * np.eye(2), grad)
        change /= max(1.0, np.abs(change).max() / 5)
        scale, shift = scale - change[0], shift - change[1]
    return max(scale, 0.0), shift
