"""Logistic regression on sparse 0/1 features, fitted on bounded samples in the driver."""

from __future__ import annotations

import numpy as np


def fit(
    rows: list[np.ndarray],
    labels: np.ndarray,
    size: int,
    ridge: float = 1.0,
    equal: list[tuple[np.ndarray, np.ndarray]] = (),
    equal_weight: float = 0.0,
    steps: int = 200,
) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise log loss + ``ridge`` / 2 |w|^2 + ``equal_weight`` / 2 times the sum
    of squared score differences over the pairs ``equal`` (indices only in the first, only in the second).

    A sample with one class, or none, gives zero weights and the bias of its share (0.5 without rows).
    """
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    weights, bias = np.zeros(size), float(np.log(share / (1 - share)))
    if len(labels) == 0 or labels.min() == labels.max():
        return weights, bias
    flat = np.concatenate(rows).astype(np.int64) if rows else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    pair_flat = np.concatenate([np.concatenate(p) for p in equal]).astype(np.int64) if equal else np.zeros(0, np.int64)
    pair_sign = np.concatenate([np.r_[np.ones(len(a)), -np.ones(len(b))] for a, b in equal]) if equal else np.zeros(0)
    pair_owner = np.repeat(np.arange(len(equal)), [len(a) + len(b) for a, b in equal])

    def loss_and_slope(w: np.ndarray, b: float):
        score = np.bincount(owner, w[flat], len(rows)) + b
        apart = np.bincount(pair_owner, w[pair_flat] * pair_sign, max(1, len(equal)))
        loss = np.logaddexp(0, score).sum() - score[labels == 1].sum() + ridge / 2 * (w @ w)
        loss += equal_weight / 2 * (apart @ apart)
        off = 1 / (1 + np.exp(-np.clip(score, -30, 30))) - labels
        slope = np.bincount(flat, off[owner], size) + ridge * w
        slope += equal_weight * np.bincount(pair_flat, apart[pair_owner] * pair_sign, size)
        return loss, slope, off.sum()

    scale = 1 / np.sqrt(np.bincount(flat, minlength=size) / 4 + ridge)  # evens out frequent and rare features
    point = np.zeros(size + 1)
    point[-1] = bias
    spread = np.r_[scale, 2 / np.sqrt(len(rows))]
    history: list[tuple[np.ndarray, np.ndarray]] = []

    def at(p: np.ndarray):
        loss, slope, slope_b = loss_and_slope(p[:-1] * scale, p[-1] * spread[-1])
        return loss, np.r_[slope * scale, slope_b * spread[-1]]

    point[-1] /= spread[-1]
    value, slope = at(point)
    for _ in range(steps):  # limited-memory quasi-Newton steps
        way, kept = slope.copy(), []
        for move, change in reversed(history):
            a = (move @ way) / (move @ change)
            kept.append(a)
            way -= a * change
        if history:
            way *= (history[-1][0] @ history[-1][1]) / (history[-1][1] @ history[-1][1])
        else:
            way /= max(1.0, np.linalg.norm(slope))
        for (move, change), a in zip(history, reversed(kept), strict=True):
            way += (a - (change @ way) / (move @ change)) * move
        length = 1.0
        while True:
            following = point - length * way
            new_value, new_slope = at(following)
            if new_value <= value - 1e-4 * length * (slope @ way) or length < 1e-8:
                break
            length /= 2
        move, change = following - point, new_slope - slope
        done = value - new_value < 1e-7 * max(1.0, abs(value))
        point, value, slope = following, new_value, new_slope
        if move @ change > 1e-12:
            history = [*history[-7:], (move, change)]
        if done:
            break
    return point[:-1] * scale, float(point[-1] * spread[-1])
