"""Logistic regression by Newton steps, for models small enough for one machine."""

from __future__ import annotations

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1.0, penalty: np.ndarray | None = None, steps: int = 25, more=None) -> np.ndarray:
    """Coefficients, the intercept last. penalty: a positive semidefinite matrix P that adds w P w / 2 to the loss (intercept not included).
    more: (w0, g, H), the loss of further rows around w0 to the second order: g (w - w0) + (w - w0) H (w - w0) / 2.

    Without rows, or with one class only, the intercept says all."""
    weight = np.ones(len(y)) if weight is None else weight
    d = x.shape[1]
    if not len(y) or not 0 < y.sum() < len(y):
        share = (y.sum() + 0.5) / (len(y) + 1)
        return np.append(np.zeros(d), np.log(share / (1 - share)))
    full = np.concatenate([x, np.ones((len(y), 1), x.dtype)], 1)
    prior = np.diag(np.append(np.full(d, ridge), 1e-6))
    if penalty is not None:
        prior[:d, :d] += penalty
    at, slope, bend = more if more is not None else (np.zeros(d + 1), np.zeros(d + 1), np.zeros((d + 1, d + 1)))
    w = at.copy()

    def loss(w):
        z = full @ w
        return float((weight * (np.logaddexp(0, z) - y * z)).sum() + w @ prior @ w / 2 + (w - at) @ (slope + bend @ (w - at) / 2))

    now = loss(w)
    for _ in range(steps):
        p = sigmoid(full @ w)
        grad = full.T @ (weight * (p - y)) + prior @ w + slope + bend @ (w - at)
        curve = (full * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ full + prior + bend
        step, size = np.linalg.solve(curve, grad), 1.0
        while size > 1e-3 and loss(w - size * step) > now:
            size /= 2
        w = w - size * step
        before, now = now, loss(w)
        if before - now < 1e-6 * max(1, abs(now)):
            break
    return w


def predict(w: np.ndarray, x: np.ndarray) -> np.ndarray:
    return sigmoid(x @ w[:-1] + w[-1])


def calibrated(score: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Slope and offset that turn a logit into the logit of a probability."""
    return fit(score[:, None], y, ridge=1e-3)
