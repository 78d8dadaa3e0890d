"""Small dense fits on bounded samples: weighted ridge logistic regression and isotonic regression."""

from __future__ import annotations

import numpy as np


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Coefficients (the last is the intercept, which isn't penalised) by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    beta, penalty = np.zeros(x.shape[1]), np.append(np.full(x.shape[1] - 1, ridge), 1e-6)
    for _ in range(steps):
        p = sigmoid(x @ beta)
        slope = x.T @ (weight * (y - p)) - penalty * beta
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(penalty)
        step = np.clip(np.linalg.solve(curve, slope), -5, 5)
        beta = beta + step
        if np.abs(step).max() < 1e-6:
            break
    return beta


def linear(x: np.ndarray, beta: np.ndarray) -> np.ndarray:
    return x @ beta[:-1] + beta[-1]


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the rising step fit by pooling neighbours; read it with np.interp. Equal x are one knot."""
    at, of = np.unique(x, return_inverse=True)
    w = np.bincount(of, weight)
    blocks: list[list[float]] = []  # mean, weight, first, last
    for i, (m, n) in enumerate(zip(np.bincount(of, weight * y) / w, w, strict=True)):
        blocks.append([m, n, i, i])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            m2, n2, _, last = blocks.pop()
            m1, n1, first, _ = blocks.pop()
            blocks.append([(m1 * n1 + m2 * n2) / (n1 + n2), n1 + n2, first, last])
    knots = [(at[int(b[e])], b[0]) for b in blocks for e in (2, 3)]
    return np.array([k for k, _ in knots]), np.array([v for _, v in knots])
