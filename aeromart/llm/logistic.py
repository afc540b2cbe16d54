"""Logistic regression on a bounded number of rows, for calibrating scores."""

from __future__ import annotations

import numpy as np


class Logistic:
    """Weights over standardised features; with one class only, a constant."""

    def __init__(self, rows: list[list[float]], labels: list[int], width: int, ridge: float = 1e-2):
        x, y = np.asarray(rows, float).reshape(-1, width), np.asarray(labels, float)
        self.mean, self.scale = np.zeros(width), np.ones(width)
        self.weights = np.zeros(width + 1)
        if not len(y) or y.min() == y.max():
            share = y.mean() if len(y) else 0.5
            self.weights[0] = float(np.log((share + 0.01) / (1.01 - share)))
            return
        self.mean, spread = x.mean(axis=0), x.std(axis=0)
        self.scale = np.where(spread > 0, spread, 1.0)
        x = np.c_[np.ones(len(x)), (x - self.mean) / self.scale]
        penalty = ridge * np.eye(width + 1)
        penalty[0, 0] = 1e-6
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))
            step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + penalty, x.T @ (y - p) - penalty @ self.weights)
            self.weights = self.weights + np.clip(step, -5, 5)
            if np.abs(step).max() < 1e-8:
                break

    def scores(self, rows: np.ndarray) -> np.ndarray:
        z = np.asarray(rows, float).reshape(-1, len(self.mean))
        z = ((z - self.mean) / self.scale) @ self.weights[1:] + self.weights[0]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))
