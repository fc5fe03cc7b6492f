"""A logistic scorer fitted on a bounded sample in the driver."""

from __future__ import annotations

import numpy as np


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fitted(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, target: np.ndarray, width: int,
           weight: np.ndarray | None = None, ridge: float = 1e-4, steps: int = 400,
           rate: float = 0.5) -> tuple[np.ndarray, float]:
    """Weights and intercept for entries (row, column, value) and targets between 0 and 1.

    Full-batch steps with a rate of its own for each weight (Adam), so that rare columns learn as well.
    """
    count = len(target)
    weight = np.ones(count) if weight is None else weight
    weight = weight / max(weight.sum(), 1e-12)
    theta, first, second = (np.zeros(width + 1) for _ in range(3))
    mean = float(np.clip((weight * target).sum(), 1e-3, 1 - 1e-3)) if count else 0.5
    theta[-1] = np.log(mean / (1 - mean))
    for step in range(1, steps + 1 if count else 1):
        margin = np.bincount(rows, theta[columns] * values, minlength=count) + theta[-1]
        wrong = weight * (sigmoid(margin) - target)
        slope = np.append(np.bincount(columns, wrong[rows] * values, minlength=width), wrong.sum())
        slope[:-1] += ridge * theta[:-1]
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        theta -= rate / np.sqrt(step) * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
    return theta[:-1], float(theta[-1])
