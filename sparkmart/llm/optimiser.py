"""A small optimiser for the models trained here."""

from __future__ import annotations

import numpy as np


class Adam:
    """Updates arrays in place by their gradients."""

    def __init__(self, arrays: dict[str, np.ndarray], rate: float, decay: float = 0.0):
        self.arrays, self.rate, self.decay, self.t = arrays, rate, decay, 0
        self.first = {k: np.zeros_like(a) for k, a in arrays.items()}
        self.second = {k: np.zeros_like(a) for k, a in arrays.items()}

    def step(self, gradients: dict[str, np.ndarray], rows: dict | None = None) -> None:
        """``rows``: for some arrays, the rows that the gradient is of."""
        self.t += 1
        fix = np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
        for k, g in gradients.items():
            at = rows[k] if rows and k in rows else slice(None)
            a, m, v = self.arrays[k], self.first[k], self.second[k]
            m[at] = 0.9 * m[at] + 0.1 * g
            v[at] = 0.999 * v[at] + 0.001 * g * g
            a[at] -= self.rate * (fix * m[at] / (np.sqrt(v[at]) + 1e-7) + self.decay * a[at])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))
