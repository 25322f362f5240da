"""Logistic regression on hashed features, trained on the driver over a bounded sample and applied in the workers."""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np

BITS = 18


def hashed(features: list[str], bits: int = BITS) -> np.ndarray:
    mask = (1 << bits) - 1
    return np.fromiter({zlib.crc32(f.encode("utf-8", "surrogatepass")) & mask for f in features}, np.int32)


@dataclass
class Rows:
    """Feature indices of many examples, one after another; ``ends`` are the row ends."""

    flat: np.ndarray
    ends: np.ndarray

    @classmethod
    def of(cls, rows: list[np.ndarray]) -> Rows:
        lens = np.array([len(r) for r in rows], np.int64)
        return cls(np.concatenate(rows) if rows else np.zeros(0, np.int32), np.cumsum(lens))

    def used(self) -> tuple[np.ndarray, np.ndarray]:
        """The features that occur, and ``flat`` in places among them."""
        if not hasattr(self, "_used"):
            self._used = np.unique(self.flat, return_inverse=True)
        return self._used

    def sums(self, w: np.ndarray) -> np.ndarray:
        total = np.zeros(len(self.flat) + 1)
        np.cumsum(w[self.flat], out=total[1:])
        return np.diff(total[self.ends], prepend=0.0)

    def spread(self, per_row: np.ndarray, size: int) -> np.ndarray:
        lens = np.diff(np.concatenate([[0], self.ends]))
        return np.bincount(self.flat, np.repeat(per_row, lens), size)


class Trainer:
    """Weights and bias of one classifier, moved by full-batch AdaGrad steps; a later call goes on from where the last ended.

    Only the features that occur are held while training. Runs give the same model again.
    """

    def __init__(self, rows: Rows, weight: np.ndarray, bits: int = BITS, rate: float = 0.5, ridge: float = 1e-6):
        self.used, flat = rows.used()
        self.rows, self.size = Rows(flat, rows.ends), 1 << bits
        self.share, self.rate, self.ridge = weight / max(weight.sum(), 1e-9), rate, ridge
        self.w, self.b = np.zeros(len(self.used)), 0.0
        self.seen, self.seen_b = np.full(len(self.used), 1e-8), 1e-8

    def step(self, target: np.ndarray, steps: int) -> Trainer:
        for _ in range(steps):
            g = (1 / (1 + np.exp(-np.clip(self.odds(), -30, 30))) - target) * self.share
            grad, grad_b = self.rows.spread(g, len(self.used)) + self.ridge * self.w, g.sum()
            self.seen += grad * grad
            self.seen_b += grad_b * grad_b
            self.w -= self.rate * grad / np.sqrt(self.seen)
            self.b -= self.rate * grad_b / np.sqrt(self.seen_b)
        return self

    def odds(self) -> np.ndarray:
        return self.rows.sums(self.w) + self.b

    def model(self) -> tuple[np.ndarray, float]:
        w = np.zeros(self.size, np.float32)
        w[self.used] = self.w
        return w, float(self.b)


def fit(rows: Rows, target: np.ndarray, weight: np.ndarray, bits: int = BITS, steps: int = 60) -> tuple[np.ndarray, float]:
    """Weights and bias for targets in [0, 1]."""
    return Trainer(rows, weight, bits).step(target, steps).model()
