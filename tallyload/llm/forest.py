"""Spanning forests of link pairs inside one task."""

from __future__ import annotations

import numpy as np


class Forest:
    """Components of nodes 0 to n - 1 under pairs added in lots; the label is the smallest node."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def open(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs are not connected yet."""
        return self.label[a] != self.label[b]

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        a, b = self.label[a], self.label[b]
        keep = a != b
        a, b = a[keep], b[keep]
        if not len(a):
            return
        to = np.arange(len(self.label))
        while True:
            low = np.minimum(to[a], to[b])
            np.minimum.at(to, a, low)
            np.minimum.at(to, b, low)
            while True:
                up = to[to]
                if np.array_equal(up, to):
                    break
                to = up
            if np.array_equal(to[a], to[b]):
                break
            a, b = to[a], to[b]
            keep = a != b
            a, b = a[keep], b[keep]
        self.label = to[self.label]
