"""Union-find over arrays, for what one task compares."""

from __future__ import annotations

import numpy as np


def merge(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after linking a[i] with b[i]; every label is the smallest index of its set."""
    while True:
        la, lb = labels[a], labels[b]
        apart = la != lb
        if not apart.any():
            return labels
        np.minimum.at(labels, np.maximum(la, lb)[apart], np.minimum(la, lb)[apart])
        while True:
            shorter = labels[labels]
            if np.array_equal(shorter, labels):
                break
            labels = shorter
