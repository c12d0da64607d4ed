"""Isotonic calibration of scores from binned counts."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 1024


def isotonic(weights: np.ndarray, means: np.ndarray) -> np.ndarray:
    """Non-decreasing least-squares fit (pool adjacent violators)."""
    blocks: list[list[float]] = []
    for weight, mean in zip(weights, means):
        blocks.append([weight, mean, 1])
        while len(blocks) > 1 and blocks[-2][1] >= blocks[-1][1]:
            w, m, n = blocks.pop()
            total = blocks[-1][0] + w
            blocks[-1] = [total, (blocks[-1][0] * blocks[-1][1] + w * m) / total, blocks[-1][2] + n]
    return np.concatenate([np.full(int(n), m) for _, m, n in blocks]) if blocks else np.zeros(0)


def fit_isotonic(rows: DataFrame, raw: Column, label: Column, low: float, high: float, bins: int = BINS):
    """Curve (points, chances) from raw scores in [low, high]; None without rows.

    Spark counts rows and positives per bin, so the driver sees at most ``bins + 1`` rows.
    """
    place = F.floor((F.least(F.greatest(raw, F.lit(low)), F.lit(high)) - low) / (high - low) * bins)
    counted = rows.groupBy(place.alias("bin")).agg(F.count(label).alias("n"), F.sum(label.cast("double")).alias("s"))
    found = counted.filter("n > 0").orderBy("bin").collect()
    if not found:
        return None
    n = np.array([r["n"] for r in found], dtype=float)
    s = np.array([r["s"] for r in found], dtype=float)
    points = low + (np.array([r["bin"] for r in found], dtype=float) + 0.5) * (high - low) / bins
    # Laplace smoothing keeps chances off 0 and 1.
    return points, isotonic(n + 1.0, (s + 0.5) / (n + 1.0))
