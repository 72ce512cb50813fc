"""Hashed linear classifiers: features by name, logistic regression by AdaGrad, thresholds on held-out rows."""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIMENSIONS_LOG2 = 17
#: Rows of a table that a classifier may be fitted on (documented bound; scoring covers every row).
SAMPLE_ROWS = 6000
#: Share of true cases that a threshold is set for: rarer than in the labelled rows, where half are made.
PRIOR = 0.05
#: Names whose place is remembered by a task.
REMEMBERED = 200_000

Features = dict[str, float]


class Places(dict):
    """name -> place in the hashed space: the CRC of the name, so it is the same everywhere."""

    def __missing__(self, name: str) -> int:
        at = zlib.crc32(name.encode("utf-8", "surrogatepass")) & ((1 << DIMENSIONS_LOG2) - 1)
        if len(self) < REMEMBERED:
            self[name] = at
        return at


@dataclass
class Sparse:
    """Rows of hashed features, as (row, place, value), rows in order."""

    row: np.ndarray
    place: np.ndarray
    value: np.ndarray
    size: int

    @staticmethod
    def of(rows: list[Features], places: Places) -> Sparse:
        counts = np.fromiter(map(len, rows), np.int64, len(rows))
        total = int(counts.sum())
        place = np.fromiter((places[name] for row in rows for name in row), np.int64, total)
        value = np.fromiter((v for row in rows for v in row.values()), np.float64, total)
        return Sparse(np.repeat(np.arange(len(rows)), counts), place, value, len(rows))

    def joined(self, other: Sparse) -> Sparse:
        """The features of both for each row."""
        row = np.concatenate([self.row, other.row])
        order = np.argsort(row, kind="stable")
        return Sparse(row[order], np.concatenate([self.place, other.place])[order], np.concatenate([self.value, other.value])[order], self.size)

    def take(self, rows: np.ndarray) -> Sparse:
        """Some rows, in the order given."""
        start = np.searchsorted(self.row, rows)
        counts = np.searchsorted(self.row, rows, "right") - start
        at = np.repeat(start - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
        return Sparse(np.repeat(np.arange(len(rows)), counts), self.place[at], self.value[at], len(rows))


@dataclass
class Linear:
    """Weights, bias and threshold of one label."""

    weights: np.ndarray
    bias: float
    threshold: float

    def parts(self) -> tuple:
        """What makes the model, without its class: broadcasts are unpickled where this package need not be installed."""
        return self.weights, self.bias, self.threshold

    def scores(self, rows: Sparse) -> np.ndarray:
        """A probability per row."""
        z = np.bincount(rows.row, weights=self.weights[rows.place] * rows.value, minlength=rows.size) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def fit(rows: Sparse, truth: np.ndarray, epochs: int = 8, rate: float = 0.25, ridge: float = 1e-5, seed: int = 5, held_out: float = 0.2, prior: float = PRIOR) -> Linear:
    """Fits on four fifths of the rows and calibrates the threshold on the rest.

    The threshold is the one of greatest F1 on the held-out rows weighed as if ``prior`` of
    them were true, the middle of the range within a hundredth of the best. Without true
    rows it is above 1 (never).
    """
    random = np.random.default_rng(seed)
    order = random.permutation(rows.size)
    hold, train = order[: int(rows.size * held_out)], order[int(rows.size * held_out) :]
    weights, power = np.zeros(1 << DIMENSIONS_LOG2), np.full(1 << DIMENSIONS_LOG2, 1e-2)
    bias, bias_power = 0.0, 1e-2
    for _ in range(epochs):
        random.shuffle(train)
        now, want = rows.take(train), truth[train]
        ends = np.searchsorted(now.row, np.arange(0, len(train) + 32, 32))
        for k in range(len(ends) - 1):
            part = slice(ends[k], ends[k + 1])
            at, value, row = now.place[part], now.value[part], now.row[part] - 32 * k
            said = want[32 * k : 32 * (k + 1)]
            z = np.bincount(row, weights=weights[at] * value, minlength=len(said)) + bias
            wrong = 1 / (1 + np.exp(-np.clip(z, -60, 60))) - said
            places, inverse = np.unique(at, return_inverse=True)
            step = np.bincount(inverse, weights=wrong[row] * value, minlength=len(places)) + ridge * weights[places]
            power[places] += step**2
            weights[places] -= rate * step / np.sqrt(power[places])
            down = wrong.sum()
            bias_power += down**2
            bias -= rate * down / np.sqrt(bias_power)
    model = Linear(weights.astype(np.float32), float(bias), 2.0)
    if len(hold):
        model.threshold = best_threshold(model.scores(rows.take(hold)), truth[hold] > 0, prior)
    return model


def best_threshold(probability: np.ndarray, truth: np.ndarray, prior: float) -> float:
    if not truth.any():
        return 2.0
    weight = np.where(truth, prior / truth.mean(), (1 - prior) / max(1e-9, 1 - truth.mean()))
    cuts = np.linspace(0.02, 0.98, 49)
    said = probability[None] >= cuts[:, None]
    both = (said * (weight * truth)).sum(axis=1)
    f1 = 2 * both / np.maximum(1e-9, (said * weight).sum(axis=1) + (weight * truth).sum())
    best = np.flatnonzero(f1 >= f1.max() - 0.01)
    return float(cuts[best[len(best) // 2]])


def spot(key: str, salt: int = 11) -> Column:
    """A place in [0, 2^30) by the hash of the key."""
    return F.pmod(F.xxhash64(F.lit(salt), F.col(key)), F.lit(1 << 30))


def reach(df: DataFrame, rows: int) -> int:
    """The least place that is not in a sample of about ``rows`` of the table's rows."""
    return int(min(1.0, 1.2 * rows / max(1, df.count())) * (1 << 30))


def sample(df: DataFrame, key: str, rows: int = SAMPLE_ROWS) -> list:
    """At most ``rows`` rows by the hash of their key: the same rows on every run."""
    some = df.withColumn("_spot", spot(key)).where(F.col("_spot") < F.lit(reach(df, rows))).collect()
    return sorted(some, key=lambda r: (r["_spot"], r[key]))[:rows]
