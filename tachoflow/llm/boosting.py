"""Gradient-boosted depth-two trees over a bounded table of small-integer features.

The table holds one row per distinct feature vector with its label counts, so its size is
bounded by the product of the feature domains, not by the data; Spark counts it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple


class Row(NamedTuple):
    features: tuple[int, ...]
    positive: float
    negative: float


class Tree(NamedTuple):
    """value[k] for k = 2 * (first split passed) + (second split passed); a split is (feature, at least)."""

    first: tuple[int, int]
    second: tuple[tuple[int, int], tuple[int, int]]
    value: tuple[float, float, float, float]

    def score(self, features: Sequence[int]) -> float:
        k = int(features[self.first[0]] >= self.first[1])
        feature, least = self.second[k]
        return self.value[2 * k + int(features[feature] >= least)]

    def sql(self, names: Sequence[str]) -> str:
        test = lambda s: f"{names[s[0]]} >= {s[1]}"
        branch = lambda k: f"if({test(self.second[k])}, {self.value[2 * k + 1]!r}D, {self.value[2 * k]!r}D)"
        return f"if({test(self.first)}, {branch(1)}, {branch(0)})"


def sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-40.0, min(40.0, x))))


def _best(rows, splits, ridge: float):
    """The split of (gradient, weight, features) rows with the largest gain."""
    total_g, total_h = sum(r[0] for r in rows), sum(r[1] for r in rows)
    best = (-1.0, splits[0])
    for split in splits:
        g = sum(r[0] for r in rows if r[2][split[0]] >= split[1])
        h = sum(r[1] for r in rows if r[2][split[0]] >= split[1])
        gain = g * g / (h + ridge) + (total_g - g) ** 2 / (total_h - h + ridge)
        if gain > best[0] + 1e-12:
            best = (gain, split)
    return best[1]


def boost(rows: list[Row], domains: Sequence[int], rounds: int = 24, rate: float = 0.4, ridge: float = 1.0) -> tuple[float, list[Tree]]:
    """Bias and trees of a logistic model; features[k] lies in 0..domains[k] - 1."""
    positive, negative = sum(r.positive for r in rows), sum(r.negative for r in rows)
    bias = math.log((positive + 0.5) / (negative + 0.5))
    splits = [(k, v) for k, n in enumerate(domains) for v in range(1, n)]
    margin = [bias] * len(rows)
    trees: list[Tree] = []
    # Weights are taken relative to the mean, so the ridge means the same at any size.
    scale = len(rows) / max(positive + negative, 1e-9)
    for _ in range(rounds if positive and negative else 0):
        work = []
        for r, m in zip(rows, margin, strict=True):
            p, n = sigmoid(m), (r.positive + r.negative) * scale
            work.append((r.positive * scale - n * p, n * p * (1 - p), r.features))
        first = _best(work, splits, ridge)
        sides = [[w for w in work if (w[2][first[0]] >= first[1]) == bool(k)] for k in (0, 1)]
        second = tuple(_best(side, splits, ridge) if side else splits[0] for side in sides)
        value = []
        for side, split in zip(sides, second, strict=True):
            for passed in (False, True):
                leaf = [w for w in side if (w[2][split[0]] >= split[1]) == passed]
                value.append(rate * sum(w[0] for w in leaf) / (sum(w[1] for w in leaf) + ridge))
        tree = Tree(first, second, tuple(value))
        trees.append(tree)
        margin = [m + tree.score(r.features) for m, r in zip(margin, rows, strict=True)]
    return bias, trees


def threshold(rows: list[tuple[float, float, float]], precision: float) -> float:
    """Lowest margin from which on all labelled rows (margin, positive, negative) reach the precision."""
    best, good, bad = math.inf, 0.0, 0.0
    for margin, positive, negative in sorted(rows, reverse=True):
        good, bad = good + positive, bad + negative
        if good and good >= precision * (good + bad):
            best = margin
    return max(best, 0.0) if best < math.inf else math.inf
