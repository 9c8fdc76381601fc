"""Small decision trees (Gini), for the classifiers that learn from a table of a few hundred rows."""

from __future__ import annotations

import random
from typing import Any

Tree = tuple[Any, ...]  # (share of 1s,) or (feature, cut, tree for <= cut, tree for > cut)


def _gini(ones: int, n: int) -> float:
    return 2 * ones * (n - ones) / n if n else 0.0


def grow(rows: list[list[float]], labels: list[int], depth: int, leaf: int, pick: random.Random | None = None, features: int | None = None) -> Tree:
    """pick and features: each split looks at so many features, drawn by pick; else at all."""
    ones, n = sum(labels), len(labels)
    if depth == 0 or n < 2 * leaf or ones in (0, n):
        return (ones / n if n else 0.5,)
    names = range(len(rows[0]))
    best: tuple[float, int, float] | None = None
    for f in pick.sample(names, features) if pick and features else names:
        order = sorted(range(n), key=lambda i: rows[i][f])
        left = 0
        for k in range(1, n):
            left += labels[order[k - 1]]
            lo, hi = rows[order[k - 1]][f], rows[order[k]][f]
            if lo < hi and leaf <= k <= n - leaf and (best is None or (cost := _gini(left, k) + _gini(ones - left, n - k)) < best[0] - 1e-12):
                best = (_gini(left, k) + _gini(ones - left, n - k), f, (lo + hi) / 2)
    if best is None or best[0] >= _gini(ones, n) - 1e-12:
        return (ones / n,)
    _, f, cut = best
    sides = [[i for i in range(n) if (rows[i][f] <= cut) == under] for under in (True, False)]
    return (f, cut, *(grow([rows[i] for i in side], [labels[i] for i in side], depth - 1, leaf, pick, features) for side in sides))


def share(tree: Tree, row: list[float]) -> float:
    while len(tree) > 1:
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree[0]
