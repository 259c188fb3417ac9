"""Cutting stock by column generation: cut patterns of bins from a histogram of piece sizes.

The linear program has one row for each size, so its work depends on the number of sizes and not on the number of pieces. A dynamic
program over the capacity prices new patterns; a pattern enters while the sizes' dual values in it exceed one bin.
"""

from __future__ import annotations

import numpy as np

EPSILON = 1e-9


def best_pattern(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The unbounded knapsack: how often each size is taken for the largest value within the capacity."""
    best = np.zeros(capacity + 1)
    taken = np.full(capacity + 1, -1)
    for c in range(1, capacity + 1):
        best[c], fit = best[c - 1], int(np.searchsorted(sizes, c, "right"))
        if fit:
            worth = values[:fit] + best[c - sizes[:fit]]
            k = int(np.argmax(worth))
            if worth[k] > best[c]:
                best[c], taken[c] = worth[k], k
    pattern, c = np.zeros(len(sizes), np.int64), capacity
    while c > 0:
        if taken[c] < 0:
            c -= 1
        else:
            pattern[taken[c]] += 1
            c -= int(sizes[taken[c]])
    return float(best[capacity]), pattern


def solve(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 20_000) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (rows) and how many bins of each, fractional; sizes ascend. Revised simplex on the covering program."""
    n = len(sizes)
    patterns = np.diag(capacity // sizes).astype(np.int64)
    inverse = np.diag(1.0 / (capacity // sizes))
    amount = inverse @ demand
    for _ in range(rounds):
        duals = inverse.sum(axis=0)
        value, entering = best_pattern(sizes, duals, capacity)
        if value <= 1 + EPSILON:
            break
        change = inverse @ entering
        falls = change > EPSILON
        ratio = np.where(falls, amount / np.where(falls, change, 1), np.inf)
        out = int(np.argmin(ratio))
        amount = np.maximum(amount - ratio[out] * change, 0)
        amount[out] = ratio[out]
        row = inverse[out] / change[out]
        inverse -= np.outer(change, row)
        inverse[out] = row
        patterns[out] = entering
    return patterns, amount[:n]


def whole_bins(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Patterns and whole numbers of bins that hold all pieces: the program's solution rounded down, the rest packed first-fit."""
    if not len(sizes):
        return np.zeros((0, 0), np.int64), np.zeros(0, np.int64)
    patterns, amount = solve(sizes, demand.astype(float), capacity)
    bins = np.floor(amount + 1e-6).astype(np.int64)
    left = np.maximum(demand - patterns.T @ bins, 0)
    extra = []
    while left.any():
        room, pattern = capacity, np.zeros(len(sizes), np.int64)
        for k in np.flatnonzero(left)[::-1]:
            pattern[k] = min(left[k], room // sizes[k])
            room -= int(pattern[k] * sizes[k])
        # The same bin again as often as the rest allows.
        used = pattern > 0
        times = int((left[used] // pattern[used]).min())
        extra.append((pattern, times))
        left = left - times * pattern
    patterns = np.vstack([patterns, *(p for p, _ in extra)])
    return patterns, np.concatenate([bins, np.array([t for _, t in extra], np.int64)])
