"""The cutting-stock linear program by column generation, over a histogram of lengths.

The program is as large as the histogram has bins, whatever the corpus: it is solved on the driver.
"""

from __future__ import annotations

import numpy as np


def best_pattern(values: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of ``sizes`` within ``room`` (unbounded knapsack), by dynamic programming."""
    worth = np.zeros(room + 1)
    choice = np.full(room + 1, -1)
    order = np.argsort(sizes, kind="stable")
    ranked, gains = sizes[order], np.maximum(values[order], 0)
    fitting = np.searchsorted(ranked, np.arange(room + 1), "right")
    for c in range(1, room + 1):
        worth[c] = worth[c - 1]
        k = fitting[c]
        if k:
            total = worth[c - ranked[:k]] + gains[:k]
            best = int(np.argmax(total))
            if total[best] > worth[c] + 1e-12:
                worth[c], choice[c] = total[best], best
    pattern, c = np.zeros(len(sizes), np.int64), room
    while c > 0:
        if choice[c] < 0:
            c -= 1
        else:
            pattern[order[choice[c]]] += 1
            c -= int(ranked[choice[c]])
    return float(worth[room]), pattern


def solve(sizes: np.ndarray, demand: np.ndarray, room: int, rounds: int = 5000) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (one per row) and how often each is cut, so that every size is met exactly with fewest stocks.

    Revised simplex; the knapsack prices one new column a round. If ``rounds`` should not be enough the solution so far
    is feasible, only not the best; so it is when ``m`` rounds (the number of sizes) have gained next to nothing.
    """
    m = len(sizes)
    whole = demand.sum()
    need = demand / whole
    patterns = np.diag(room // sizes)
    inverse = np.diag(1 / (room // sizes))
    amount = inverse @ need
    reached, since = np.inf, 0
    for k in range(rounds):
        if amount.sum() < reached * (1 - 1e-6):
            reached, since = amount.sum(), k
        elif k - since > m:  # small demands: many bases give the same solution
            break
        prices = inverse.sum(axis=0)
        gain, column = best_pattern(prices, sizes, room)
        if gain <= 1 + 1e-7:
            break
        # not by a threaded library: thousands of small products would wait for each other's threads
        step = np.einsum("ij,j->i", inverse, column.astype(float))
        usable = np.flatnonzero(step > 1e-9)
        leave = usable[np.argmin(amount[usable] / step[usable])]
        far = amount[leave] / step[leave]
        amount = np.maximum(amount - far * step, 0)
        amount[leave] = far
        row = inverse[leave] / step[leave]
        inverse -= np.outer(step, row)
        inverse[leave] = row
        patterns[leave] = column
    return patterns.reshape(m, m), amount * whole


def rounded(patterns: np.ndarray, amounts: np.ndarray, demand: np.ndarray, most: int) -> np.ndarray:
    """Whole numbers of each pattern, at most ``most`` in all, that use no size more often than there is demand.

    Rounded down, then up where the items left allow it, the largest fractions first.
    """
    scale = min(1.0, most / max(amounts.sum(), 1e-9))
    counts = np.floor(amounts * scale + 1e-9).astype(np.int64)
    left = demand - counts @ patterns
    while (left < 0).any():  # rounding of the solution itself
        guilty = np.flatnonzero((patterns[:, left < 0] > 0).any(axis=1) & (counts > 0))
        counts[guilty] -= 1
        left = demand - counts @ patterns
    for k in np.argsort(-(amounts * scale - counts), kind="stable"):
        if counts.sum() < most and (patterns[k] <= left).all():
            counts[k] += 1
            left = left - patterns[k]
    while counts.sum() > most:
        counts[np.argmax(counts)] -= 1
    return counts
