"""Cutting stock over a histogram: column generation, rounding, and a fill of what rounding leaves."""

from __future__ import annotations

import numpy as np


def best_pattern(value: np.ndarray, size: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack by dynamic programming: the most valuable pattern and its counts."""
    worth = np.full(capacity + 1, -np.inf)  # of one piece of each size
    worth[size] = value
    best, pick = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for c in range(1, capacity + 1):
        options = worth[1:c + 1] + best[c - 1::-1] if c > 1 else worth[1:2] + best[:1]
        at = int(options.argmax())
        best[c], pick[c] = best[c - 1], 0
        if options[at] > best[c]:
            best[c], pick[c] = options[at], at + 1
    counts, c = np.zeros(capacity + 1, np.int64), capacity
    while c > 0:
        if pick[c]:
            counts[pick[c]] += 1
            c -= pick[c]
        else:
            c -= 1
    return float(best[capacity]), counts[size]


def linear_patterns(size: np.ndarray, demand: np.ndarray, capacity: int, gap: float = 5e-4,
                    rounds: int = 500) -> tuple[np.ndarray, np.ndarray]:
    """Basic solution of the linear program: patterns (rows) and how often each is used.

    Starts from patterns of one size each; the knapsack prices a new column until the solution is
    within ``gap`` of the best bound. Columns are priced at duals drawn halfway to those of the best
    bound so far (at first each size's share of the capacity), which keeps them from swinging.
    """
    m = len(size)
    per = capacity // size
    patterns = np.diag(per).astype(np.int64)  # row p: counts of pattern p
    inverse = np.diag(1.0 / per)
    used = demand / per
    centre = size / capacity
    bound = float(centre @ demand)
    for _ in range(rounds):
        if used.sum() <= bound * (1 + gap):
            break
        dual = inverse.sum(axis=0)
        for pull in (0.7, 0.0):
            price = np.maximum(pull * centre + (1 - pull) * dual, 0)
            worth, column = best_pattern(price, size, capacity)
            if price @ demand / worth > bound:
                bound, centre = float(price @ demand / worth), price / worth
            if dual @ column > 1 + 1e-9:
                break
        else:
            break
        few = np.flatnonzero(column)
        step = (inverse[:, few] * column[few]).sum(axis=1)
        ratio = np.where(step > 1e-9, np.maximum(used, 0) / np.where(step > 1e-9, step, 1), np.inf)
        leave = int(ratio.argmin())
        amount = ratio[leave]
        used = used - amount * step
        used[leave] = amount
        pivot = inverse[leave] / step[leave]
        inverse = inverse - np.outer(step, pivot)
        inverse[leave] = pivot
        patterns[leave] = column
    return patterns, np.maximum(used, 0)


def _fill(left: dict[int, int], gap: int) -> dict[int, int]:
    """Pieces of the left counts whose sum comes nearest to ``gap``; larger pieces first."""
    sums, steps = 1, []  # bit s: a sum of s can be reached
    mask = (1 << (gap + 1)) - 1
    for size in sorted(left, reverse=True):
        n = min(left[size], gap // size)
        part = 1
        while n:
            part = min(part, n)
            made = (sums | sums << (size * part)) & mask
            steps.append((size, part, sums))
            sums, n, part = made, n - part, part * 2
        if sums >> gap & 1:
            break
    at, taken = sums.bit_length() - 1, {}
    for size, part, before in reversed(steps):
        if not before >> at & 1:
            taken[size] = taken.get(size, 0) + part
            at -= size * part
    return taken


def stock_plan(size: np.ndarray, demand: np.ndarray, capacity: int, waste: float = 0.004) -> list[tuple[dict[int, int], int]]:
    """``(counts by size, times)`` of the patterns that use up the demand exactly.

    The linear program's counts are rounded down, patterns that leave more than ``waste`` of a
    sequence empty are not used; the pieces that are left are packed largest first, each sequence
    filled as well as the left pieces allow and repeated while they last.
    """
    size, demand = np.asarray(size, np.int64), np.asarray(demand, np.int64)
    left, plan = dict(zip(size.tolist(), demand.tolist())), []
    if len(size):
        patterns, used = linear_patterns(size, demand.astype(float), capacity)
        for p in np.argsort(-used, kind="stable"):
            counts = {int(size[i]): int(patterns[p, i]) for i in np.flatnonzero(patterns[p])}
            times = min([int(used[p] + 1e-6)] + [left[s] // n for s, n in counts.items()])
            if times and size @ patterns[p] >= (1 - waste) * capacity:
                plan.append((counts, times))
                for s, n in counts.items():
                    left[s] -= n * times
    left = {s: n for s, n in left.items() if n}
    while left:
        first = max(left)
        left[first] -= 1
        counts = {first: 1}
        for s, n in _fill(left, capacity - first).items():
            counts[s] = counts.get(s, 0) + n
            left[s] -= n
        left = {s: n for s, n in left.items() if n}
        times = min([1 << 40] + [left.get(s, 0) // n for s, n in counts.items()])
        for s, n in counts.items() if times else ():
            left[s] -= n * times
        left = {s: n for s, n in left.items() if n}
        plan.append((counts, times + 1))
    return plan
