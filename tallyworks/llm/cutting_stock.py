"""Cutting stock by column generation: how to fill bins of one capacity from a histogram of item sizes.

A linear program chooses how often each pattern (a set of sizes that fits into a bin) is used, so
that every item is placed with the fewest bins. It starts from bins filled by decreasing size. In each round the
dual prices of the sizes go into a knapsack, solved by dynamic programming, whose
best fillings are the next patterns to enter; when none is worth more than a bin, or the use is
within ``TOLERANCE`` of the bound that the prices give, the program is done. The solution is rounded down, and the few items that are left (less than one bin for
each pattern) are filled in by decreasing size.

The work depends on the number of sizes alone, not on the number of items.
"""

from __future__ import annotations

import numpy as np

# Pricing stops after so many knapsacks, or when the program is within this share of its bound.
ROUNDS = 200
TOLERANCE = 2e-4
PIVOTS = 400
REFRESH = 100
EPSILON = 1e-9

Pattern = tuple[dict[int, int], int]


def knapsacks(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable filling's value, and the best filling around each size, one in each column.

    Each size may be taken any number of times; one dynamic program serves all columns.
    """
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fitting = np.searchsorted(sizes, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        best[room], n = best[room - 1], fitting[room]
        if n:
            values = best[room - sizes[:n]] + prices[:n]
            i = int(values.argmax())
            if values[i] > best[room] + EPSILON:
                best[room], last[room] = values[i], i
    fillings = np.eye(len(sizes))
    for column, size in enumerate(sizes.tolist()):
        room = capacity - size
        while room > 0:
            if last[room] < 0:
                room -= 1
            else:
                fillings[last[room], column] += 1
                room -= int(sizes[last[room]])
    return float(best[capacity]), fillings


def times(matrix: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Their product, without the thread pool of the linear algebra library, which a driver that has forked may block on."""
    return np.einsum("ij,j->i", matrix, vector)


def inverted(matrix: np.ndarray) -> np.ndarray:
    """The inverse by elimination with row exchange."""
    n = len(matrix)
    rows = np.concatenate([matrix, np.eye(n)], axis=1)
    for i in range(n):
        pivot = i + int(np.abs(rows[i:, i]).argmax())
        rows[[i, pivot]] = rows[[pivot, i]]
        rows[i] /= rows[i, i]
        factors = rows[:, i].copy()
        factors[i] = 0
        rows -= factors[:, None] * rows[i]
    return rows[:, n:]


def greedy(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> np.ndarray:
    """A basis to start from: bins filled by decreasing size, each pattern used until one size runs out."""
    left, open_sizes = demand.astype(float), np.ones(len(sizes), bool)
    basis = np.zeros((len(sizes), len(sizes)))
    while open_sizes.any():
        column, room = np.zeros(len(sizes)), capacity
        for i in np.flatnonzero(open_sizes)[::-1]:
            column[i] = room // sizes[i]
            room -= int(column[i] * sizes[i])
        part = np.flatnonzero(column)
        out = int(part[(left[part] / column[part]).argmin()])
        left = np.maximum(left - left[out] / column[out] * column, 0)
        basis[:, out], open_sizes[out] = column, False
    return basis


def relaxed(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The basis of the linear program (a pattern in each column) and how often each is used."""
    basis = greedy(sizes, demand, capacity)
    inverse, steps, bound = inverted(basis), 0, 0.0
    used = np.maximum(times(inverse, demand), 0)
    centre = sizes / capacity
    for _ in range(ROUNDS):
        # Prices between the program's own and the best known ones lead to better patterns sooner.
        own = inverse.sum(0)
        prices = 0.2 * own + 0.8 * centre
        value, pool = knapsacks(sizes, prices, capacity)
        if times(prices[None], demand)[0] / max(value, 1.0) > bound:
            bound, centre = times(prices[None], demand)[0] / max(value, 1.0), prices / max(value, 1.0)
        if used.sum() <= bound * (1 + TOLERANCE):
            break
        if times(pool.T, own).max() <= 1 + 1e-7:
            value, pool = knapsacks(sizes, own, capacity)
            if value <= 1 + 1e-7:
                break
        for _ in range(PIVOTS):
            worth = times(pool.T, inverse.sum(0))
            best = int(worth.argmax())
            if worth[best] <= 1 + 1e-7:
                break
            entering = times(inverse, pool[:, best])
            up = np.flatnonzero(entering > EPSILON)
            if not len(up):
                break
            out = int(up[(used[up] / entering[up]).argmin()])
            amount, steps = used[out] / entering[out], steps + 1
            basis[:, out] = pool[:, best]
            if steps % REFRESH:
                used -= amount * entering
                used[out] = amount
                row = inverse[out] / entering[out]
                inverse -= np.outer(entering, row)
                inverse[out] = row
            else:
                inverse = inverted(basis)
                used = times(inverse, demand)
            used = np.maximum(used, 0)
    return basis, used


def solve(histogram: dict[int, int], capacity: int) -> list[Pattern]:
    """Patterns (how many of each size) with how often each is used; together they place every item exactly once."""
    sizes = np.array(sorted(k for k, n in histogram.items() if n > 0))
    if not len(sizes):
        return []
    demand = np.array([histogram[k] for k in sizes.tolist()], float)
    basis, used = relaxed(sizes, demand, capacity)
    left, patterns = demand.astype(int), []
    for column, amount in zip(basis.T.astype(int), np.floor(used + EPSILON).astype(int)):
        part = column > 0
        repeats = int(min(amount, (left[part] // column[part]).min()))
        if repeats > 0:
            patterns.append((dict(zip(sizes[part].tolist(), column[part].tolist())), repeats))
            left = left - repeats * column
    while left.any():
        column, room = np.zeros_like(left), capacity
        for i in reversed(range(len(sizes))):
            column[i] = min(left[i], room // sizes[i])
            room -= int(column[i] * sizes[i])
        part = column > 0
        repeats = int((left[part] // column[part]).min())
        patterns.append((dict(zip(sizes[part].tolist(), column[part].tolist())), repeats))
        left = left - repeats * column
    return patterns
