"""The plan of a packing, made from a histogram of lengths alone.

Its size depends on the number of different lengths (at most the capacity), never on the number of
pieces: pieces of one length are interchangeable, so the plan speaks of ranges of them ("pieces
start..start+count of this length go to sequences first..first+count, at this offset").
"""

from __future__ import annotations

from collections import defaultdict
from typing import NamedTuple

import numpy as np


class Move(NamedTuple):
    """``count`` pieces of a length, numbered from ``start``, one to each sequence from ``first``, all at ``offset``."""

    length: int
    start: int
    count: int
    first: int
    offset: int


def configurations(sizes: list[int], demand: list[int], capacity: int, rounds: int = 2000) -> list[tuple[list[int], int]]:
    """Bins as lists of counts per size, each with how often to use it, from the linear programme over all configurations.

    Columns are generated by knapsack pricing until none improves the bound; the optimum's whole parts are
    used, and what they leave over (less than one bin per size) is for the caller to place.
    """
    k = len(sizes)
    if not k:
        return []
    columns = [[0] * i + [capacity // s] + [0] * (k - i - 1) for i, s in enumerate(sizes)]
    basis = np.array(columns, dtype=float).T
    need = np.array(demand, dtype=float)
    for _ in range(rounds):
        prices = np.linalg.solve(basis.T, np.ones(k))
        column = _best_configuration(sizes, prices, capacity)
        if float(prices @ column) <= 1 + 1e-9:
            break
        used, enters = np.linalg.solve(basis, need), np.linalg.solve(basis, np.array(column, dtype=float))
        ratios = np.where(enters > 1e-9, used / np.where(enters > 1e-9, enters, 1), np.inf)
        basis[:, int(np.argmin(ratios))] = column
    often = np.floor(np.linalg.solve(basis, need) + 1e-7).astype(int)
    return [([int(a) for a in basis[:, j]], int(often[j])) for j in range(k) if often[j] > 0]


def _best_configuration(sizes: list[int], prices: np.ndarray, capacity: int) -> np.ndarray:
    """The configuration of the highest total price that fits (unbounded knapsack)."""
    size, best = np.array(sizes), np.zeros(capacity + 1)
    chosen = np.full(capacity + 1, -1)
    smallest = int(size.min())
    for room in range(smallest, capacity + 1):
        fits = size <= room
        values = np.where(fits, prices + best[np.where(fits, room - size, 0)], -1.0)
        pick = int(values.argmax())
        best[room], chosen[room] = values[pick], pick
        if best[room - 1] >= best[room]:
            best[room], chosen[room] = best[room - 1], -1
    column, room = np.zeros(len(sizes)), capacity
    while room >= smallest:
        if chosen[room] < 0:
            room -= 1
        else:
            column[chosen[room]] += 1
            room -= sizes[chosen[room]]
    return column


def plan(histogram: dict[int, int], capacity: int, groups: int = 48, small: int | None = None) -> tuple[list[Move], int]:
    """Moves that place every piece once, and the number of sequences.

    Lengths over ``small`` (an eighth of the capacity by default) are large. Sorted, they are cut into
    ``groups`` groups of equal cardinality, and each counts as long as its group's longest; the rounded
    sizes are packed by ``configurations``; the group's actual pieces, longest first, take the places.
    The room this leaves is known exactly, and what remains (small pieces and the rest of the large) goes
    best fit, longest first, into the fullest sequence that still has room.
    """
    small = capacity // 8 if small is None else small
    moves: list[Move] = []
    left = {n: [0, c] for n, c in histogram.items() if c}  # next piece of a length, pieces left
    room: dict[int, list[list[int]]] = defaultdict(list)  # room -> ranges [first sequence, count]
    sequences = 0
    if capacity in left:
        moves.append(Move(capacity, 0, left[capacity][1], 0, 0))
        sequences = left.pop(capacity)[1]

    large = sorted((n for n in left if n > small), reverse=True)
    total = sum(left[n][1] for n in large)
    share, members, rounded = -(-total // max(1, groups)), [], []
    filled = share
    for n in large:  # groups of equal cardinality; a length may be split between two
        start, count = left[n]
        while count:
            if filled >= share:
                members.append([])
                rounded.append(n)
                filled = 0
            take = min(count, share - filled)
            members[-1].append([n, start, take])
            start, count, filled = start + take, count - take, filled + take
    demand = [sum(m[2] for m in g) for g in members]
    merged = sorted(set(rounded), reverse=True)  # groups rounded to one size share it
    queues = {s: [m for g, r in zip(members, rounded, strict=True) if r == s for m in g] for s in merged}
    wanted = [sum(d for d, r in zip(demand, rounded, strict=True) if r == s) for s in merged]
    for column, often in configurations(merged, wanted, capacity):
        ranges = [[sequences, often, 0]]  # first, count, load
        for size, copies in zip(merged, column, strict=True):
            for _ in range(copies):
                placed = []
                for first, count, load in ranges:
                    while count:
                        if not queues[size]:  # fewer pieces than places: the place stays free
                            placed.append([first, count, load])
                            break
                        n, start, have = head = queues[size][0]
                        take = min(have, count)
                        moves.append(Move(n, start, take, first, load))
                        left[n][1] -= take
                        placed.append([first, take, load + n])
                        head[1], head[2] = start + take, have - take
                        if not head[2]:
                            queues[size].pop(0)
                        first, count = first + take, count - take
                ranges = placed
        for first, count, load in ranges:
            room[capacity - load].append([first, count])
        sequences += often

    rest: dict[int, list[list[int]]] = defaultdict(list)  # what is left of each length, as ranges of pieces
    for queue in queues.values():
        for n, start, count in queue:
            rest[n].append([start, count])
    for n in left:
        if n <= small:
            rest[n].append([0, left[n][1]])
    for n in sorted(rest, reverse=True):
        for start, count in rest[n]:
            while count:
                fit = next((r for r in range(n, capacity + 1) if room.get(r)), None)
                if fit is None:
                    opened = -(-count // (capacity // n))
                    room[capacity].append([sequences, opened])
                    sequences += opened
                    fit = capacity
                first, have = room[fit][-1]
                take = min(have, count)
                moves.append(Move(n, start, take, first, capacity - fit))
                start, count = start + take, count - take
                if take == have:
                    room[fit].pop()
                else:
                    room[fit][-1] = [first + take, have - take]
                room[fit - n].append([first, take])
    return moves, sequences


def fewest_sequences(histogram: dict[int, int], capacity: int, group_counts: tuple[int, ...] = (24, 48, 96)) -> tuple[list[Move], int]:
    """The best plan over several numbers of groups and two limits of what counts as small."""
    plans = [plan(histogram, capacity, groups, limit) for groups in group_counts for limit in (capacity // 8, capacity // 4)]
    return min(plans, key=lambda p: (p[1], len(p[0])))
