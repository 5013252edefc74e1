"""The composition-aware fill as a plain loop, which tests compare with."""

from __future__ import annotations

import numpy as np


def composition_aware(
    descriptors: np.ndarray, bins: list[list[tuple]], anchors: list[int], target: int, frontier: float, ternary_weight: float = 1.0, totals: tuple[int, int] = (20, 190), floor: float = 0.9
) -> list[int]:
    """Chosen positions, in order, over lists in memory.

    ``bins`` holds for each row its (subset..., bin...) keys, two-element subsets as (a, b, bin). In each step the
    rows are ordered by distance to the chosen ones; of the first max(1, ceil(frontier * n)) those at no distance are
    left out if others remain, and so are those below ``floor`` of the largest distance; the row whose bins are the
    emptiest is taken, then the farther one, then the earlier one.
    """
    chosen = list(anchors) or [0]
    near = np.full(len(descriptors), np.inf)
    tally: dict[tuple, int] = {}
    sums: dict[tuple, int] = {}

    def subset(key: tuple) -> tuple:
        return key[:2] if len(key) == 3 else key[:3]

    def take(i: int) -> None:
        nonlocal near
        near = np.minimum(near, np.sqrt(((descriptors - descriptors[i]) ** 2).sum(axis=1)))
        for key in bins[i]:
            tally[key] = tally.get(key, 0) + 1
            sums[subset(key)] = sums.get(subset(key), 0) + 1

    def reward(i: int) -> float:
        weight = total = 0.0
        for key in bins[i]:
            w, cells = (1.0, totals[0]) if len(key) == 3 else (ternary_weight, totals[1])
            if w > 0:
                goal = max(1, sums.get(subset(key), 0) // cells + 1)
                total += w * max(0, goal - tally.get(key, 0)) / goal
                weight += w
        return total / weight if weight else 0.0

    for i in chosen:
        take(i)
    left = [i for i in range(len(descriptors)) if i not in set(chosen)]
    while left and len(chosen) < target:
        left.sort(key=lambda i: (-near[i], i))
        front = left[: max(1, int(np.ceil(frontier * len(left))))]
        far = [i for i in front if near[i] > 1e-12]
        front = far or front
        front = [i for i in front if near[i] >= floor * near[front[0]]]
        best = min(front, key=lambda i: (-reward(i), -near[i], i))
        chosen.append(best)
        left.remove(best)
        take(best)
    return chosen
