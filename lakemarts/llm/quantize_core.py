"""Product codes over integer vectors: Orchard search for the nearest entry
(see ``quantize``)."""

from __future__ import annotations

import numpy as np

SCALE = 1024
PARTS = 4
#: Components beyond this leave no room for exact squared distances.
LARGEST = 1 << 24
#: Vectors whose searches run side by side.
SIDE_BY_SIDE = 4096


def usable(vector) -> bool:
    """No null vector, no empty one, and no null or non-finite component."""
    return vector is not None and len(vector) > 0 and bool(np.isfinite(np.array(vector, dtype=np.float64)).all())


def integers(vectors: list) -> np.ndarray:
    """Rows of floor(1024 * x); the product by a power of two is exact."""
    scaled = np.floor(np.array(vectors, dtype=np.float64) * SCALE)
    if scaled.size and np.abs(scaled).max() >= LARGEST:
        raise ValueError(f"vector components must be less than {LARGEST // SCALE} for exact distances")
    return scaled.astype(np.int64)


def parts(vectors: np.ndarray) -> np.ndarray:
    """``(part, vector, component)``."""
    return np.ascontiguousarray(vectors.reshape(len(vectors), PARTS, -1).transpose(1, 0, 2))


class Orchard:
    """Nearest of a codebook's entries by neighbour lists.

    Every entry has the list of all entries by distance.  A search holds its
    best entry so far and walks that entry's list: an entry nearer to the
    vector takes its place and the walk jumps to the start of the new list;
    entries already compared are marked and passed over.  By the triangle
    inequality nothing behind twice the current distance can be nearer or as
    near, so there the walk stops.  Ties go to the lower index: an entry as
    near as the best is within the bound, and takes its place if its index is
    lower.  Distances are squared integers, compared exactly."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        between = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
        self.lists = np.argsort(between, axis=1, kind="stable")
        self.reach = np.take_along_axis(between, self.lists, axis=1)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry of each vector."""
        found = [self._search(vectors[lo : lo + SIDE_BY_SIDE]) for lo in range(0, len(vectors), SIDE_BY_SIDE)]
        if not found:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def _search(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, size = len(vectors), len(self.entries)
        best = np.zeros(n, dtype=np.int64)
        distance = ((vectors - self.entries[0]) ** 2).sum(axis=1)
        owner = best.copy()  # the entry whose list is walked
        marked = np.zeros((n, size), dtype=bool)
        marked[:, 0] = True
        at = np.zeros(n, dtype=np.int64)
        walking = np.arange(n)
        while len(walking):
            entry = self.lists[owner[walking], at[walking]]
            # the bound is of the entry whose list it is: it and the best are equally far
            going = self.reach[owner[walking], at[walking]] <= 4 * distance[walking]
            walking, entry = walking[going], entry[going]
            at[walking] += 1
            fresh = ~marked[walking, entry]
            rows, tried = walking[fresh], entry[fresh]
            marked[rows, tried] = True
            gap = ((vectors[rows] - self.entries[tried]) ** 2).sum(axis=1)
            nearer = gap < distance[rows]
            moved, to = rows[nearer], tried[nearer]
            best[moved] = owner[moved] = to
            distance[moved] = gap[nearer]
            at[moved] = 0
            same = (gap == distance[rows]) & (tried < best[rows])
            best[rows[same]] = tried[same]
            walking = walking[at[walking] < size]
        return best, distance


def replaced(entries: np.ndarray, sums: dict[int, tuple[int, list[int]]]) -> np.ndarray:
    """Entries with the floor of the mean of what was assigned to them;
    unused entries stay."""
    out = entries.copy()
    for i, (count, total) in sums.items():
        out[i] = [t // count for t in total]
    return out
