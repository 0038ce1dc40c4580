"""The E8 lattice in numpy: nearest points, neighbouring cells, hashed cells of random projections."""

from __future__ import annotations

import itertools

import numpy as np

DIMENSIONS = 8
# unrelated odd numbers: related ones would give one number to many points
MULTIPLIERS = np.random.default_rng(2024).integers(0, 1 << 64, DIMENSIONS + 1, np.uint64) | np.uint64(1)


def roots() -> np.ndarray:
    """The 240 shortest vectors: the steps from a cell to those that touch it closest."""
    found = []
    for i, j in itertools.combinations(range(DIMENSIONS), 2):
        for a, b in itertools.product((-1.0, 1.0), repeat=2):
            v = np.zeros(DIMENSIONS)
            v[i], v[j] = a, b
            found.append(v)
    for signs in itertools.product((-0.5, 0.5), repeat=DIMENSIONS):
        if sum(s < 0 for s in signs) % 2 == 0:
            found.append(np.array(signs))
    return np.array(found)


def _even(x: np.ndarray) -> np.ndarray:
    """Nearest integer points with an even coordinate sum."""
    point = np.rint(x)
    odd = np.flatnonzero(point.sum(axis=1) % 2)
    rest = x[odd] - point[odd]
    worst = np.abs(rest).argmax(axis=1)
    at = np.arange(len(odd))
    point[odd, worst] += np.where(rest[at, worst] >= 0, 1.0, -1.0)
    return point


def nearest(x: np.ndarray) -> np.ndarray:
    """The nearest lattice point of each row: integers of even sum, or those moved by a half."""
    whole, half = _even(x), _even(x - 0.5) + 0.5
    closer = ((x - half) ** 2).sum(axis=1) < ((x - whole) ** 2).sum(axis=1)
    return np.where(closer[:, None], half, whole)


def hashed(points: np.ndarray, table: int) -> np.ndarray:
    """A 64-bit number for each lattice point of a table."""
    codes = np.rint(points * 2).astype(np.int64).astype(np.uint64)
    mixed = (codes * MULTIPLIERS[:DIMENSIONS]).sum(axis=-1, dtype=np.uint64) + MULTIPLIERS[DIMENSIONS:] * np.uint64(table + 1)
    mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return (mixed ^ (mixed >> np.uint64(31))).view(np.int64)


class Tables:
    """Random projections of unit vectors to eight dimensions, one per table."""

    def __init__(self, dimensions: int, tables: int, spacing: float, seed: int = 11) -> None:
        drawn = np.random.default_rng([seed, dimensions])
        scale = np.sqrt(dimensions / DIMENSIONS) / spacing
        self.maps, self.shifts = [], []
        for _ in range(tables):
            plane = np.linalg.qr(drawn.standard_normal((max(dimensions, DIMENSIONS), DIMENSIONS)))[0][:dimensions]
            self.maps.append(plane * scale)
            self.shifts.append(drawn.uniform(0, 2, DIMENSIONS))
        self.roots = roots()

    def cells(self, unit: np.ndarray, probes: int) -> tuple[np.ndarray, np.ndarray]:
        """Own cell per (vector, table), and the ``probes`` closest other cells."""
        own, near = [], []
        for t, (plane, shift) in enumerate(zip(self.maps, self.shifts)):
            x = unit @ plane + shift
            point = nearest(x)
            own.append(hashed(point, t))
            toward = (x - point) @ self.roots.T
            best = np.argpartition(-toward, probes - 1, axis=1)[:, :probes]
            near.append(hashed(point[:, None, :] + self.roots[best], t))
        return np.stack(own, axis=1), np.stack(near, axis=1)
