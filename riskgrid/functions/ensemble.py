"""A fitted tree ensemble as arrays, scored by whole batches.

Partial dependence needs each row's score at every grid point.  A feature's
trees cut its axis into cells between their thresholds, and all grid points in one
cell score alike; trees that do not read the feature score alike at every point.
So per batch the margins of the other trees are added once, and the feature's own
trees are walked once per cell that holds a grid point.  For a pair of features
the trees fall into four parts (neither, one, the other, both), and only the last is
walked per pair of cells.  The sums of a batch are added up and merged, so no row
is written per grid point.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd


@dataclass
class Nodes:
    left: np.ndarray
    right: np.ndarray
    feature: np.ndarray  # -1: a leaf
    threshold: np.ndarray
    value: np.ndarray

    @property
    def used(self) -> frozenset[int]:
        return frozenset(self.feature[self.feature >= 0].tolist())


_LOWEST = np.zeros(1 << 16, np.intp)  # the lowest set bit of 16
for _bit in range(15, -1, -1):
    _LOWEST[1 << _bit::2 << _bit] = _bit


class LeafTables:
    """Which leaf of each tree a row ends in, by table lookups instead of walks.

    A tree's leaves, from left to right, are the bits of a mask.  For each feature and each rank of a
    value among the cuts a table holds the leaves that the feature's splits leave open; the lowest bit
    that all features leave is the leaf.  Masks of several trees share a 64-bit word, so one lookup
    serves them all.  ``cut[i]`` is the largest rank that goes left at node i; trees of more than 64 leaves
    are split into words of their own by walking.
    """

    def __init__(self, trees: Sequence[Nodes], cuts: Sequence[np.ndarray], sizes: Sequence[int]):
        self.trees, self.cuts = list(trees), list(cuts)
        self.leaves: list[np.ndarray] = []  # per tree, the nodes of its leaves from left to right
        parts = []
        for t, cut in zip(self.trees, self.cuts):
            found: list[int] = []
            splits: list[tuple[int, int, int, int]] = []  # feature, cut, first and last leaf of the left side

            def walk(i: int) -> None:
                if t.feature[i] < 0:
                    found.append(i)
                    return
                first = len(found)
                walk(int(t.left[i]))
                splits.append((int(t.feature[i]), int(cut[i]), first, len(found)))
                walk(int(t.right[i]))
            walk(0)
            self.leaves.append(np.array(found))
            parts.append(splits)
        most = max(map(len, self.leaves), default=1)
        self.width = next((w for w in (16, 32, 64) if most <= w), 0)
        self.words: list[tuple[list[tuple[int, np.ndarray]], int, int]] = []
        per = 64 // self.width if self.width else 1
        for lo in range(0, len(parts) if self.width else 0, per):
            tables: dict[int, np.ndarray] = {}
            for i, splits in enumerate(parts[lo:lo + per]):
                for f, c, first, last in splits:
                    table = tables.setdefault(f, np.full(sizes[f], 2**64 - 1, np.uint64))
                    table[c + 1:] &= np.uint64((2**64 - 1) ^ ((2**last - 2**first) << (i * self.width)))
            self.words.append((sorted(tables.items()), lo, min(per, len(parts) - lo)))

    def each(self, ranks: Sequence[np.ndarray]):
        """Each tree's number and, per row, the place of its leaf in ``leaves``; ``ranks`` by feature, as indices."""
        for tables, lo, n in self.words:
            word = None
            for f, table in tables:
                open_ = table.take(ranks[f])
                word = open_ if word is None else np.bitwise_and(word, open_, out=word)
            if word is None:
                word = np.full(len(ranks[0]), 2**64 - 1, np.uint64)
            masks = word.astype("<u8", copy=False).view(f"<u{self.width // 8}").reshape(len(word), -1)
            for i in range(n):
                own = masks[:, i]
                yield lo + i, _LOWEST.take(own) if self.width == 16 else np.log2((own & (~own + own.dtype.type(1))).astype(float)).astype(np.intp)
        for k, (t, cut) in enumerate(zip(self.trees, self.cuts) if not self.width else ()):
            at, rows = np.zeros(len(ranks[0]), dtype=int), np.arange(len(ranks[0]))
            x = np.stack(ranks)
            while (t.feature[at] >= 0).any():
                at = np.where(t.feature[at] < 0, at, np.where(x[t.feature[at], rows] > cut[at], t.right[at], t.left[at]))
            yield k, np.argsort(self.leaves[k])[np.searchsorted(np.sort(self.leaves[k]), at)]


class ValueTables:
    """Margins of several ensembles over the values of one row set: values are ranked among all thresholds once."""

    CHUNK = 16384

    def __init__(self, ensembles: Sequence[Sequence[Nodes]], n_features: int, nulls_left: bool):
        trees = [t for own in ensembles for t in own]
        self.owner = [k for k, own in enumerate(ensembles) for _ in own]
        self.n, self.nulls_left = len(ensembles), nulls_left
        self.cuts = [np.unique(np.concatenate([t.threshold[t.feature == f] for t in trees] or [np.zeros(0)])) for f in range(n_features)]
        rank = [np.array([np.searchsorted(self.cuts[f], v) if f >= 0 else -1 for f, v in zip(t.feature, t.threshold)], dtype=int) for t in trees]
        self.tables = LeafTables(trees, rank, [len(c) + 1 for c in self.cuts])
        self.values = [t.value[leaves] for t, leaves in zip(trees, self.tables.leaves)]

    def margins(self, x: np.ndarray) -> np.ndarray:
        """(ensembles, rows)."""
        out = np.zeros((self.n, len(x)))
        for lo in range(0, len(x), self.CHUNK):
            part, sums = x[lo:lo + self.CHUNK], out[:, lo:lo + self.CHUNK]
            ranks = []
            for f, cuts in enumerate(self.cuts):
                v = np.ascontiguousarray(part[:, f])
                at = np.searchsorted(cuts, v, side="left")
                if self.nulls_left:
                    at[np.isnan(v)] = 0
                ranks.append(at)
            for k, leaf in self.tables.each(ranks):
                sums[self.owner[k]] += self.values[k].take(leaf)
        return out


class TreeEnsemble:
    """P(class 1) = 1 / (1 + exp(-scale margin)); ``nulls_left`` says where NaN goes."""

    def __init__(self, trees: list[Nodes], features: Sequence[str], scale: float, nulls_left: bool):
        self.trees, self.features, self.scale, self.nulls_left = trees, list(features), scale, nulls_left
        self._tables: dict[tuple[int, ...], ValueTables] = {}

    @classmethod
    def of(cls, model, features: Sequence[str]) -> TreeEnsemble:
        from riskgrid.operators.boosting import BoostedTrees
        from riskgrid.operators.model import node_table
        own = isinstance(model, BoostedTrees)
        return cls.from_table(node_table(model), model.features if own else features, 1.0 if own else 2.0, own)

    @classmethod
    def from_table(cls, table: pd.DataFrame, features: Sequence[str], scale: float, nulls_left: bool) -> TreeEnsemble:
        trees = []
        for _, t in table.sort_values(["tree", "id"]).groupby("tree"):
            place = {int(i): k for k, i in enumerate(t["id"])}
            leaf = t["left"].to_numpy() < 0
            child = [np.array([k if end else place[int(c)] for k, (end, c) in enumerate(zip(leaf, t[side]))]) for side in ("left", "right")]
            trees.append(Nodes(*child, np.where(leaf, -1, t["feature"].to_numpy()).astype(int),
                               np.where(leaf, 0.0, t["threshold"].to_numpy(dtype=float)), (t["weight"] * t["value"]).to_numpy()))
        return cls(trees, features, scale, nulls_left)

    def margin(self, x: np.ndarray, trees: Sequence[Nodes] | None = None) -> np.ndarray:
        trees = self.trees if trees is None else list(trees)
        own = tuple(map(id, trees))
        if own not in self._tables:
            self._tables[own] = ValueTables([trees], len(self.features), self.nulls_left)
        return self._tables[own].margins(x)[0]

    def __getstate__(self):
        return {**self.__dict__, "_tables": {}}  # keyed by what the trees are called in this process

    def prob(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.scale * margin))

    def score(self, x: np.ndarray) -> np.ndarray:
        return self.prob(self.margin(x))

    def cells(self, f: int, grid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each grid point's cell number, and one grid point of each of these cells."""
        cuts = np.unique(np.concatenate([t.threshold[t.feature == f] for t in self.trees] or [np.zeros(0)]))
        _, first, cell = np.unique(np.searchsorted(cuts, grid, side="left"), return_index=True, return_inverse=True)
        return cell, grid[first]

    def _at_cells(self, x: np.ndarray, f: int, points: np.ndarray, trees: list[Nodes]) -> np.ndarray:
        """(cells, rows): margins of ``trees`` with feature f at each cell's point."""
        x, out = x.copy(), np.empty((len(points), len(x)))
        for k, g in enumerate(points):
            x[:, f] = g
            out[k] = self.margin(x, trees)
        return out

    def along(self, x: np.ndarray, f: int, grid: np.ndarray) -> np.ndarray:
        """(grid points, rows): each row's score with feature f at each grid point."""
        cell, points = self.cells(f, grid)
        rest = self.margin(x, [t for t in self.trees if f not in t.used])
        return self.prob(rest + self._at_cells(x, f, points, [t for t in self.trees if f in t.used]))[cell]

    def sums_along(self, x: np.ndarray, f: int, grid: np.ndarray) -> np.ndarray:
        cell, points = self.cells(f, grid)
        rest = self.margin(x, [t for t in self.trees if f not in t.used])
        return self.prob(rest + self._at_cells(x, f, points, [t for t in self.trees if f in t.used])).sum(axis=1)[cell]

    def sums_over(self, x: np.ndarray, f: int, f_grid: np.ndarray, g: int, g_grid: np.ndarray) -> np.ndarray:
        """(f points, g points): the sum of scores at each pair of grid points."""
        part = {(i, j): [t for t in self.trees if (f in t.used, g in t.used) == (i, j)] for i in (True, False) for j in (True, False)}
        f_cell, f_points = self.cells(f, f_grid)
        g_cell, g_points = self.cells(g, g_grid)
        base = self.margin(x, part[False, False])
        by_f = self._at_cells(x, f, f_points, part[True, False])
        by_g = self._at_cells(x, g, g_points, part[False, True])
        out, x = np.empty((len(f_points), len(g_points))), x.copy()
        for a, p in enumerate(f_points):
            x[:, f] = p
            both = self._at_cells(x, g, g_points, part[True, True])
            out[a] = self.prob(base + by_f[a] + by_g + both).sum(axis=1)
        return out[np.ix_(f_cell, g_cell)]
