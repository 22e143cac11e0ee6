"""Boosted trees on gradient histograms, a whole parameter grid at a time.

``pyspark.ml`` has no leaf regularisation, no least child weight, no bounded leaf
and no column sampling, and fits one parameter point per run.  Here a level of the
next tree is one Spark job for every point of the grid: each task reads its rows'
bins and margins, finds every point's gradients and the rows' nodes, and adds
them into (point, node, feature, bin) sums; the sums of all tasks meet in one
shuffle, whose size follows the grid and the bins, not the rows.  The driver gets
only those sums and picks the splits.

Gradients are added as whole numbers (2^-24 steps), so the sums, the splits and
the trees do not depend on task order or on a task that ran twice.  Rows are
sampled by a hash of their key and the tree's number.

Margins are kept beside the bins and written anew after every ``block`` trees, so a
pass scores at most a block of trees.  With each block two passes over the
validation rows give the scores of every tree prefix, first their range, then counts
per score cell; from these come the average precisions that pick the best prefix and
stop a point that has not improved for ``patience`` trees.

A job for each level costs far more than its work where rows are few.  Rows that take
no more than ``APART`` bytes are therefore sent to one task per point, which grows all
its trees without a job in between: the same sums, so the same trees.

Nulls go left at every split.  A row without a label counts as a negative, as it does
in the class weight.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskgrid.functions.ensemble import LeafTables, Nodes, ValueTables
from riskgrid.session import drop_table, write_lineage

BINS = 256
FIXED = float(1 << 24)
CELLS = 2048  # score cells of the prefix evaluation
APART = 32 << 20  # bytes of hashes, labels and bins up to which a point is grown in one task


@dataclass(frozen=True)
class Point:
    """One set of training parameters."""
    max_depth: int = 4
    min_child_weight: float = 8.0
    reg_lambda: float = 12.0
    learning_rate: float = 0.04
    max_delta_step: float = 1.0


@dataclass
class Tree:
    """Nodes in heap order: the children of i are 2i + 1 and 2i + 2; feature -1 is a leaf."""
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    cut: np.ndarray  # the threshold as a bin

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        return cls(np.full(n, -1, np.int16), np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n, np.int16))

    def leaf(self, go_left, n: int) -> np.ndarray:
        """The node where each of n rows ends; ``go_left(rows, nodes)`` decides at a split."""
        at = np.zeros(n, np.int32)
        while True:
            rows = np.nonzero(self.feature[at] >= 0)[0]
            if not len(rows):
                return at
            nodes = at[rows]
            at[rows] = 2 * nodes + 2 - go_left(rows, nodes)

    def as_nodes(self) -> Nodes:
        i = np.arange(len(self.feature))
        return Nodes(2 * i + 1, 2 * i + 2, self.feature.astype(int), self.threshold, self.value)

    def of_values(self, x: np.ndarray) -> np.ndarray:
        return self.leaf(lambda rows, nodes: ~(x[rows, self.feature[nodes]] > self.threshold[nodes]), len(x))


@dataclass
class BoostedTrees:
    """A fitted ensemble: the margin is the sum of the leaf values."""
    features: list[str]
    trees: list[Tree]
    point: Point
    val_ap: list[float] = field(default_factory=list)

    def tables(self) -> ValueTables:
        return ValueTables([[t.as_nodes() for t in self.trees]], len(self.features), True)

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.tables().margins(x)[0]

    def staged(self, x: np.ndarray) -> Iterator[np.ndarray]:
        """The margin after each tree."""
        out = np.zeros(len(x))
        for t in self.trees:
            out = out + t.value[t.of_values(x)]
            yield out

    def prefix(self, n: int) -> BoostedTrees:
        return replace(self, trees=self.trees[:n], val_ap=self.val_ap[:n])

    def score(self, df: DataFrame, out: str = "prob") -> DataFrame:
        """``df`` with P(class 1), by Arrow batches; the trees are shipped with the task."""
        from pyspark.sql.functions import pandas_udf
        tables = self.tables()

        @pandas_udf("double")
        def prob(cols: pd.DataFrame) -> pd.Series:
            return pd.Series(1 / (1 + np.exp(-tables.margins(cols.to_numpy(dtype=float))[0])))
        return df.withColumn(out, prob(F.struct(*[F.col(f).cast("double").alias(f) for f in self.features])))

    def nodes(self) -> pd.DataFrame:
        """(tree, id, left, right, feature, threshold, value, cover, weight), as tree contributions read it."""
        rows = []
        for k, t in enumerate(self.trees):
            live = [0]
            for i in live:
                split = bool(t.feature[i] >= 0)
                rows.append((k, i, 2 * i + 1 if split else -1, 2 * i + 2 if split else -1, int(t.feature[i]), float(t.threshold[i]),
                             float(t.value[i]), float(t.cover[i]), 1.0))
                live += [2 * i + 1, 2 * i + 2] * split
        return pd.DataFrame(rows, columns=["tree", "id", "left", "right", "feature", "threshold", "value", "cover", "weight"])

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.nodes())


def grid(depths=(3, 4), child_weights=(8.0, 12.0), lambdas=(10.0, 20.0), rates=(0.03, 0.05)) -> list[Point]:
    """The 16 points of the small grid, in the order in which the first best wins."""
    return [Point(d, c, r, s) for d in depths for c in child_weights for r in lambdas for s in rates]


def cut_points(train: DataFrame, features: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """At most ``bins - 1`` increasing cuts per feature, from one mergeable sketch."""
    qs = [i / bins for i in range(1, bins)]
    row = train.agg(*[F.percentile_approx(F.col(f).cast("double"), qs, 10_000).alias(f"c{k}") for k, f in enumerate(features)]).first()
    return [np.unique(np.array(row[f"c{k}"] or [], dtype=float)) for k in range(len(features))]


PACKED = "h binary, y binary, bins binary, margin binary"
CHUNK = 16384  # rows that the sums are formed of at a time


def _packs(h: np.ndarray, y: np.ndarray, bins: np.ndarray, margin: np.ndarray) -> pa.RecordBatch:
    """Some 4 KB of rows to a record: hashes, labels, bins (rows x features) and margins (rows x points)."""
    n, own = len(h), 16 + bins.shape[1] + 8 * margin.shape[1]
    per = max(1, 4096 // own)
    at = range(0, n, per)
    return pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(a[i:i + per]).tobytes() for i in at], pa.binary())
                                       for a in (h, y, bins, margin)], ["h", "y", "bins", "margin"])


def _binned(df: DataFrame, features: Sequence[str], cuts: list[np.ndarray], label: str, key: str, points: int) -> DataFrame:
    """(h, y, bins, margin): the key's hash, the label, one byte per feature, a margin per point, in packs of rows."""
    def rows(batches):
        for b in batches:
            x = np.column_stack([np.asarray(b.column(2 + k).to_numpy(zero_copy_only=False), dtype=float) for k in range(len(features))])
            at = np.column_stack([np.where(np.isnan(x[:, k]), 0, np.searchsorted(c, x[:, k], side="left")) for k, c in enumerate(cuts)])
            yield _packs(b.column(0).to_numpy(), np.asarray(b.column(1).to_numpy(zero_copy_only=False), dtype=float), at.astype(np.uint8),
                         np.zeros((b.num_rows, points)))
    cols = [F.xxhash64(key).alias("h"), F.coalesce(F.col(label).cast("double"), F.lit(0.0)).alias("y"), *[F.col(f).cast("double").alias(f"x{k}") for k, f in enumerate(features)]]
    return df.select(*cols).mapInArrow(rows, PACKED)


def _arrays(b: pa.RecordBatch, n_features: int, points: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """h, y, bins (rows x features), margins (rows x points), ``CHUNK`` rows at a time."""
    h, y, bins, margin = (np.frombuffer(b"".join(c.to_pylist()), t) for c, t in zip(b.columns, (np.int64, np.float64, np.uint8, np.float64)))
    bins, margin = bins.reshape(len(h), n_features), margin.reshape(len(h), points)
    for lo in range(0, len(h), CHUNK):
        at = slice(lo, lo + CHUNK)
        yield h[at], y[at], bins[at], margin[at]


def _ranks(bins: np.ndarray) -> list[np.ndarray]:
    return list(np.ascontiguousarray(bins.T).astype(np.intp))


class Block:
    """Trees of several points, looked up by bins, a point's own in their order."""

    def __init__(self, trees: list[list[Tree]], n_features: int):
        order = [(j, k) for j in range(max(map(len, trees), default=0)) for k in range(len(trees)) if j < len(trees[k])]
        own = [trees[k][j] for j, k in order]
        self.order, self.tables = order, LeafTables([t.as_nodes() for t in own], [t.cut.astype(int) for t in own], [BINS] * n_features)
        self.values = [t.value[leaves] for t, leaves in zip(own, self.tables.leaves)]

    def advance(self, margin: np.ndarray, ranks: list[np.ndarray]) -> Iterator[tuple[int, int]]:
        """Add the trees to the margins (points x rows); (tree, point) after each."""
        for i, leaf in self.tables.each(ranks):
            j, k = self.order[i]
            margin[k] += self.values[i].take(leaf)
            yield j, k


def _advance(margin: np.ndarray, ranks: list[np.ndarray], block: Block) -> np.ndarray:
    """Margins (points x rows) after the given trees of each point."""
    for _ in block.advance(margin, ranks):
        pass
    return margin


def _sampled(h: np.ndarray, tree: int, seed: int, share: float) -> np.ndarray:
    """Rows of the tree's sample: a multiplicative hash of the row's hash, the tree and the seed."""
    with np.errstate(over="ignore"):
        x = h.view(np.uint64) + np.uint64((tree + 1) * 0x9E3779B97F4A7C15 % 2**64) + np.uint64(seed)
        for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(by)
        x ^= x >> np.uint64(31)
    return x < np.uint64(min(2**64 - 1, int(share * 2.0**64)))


def _slopes(margin: np.ndarray, y: np.ndarray, weight: float) -> tuple[np.ndarray, np.ndarray]:
    """Gradients and hessians as whole numbers."""
    v, p = np.where(y == 1, weight, 1.0), 1 / (1 + np.exp(-margin))
    return np.rint(v * (p - y) * FIXED), np.rint(v * p * (1 - p) * FIXED)


def _histograms(table: DataFrame, done: list[list[Tree]], open_: list[Tree], level: int, active: list[int], weight: float,
                tree: int, cols: np.ndarray, n_features: int, seed: int, share: float, above: dict[int, np.ndarray]) -> np.ndarray:
    """Gradient and hessian sums (2, points, nodes of the level, features, bins) of the active points.

    Below the root only the lighter child of each split is summed: the sums are whole numbers, so the other
    child's are exactly what is left of the parent's (``above``)."""
    width, points = 2 ** level, len(done)
    nodes = max(1, width // 2)  # one of each pair
    shape = (len(active), nodes, n_features, BINS)
    now = Block([[open_[k]] for k in active], n_features)
    light = np.zeros((len(active), nodes), int)
    place = []  # per active point and leaf: its pair, or -1 where it is not summed
    for a, k in enumerate(active):
        t, pair = open_[k], np.full(len(open_[k].feature), -1)
        if level == 0:
            pair[0] = 0
        for j in range(nodes if level else 0):
            i = width // 2 - 1 + j
            if t.feature[i] >= 0:
                light[a, j] = int(t.cover[2 * i + 2] < t.cover[2 * i + 1])
                pair[2 * i + 1 + light[a, j]] = j
        place.append(pair[now.tables.leaves[a]])
    shipped = table.sparkSession.sparkContext.broadcast((Block(done, n_features), now.tables, place))

    def rows(batches):
        before, at_level, of_leaf = shipped.value
        sums = np.zeros((2, *shape))
        for b in batches:
            for h, y, bins, margin in _arrays(b, n_features, points):
                keep = np.nonzero(_sampled(h, tree, seed, share))[0]
                if not len(keep):
                    continue
                y, ranks = y[keep], _ranks(bins[keep])
                margin = _advance(np.ascontiguousarray(margin[keep].T), ranks, before)
                for a, leaf in at_level.each(ranks):
                    pair = of_leaf[a].take(leaf)
                    own = np.nonzero(pair >= 0)[0]
                    base = pair.take(own) * BINS
                    g, s = _slopes(margin[active[a]].take(own), y.take(own), weight)
                    for f in cols:
                        at = ranks[f].take(own)
                        at += base
                        for i, x in enumerate((g, s)):
                            sums[i, a, :, f] += np.bincount(at, x, nodes * BINS).reshape(nodes, BINS)
        g, s = sums.reshape(2, -1)
        at = np.nonzero(s)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(g[at].astype(np.int64)), pa.array(s[at].astype(np.int64))], ["slot", "g", "h"])

    sums = table.mapInArrow(rows, "slot long, g long, h long").groupBy("slot").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toArrow()
    shipped.destroy()
    out = np.zeros((2, math.prod(shape)))
    out[0, sums["slot"].to_numpy()] = sums["g"].to_numpy() / FIXED
    out[1, sums["slot"].to_numpy()] = sums["h"].to_numpy() / FIXED
    out = out.reshape(2, *shape)
    if level == 0:
        return out
    both = np.zeros((2, len(active), width, n_features, BINS))
    for a, k in enumerate(active):
        for j in np.nonzero(open_[k].feature[width // 2 - 1:width - 1] >= 0)[0]:
            both[:, a, 2 * j + light[a, j]] = out[:, a, j]
            both[:, a, 2 * j + 1 - light[a, j]] = above[k][:, j] - out[:, a, j]
    return both


def _leaf(g, h, p: Point):
    w = -g / (h + p.reg_lambda)
    return np.clip(w, -p.max_delta_step, p.max_delta_step) if p.max_delta_step > 0 else w


def _gain(g, h, p: Point):
    """Loss that a leaf with these sums takes away."""
    w = _leaf(g, h, p)
    return -(2 * g * w + (h + p.reg_lambda) * w * w)


def _split(tree: Tree, level: int, hist: np.ndarray, cuts: list[np.ndarray], cols: np.ndarray, p: Point) -> None:
    """Give the level's nodes their best split; a node without one stays a leaf."""
    open_ = np.zeros(hist.shape[2:], bool)  # (features, bins) where a split may be
    for f in cols:
        open_[f, :len(cuts[f])] = True
    for j in range(2 ** level):
        i = 2 ** level - 1 + j
        if i and tree.feature[(i - 1) // 2] < 0:
            continue
        g, h = hist[0, j], hist[1, j]
        total_g, total_h = g[cols[0]].sum(), h[cols[0]].sum()
        if level == 0:
            tree.value[0], tree.cover[0] = p.learning_rate * _leaf(total_g, total_h, p), total_h
        left_g, left_h = g.cumsum(axis=1), h.cumsum(axis=1)
        right_g, right_h = total_g - left_g, total_h - left_h
        gain = _gain(left_g, left_h, p) + _gain(right_g, right_h, p) - _gain(total_g, total_h, p)
        gain = np.where(open_ & (left_h >= p.min_child_weight) & (right_h >= p.min_child_weight), gain, -np.inf)
        f, b = np.unravel_index(np.argmax(gain), gain.shape)
        if not gain[f, b] > 1e-9:
            continue
        tree.feature[i], tree.cut[i], tree.threshold[i] = f, b, cuts[f][b]
        for child, cg, ch in ((2 * i + 1, left_g[f, b], left_h[f, b]), (2 * i + 2, right_g[f, b], right_h[f, b])):
            tree.value[child], tree.cover[child] = p.learning_rate * _leaf(cg, ch, p), ch


def _cell(margin: np.ndarray, lo: float, hi: float) -> np.ndarray:
    return np.clip(((margin - lo) / max(hi - lo, 1e-300) * CELLS).astype(np.int64), 0, CELLS - 1)


def _ranges(table: DataFrame, new: list[list[Tree]], n_features: int) -> np.ndarray:
    """Least and largest margin per (point, prefix): the sums of the trees' least and largest leaves would be
    ever farther from them, and the cells between ever fewer."""
    points, most = len(new), max(map(len, new))
    shipped = table.sparkSession.sparkContext.broadcast(Block(new, n_features))

    def rows(batches):
        lo, hi = np.full((points, most), np.inf), np.full((points, most), -np.inf)
        for b in batches:
            for _, _, bins, margin in _arrays(b, n_features, points):
                margin = np.array(margin.T, order="C")
                for j, k in shipped.value.advance(margin, _ranks(bins)):
                    lo[k, j], hi[k, j] = min(lo[k, j], margin[k].min()), max(hi[k, j], margin[k].max())
        at = np.nonzero(lo.ravel() <= hi.ravel())[0]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(lo.ravel()[at]), pa.array(hi.ravel()[at])], ["slot", "lo", "hi"])

    found = table.mapInArrow(rows, "slot long, lo double, hi double").groupBy("slot").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).toArrow()
    shipped.destroy()
    out = np.zeros((points * most, 2))
    out[found["slot"].to_numpy()] = np.column_stack([found["lo"].to_numpy(), found["hi"].to_numpy()])
    return out.reshape(points, most, 2)


def _staged_cells(table: DataFrame, new: list[list[Tree]], bounds: np.ndarray, n_features: int) -> np.ndarray:
    """Rows and positives per (point, prefix, score cell): one pass for every prefix of the block."""
    points, most = len(new), max(map(len, new))
    shipped = table.sparkSession.sparkContext.broadcast((Block(new, n_features), bounds))

    def rows(batches):
        block, lim = shipped.value
        count = np.zeros((2, points, most, CELLS), np.int64)
        for b in batches:
            for _, y, bins, margin in _arrays(b, n_features, points):
                margin, pos = np.array(margin.T, order="C"), np.nonzero(y == 1)[0]
                for j, k in block.advance(margin, _ranks(bins)):
                    cell = _cell(margin[k], *lim[k, j])
                    count[0, k, j] += np.bincount(cell, minlength=CELLS)
                    count[1, k, j] += np.bincount(cell.take(pos), minlength=CELLS)
        count = count.reshape(2, -1)
        at = np.nonzero(count[0])[0]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(count[0, at]), pa.array(count[1, at])], ["slot", "n", "pos"])

    sums = table.mapInArrow(rows, "slot long, n long, pos long").groupBy("slot").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos")).toArrow()
    shipped.destroy()
    out = np.zeros((2, points * most * CELLS))
    for i, c in enumerate(("n", "pos")):
        out[i, sums["slot"].to_numpy()] = sums[c].to_numpy()
    return out.reshape(2, points, most, CELLS)


def cell_average_precision(n: np.ndarray, pos: np.ndarray) -> float:
    """Step-wise average precision down the cells, the rows of a cell tied."""
    n, pos = n[::-1], pos[::-1]
    k, tp = n.cumsum(), pos.cumsum()
    return float((tp / np.maximum(k, 1) * pos).sum() / tp[-1]) if tp[-1] else 0.0


def _ended(aps: Sequence[float], patience: int) -> int | None:
    """The number of trees that are ``patience`` past the best one so far, if a point has come to it."""
    best = 0
    for i, ap in enumerate(aps):
        if ap > aps[best]:
            best = i
        elif i - best >= patience:
            return i + 1
    return None


def _columns(rng: np.random.Generator, n_features: int, share: float) -> np.ndarray:
    return np.sort(rng.permutation(n_features)[:max(1, int(share * n_features))])


def _sums(bins: np.ndarray, cols: np.ndarray, g: np.ndarray, s: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
    """Gradient and hessian sums (2, features, bins) of a node's rows."""
    out = np.zeros((2, len(bins), BINS))
    if rows is not None:
        g, s = g.take(rows), s.take(rows)
    for f in cols:
        at = (bins[f] if rows is None else bins[f].take(rows)).astype(np.intp)
        for i, x in enumerate((g, s)):
            out[i, f] = np.bincount(at, x, BINS)
    return out / FIXED


def _grown(p: Point, cuts: list[np.ndarray], cols: np.ndarray, bins: np.ndarray, g: np.ndarray, s: np.ndarray) -> Tree:
    """The next tree of one point; bins are (features x sampled rows)."""
    tree, nodes = Tree.empty(p.max_depth), {0: np.arange(len(g))}
    above = np.zeros(0)
    for level in range(p.max_depth):
        first = 2 ** level - 1
        hist = np.zeros((2, first + 1, len(bins), BINS))
        if level == 0:
            hist[:, 0] = _sums(bins, cols, g, s)
        parents = np.nonzero(tree.feature[first // 2:first] >= 0)[0].tolist()
        if level and not parents:
            break
        for j in parents:
            i = first // 2 + j
            own = nodes.pop(i)
            right = bins[tree.feature[i]].take(own) > int(tree.cut[i])
            pair = own[~right], own[right]
            nodes[2 * i + 1], nodes[2 * i + 2] = pair
            light = int(len(pair[1]) < len(pair[0]))
            hist[:, 2 * j + light] = _sums(bins, cols, g, s, pair[light])
            hist[:, 2 * j + 1 - light] = above[:, j] - hist[:, 2 * j + light]
        _split(tree, level, hist, cuts, cols, p)
        above = hist
    return tree


def _added(margin: np.ndarray, bins: np.ndarray, tree: Tree) -> None:
    """Add a tree to the margins of rows held as bins (features x rows)."""
    block = Block([[tree]], len(bins))
    for lo in range(0, len(margin), CHUNK):
        _advance(margin[None, lo:lo + CHUNK], list(bins[:, lo:lo + CHUNK].astype(np.intp)), block)


Held = tuple[np.ndarray, np.ndarray, np.ndarray]  # hashes, labels, bins (features x rows)


def _fit_point(p: Point, train: Held, val: Held | None, cuts: list[np.ndarray], weight: float, n_trees: int, patience: int, block: int,
               subsample: float, colsample: float, seed: int) -> tuple[list[Tree], list[float]]:
    """The trees of one point and the average precision of every prefix."""
    (h, y, bins), rng = train, np.random.default_rng(seed)
    margin = np.zeros(len(h))
    _, v_y, v_bins = val if val is not None else train
    v_margin, v_pos = np.zeros(len(v_y)), np.nonzero(v_y == 1)[0]
    trees: list[Tree] = []
    aps: list[float] = []
    for n in range(n_trees):
        cols = _columns(rng, len(bins), colsample)
        keep = np.nonzero(_sampled(h, n, seed, subsample))[0]
        trees.append(_grown(p, cuts, cols, bins.take(keep, axis=1), *_slopes(margin.take(keep), y.take(keep), weight)))
        _added(margin, bins, trees[-1])
        if val is None:
            continue
        _added(v_margin, v_bins, trees[-1])
        cell = _cell(v_margin, v_margin.min(initial=np.inf), v_margin.max(initial=-np.inf)) if len(v_margin) else np.zeros(0, np.int64)
        aps.append(cell_average_precision(np.bincount(cell, minlength=CELLS), np.bincount(cell.take(v_pos), minlength=CELLS)))
        if (n + 1) % block == 0 and _ended(aps, patience):
            break
    return trees, aps


def _fit_apart(train: DataFrame, val: DataFrame | None, features: Sequence[str], points: list[Point], cuts: list[np.ndarray], label: str,
               key: str, *how) -> list[tuple[list[Tree], list[float]]]:
    """``_fit_point`` of every point, a task for each."""
    def held(df: DataFrame) -> Held:
        packs = _binned(df, features, cuts, label, key, 0).toArrow()  # at most APART bytes
        h, y, bins = (np.frombuffer(b"".join(packs[c].to_pylist()), t) for c, t in (("h", np.int64), ("y", np.float64), ("bins", np.uint8)))
        return h, y, np.ascontiguousarray(bins.reshape(len(h), len(features)).T)
    spark = train.sparkSession
    shipped = spark.sparkContext.broadcast((held(train), held(val) if val is not None else None))

    def fit(batches):
        for b in batches:
            for k in b.column(0).to_pylist():
                fitted = _fit_point(points[k], *shipped.value, cuts, *how)
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([pickle.dumps(fitted)])], ["point", "fitted"])
    found = spark.range(0, len(points), 1, len(points)).mapInArrow(fit, "point long, fitted binary").toArrow()
    shipped.destroy()
    by_point = dict(zip(found["point"].to_pylist(), found["fitted"].to_pylist()))
    return [pickle.loads(by_point[k]) for k in range(len(points))]


def _written(df: DataFrame) -> tuple[str, DataFrame]:
    path = write_lineage(df)
    return path, df.sparkSession.read.parquet(path)


def fit_grid(train: DataFrame, val: DataFrame | None, features: Sequence[str], points: Sequence[Point], key: str, label: str = "label",
             n_trees: int = 2000, patience: int = 100, block: int = 10, subsample: float = 0.8, colsample: float = 0.8,
             seed: int = 42, best_prefix: bool = True) -> list[BoostedTrees]:
    """J1 for every point at once: positives weigh ``neg / max(1, pos)``; each ensemble is cut to the prefix
    with the best average precision on ``val`` (the first, where equal) and ends ``patience`` trees after it.
    Whole blocks are grown; what lies past that end is not looked at.  (With ``best_prefix`` false it is returned.)"""
    features, points, n_features = list(features), list(points), len(features)

    def cut_to_best(trees: list[list[Tree]], aps: list[list[float]]) -> list[BoostedTrees]:
        out = [BoostedTrees(features, t, p, a) for t, p, a in zip(trees, points, aps)]
        return [m.prefix(int(np.argmax(m.val_ap[:_ended(m.val_ap, patience)])) + 1) if best_prefix and m.val_ap else m for m in out]
    row = train.agg(F.coalesce(F.sum(F.col(label).cast("long")), F.lit(0)), F.count("*")).first()
    weight = (row[1] - row[0]) / max(1, row[0])
    cuts = cut_points(train, features)
    if (row[1] + (val.count() if val is not None else 0)) * (16 + n_features) <= APART:
        return cut_to_best(*zip(*_fit_apart(train, val, features, points, cuts, label, key, weight, n_trees, patience, block, subsample, colsample, seed)))
    paths, tables = zip(*[_written(_binned(d, features, cuts, label, key, len(points))) for d in (train, *([val] if val is not None else []))])
    paths, tables = list(paths), list(tables)
    trees: list[list[Tree]] = [[] for _ in points]
    aps: list[list[float]] = [[] for _ in points]
    since: list[list[Tree]] = [[] for _ in points]  # not in the stored margins yet
    live = set(range(len(points)))
    rng = np.random.default_rng(seed)
    for n in range(n_trees):
        cols = _columns(rng, n_features, colsample)
        new = [Tree.empty(p.max_depth) for p in points]
        above: dict[int, np.ndarray] = {}
        for level in range(max(points[k].max_depth for k in live)):
            active = [k for k in sorted(live) if level < points[k].max_depth
                      and (level == 0 or (new[k].feature[2 ** (level - 1) - 1:2 ** level - 1] >= 0).any())]
            if not active:
                break
            hist = _histograms(tables[0], since, new, level, active, weight, n, cols, n_features, seed, subsample, above)
            above = {k: hist[:, a] for a, k in enumerate(active)}
            for a, k in enumerate(active):
                _split(new[k], level, hist[:, a], cuts, cols, points[k])
        for k in live:
            trees[k].append(new[k])
            since[k].append(new[k])
        if len(since[min(live)]) < block and n + 1 < n_trees:
            continue
        if val is not None:
            count = _staged_cells(tables[1], since, _ranges(tables[1], since, n_features), n_features)
            for k in sorted(live):
                aps[k] += [cell_average_precision(count[0, k, j], count[1, k, j]) for j in range(len(since[k]))]
                if _ended(aps[k], patience):
                    live.discard(k)
        if not live or n + 1 == n_trees:
            break
        for i, t in enumerate(tables):
            old = paths[i]
            paths[i], tables[i] = _written(_moved(t, [list(s) for s in since], n_features))
            drop_table(t.sparkSession, old)
        since = [[] for _ in points]
    for p in paths:
        drop_table(train.sparkSession, p)
    return cut_to_best(trees, aps)


def _moved(table: DataFrame, trees: list[list[Tree]], n_features: int) -> DataFrame:
    """The table with its margins after ``trees``."""
    shipped, points = table.sparkSession.sparkContext.broadcast(Block(trees, n_features)), len(trees)

    def rows(batches):
        for b in batches:
            for h, y, bins, margin in _arrays(b, n_features, points):
                yield _packs(h, y, bins, _advance(np.array(margin.T, order="C"), _ranks(bins), shipped.value).T)
    return table.mapInArrow(rows, PACKED)


def save(model: BoostedTrees, path: str, spark: SparkSession) -> str:
    """A10: nodes, with the parameters in every row, as Parquet."""
    nodes = model.table(spark).withColumns({k: F.lit(v) for k, v in asdict(model.point).items()})
    nodes.withColumn("features", F.array(*[F.lit(f) for f in model.features])).write.mode("overwrite").parquet(path)
    return path


def load(path: str, spark: SparkSession) -> BoostedTrees:
    nodes = spark.read.parquet(path).toPandas()  # trees x nodes, a model parameter
    first = nodes.iloc[0]
    point = Point(int(first["max_depth"]), *[float(first[c]) for c in ("min_child_weight", "reg_lambda", "learning_rate", "max_delta_step")])
    trees = []
    for _, own in nodes.sort_values(["tree", "id"]).groupby("tree"):
        t, at = Tree.empty(point.max_depth), own["id"].to_numpy()
        t.feature[at], t.threshold[at], t.value[at], t.cover[at] = (own[c].to_numpy() for c in ("feature", "threshold", "value", "cover"))
        trees.append(t)
    return BoostedTrees(list(first["features"]), trees, point)
