"""Exact nearest neighbours by a distributed spatial tree.

Rows with equal coordinates are one location with its ``k + 1`` smallest keys, all
that any answer can name; a hot location is one row.  A k-d tree cuts the space into
leaves of about ``LEAF`` locations: the widest side of a box is cut at its median,
found from a bounded sample.  The tree and the boxes of its leaves are small and are
shipped; a location's leaf is a function of its coordinates.

A query first searches its own leaf.  The distance of its last candidate bounds the
answer, so it then descends the tree and visits only leaves whose box is that near
(branch and bound).  A box is never farther, in floating point too, than any point in
it, so nothing is missed.  A leaf with many visitors is dealt to several tasks.  The
work per query follows the leaf size and the number of near leaves, not the number of
points, as long as there are fewer than ``LEAF * MOST_LEAVES`` locations; beyond that
leaves grow.

Coordinates must not be null.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskgrid.session import checked_broadcast, cut_lineage

LEAF = 256
MOST_LEAVES = 65_536
SAMPLE_PER_LEAF = 16
VISITORS = 20_000  # queries of one leaf in one task
CELLS = 2_000_000  # distances held at once


def decode(blobs, d: int) -> np.ndarray:
    return np.frombuffer(b"".join(bytes(b) for b in blobs), np.float64).reshape(-1, d)


@dataclass
class SpaceTree:
    """Nodes in creation order; axis -1 is a leaf with a number."""
    axis: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    leaf: np.ndarray
    lo: np.ndarray | None = None
    hi: np.ndarray | None = None

    @classmethod
    def grow(cls, sample: np.ndarray, leaves: int) -> SpaceTree:
        axis, cut, left, right, leaf = [], [], [], [], []
        todo = [(np.arange(len(sample)), leaves, None)]
        count = 0
        while todo:
            rows, quota, parent = todo.pop()
            me = len(axis)
            if parent is not None:
                (left if parent[1] else right)[parent[0]] = me
            box = sample[rows]
            spread = box.max(axis=0) - box.min(axis=0) if len(rows) else np.zeros(sample.shape[1])
            split = quota > 1 and len(rows) > 1 and spread.max() > 0
            at, a = 0.0, int(np.argmax(spread))
            if split:
                at = float(np.median(box[:, a]))
                if at >= box[:, a].max():  # all of the upper half is one value: cut below it
                    at = float(box[:, a][box[:, a] < at].max())
            axis.append(a if split else -1)
            cut.append(at)
            left.append(-1)
            right.append(-1)
            leaf.append(-1 if split else count)
            if split:
                below = box[:, a] <= at
                todo += [(rows[~below], quota // 2, (me, False)), (rows[below], quota - quota // 2, (me, True))]
            else:
                count += 1
        return cls(*map(np.array, (axis, cut, left, right, leaf)))

    def of(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        at = np.zeros(len(x), dtype=int)
        while (open_ := np.nonzero(self.axis[at] >= 0)[0]).size:
            n = at[open_]
            at[open_] = np.where(x[open_, self.axis[n]] <= self.cut[n], self.left[n], self.right[n])
        return self.leaf[at]

    def boxed(self, lo: dict[int, np.ndarray], hi: dict[int, np.ndarray], d: int) -> None:
        """Set each node's box from its leaves' boxes; a leaf without points has none."""
        self.lo, self.hi = np.full((len(self.axis), d), np.inf), np.full((len(self.axis), d), -np.inf)
        for n in range(len(self.axis) - 1, -1, -1):  # children come after their parent
            if self.axis[n] < 0:
                if int(self.leaf[n]) in lo:
                    self.lo[n], self.hi[n] = lo[int(self.leaf[n])], hi[int(self.leaf[n])]
            else:
                kids = [self.left[n], self.right[n]]
                self.lo[n], self.hi[n] = self.lo[kids].min(axis=0), self.hi[kids].max(axis=0)

    def near(self, x: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of every leaf whose box is within the row's reach."""
        rows, nodes = np.arange(len(x)), np.zeros(len(x), dtype=int)
        found_rows, found_leaves = [], []
        while len(rows):
            gap = np.maximum(0.0, np.maximum(self.lo[nodes] - x[rows], x[rows] - self.hi[nodes]))
            keep = np.sqrt(squares(gap)) <= reach[rows]
            rows, nodes = rows[keep], nodes[keep]
            end = self.axis[nodes] < 0
            found_rows.append(rows[end])
            found_leaves.append(self.leaf[nodes[end]])
            rows, nodes = rows[~end], nodes[~end]
            rows, nodes = np.concatenate([rows, rows]), np.concatenate([self.left[nodes], self.right[nodes]])
        return np.concatenate(found_rows or [rows]), np.concatenate(found_leaves or [nodes])


def squares(gap: np.ndarray) -> np.ndarray:
    """Sum of squares over the last axis, added up axis by axis."""
    out = np.zeros(gap.shape[:-1])
    for a in range(gap.shape[-1]):
        out = out + gap[..., a] * gap[..., a]
    return out


def _searched(k: int, d: int, key_name: str):
    """cogroup function: the ``k + 1`` nearest (distance, key) of each visiting query among one leaf's points."""
    def search(points: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(points) or not len(queries):
            return pd.DataFrame({"q": [], "nn_key": [], "dist": []})
        p, q = decode(points["q"], d), decode(queries["q"], d)
        keys = points["keys"].to_numpy()
        parts = []
        step = max(1, CELLS // len(p))
        for lo in range(0, len(q), step):
            dist = np.sqrt(squares(q[lo:lo + step, None, :] - p[None, :, :]))
            last = np.partition(dist, min(k, len(p) - 1), axis=1)[:, min(k, len(p) - 1)]
            row, at = np.nonzero(dist <= last[:, None])
            size = np.array([len(keys[i]) for i in at])
            parts.append(pd.DataFrame({"row": np.repeat(row + lo, size), "dist": np.repeat(dist[row, at], size),
                                       "nn_key": [x for i in at for x in keys[i]]}))
        best = pd.concat(parts).sort_values(["row", "dist", "nn_key"]).groupby("row").head(k + 1)
        return pd.DataFrame({"q": queries["q"].to_numpy()[best["row"]], "nn_key": best["nn_key"].to_numpy(), "dist": best["dist"].to_numpy()})
    return search


def knn(points: DataFrame, feats: Sequence[str], key: str, k: int = 5, queries: DataFrame | None = None,
        stats: dict | None = None) -> DataFrame:
    """The k nearest other rows (Euclidean, ties by key) of every row of ``queries``, rows of
    ``points`` (all of them by default) -> (key, nn_rank, nn_key, dist).  ``stats`` receives
    the number of leaves, of queries and of distances computed."""
    spark, d = points.sparkSession, len(feats)
    kind = points.schema[key].dataType

    @F.pandas_udf("binary")
    def place(x: pd.DataFrame) -> pd.Series:
        return pd.Series([r.tobytes() for r in x.to_numpy(dtype=np.float64) + 0.0], dtype=object)

    coords = F.struct(*[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(feats)])
    located = cut_lineage(points.select(F.col(key).alias("key"), place(coords).alias("q")))
    first = Window.partitionBy("q").orderBy("key")
    spots = cut_lineage(located.withColumn("rn", F.row_number().over(first)).filter(F.col("rn") <= k + 1)
                        .groupBy("q").agg(F.array_sort(F.collect_list("key")).alias("keys")))
    n = spots.count()
    leaves = min(MOST_LEAVES, -(-n // LEAF)) or 1
    share = min(1.0, leaves * SAMPLE_PER_LEAF / max(n, 1)) if n > 100_000 else 1.0
    sample = spots.filter(F.pmod(F.xxhash64("q"), F.lit(1 << 40)) <= int(share * (1 << 40))).select("q").toPandas()
    tree = SpaceTree.grow(decode(sample["q"], d), leaves)

    @F.pandas_udf("int")
    def leaf_of(q: pd.Series) -> pd.Series:
        return pd.Series(tree.of(decode(q, d)))

    spots = cut_lineage(spots.withColumn("leaf", leaf_of("q")))

    def box(own: pd.DataFrame) -> pd.DataFrame:
        x = decode(own["q"], d)
        return pd.DataFrame({"leaf": [own["leaf"].iat[0]], "n": [len(x)], "lo": [x.min(axis=0).tolist()], "hi": [x.max(axis=0).tolist()]})
    boxes = spots.groupBy("leaf").applyInPandas(box, "leaf int, n long, lo array<double>, hi array<double>").toPandas()  # a row per leaf
    size = dict(zip(boxes["leaf"], boxes["n"]))
    tree.boxed({i: np.array(b) for i, b in zip(boxes["leaf"], boxes["lo"])}, {i: np.array(b) for i, b in zip(boxes["leaf"], boxes["hi"])}, d)

    asked = located if queries is None else queries.select(F.col(key).alias("key"), place(coords).alias("q"))
    own = cut_lineage(asked.select("q").distinct().withColumn("leaf", leaf_of("q")))
    found = T.StructType([T.StructField("q", T.BinaryType()), T.StructField("nn_key", kind), T.StructField("dist", T.DoubleType())])

    def visit(pairs: DataFrame) -> DataFrame:
        per = {r["leaf"]: r["count"] for r in pairs.groupBy("leaf").count().collect()}  # a row per leaf
        if stats is not None:
            stats["pairs"] = stats.get("pairs", 0) + sum(c * size.get(i, 0) for i, c in per.items())
        pieces = spark.createDataFrame([(i, 1 + c // VISITORS) for i, c in per.items()], "leaf int, pieces long")
        pieces = checked_broadcast(pieces, len(per))
        left = spots.join(pieces, "leaf").select("leaf", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"), "q", "keys")
        right = pairs.join(pieces, "leaf").select("leaf", F.pmod(F.xxhash64("q"), "pieces").alias("piece"), "q")
        return left.groupBy("leaf", "piece").cogroup(right.groupBy("leaf", "piece")).applyInPandas(_searched(k, d, key), found)

    near = cut_lineage(visit(own))
    reach = near.groupBy("q").agg(F.when(F.count("*") > k, F.max("dist")).otherwise(float("inf")).alias("reach"))

    def others(batches):
        for b in batches:
            x = decode(b["q"], d)
            row, leaf = tree.near(x, b["reach"].to_numpy(dtype=float))
            far = leaf != b["leaf"].to_numpy()[row]
            yield pd.DataFrame({"q": b["q"].to_numpy()[row[far]], "leaf": leaf[far]})

    more = cut_lineage(own.join(reach, "q").mapInPandas(others, "q binary, leaf int"))
    near = near.unionByName(visit(more)) if not more.isEmpty() else near
    if stats is not None:
        stats |= {"leaves": len(size), "points": n, "queries": own.count()}
    by_spot = Window.partitionBy("q").orderBy("dist", "nn_key")
    near = near.withColumn("rn", F.row_number().over(by_spot)).filter(F.col("rn") <= k + 1).drop("rn")
    by_key = Window.partitionBy("key").orderBy("dist", "nn_key")
    return (asked.join(near, "q").filter(F.col("key") != F.col("nn_key"))
            .withColumn("nn_rank", F.row_number().over(by_key)).filter(F.col("nn_rank") <= k)
            .select(F.col("key").alias(key), "nn_rank", "nn_key", "dist"))
