"""Exact neighbours against brute force, and the work per point."""

import numpy as np
import pytest
from riskgrid.operators import neighbours, sampling
from riskgrid.operators.neighbours import SpaceTree, knn
from riskgrid.plans import base as B


def brute(x, keys, k):
    out = {}
    for i, key in enumerate(keys):
        d = np.sqrt(neighbours.squares(x - x[i]))
        order = sorted((float(d[j]), keys[j]) for j in range(len(keys)) if j != i)[:k]
        out[key] = [(r + 1, n, dist) for r, (dist, n) in enumerate(order)]
    return out


@pytest.mark.parametrize("leaf", [4, 64, 10_000])
def test_knn_against_brute_force(spark, monkeypatch, leaf):
    monkeypatch.setattr(neighbours, "LEAF", leaf)
    monkeypatch.setattr(neighbours, "VISITORS", 50)
    rng = np.random.default_rng(leaf)
    x = np.concatenate([rng.normal(size=(200, 3)), np.zeros((40, 3)), rng.integers(0, 3, (200, 3)).astype(float), -np.zeros((3, 3))])
    keys = [f"p{i:04d}" for i in rng.permutation(len(x))]
    df = spark.createDataFrame([(k, *map(float, r)) for k, r in zip(keys, x)], "key string, a double, b double, c double")
    got = {}
    for r in knn(df, ["a", "b", "c"], "key", 4).collect():
        got.setdefault(r.key, []).append((r.nn_rank, r.nn_key, r.dist))
    want = brute(x, keys, 4)
    assert {k: sorted(v) for k, v in got.items()} == want
    some = df.filter("key < 'p0050'")
    part = knn(df, ["a", "b", "c"], "key", 4, queries=some)
    assert sorted((r.key, r.nn_rank, r.nn_key) for r in part.collect()) == sorted((k, *v[:2]) for k, vs in want.items() if k < "p0050" for v in vs)


def test_fewer_points_than_neighbours(spark):
    df = spark.createDataFrame([("a", 0.0), ("b", 1.0), ("c", 3.0)], "key string, x double")
    assert [(r.key, r.nn_key) for r in knn(df, ["x"], "key", 5).orderBy("key", "nn_rank").collect()] == [
        ("a", "b"), ("a", "c"), ("b", "a"), ("b", "c"), ("c", "b"), ("c", "a")]


def test_leaves_are_even():
    x = np.random.default_rng(0).normal(size=(10_000, 4))
    tree = SpaceTree.grow(x, 37)
    sizes = np.bincount(tree.of(x))
    assert len(sizes) == 37 and sizes.max() < 3 * sizes.min()


def test_work_per_point_stays_flat(spark):
    """Distances per query on 4 times the points: at most doubled."""
    per = []
    for sf in ("sf0.001", "sf0.01"):
        stats = {}
        knn(B.train_positives(spark, f"/root/testdata/{sf}"), B.KNN_FEATURES, B.KEY, 5, stats=stats).count()
        per.append(stats["pairs"] / stats["queries"])
    rng = np.random.default_rng(4)
    for n in (4_000, 16_000):
        df = spark.createDataFrame([(f"p{i}", *map(float, r)) for i, r in enumerate(rng.random((n, 3)))], "key string, a double, b double, c double")
        stats = {}
        knn(df, ["a", "b", "c"], "key", 5, stats=stats).count()
        per.append(stats["pairs"] / stats["queries"])
    assert per[3] <= 2 * per[2] and per[3] < 16_000 / 3


def test_smote_asks_for_drawn_rows_only(spark, monkeypatch):
    asked = []
    whole = sampling.knn

    def spy(points, feats, key, k=5, queries=None, stats=None):
        asked.append((points.count(), queries.count()))
        return whole(points, feats, key, k, queries, stats)
    monkeypatch.setattr(sampling, "knn", spy)
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(f"p{i:03d}", *map(float, r)) for i, r in enumerate(rng.random((300, 2)))], "key string, a double, b double")
    rows = sampling.smote(df, ["a", "b"], 320, 1, "key").collect()
    assert len(rows) == 20 and asked[0][0] == 300 and asked[0][1] <= 20
