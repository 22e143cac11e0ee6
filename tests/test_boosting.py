"""The grid trainer against a plain single-process version of itself, and its prefixes."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from riskgrid.functions.ensemble import Nodes, TreeEnsemble, ValueTables
from riskgrid.functions.scorer import TreeScorer
from riskgrid.operators import boosting, explain, model
from riskgrid.operators.boosting import BoostedTrees, Point, cell_average_precision, fit_grid, grid
from riskgrid.session import ensure_checkpoint_dir

FEATS = ["a", "b", "c"]


def frame(spark, n=3000, seed=1):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 6, n).astype(float), rng.random(n)])
    x[rng.random(n) < 0.05, 2] = np.nan
    z = 1.5 * x[:, 0] + (x[:, 1] == 3) - 1.8 + np.where(np.isnan(x[:, 2]), 1, 0)
    y = (rng.random(n) < 1 / (1 + np.exp(-z))).astype(int)
    rows = [(f"k{i}", *(None if np.isnan(v) else float(v) for v in r), int(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "key string, a double, b double, c double, label int"), x, y


def plain_tree(x, y, w, margin, p, depth, cuts):
    """Exact greedy growth of one tree on all rows and columns; returns row leaf values."""
    prob = 1 / (1 + np.exp(-margin))
    g, h = np.rint(w * (prob - y) * boosting.FIXED) / boosting.FIXED, np.rint(w * prob * (1 - prob) * boosting.FIXED) / boosting.FIXED
    out = np.zeros(len(y))

    def leaf(rows):
        v = -g[rows].sum() / (h[rows].sum() + p.reg_lambda)
        return np.clip(v, -p.max_delta_step, p.max_delta_step)

    def loss(rows):
        v = leaf(rows)
        return -(2 * g[rows].sum() * v + (h[rows].sum() + p.reg_lambda) * v * v)

    def grow(rows, level):
        best = (1e-9, None)
        if level < depth:
            for f in range(x.shape[1]):
                for c in cuts[f]:
                    left = ~(x[rows, f] > c)
                    a, b = rows[left], rows[~left]
                    if h[a].sum() < p.min_child_weight or h[b].sum() < p.min_child_weight:
                        continue
                    gain = loss(a) + loss(b) - loss(rows)
                    if gain > best[0] + 1e-9:
                        best = (gain, (a, b))
        if best[1] is None:
            out[rows] = p.learning_rate * leaf(rows)
        else:
            grow(best[1][0], level + 1)
            grow(best[1][1], level + 1)
    grow(np.arange(len(y)), 0)
    return out


def test_trees_equal_a_plain_version(spark):
    df, x, y = frame(spark, 600)
    points = [Point(2, 4.0, 5.0, 0.3), Point(3, 8.0, 1.0, 0.1, 0.2)]
    fitted = fit_grid(df.repartition(5), None, FEATS, points, "key", n_trees=4, block=2, subsample=1.0, colsample=1.0)
    cuts = boosting.cut_points(df, FEATS)
    w = np.where(y == 1, (len(y) - y.sum()) / y.sum(), 1.0)
    for p, m in zip(points, fitted):
        margin = np.zeros(len(y))
        for k, staged in enumerate(m.staged(x)):
            margin += plain_tree(x, y, w, margin, p, p.max_depth, cuts)
            assert np.allclose(staged, margin, atol=1e-9), k


def test_same_trees_in_any_partitioning_and_block(spark):
    df, x, _ = frame(spark, 1500)
    runs = [fit_grid(df.repartition(n), df, FEATS, grid()[:3], "key", n_trees=6, block=b) for n, b in ((1, 2), (7, 5))]
    for a, b in zip(*runs):
        assert len(a.trees) == len(b.trees) and np.array_equal(a.margin(x), b.margin(x)) and a.val_ap == b.val_ap


def test_best_prefix_and_patience(spark):
    from riskgrid.operators.curves import auc_ap
    df, x, y = frame(spark)
    val, vx, vy = frame(spark, 2000, 2)
    whole, = fit_grid(df, val, FEATS, [Point(4, 1.0, 1.0, 0.5)], "key", n_trees=10, patience=100, block=4, best_prefix=False)
    assert len(whole.trees) == len(whole.val_ap) == 10
    exact = []
    for m in whole.staged(vx):
        rows = [(float(p), int(t)) for p, t in zip(1 / (1 + np.exp(-m)), vy)]
        exact.append(auc_ap(spark.createDataFrame(rows, "prob double, label int")).first()["average_precision"])
    assert np.allclose(exact, whole.val_ap, atol=2e-3)
    best = fit_grid(df, val, FEATS, [Point(4, 1.0, 1.0, 0.5)], "key", n_trees=10, patience=100, block=4)[0]
    assert len(best.trees) == int(np.argmax(whole.val_ap)) + 1
    short = fit_grid(df, val, FEATS, [Point(4, 1.0, 1.0, 0.5)], "key", n_trees=10, patience=2, block=2, best_prefix=False)[0]
    assert len(short.trees) == min(10, next((2 * -(-(k + 1) // 2) for k in range(10) if k - int(np.argmax(whole.val_ap[:k + 1])) >= 2), 10))
    assert max(exact) > 0.55 > vy.mean()


def test_cells_tie_rows():
    assert cell_average_precision(np.array([2.0, 0, 2]), np.array([1.0, 0, 1])) == pytest.approx(0.5)
    assert cell_average_precision(np.zeros(3), np.zeros(3)) == 0.0


def test_save_score_and_contributions(spark):
    df, x, _ = frame(spark, 500)
    m = fit_grid(df, None, FEATS, [Point(3, 1.0, 1.0, 0.3)], "key", n_trees=5)[0]
    again = boosting.load(model.save_model(m, f"{ensure_checkpoint_dir(spark)}/boost-test"), spark)
    assert np.array_equal(m.margin(x), again.margin(x)) and again.point == m.point
    scored = {r.key: r.prob for r in again.score(df).collect()}
    assert np.allclose([scored[f"k{i}"] for i in range(500)], 1 / (1 + np.exp(-m.margin(x))))
    con = model.tree_contributions(df, m, FEATS, "key").toPandas().groupby("key")["shap"].sum()
    assert np.allclose([con[f"k{i}"] for i in range(500)], m.margin(x), atol=1e-9)
    assert isinstance(m, BoostedTrees) and model.explain_importance(df, m, FEATS, "key")[0] == "tree_contributions"


def test_partial_dependence_by_cells_equals_brute_force(spark):
    """J9, J10 at 40 and 25^2 points, for both kinds of ensemble; and scores of variants and grids."""
    df, x, _ = frame(spark, 800)
    own = fit_grid(df, None, FEATS, [Point(3, 1.0, 1.0, 0.3)], "key", n_trees=6)[0]
    full = df.na.fill(0.5)
    gbt = model.fit_gbt(full, FEATS, max_depth=3, max_iter=4, step_size=0.3)
    for m, d, z in ((own, df, x), (gbt, full, np.where(np.isnan(x), 0.5, x))):
        e, s = TreeEnsemble.of(m, FEATS), TreeScorer(m, FEATS)
        direct = {r.key: r.prob for r in model.score(m, d, FEATS).collect()}
        assert np.allclose([direct[f"k{i}"] for i in range(800)], e.score(z))
        for r in explain.pd_1d(d, FEATS, s, n=40).collect():
            forced = z.copy()
            forced[:, FEATS.index(r.feature)] = r.g
            assert r.pd == pytest.approx(e.score(forced).mean(), abs=1e-9)
        rows = explain.pd_2d(d, explain.pairs(FEATS), s, n=25).collect()
        assert len(rows) == 3 * 625
        for r in rows[::37]:
            forced = z.copy()
            forced[:, FEATS.index(r.f1)], forced[:, FEATS.index(r.f2)] = r.g1, r.g2
            assert r.pd == pytest.approx(e.score(forced).mean(), abs=1e-9)
        both = s.with_grid(s.with_variants(d, [{"a": F.lit(1.0)}, {"b": F.col("a")}], "v"), {"c": [0.1, 0.7]}, "g").collect()
        at = {r.key: i for i, r in enumerate(d.select("key").collect())}
        for r in both[:50]:
            row = z[[int(r.key[1:])]].repeat(4, axis=0)
            row[0, 0], row[1, 1], row[2, 2], row[3, 2] = 1.0, row[0, 0] if row[1, 0] != 1.0 else row[1, 0], 0.1, 0.7
            row[1, 1] = row[1, 0]
            assert np.allclose([*r.v, *r.g], e.score(row)) and r.key in at


@pytest.mark.parametrize("depth", [0, 1, 4, 5, 6, 7])
def test_leaf_tables_equal_walks(depth):
    """looked-up leaves, for words of one to four trees and for trees too deep for a word; nulls on either side."""
    rng = np.random.default_rng(depth)
    x = np.round(rng.normal(size=(3000, 4)), 1)
    x[rng.random(x.shape) < 0.1] = np.nan

    def tree():
        n = 2 ** (depth + 1) - 1
        feature = np.where(rng.random(n) < 0.85, rng.integers(0, 4, n), -1)
        feature[2 ** depth - 1:] = -1
        i = np.arange(n)
        return Nodes(2 * i + 1, 2 * i + 2, feature, np.round(rng.normal(size=n), 1), rng.normal(size=n))

    def walked(t, row, nulls_left):
        at = 0
        while t.feature[at] >= 0:
            v = row[t.feature[at]]
            right = v > t.threshold[at] if nulls_left else not v <= t.threshold[at]
            at = t.right[at] if right else t.left[at]
        return t.value[at]
    own = [[tree() for _ in range(n)] for n in (5, 0, 2)]
    for nulls_left in (True, False):
        got = ValueTables(own, 4, nulls_left).margins(x)
        assert np.allclose(got, [[sum(walked(t, r, nulls_left) for t in trees) for r in x] for trees in own], atol=1e-12)


def test_packed_rows_come_back(spark):
    """margins lie in packs of rows, not in a record per row."""
    df, _, _ = frame(spark, 1500)
    cuts = boosting.cut_points(df, FEATS)
    table = boosting._binned(df.coalesce(1), FEATS, cuts, "label", "key", 4)
    records = table.toArrow().to_batches()
    back = [a for b in records for a in boosting._arrays(b, 3, 4)]
    assert sum(len(a[0]) for a in back) == 1500 and sum(a[1].sum() for a in back) == df.agg(F.sum("label")).first()[0]
    assert sum(b.num_rows for b in records) < 100


def test_a_task_per_point_grows_the_trees_of_a_job_per_level(spark, monkeypatch):
    """Both ways of growth, in several partitionings and blocks, with a point that stops early."""
    df, x, _ = frame(spark, 1500)
    val, _, _ = frame(spark, 700, 2)
    points = [Point(3, 2.0, 10.0, 0.1), Point(2, 2.0, 20.0, 0.3), Point(3, 0.1, 0.1, 2.0, 0.0)]

    def fitted(apart, parts, block, **how):
        monkeypatch.setattr(boosting, "APART", apart)
        return fit_grid(df.repartition(parts), val.repartition(parts), FEATS, points, "key", n_trees=8, patience=2, block=block, **how)
    one, other = fitted(32 << 20, 3, 2, best_prefix=False), fitted(0, 5, 2, best_prefix=False)
    assert len({len(m.trees) for m in one}) > 1
    for a, b in zip(one, other):
        assert len(a.trees) == len(b.trees) and a.val_ap == b.val_ap
        assert all(np.array_equal(getattr(s, c), getattr(t, c)) for s, t in zip(a.trees, b.trees) for c in ("feature", "threshold", "value", "cover", "cut"))
    for a, b in zip(fitted(32 << 20, 2, 3), fitted(0, 2, 5)):
        assert len(a.trees) == len(b.trees) and a.val_ap == b.val_ap and np.array_equal(a.margin(x), b.margin(x))


def test_patience_ends_a_point_inside_a_block():
    """A later, better tree of the same block does not reopen a point that has ended."""
    aps = [0.1, 0.3, 0.2, 0.2, 0.25, 0.9]
    assert boosting._ended(aps, 2) == 4 and boosting._ended(aps[:3], 2) is None
    assert boosting._ended(aps, 4) is None and boosting._ended([], 2) is None


def test_cells_stay_fine_after_many_trees(spark):
    """Cells span the margins themselves, not the sum of all trees' outermost leaves."""
    df, _, _ = frame(spark, 1000)
    val, vx, vy = frame(spark, 1500, 2)
    m, = fit_grid(df, val, FEATS, [Point(2, 8.0, 20.0, 1.0)], "key", n_trees=120, patience=1000, block=60, best_prefix=False)
    off = []
    for margin, ap in zip(m.staged(vx), m.val_ap):
        order = np.argsort(-margin)
        score, hit = margin[order], vy[order].cumsum()
        end = np.append(score[1:] != score[:-1], True)
        off.append(abs(ap - (np.diff(hit[end], prepend=0) * hit[end] / (np.nonzero(end)[0] + 1)).sum() / vy.sum()))
    assert np.mean(off[60:]) < 5e-4, np.mean(off[60:])


def test_a_row_without_a_label_counts_as_a_negative(spark, monkeypatch):
    df, x, _ = frame(spark, 400)
    gone = df.withColumn("label", F.when(F.abs(F.hash("key")) % 4 > 0, F.col("label")))
    for apart in (32 << 20, 0):
        monkeypatch.setattr(boosting, "APART", apart)
        a, b = (fit_grid(d, None, FEATS, [Point(3, 1.0, 1.0, 0.3)], "key", n_trees=3)[0] for d in (gone, gone.na.fill(0, ["label"])))
        assert np.array_equal(a.margin(x), b.margin(x)) and len(np.unique(a.margin(x))) > 3


def test_no_trees_without_rows_to_split(spark, monkeypatch):
    df, x, _ = frame(spark, 40)
    for apart in (32 << 20, 0):
        monkeypatch.setattr(boosting, "APART", apart)
        m, = fit_grid(df, df.limit(0), FEATS, [Point(3, 1e6, 1.0, 0.3)], "key", n_trees=3)
        assert len(m.trees) == 1 and len(np.unique(m.margin(x))) == 1 and m.val_ap == [0.0]
