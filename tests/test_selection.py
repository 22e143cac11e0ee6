"""Top-k per group, order boundaries, permutation and calibration: equal to brute force, and bounded per task."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from riskgrid.functions.permute import bijection, layout, round_keys
from riskgrid.functions.scorer import ColumnScorer
from riskgrid.operators import calibrate, curves, explain, ranking, stats
from riskgrid.operators.calibrate import apply_isotonic, apply_sigmoid, fit_isotonic, fit_sigmoid, pool
from riskgrid.plans.ordering import bucket_bounds


@pytest.mark.parametrize("ties", [False, True])
def test_top_rows_per_group(spark, ties):
    score = "cast(id % 5 as double)" if ties else "cast((id * 7919) % 100003 as double)"
    df = spark.range(30_000).selectExpr("cast(id as string) key", f"{score} prob", "if(id % 3 = 0, null, cast(id % 2 as string)) split")
    got = {}
    for r in ranking.top_rows(df, 100, by=["split"]).collect():
        got.setdefault(r.split, []).append((r.rn, r.key))
    rows = df.collect()
    for s in (None, "0", "1"):
        want = sorted((r for r in rows if r.split == s), key=lambda r: (-r.prob, r.key))[:100]
        assert sorted(got[s]) == [(i + 1, r.key) for i, r in enumerate(want)]
    few = df.filter("id < 50") if "id" in df.columns else df.limit(50)
    assert ranking.top_rows(few, 100, by=["split"]).count() == 50


def test_few_rows_reach_the_last_task(spark):
    """200 tasks hold 2 groups: far fewer than k rows per task are left to rank."""
    df = spark.range(0, 200_000, 1, 200).selectExpr("cast(id as string) key", "cast((id * 7919) % 200003 as double) prob", "id % 2 as split")
    k = 500
    left = ranking.prune_to_top(df, k, "prob", "key", ["split"])
    n = left.groupBy("split").count().collect()
    assert all(k <= r["count"] <= 3 * k for r in n)
    # one score for all: still at most k rows of each task group
    flat = ranking.prune_to_top(df.withColumn("prob", F.lit(1.0)), k, "prob", "key", ["split"])
    assert all(r["count"] <= k * ranking.TASK_GROUPS for r in flat.groupBy("split").count().collect())


@pytest.mark.parametrize("tasks", [2, 60])
def test_boundaries_do_not_follow_the_tasks(spark, tasks):
    df = spark.range(0, 50_000, 1, tasks).selectExpr("id", "if(id % 50 = 0, null, id % 13) as a")
    got = bucket_bounds(df, [F.col("a"), F.col("id")], F.col("id"), 32)
    assert len(got) == 31 and got == sorted(got, key=lambda t: tuple((v is not None, v) for v in t))
    if tasks > 2:
        assert got == bucket_bounds(df.repartition(3), [F.col("a"), F.col("id")], F.col("id"), 32)


def test_bijection():
    for n in (1, 2, 3, 10, 1000, 4097, 100_003):
        a, b = layout(n)
        assert a * b >= n and a * b - n < a
        for rep in range(2):
            got = bijection(np.arange(n), n, round_keys(42, rep))
            assert np.array_equal(np.sort(got), np.arange(n))
    n = 50_000
    got = bijection(np.arange(n), n, round_keys(1, 0))
    assert abs(np.corrcoef(np.arange(n), got)[0, 1]) < 0.02 and abs(np.corrcoef(got[:-1], got[1:])[0, 1]) < 0.02


def test_permutation_importance_against_brute_force(spark):
    rng = np.random.default_rng(3)
    n = 400
    x = rng.random((n, 2))
    y = (x[:, 0] + 0.2 * rng.random(n) > 0.6).astype(int)
    df = spark.createDataFrame([(f"k{i:04d}", *map(float, x[i]), int(y[i])) for i in range(n)], "key string, a double, b double, label int")
    scorer = ColumnScorer(lambda c: F.round(c["a"] * 0.9 + c["b"] * 0.1, 3), ["a", "b"])

    def ap(p):
        out, tp, k = 0.0, 0, 0
        for v in sorted(set(p), reverse=True):
            here = p == v
            tp, k = tp + y[here].sum(), k + here.sum()
            out += tp / k * y[here].sum()
        return out / y.sum()

    def prob(z):
        return np.array([float(v) for v in np.round(z[:, 0] * 0.9 + z[:, 1] * 0.1 + 1e-12, 3)])
    got = {r.feature: (r.importance_mean, r.importance_std) for r in explain.permutation_importance(df, ["a", "b"], scorer, "key", repeats=3).collect()}
    for f, name in enumerate("ab"):
        drops = []
        for rep in range(3):
            z = x.copy()
            z[:, f] = x[bijection(np.arange(n), n, round_keys(42, rep)), f]
            drops.append(ap(prob(x)) - ap(prob(z)))
        assert got[name] == pytest.approx((np.mean(drops), np.std(drops)), abs=1e-3)
    assert got["a"][0] > got["b"][0]


def test_isotonic_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(calibrate, "FAN", 3)
    rng = np.random.default_rng(5)
    rows = [(g, float(p), int(rng.random() < p ** (1 + g))) for g in (0, 1) for p in np.round(rng.random(3000), 3)]
    df = spark.createDataFrame(rows, "g int, p double, label int").repartition(6)
    blocks = fit_isotonic(df, "p", "label", ["g"])
    grid = [-1.0, 0.0, *np.round(rng.random(200), 4).tolist(), 1.0, 2.0]
    ask = spark.createDataFrame([(g, p) for g in (0, 1, 7) for p in [*grid, None]], "g int, p double")
    fits = {}
    for g in (0, 1):
        own = sorted({p for h, p, _ in rows if h == g})
        counts, sums = {}, {}
        for h, p, t in rows:
            if h == g:
                counts[p], sums[p] = counts.get(p, 0) + 1, sums.get(p, 0) + t
        found = pool(*(np.array(v, dtype=float) for v in (own, own, [counts[v] for v in own], [sums[v] for v in own])))
        mean = {p: s / c for a, b, c, s in found for p in own if a <= p <= b}
        # a monotone least squares fit: no block can be split or merged for the better
        assert all(x <= y + 1e-12 for x, y in zip([mean[p] for p in own], [mean[p] for p in own][1:]))
        fits[g] = (np.array(own), np.array([mean[p] for p in own]))
        got = sorted((r.lo, r.hi, r.n, r.value) for r in blocks.filter(F.col("g") == g).collect())
        assert np.allclose(got, [(a, b, c, s / c) for a, b, c, s in found])
    for most in (100_000, 3):  # shipped, joined
        got = apply_isotonic(ask, blocks, "p", "out", ["g"], most).collect()
        assert len(got) == ask.count()
        for r in got:
            if r.p is None or r.g == 7:
                assert r.out is None
            else:
                assert r.out == pytest.approx(np.interp(r.p, *fits[r.g]), abs=1e-9), (most, r)


def test_isotonic_minimises_squares():
    rng = np.random.default_rng(9)
    for _ in range(50):
        y = rng.integers(0, 2, 12).astype(float)
        x = np.arange(12.0)
        fit = np.concatenate([[s / n] * int(n) for _, _, n, s in pool(x, x, np.ones(12), y)])
        # min-max formula of the isotonic fit
        want = [max(min(y[a:b + 1].mean() for b in range(i, 12)) for a in range(i + 1)) for i in range(12)]
        assert np.allclose(fit, want)


def test_sigmoid_against_a_direct_fit(spark):
    rng = np.random.default_rng(6)
    rows = [(g, float(p), int(rng.random() < 1 / (1 + np.exp(-(4 * p - 2 + g))))) for g in (0, 1) for p in rng.random(1000)]
    rows += [(2, 0.3, 1)] * 20 + [(3, 0.1 * i, 0) for i in range(10)]
    df = spark.createDataFrame(rows, "g int, p double, label int")
    fits = fit_sigmoid(df, "p", "label", ["g"])

    def loss(a, b, own):
        pos = sum(t for _, t in own)
        tp, tn = (pos + 1) / (pos + 2), 1 / (len(own) - pos + 2)
        q = 1 / (1 + np.exp(a * np.array([p for p, _ in own]) + b))
        t = np.array([tp if y else tn for _, y in own])
        return -(t * np.log(q) + (1 - t) * np.log(1 - q)).sum()
    for g in (0, 1, 3):
        own = [(p, t) for h, p, t in map(tuple, df.collect()) if h == g]
        a, b = fits[(g,)]
        best = loss(a, b, own)
        assert all(best <= loss(a + da, b + db, own) + 1e-7 for da in (-1e-2, 0, 1e-2) for db in (-1e-2, 0, 1e-2))
    out = apply_sigmoid(df, fits, "p", "out", ["g"])
    assert out.filter("out is null or out <= 0 or out >= 1").count() == 0


def test_tables_without_groups(spark):
    df = spark.range(2000).selectExpr("cast((id * 7919) % 2003 as double) / 2003 as prob", "cast(id % 3 = 0 as int) as label")
    one = df.withColumn("g", F.lit("x"))
    for f in (curves.reliability, curves.calibration_table, curves.calibration_tail, curves.tail_summary):
        assert sorted(map(tuple, f(df).collect())) == sorted(map(tuple, f(one, by=["g"]).drop("g").collect()))
    assert stats.n_rows(df) == 2000 and not stats.is_empty(df) and stats.is_empty(df.limit(0))


def test_bootstrap_of_a_model_equals_weighted_curves(spark):
    """threshold_ci's replicate curves against explicit weights."""
    from riskgrid.operators.sampling import bootstrap_weights
    df = spark.range(300).selectExpr("cast(id as string) key", "cast(id % 17 as double) a", "cast(id % 5 as double) b")
    scorer = ColumnScorer(lambda c: 1 / (1 + F.exp(-(c["a"] - 8) * (c["b"] + 1))), ["a", "b"])
    got = {r.feature: r for r in explain.threshold_ci(df, ["a", "b"], scorer, "key", n=12, replicates=30).collect()}
    w = bootstrap_weights(df, "key", 30, 0.8, 42)
    rows = df.select("a", "b", *[c.alias(k) for k, c in w.items()]).toPandas()
    for f, grid in explain.grids(df, ["a", "b"], 12, 0.01, 0.99).items():
        z = {k: rows[k].to_numpy()[:, None] for k in "ab"}
        z[f] = np.array(grid)[None, :]
        p = 1 / (1 + np.exp(-(z["a"] - 8) * (z["b"] + 1)))

        def steepest(curve):
            x, first = np.unique(grid, return_index=True)
            return x[np.argmax(np.abs(np.gradient(np.round(curve[first], 9), x)))]
        xs = [steepest((rows[f"_w{b}"].to_numpy() @ p) / rows[f"_w{b}"].sum()) for b in range(30)]
        assert got[f].thr_unit == pytest.approx(steepest(p.mean(axis=0)))
        assert (got[f].thr_unit_lo, got[f].thr_unit_hi) == pytest.approx(tuple(np.quantile(xs, [0.025, 0.975])))
        assert got[f].thr_q_lo == pytest.approx(np.quantile([(rows[f] <= x).mean() for x in xs], 0.025))


def test_rows_meet_group_parameters_by_broadcast(spark):
    """A few groups never sort all their rows in one task, whatever the planner's own threshold."""
    df = spark.range(0, 6000, 1, 6).selectExpr("if(id % 3 = 0, null, id % 2) split", "cast((id * 7919) % 6007 as double) / 6007 prob",
                                               "cast(id % 7 = 0 as int) label")
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = [spark.conf.get(c) for c in names]
    try:
        for c in names:
            spark.conf.set(c, "-1")
        near = stats._near_ranks(df.withColumnRenamed("prob", "value"), [0.25, 0.5], ["split"], "value", 5000, None)
        got = stats.quantiles_long(df.withColumnRenamed("prob", "value"), [0.25, 0.5], ["split"]).collect()
        for d in (near, curves.reliability(df, by=["split"])):
            d.collect()
            assert "SortMergeJoin" not in d._jdf.queryExecution().executedPlan().toString()
    finally:
        for c, v in zip(names, old):
            spark.conf.set(c, v)
    rows = df.collect()
    for r in got:
        assert r["quantile"] == pytest.approx(np.quantile([x.prob for x in rows if x.split == r.split], r.q), abs=1e-12)
    assert len(got) == 6


def test_permuted_scores_are_made_once(spark):
    """F2: what orders the scores reads them from files and does not score the rows again."""
    df = spark.range(400).selectExpr("cast(id as string) key", "cast(id % 13 as double) a", "cast(id % 5 = 0 as int) label")
    imp = explain.permutation_importance(df, ["a"], ColumnScorer(lambda c: c["a"] / 13, ["a"]), "key", repeats=2)
    assert "Generate" not in imp._jdf.queryExecution().optimizedPlan().toString() and imp.count() == 1
