"""Plan-shape assertions, model properties and the driver contract."""

import io as _io
import contextlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001


def _plan(df) -> str:
    buf = _io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_bounds_filter_pushed_to_scan(spark):
    from riskgrid.operators.clean import bounds
    li = spark.read.parquet(f"{SF001}/lineitem.parquet").withColumn("lon", F.col("l_tax")) \
        .withColumn("lat", F.col("l_discount"))
    p = _plan(bounds(li).select("l_orderkey"))
    assert "PushedFilters: [IsNotNull(l_tax), IsNotNull(l_discount)" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_discount:double,l_tax:double>" in p


def test_global_topk_is_take_ordered(spark):
    from riskgrid.operators.ranking import top_rows
    df = spark.range(1000).select(F.col("id").cast("string").alias("key"), (F.col("id") % 7).alias("prob"))
    assert "TakeOrderedAndProject" in _plan(top_rows(df, 10, key="key"))


def test_grouped_topk_uses_window_group_limit(spark):
    from riskgrid.operators.ranking import topk_grouped
    df = spark.range(1000).select(F.col("id").cast("string").alias("key"), (F.col("id") % 7).alias("prob"),
                                  (F.col("id") % 2).cast("int").alias("label"), (F.col("id") % 5).alias("g"),
                                  F.lit("s").alias("split"))
    assert "WindowGroupLimit" in _plan(topk_grouped(df, ["g"], [5, 10], key="key"))


def test_no_cartesian_product_in_registered_plans(spark):
    from __spark_entry__ import queries
    q = queries()
    for name in ("topk_grouped", "topk_global_quantile", "auc", "calibration_table", "pd_1d",
                 "stratified_density", "impute_global"):
        p = _plan(q[name](spark, SF001))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_tree_contributions_are_additive(spark):
    from riskgrid.operators import model as M
    rng = np.random.default_rng(1)
    X = rng.random((400, 3))
    y = (X[:, 0] + 0.3 * X[:, 1] + 0.1 * rng.random(400) > 0.7).astype(int)
    rows = [(f"r{i}", *map(float, X[i]), int(y[i])) for i in range(400)]
    df = spark.createDataFrame(rows, "key string, a double, b double, c double, label int")
    m = M.fit_gbt(df, ["a", "b", "c"], max_depth=3, max_iter=5, step_size=0.3, subsample=1.0)
    sc = M.score(m, df, ["a", "b", "c"]).select("key", "prob").toPandas().set_index("key")
    con = M.tree_contributions(df, m, ["a", "b", "c"], "key").toPandas()
    tot = con.groupby("key")["shap"].sum()
    logit = np.log(sc["prob"] / (1 - sc["prob"]))
    assert np.allclose(tot.loc[logit.index].values, logit.values, atol=1e-6)


def test_isotonic_is_monotone_and_sigmoid_in_unit_interval(spark):
    from riskgrid.operators.calibrate import IsotonicCalibrator, SigmoidCalibrator
    rows = [(float(i) / 100, int(i % 3 == 0 or i > 70)) for i in range(100)]
    df = spark.createDataFrame(rows, "p double, label int")
    iso = IsotonicCalibrator("p").fit(df).transform(df).orderBy("p").toPandas()
    assert (np.diff(iso["prob_cal"].values) >= -1e-12).all()
    sig = SigmoidCalibrator("p").fit(df).transform(df).toPandas()
    assert ((sig["prob_cal"] > 0) & (sig["prob_cal"] < 1)).all()
    assert np.corrcoef(sig["p"], sig["prob_cal"])[0, 1] > 0.99


def test_entry_contract(spark):
    from __spark_entry__ import entry, oracle_sql, queries
    df = entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and {"split", "k_per_group", "precision", "recall"} <= set(df.columns)
    assert set(oracle_sql()) <= set(queries())


def test_checked_broadcast_hints_only_bounded_sides(spark):
    from riskgrid.session import BROADCAST_MAX_ROWS, checked_broadcast
    big = spark.range(100).withColumn("k", F.col("id") % 3)
    small = spark.range(3).withColumnRenamed("id", "k")
    assert "broadcast" in checked_broadcast(small, 3)._jdf.queryExecution().logical().toString().lower()
    for bound in (None, BROADCAST_MAX_ROWS + 1):
        plan = checked_broadcast(small, bound)._jdf.queryExecution().logical().toString().lower()
        assert "broadcast" not in plan
    # unhinted small sides are still joined correctly (AQE sizes them at run time)
    assert big.join(checked_broadcast(small, None), "k").count() == 100


def test_stage_table_builds_once_per_application(spark):
    from riskgrid.session import stage_table
    calls = []

    def build():
        calls.append(1)
        return spark.range(10)
    a = stage_table(spark, "unit_stage", "/no/such/input", build)
    b = stage_table(spark, "unit_stage", "/no/such/input/", build)
    assert len(calls) == 1
    assert a.count() == b.count() == 10
    assert sorted(a.inputFiles()) == sorted(b.inputFiles())


def test_histogram_plan_compiles_whole_stage(spark):
    """The range join keeps the unpivot + binning inside generated code."""
    from riskgrid.operators.quality import histogram
    df = spark.range(2000).select((F.col("id") % 17).cast("double").alias("a"),
                                  (F.col("id") % 5).cast("double").alias("b"))
    h = histogram(df, ["a", "b"], 10)
    assert h.agg(F.sum("count")).first()[0] == 4000
    assert "BroadcastHashJoin" in _plan(h) or "BroadcastExchange" in _plan(h)


def test_grid_select_one_winner(spark, monkeypatch):
    from __spark_entry__ import queries
    from riskgrid.plans import base as B
    monkeypatch.setattr(B, "GRID_TREES", 6)
    monkeypatch.setattr(B, "_SELECTED", {})
    g = queries()["grid_select"](spark, SF001).toPandas()
    assert len(g) == 16 and (g["n_trees"] >= 1).all() and int(g["selected"].sum()) == 1
    assert ((g["score"] >= 0) & (g["score"] <= 1)).all()
    assert np.allclose(g["score"], g[["p_at_k_iso", "p_at_k_sig"]].max(axis=1))
    win = g[g["selected"]].index[0]
    assert g.loc[win, "score"] == g["score"].max()
    assert win == g.index[g["score"] == g["score"].max()][0]


def test_grid_of_the_query_has_the_reference_size(spark, monkeypatch):
    """Every point of the grid grows up to 2,000 trees and ends 100 trees after its best."""
    from riskgrid.operators import boosting, model
    from riskgrid.plans import base as B
    asked = {}

    def fit(train, val, features, points, key, label, n_trees, patience, *rest, **how):
        asked.update(points=list(points), n_trees=n_trees, patience=patience)
        raise StopIteration
    monkeypatch.setattr(boosting, "fit_grid", fit)
    monkeypatch.setattr(B, "_SELECTED", {})
    with pytest.raises(StopIteration):
        B.selected_model(spark, SF001)
    assert model.boosting is boosting
    assert asked == {"points": boosting.grid(), "n_trees": 2000, "patience": 100} and len(asked["points"]) == 16


def test_no_pairs_join_in_any_sql_checked_plan(spark):
    """Every query with a DuckDB twin plans without all-pairs joins."""
    from __spark_entry__ import oracle_sql, queries
    q = queries()
    for name in sorted(oracle_sql()):
        p = _plan(q[name](spark, SF001))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name
