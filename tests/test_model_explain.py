"""Operators on the fitted model, and the small functions around it."""

import pytest
from conftest import SF001
from pyspark.sql import functions as F
from riskgrid import schema
from riskgrid.functions import exprs
from riskgrid.functions.scorer import ModelScorer
from riskgrid.operators import curves, explain, features, model, quality, ranking
from riskgrid.plans import base as B


def test_model_partial_dependence_reload_and_export(spark, tmp_path):
    m, mf = B.fitted_model(spark, SF001)
    val = mf.filter("split = 'val'")
    again = model.load_model(model.save_model(m, f"{tmp_path}/model"))
    pd1 = explain.pd_1d(val, ["f_qty"], ModelScorer(again, B.KNN_FEATURES), n=3).collect()
    assert len(pd1) == 3
    for r in pd1:
        forced = model.score(m, val.withColumn("f_qty", F.lit(r.g)), B.KNN_FEATURES)
        assert r.pd == pytest.approx(forced.agg(F.avg("prob")).first()[0], abs=1e-9)
    scored = model.calibrated_scores(m, val, val, B.KNN_FEATURES)
    model.export_predictions(scored, f"{tmp_path}/pred", B.KEY)
    back = spark.read.parquet(f"{tmp_path}/pred")
    assert back.count() == 4 * val.count() and set(back.columns) == {B.KEY, "prob", "label", "calibrator", "split"}


def test_small_functions(spark):
    df = spark.createDataFrame([("1.5", "2020-05-01 00:00:00", 1), ("x", "never", 0)], "a string, t string, y int")
    assert [r.a for r in features.pick(df, ["a"]).collect()] == [1.5, None]
    assert dict(features.label_int(df, "y").dtypes)["y"] == "tinyint"
    with pytest.raises(KeyError):
        features.pick(df, ["nope"])
    got = df.select(exprs.to_number("a").alias("n"), exprs.parse_timestamp("t").alias("t")).collect()
    assert got[0].n == 1.5 and got[1].n is None and got[0].t is not None and got[1].t is None
    e = F.array(*[F.lit(x) for x in (2.0, 1.0, 2.0)])
    r = spark.range(1).select(exprs.distinct_sorted(e).alias("u"), exprs.digitize(F.lit(2.0), e).alias("l"),
                              exprs.digitize(F.lit(2.0), e, right=True).alias("r")).first()
    assert list(r.u) == [1.0, 2.0] and (r.l, r.r) == (3, 1)
    assert ranking.select_rows(df, df.filter("y = 1"), "a").count() == 1
    imp = spark.createDataFrame([("a", 0.1), ("b", 0.3), ("c", 0.3)], "feature string, mean_abs_shap double")
    assert [r.feature for r in explain.top_features(imp, 2).collect()] == ["b", "c"]
    wide = spark.createDataFrame([(1, 2, 3)], "x int, mon_05 int, mon_06 int")
    assert schema.model_inputs(wide, ["x"]) == ["x", "mon_05", "mon_06"]


def test_profile_and_ungrouped_metrics_use_all_rows(spark):
    df = spark.range(400).selectExpr("cast(id as double) v", "cast(id / 400 as double) prob", "cast(id % 2 as int) label")
    p = quality.profile(df, ["v"], bins=10)
    assert p["histogram"].agg(F.sum("count")).first()[0] == 400
    m = curves.metrics(df).first()
    assert 0.49 < m.AUC < 0.51 and m.Brier > 0
