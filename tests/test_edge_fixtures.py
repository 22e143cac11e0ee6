"""Hand-made edge fixtures (FIXTURES section 4)."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskgrid.operators import curves, explain, features, quality, ranking, sampling, split
from riskgrid.sources import io


def test_csv_swapped_header_and_bad_fields(spark, tmp_path):
    p = tmp_path / "obs.csv"
    p.write_text("lat,lon,valid_time,grid_id,t2m,fire_presence\n"
                 "45.5,120.25,2020-05-01 00:00:00,7,1.5,0\n"
                 "46.0,121.0,not-a-date,8,abc,1\n"
                 "47.0,122.0,2020-06-01 00:00:00,9,NaN,\n")
    cols = ["valid_time", "grid_id", "lon", "lat", "t2m", "fire_presence"]
    df = io.read_observations(spark, str(p), cols).toPandas()
    assert list(df.columns) == cols
    assert df.loc[0, "lon"] == pytest.approx(120.25) and df.loc[0, "lat"] == pytest.approx(45.5)
    assert pd.isna(df.loc[1, "valid_time"]) and pd.isna(df.loc[1, "t2m"])
    assert pd.isna(df.loc[2, "t2m"]) and pd.isna(df.loc[2, "fire_presence"])


def test_csv_missing_column(spark, tmp_path):
    p = tmp_path / "obs.csv"
    p.write_text("valid_time,grid_id\n2020-05-01 00:00:00,1\n")
    with pytest.raises(KeyError):
        io.read_observations(spark, str(p), ["valid_time", "grid_id", "lon"])
    df = io.read_observations(spark, str(p), ["valid_time", "grid_id", "lon"], on_missing="null")
    assert df.first()["lon"] is None


def test_all_null_feature_month_stays_null(spark):
    df = spark.createDataFrame([(5, None), (5, None), (6, 1.0), (6, 3.0), (6, None)],
                               "month int, x double")
    out = features.impute(df, ["x"], monthwise=True).toPandas()
    assert out[out.month == 5]["x"].isna().all()
    assert (out[out.month == 6]["x"] == [1.0, 3.0, 2.0]).all()
    glob = features.impute(df, ["x"]).toPandas()
    assert (glob["x"].fillna(-1) == 2.0).sum() == 3


def test_constant_feature_scalers_and_histogram(spark):
    df = spark.createDataFrame([(i, 4.0, float(i)) for i in range(10)], "id int, c double, v double")
    for kind in ("minmax", "standard", "robust"):
        out = features.scale(df, ["c", "v"], kind).toPandas()
        assert (out["c"] == 0.0).all()
    mm = features.scale(df, ["v"], "minmax").toPandas()["v"]
    assert mm.min() == 0.0 and mm.max() == 1.0
    h = quality.histogram(df, ["c"], 50).toPandas()
    # NumPy: range [v - 0.5, v + 0.5], the value falls in bin 25 of 50
    assert sorted(h["bin"]) == list(range(50)) and h["count"].sum() == 10
    full = h[h["count"] > 0].iloc[0]
    assert full["bin"] == 25 and full["bin_low"] == pytest.approx(4.0) and full["count"] == 10


def test_quantiles_of_ties_nulls_and_groups_against_numpy(spark):
    """A hot value, few distinct values, one-row and null groups, nulls; a coarse
    sketch must not change the result."""
    import numpy as np
    from riskgrid.operators.stats import quantiles_long
    rng = np.random.default_rng(3)
    rows = [("hot", 7.0)] * 400 + [("hot", float(x)) for x in rng.normal(7, 3, 600).round(2)]
    rows += [(None, float(x)) for x in rng.integers(0, 4, 300)] + [("one", 5.0), ("hot", None), ("none", None)]
    df = spark.createDataFrame(rows, "g string, value double").repartition(7)
    qs = [0.0, 0.01, 0.25, 0.5, 0.9, 0.999, 1.0]
    for accuracy in (5000, 10):
        got = {(r.g, r.q_idx): r.quantile for r in quantiles_long(df, qs, ["g"], accuracy=accuracy).collect()}
        want = {(g, i): np.quantile([v for k, v in rows if k == g and v is not None], q)
                for g in ("hot", None, "one") for i, q in enumerate(qs)}
        assert got.keys() == want.keys()
        assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)
        plain = {r.q_idx: r.quantile for r in quantiles_long(df.select("value"), qs, accuracy=accuracy).collect()}
        every = [v for _, v in rows if v is not None]
        assert all(plain[i] == pytest.approx(np.quantile(every, q), abs=1e-9) for i, q in enumerate(qs))


def _tied(spark):
    rows = [("k%02d" % i, p, y) for i, (p, y) in enumerate(
        [(0.9, 1), (0.9, 0), (0.9, 1), (0.5, 0), (0.5, 1), (0.5, 0), (0.1, 0), (0.1, 0), (0.1, 1), (0.1, 0)])]
    return spark.createDataFrame(rows, "key string, prob double, label int"), rows


def test_tied_scores_auc_ap_against_brute_force(spark):
    df, rows = _tied(spark)
    g = df.withColumn("g", F.lit("a"))
    res = curves.auc_ap(g, by=["g"]).first()
    pos = [p for _, p, y in rows if y == 1]
    neg = [p for _, p, y in rows if y == 0]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    assert res["auc"] == pytest.approx(auc)
    ap = 0.0
    for t in sorted({p for _, p, _ in rows}, reverse=True):
        sel = [y for _, p, y in rows if p >= t]
        ap += (sum(sel) / len(sel)) * (sum(y for _, p, y in rows if p == t) / len(pos))
    assert res["average_precision"] == pytest.approx(ap)
    # AUC(p) = 1 - AUC(-p)
    neg_res = curves.auc_ap(g.withColumn("prob", -F.col("prob")), by=["g"]).first()
    assert neg_res["auc"] == pytest.approx(1 - auc)


def test_precision_at_k_tie_break_and_guards(spark):
    df, rows = _tied(spark)
    r = ranking.precision_recall_at_k(df, [1, 2, 3, 50], key="key").toPandas().set_index("k")
    assert r.loc[1, "tp"] == 1 and r.loc[2, "tp"] == 1 and r.loc[3, "tp"] == 2   # k00,k01,k02
    assert r.loc[50, "kk"] == 10 and r.loc[50, "recall"] == 1.0                  # k > n clamps
    none = df.withColumn("label", F.lit(0))
    z = ranking.precision_recall_at_k(none, [3], key="key").first()
    assert z["precision"] == 0.0 and z["recall"] == 0.0                         # no positives
    t = ranking.topk_by_k(df.withColumn("split", F.lit("s")), [0, 3], key="key").toPandas()
    assert t[t.k_or_q == 0]["threshold"].iloc[0] == 1.0


def test_null_group_kept_in_grouped_topk(spark):
    df = spark.createDataFrame([("a", None, 0.9, 1), ("b", None, 0.8, 0), ("c", 1, 0.7, 1), ("d", 1, 0.6, 0)],
                               "key string, grp int, prob double, label int").withColumn("split", F.lit("s"))
    out = ranking.topk_grouped(df, ["grp"], [1], key="key").first()
    assert out["alerts"] == 2 and out["tp"] == 2 and out["fn"] == 0
    with pytest.raises(KeyError):
        ranking.topk_grouped(df, ["nope"], [1], key="key")


def test_empty_bins_labelled_by_bin_id(spark):
    probs = [0.01] * 50 + [0.9] * 50
    df = spark.createDataFrame([(f"k{i}", p, int(i % 2)) for i, p in enumerate(probs)],
                               "key string, prob double, label int").withColumn("s", F.lit("a"))
    t = curves.calibration_table(df, n_bins=20, by=["s"]).toPandas()
    assert t["n"].sum() == 100
    for r in t.itertuples():
        assert r.bin_low <= r.bin_high


def test_time_ties_at_cut(spark):
    rows = [(f"k{i:03d}", "2020-05-01 00:00:00" if i < 60 else "2020-06-01 00:00:00") for i in range(100)]
    df = spark.createDataFrame(rows, "key string, t string").withColumn("valid_time", F.to_timestamp("t"))
    s = split.time_split(df, "key").toPandas()
    assert dict(s.split.value_counts()) == {"train": 50, "val": 30, "test": 20}
    train_keys = sorted(s[s.split == "train"].key)
    assert train_keys == [f"k{i:03d}" for i in range(50)]


def test_two_point_grid_uses_medians(spark):
    df = spark.createDataFrame([("f", 0, 1.0, 0.2), ("f", 1, 3.0, 0.4)], "feature string, i int, g double, pd double")
    gr = explain.gradient(df.withColumnRenamed("g", "x").withColumnRenamed("pd", "y"), ["feature"])
    st = explain.steepest(gr, ["feature"]).first()
    assert st["x_star"] == pytest.approx(2.0) and st["y_star"] == pytest.approx(0.3)
    assert explain.detect_thresholds(df).count() == 0


def test_smote_few_positives_and_short_negatives(spark):
    feats = ["a", "b"]
    pos = spark.createDataFrame([("p0", 0.0, 0.0), ("p1", 1.0, 2.0)], "key string, a double, b double")
    syn = sampling.smote(pos, feats, 6, 42, "key").toPandas()
    assert len(syn) == 4
    # two points: every synthetic row lies on the segment between them
    assert np.allclose(syn["b"], 2 * syn["a"]) and ((syn["a"] >= 0) & (syn["a"] <= 1)).all()
    one = spark.createDataFrame([("p0", 5.0, 5.0)], "key string, a double, b double")
    assert sampling.smote(one, feats, 3, 42, "key").count() == 2
    with pytest.raises(ValueError):
        sampling.smote(one.limit(0), feats, 3, 42, "key")
    df = spark.createDataFrame([(f"n{i}", float(i), 0.0, 0) for i in range(3)] +
                               [(f"p{i}", float(i), 1.0, 1) for i in range(5)],
                               "key string, a double, b double, label int")
    bal = sampling.balance(df, feats, "label", 10, 42, "key").groupBy("label").count().toPandas()
    assert dict(zip(bal["label"], bal["count"])) == {0: 3, 1: 3}


def test_knn_matches_brute_force(spark):
    rng = np.random.default_rng(0)
    pts = rng.random((60, 3))
    df = spark.createDataFrame([(f"p{i:02d}", *map(float, r)) for i, r in enumerate(pts)],
                               "key string, a double, b double, c double")
    got = sampling.knn(df, ["a", "b", "c"], "key", 4).toPandas()
    for i in range(60):
        d = np.sqrt(((pts - pts[i]) ** 2).sum(1))
        d[i] = np.inf
        exp = [f"p{j:02d}" for j in np.argsort(d, kind="stable")[:4]]
        row = got[got.key == f"p{i:02d}"].sort_values("nn_rank")
        assert list(row.nn_key) == exp


def test_meta_fallback(spark, tmp_path):
    path = str(tmp_path / "meta")
    io.write_meta(spark, path, {"seed": 42}, "fire_presence", ["a"], ["x"], ["y"], ["grid_id"],
                  "valid_time", {"cls_train_std": "/data/train", "cls_val": "/data/val"})
    m = io.read_meta(spark, path)
    r = m.select(io.resolve_artifact(m, "cls_train", "cls_train_std").alias("p")).first()
    assert r["p"] == "/data/train"


def test_bootstrap_poisson_weights_moments(spark):
    df = spark.range(20000).withColumn("key", F.col("id").cast("string"))
    w = df.select(*[c.alias(n) for n, c in sampling.bootstrap_weights(df, "key", 2, 0.8, 42).items()])
    s = w.agg(F.avg("_w0").alias("m"), F.variance("_w0").alias("v")).first()
    assert s["m"] == pytest.approx(0.8, abs=0.03) and s["v"] == pytest.approx(0.8, abs=0.05)
    assert sampling.poisson_cdf(0.8)[-1] == pytest.approx(1.0)
    assert math.isclose(sampling.poisson_cdf(0.8)[0], math.exp(-0.8))
