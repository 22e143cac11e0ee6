"""From the CSV to the fit report: every artifact read back, continued after a failure, nothing stale left."""

import json
import os
import random

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F
from riskgrid import schema
from riskgrid.operators import boosting, model, prepared_model
from riskgrid.plans import workflow
from riskgrid.plans.workflow import RunConfig, run
from riskgrid.sources import io

FEATS = ["t2m", "swvl1", "VHI"]


def write_csv(path, n=1500):
    rng = random.Random(4)
    cols = list(schema.ALL_COLUMNS)
    rng.shuffle(cols)
    with open(path, "w") as f:
        f.write(",".join(cols) + "\n")
        for i in range(n):
            hot = rng.random()
            row = {c: f"{rng.random():.4f}" for c in cols}
            row |= {"valid_time": f"20{10 + i % 9}-{rng.randint(4, 9):02d}-{rng.randint(1, 28):02d} 00:00:00", "grid_id": str(i % 40),
                    "lon": "121.5", "lat": "51.0" if i % 50 else "99", "t2m": f"{hot:.3f}" if i % 11 else "", "fire_count": "1",
                    "fire_presence": str(int(rng.random() < hot ** 4)), "events": "x"}
            line = ",".join(row[c] for c in cols) + "\n"
            f.write(line)
            if i % 100 == 0:
                f.write(line)  # a duplicate


def config(tmp_path, **over):
    base = dict(features=FEATS, final_samples=100, points=boosting.grid(child_weights=(1.0,), lambdas=(1.0,), rates=(0.3,)), n_trees=4,
                select_k=50, ks=(10, 50), quantiles=(0.9, 0.99), group_ks=(2,), primary_q=0.95, tail_q=0.9, tail_bins=4, top_m=2,
                pd_points=8, pd2_points=4, replicates=10)
    return RunConfig(f"{tmp_path}/obs.csv", f"{tmp_path}/out", **(base | over))


def tables(tmp_path):
    return sorted(os.listdir(f"{tmp_path}/out/tables"))


def test_run_to_the_report(spark, tmp_path, monkeypatch):
    write_csv(f"{tmp_path}/obs.csv")
    cfg = config(tmp_path)

    # the evaluation breaks after its first tables
    whole = workflow.ranking.topk_global
    monkeypatch.setattr(workflow.ranking, "topk_global", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError, match="killed"):
        run(spark, cfg)
    monkeypatch.setattr(workflow.ranking, "topk_global", whole)
    before = {t: os.path.getmtime(f"{tmp_path}/out/tables/{t}/_DONE") for t in tables(tmp_path) if os.path.exists(f"{tmp_path}/out/tables/{t}/_DONE")}
    assert any(t.startswith("scored-") for t in before) and not any(t.startswith("fit_report-") for t in before)
    arts = run(spark, cfg)
    assert all(os.path.getmtime(f"{tmp_path}/out/tables/{t}/_DONE") == m for t, m in before.items())

    # every artifact, read back
    read = spark.read.option("header", True)
    s1 = spark.read.parquet(arts["clean"])
    assert s1.count() == s1.select("obs_key").distinct().count() and s1.filter("lat > 90 or month not in (5, 6, 7, 8)").isEmpty()
    sizes = {s: spark.read.parquet(arts[f"cls_{s}"]).count() for s in ("train", "val", "test")}
    te = int(s1.count() * 0.8)
    assert sizes == {"train": te - int(te * 0.375), "val": int(te * 0.375), "test": s1.count() - te}
    assert {"burned_area_ha_sum", "duration_days_sum"} <= set(spark.read.parquet(arts["reg_val"]).columns)
    for part in ("missing", "describe", "histogram", "box"):
        assert read.csv(arts[f"profile_before_{part}"]).count() == read.csv(arts[f"profile_after_{part}"]).count() or part == "missing"
    nulls = {r["column"]: int(r["missing_count"]) for r in read.csv(arts["profile_before_missing"]).collect()}
    assert nulls["t2m"] > 0 and {r["column"]: int(r["missing_count"]) for r in read.csv(arts["profile_after_missing"]).collect()}["t2m"] == 0
    assert read.csv(arts["class_balance"]).count() == 6 and read.csv(arts["group_sizes"]).count() == 3
    balanced = spark.read.parquet(arts["cls_train_balanced"]).groupBy("label").count().collect()
    assert {r["count"] for r in balanced} == {100}
    meta = io.read_meta(spark, arts["meta"]).first()
    assert meta.classification_target == "fire_presence" and meta.artifacts["cls_train"] == arts["cls_train"]
    grid = read.csv(arts["grid"]).collect()
    assert len(grid) == 2 and sum(r.selected == "true" for r in grid) == 1
    record = json.loads(spark.read.text(arts["train_meta"]).first()[0])
    assert record["train_pos"] + record["train_neg"] == sizes["train"] and record["best_params"]["n_trees"] >= 1
    mets = spark.read.json(arts["metrics"]).collect()
    assert len(mets) == 4 and all(0.5 < r.AUC <= 1 for r in mets if r.split == "val")
    assert read.csv(arts["precision_at_k"]).count() == 8 and read.csv(arts["topk_global"]).count() == 16
    assert read.csv(arts["topk_grouped"]).count() == 4 and read.csv(arts["calibration"]).count() > 4 and read.csv(arts["calibration_tail"]).count() >= 4
    assert spark.read.json(arts["thresholds"]).first().anchor_k == 50
    assert spark.read.parquet(arts["predictions"]).count() == 2 * (sizes["val"] + sizes["test"])
    assert spark.read.parquet(arts["pd_curves"]).groupBy("feature").count().count() <= 2
    assert read.csv(arts["pd_thresholds"]).count() >= 2 and read.csv(arts["threshold_ci"]).count() >= 1
    report = spark.read.json(arts["fit_report"]).collect()
    assert {r.calibrator for r in report} == {"iso", "sig"} and all(r.explain == "tree_contributions" for r in report)
    assert report[0].operating_point.primary_mode == "quantile" and report[0].operating_point.fallback_k == 50 and report[0].top

    # the stored preparation and model score raw rows as the run did
    m = prepared_model.PreparedModel.load(arts["model"])
    val = spark.read.parquet(arts["scored"]).filter("split = 'val'")
    again = m.transform(s1).select("obs_key", "prob_iso", "prob_sig")
    j = val.join(again, "obs_key").select("prob", F.when(F.col("calibrator") == "iso", F.col("prob_iso")).otherwise(F.col("prob_sig")).alias("p"))
    assert j.count() == 2 * sizes["val"] and j.filter("abs(prob - p) > 1e-12").isEmpty()
    PipelineModel([m]).write().overwrite().save(f"{tmp_path}/pipe")
    piped = PipelineModel.load(f"{tmp_path}/pipe").transform(s1).select("obs_key", "prob_iso")
    assert piped.join(again.withColumnRenamed("prob_iso", "b"), "obs_key").filter("abs(prob_iso - b) > 1e-12").isEmpty()

    # nothing to do, then one parameter: what depends on it is built anew, its old tables go
    old = tables(tmp_path)
    assert run(spark, cfg) == arts and tables(tmp_path) == old
    new = run(spark, config(tmp_path, primary_q=0.9))
    assert new["fit_report"] != arts["fit_report"] and new["scored"] == arts["scored"]
    assert len(tables(tmp_path)) == len(old) and not os.path.exists(arts["fit_report"])
    manifest = json.load(open(f"{tmp_path}/out/manifest.json"))
    assert sorted(p.rsplit("/", 1)[1] for p in manifest.values()) == tables(tmp_path)


def test_stop_and_empty_input(spark, tmp_path):
    write_csv(f"{tmp_path}/obs.csv", 60)
    arts = run(spark, config(tmp_path), stop_after="clean")
    assert list(arts) == ["clean"]
    with pytest.raises(ValueError):
        run(spark, config(tmp_path), stop_after="step 3")
    with pytest.raises(ValueError, match="no row"):
        run(spark, config(tmp_path, keep_months=(13,)))


def test_explainer_of_another_model(spark):
    """A model that is no tree ensemble is explained by permutation."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    df = spark.range(400).selectExpr("cast(id as string) key", "cast(id % 20 as double) a", "cast(id % 7 as double) b", "cast(id % 20 > 12 as int) label")
    lr = LogisticRegression(labelCol="label").fit(VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df))
    method, imp = model.explain_importance(df, lr, ["a", "b"], "key", repeats=2)
    got = {r.feature: r.importance_mean for r in imp.collect()}
    assert method == "permutation_importance" and got["a"] > 0.2 and abs(got["b"]) < 0.1
