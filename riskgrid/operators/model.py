"""Boosted-tree model operators: class weight column (D9), fits on ``pyspark.ml``
and on ``operators.boosting`` (J1), the small grid selected by precision@k over both
calibrators (J2), scoring (J5, C8), evaluation of (calibrator, split) pairs (J6),
persistence (A10), prediction export (A11), the node table of the fitted trees and
path-dependent tree contributions (J7), and the explainer fallback (J15)."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskgrid.functions.ensemble import ValueTables
from riskgrid.operators import boosting
from riskgrid.operators.boosting import BoostedTrees
from riskgrid.operators.calibrate import (IsotonicCalibrator, SigmoidCalibrator, apply_isotonic, apply_sigmoid, fit_isotonic,
                                          fit_sigmoid)
from riskgrid.operators.curves import metrics
from riskgrid.operators.ranking import precision_recall_at_k
from riskgrid.session import cut_lineage, ensure_checkpoint_dir


def with_class_weight(train: DataFrame, label: str = "label", weight: str = "w") -> DataFrame:
    """D9 as a column: positives weighted ``neg / max(1, pos)``, negatives 1."""
    c = train.agg(F.sum(F.col(label).cast("long")).alias("p"), F.count(F.lit(1)).alias("n")).first()
    pos = int(c["p"] or 0)
    spw = (int(c["n"]) - pos) / max(1, pos)
    return train.withColumn(weight, F.when(F.col(label) == 1, F.lit(float(spw))).otherwise(F.lit(1.0)))


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep").transform(df)


def fit_gbt(train: DataFrame, features: Sequence[str], label: str = "label", max_depth: int = 4,
            max_iter: int = 20, step_size: float = 0.04, subsample: float = 0.8,
            feature_subset: str = "all", max_bins: int = 256, seed: int = 42) -> GBTClassificationModel:
    """Gradient-boosted trees with the class weight, row subsampling and
    ``maxBins=256``; a fixed number of trees (Spark's validation stop can
    halt after one tree on weak labels)."""
    weighted = train if "w" in train.columns else with_class_weight(train, label)
    data = assemble(weighted, features)
    gbt = GBTClassifier(featuresCol="features", labelCol=label, weightCol="w", maxDepth=max_depth,
                        maxIter=max_iter, stepSize=step_size, subsamplingRate=subsample,
                        featureSubsetStrategy=feature_subset, maxBins=max_bins, seed=seed)
    return gbt.fit(data.withColumn(label, F.col(label).cast("double")))


def score(model, df: DataFrame, features: Sequence[str], out: str = "prob") -> DataFrame:
    """P(class 1) from the probability vector (raw prediction otherwise)."""
    if isinstance(model, BoostedTrees):
        return model.score(df, out)
    res = model.transform(assemble(df, features))
    p = vector_to_array("probability")[1] if "probability" in res.columns else F.col("prediction")
    return res.withColumn(out, p.cast("double")).drop("features", "rawPrediction", "probability", "prediction")


def calibrated_scores(model, val: DataFrame, test: DataFrame, features: Sequence[str],
                      label: str = "label") -> DataFrame:
    """J6 input: one long table (calibrator, split, key..., label, prob) with
    isotonic and sigmoid calibrators fitted on the validation scores."""
    # written once: two fits and four transforms read the scores
    sv = cut_lineage(score(model, val, features, "prob_raw"))
    st = cut_lineage(score(model, test, features, "prob_raw"))
    iso = IsotonicCalibrator("prob_raw", label).fit(sv)
    sig = SigmoidCalibrator("prob_raw", label).fit(sv)
    out = None
    for name, cal in (("iso", iso), ("sig", sig)):
        for split, d in (("val", sv), ("test", st)):
            part = cal.transform(d, "prob").withColumn("calibrator", F.lit(name)) \
                .withColumn("split", F.lit(split))
            out = part if out is None else out.unionByName(part)
    return out


def evaluate(scored: DataFrame, ks: Sequence[int], key: str, label: str = "label") -> tuple[DataFrame, DataFrame]:
    """Metrics and precision/recall@k per (calibrator, split)."""
    by = ["calibrator", "split"]
    return metrics(scored, "prob", label, by), precision_recall_at_k(scored, ks, "prob", label, key, by)


def grid_select(train: DataFrame, val: DataFrame, features: Sequence[str], key: str, anchor_k: int,
                points: Sequence[boosting.Point] | None = None, label: str = "label", n_trees: int = 2000, patience: int = 100,
                block: int = 10, seed: int = 42) -> tuple[DataFrame, BoostedTrees]:
    """Fit every grid point, cut each to its best prefix on validation, calibrate both ways there,
    and score by precision@anchor_k (the better of the two); the first best point wins.

    All points are fitted together (``boosting.fit_grid``), scored in one pass, and calibrated and
    ranked as groups of one table, so the number of jobs does not follow the number of points.
    -> (one row per point with ``selected``, the winner).
    """
    points = list(points or boosting.grid())
    models = boosting.fit_grid(train, val, features, points, key, label, n_trees, patience, block, seed=seed)
    raw = cut_lineage(score_all(models, val, key, label))
    both = apply_isotonic(raw, fit_isotonic(raw, "prob_raw", label, ["point"]), "prob_raw", "prob", ["point"]).withColumn("calibrator", F.lit("iso")) \
        .unionByName(apply_sigmoid(raw, fit_sigmoid(raw, "prob_raw", label, ["point"]), "prob_raw", "prob", ["point"])
                     .withColumn("calibrator", F.lit("sig")))
    at_k = precision_recall_at_k(cut_lineage(both), [anchor_k], "prob", label, key, ["point", "calibrator"]).collect()  # two rows per point
    found = {(r["point"], r["calibrator"]): float(r["precision"]) for r in at_k}
    rows = []
    for i, (p, m) in enumerate(zip(points, models)):
        iso, sig = found.get((i, "iso"), 0.0), found.get((i, "sig"), 0.0)
        rows.append((p.max_depth, p.min_child_weight, p.reg_lambda, p.learning_rate, len(m.trees), m.val_ap[-1] if m.val_ap else None,
                     iso, sig, max(iso, sig)))
    best = max(range(len(rows)), key=lambda i: (rows[i][-1], -i))
    table = train.sparkSession.createDataFrame(
        [(*r, i == best) for i, r in enumerate(rows)],
        "max_depth int, min_child_weight double, reg_lambda double, learning_rate double, n_trees int, val_ap double, "
        "p_at_k_iso double, p_at_k_sig double, score double, selected boolean")
    return table, models[best]


def score_all(models: Sequence[BoostedTrees], df: DataFrame, key: str, label: str = "label") -> DataFrame:
    """(point, key, label, prob_raw): every row under every model, one pass."""
    feats = models[0].features
    tables = ValueTables([[t.as_nodes() for t in m.trees] for m in models], len(feats), True)

    @F.pandas_udf("array<double>")
    def probs(x: pd.DataFrame) -> pd.Series:
        return pd.Series(list((1 / (1 + np.exp(-tables.margins(x.to_numpy(dtype=float))))).T))
    cols = F.struct(*[F.col(f).cast("double").alias(f) for f in feats])
    return df.select(key, label, F.posexplode(probs(cols)).alias("point", "prob_raw"))


def save_model(model, path: str) -> str:
    """A10: persist with the ML writer (overwrite), or the node table of a ``BoostedTrees``."""
    if isinstance(model, BoostedTrees):
        return boosting.save(model, path, _session())
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> GBTClassificationModel:
    return GBTClassificationModel.load(path)


def export_predictions(scored: DataFrame, path: str, key: str, label: str = "label") -> None:
    """(key, calibrator, split, prob, label), partitioned by calibrator and split."""
    scored.select(key, "calibrator", "split", "prob", label).write.mode("overwrite") \
        .partitionBy("calibrator", "split").parquet(path)


# ---- tree contributions (J7) -------------------------------------------------------
def node_table(model: GBTClassificationModel) -> pd.DataFrame:
    """Nodes of all trees from the saved model: (tree, id, left, right, feature,
    threshold, value, cover, weight).  Size: trees x nodes, a model parameter."""
    if isinstance(model, BoostedTrees):
        return model.nodes()
    ss = _session()
    path = f"{ensure_checkpoint_dir(ss).rstrip('/')}/models/gbt-{model.uid}"
    save_model(model, path)
    data = ss.read.parquet(f"{path}/data").select(
        "treeID", "nodeData.id", "nodeData.leftChild", "nodeData.rightChild",
        F.col("nodeData.split.featureIndex").alias("feature"),
        F.try_element_at("nodeData.split.leftCategoriesOrThreshold", F.lit(1)).alias("threshold"),
        F.col("nodeData.prediction").alias("value"),
        F.coalesce(F.try_element_at("nodeData.impurityStats", F.lit(1)),
                   F.col("nodeData.rawCount").cast("double")).alias("cover")).toPandas()
    weights = list(model.treeWeights)
    data["weight"] = data["treeID"].map(lambda t: weights[int(t)])
    return data.rename(columns={"treeID": "tree", "leftChild": "left", "rightChild": "right"})


def _session():
    from pyspark.sql import SparkSession
    return SparkSession.getActiveSession()


def _leaf_paths(nodes: pd.DataFrame):
    """Per tree, per leaf: value, weight and the path [(feature, thr, go_left, cover_ratio)]."""
    out = []
    for tree, t in nodes.groupby("tree"):
        by_id = {int(r.id): r for r in t.itertuples()}
        w = float(t["weight"].iloc[0])

        def walk(nid, path):
            r = by_id[nid]
            if r.left < 0:
                out.append((w * float(r.value), path))
                return
            for child, go_left in ((int(r.left), True), (int(r.right), False)):
                ratio = by_id[child].cover / r.cover if r.cover > 0 else 0.5
                walk(child, path + [(int(r.feature), float(r.threshold), go_left, float(ratio))])
        walk(0, [])
    return out


def tree_contributions(df: DataFrame, model: GBTClassificationModel | BoostedTrees, features: Sequence[str],
                       key: str, log_odds: bool = True) -> DataFrame:
    """Exact path-dependent tree contributions per row -> long
    (key, feature, value, shap) plus a ``__base__`` row per key.

    ``E[f | x_S]`` of a tree is a sum over leaves of ``v_l * prod_j c_j(S)``,
    where node j contributes the direction indicator if its feature is in S
    and the cover ratio otherwise; each leaf is a game over at most
    ``depth`` distinct path features, so its Shapley values come from
    enumerating those subsets, vectorised over the rows of a batch
    (``mapInPandas``); the node table is a model parameter shipped with the
    closure.  Contributions are in log-odds units (2F for Spark GBT).
    """
    leaves = _leaf_paths(node_table(model))
    own = isinstance(model, BoostedTrees)
    scale = 2.0 if log_odds and not own else 1.0
    feats = list(features)
    nf = len(feats)
    from math import factorial

    def shap_batch(it):
        for pdf in it:
            X = pdf[feats].to_numpy(dtype=float)
            n = X.shape[0]
            phi = np.zeros((n, nf))
            base = 0.0
            for v, path in leaves:
                uniq = sorted({p[0] for p in path})
                m = len(uniq)
                ind = {}
                for s_mask in range(1 << m):
                    g = np.full(n, v)
                    for fidx, thr, go_left, ratio in path:
                        if s_mask >> uniq.index(fidx) & 1:
                            xv = X[:, fidx]
                            left = ~(xv > thr) if own else xv <= thr  # where nulls go
                            g = g * (left if go_left else ~left)
                        else:
                            g = g * ratio
                    ind[s_mask] = g
                base += float(ind[0][0]) if n else 0.0
                for pos, fidx in enumerate(uniq):
                    bit = 1 << pos
                    for s_mask in range(1 << m):
                        if s_mask & bit:
                            continue
                        k = bin(s_mask).count("1")
                        wgt = factorial(k) * factorial(m - k - 1) / factorial(m)
                        phi[:, fidx] += wgt * (ind[s_mask | bit] - ind[s_mask])
            keys = pdf[key].to_numpy()
            parts = [pd.DataFrame({key: keys, "feature": f, "value": X[:, i],
                                   "shap": scale * phi[:, i]}) for i, f in enumerate(feats)]
            parts.append(pd.DataFrame({key: keys, "feature": "__base__", "value": np.nan,
                                       "shap": scale * base}))
            yield pd.concat(parts, ignore_index=True)

    schema = T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField("feature", T.StringType()),
                           T.StructField("value", T.DoubleType()), T.StructField("shap", T.DoubleType())])
    return df.select(key, *[F.col(f).cast("double").alias(f) for f in feats]).mapInPandas(shap_batch, schema)


def explain_importance(df: DataFrame, model, features: Sequence[str], key: str, scorer=None,
                       label: str = "label", repeats: int = 5, seed: int = 42) -> tuple[str, DataFrame]:
    """(method, importance).  Tree contributions of a tree ensemble; permutation importance of
    any other model or scorer."""
    from riskgrid.functions.scorer import ModelScorer
    from riskgrid.operators.explain import mean_abs, permutation_importance
    if isinstance(model, (GBTClassificationModel, BoostedTrees)):
        return "tree_contributions", mean_abs(tree_contributions(df, model, features, key)
                                              .filter(F.col("feature") != "__base__"))
    return "permutation_importance", permutation_importance(df, features, scorer or ModelScorer(model, features), key, label, repeats, seed)
