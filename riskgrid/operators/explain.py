"""Explanation operators: 1-D and 2-D partial dependence (J9, J10, C3, C4),
feature pairs (C7), gradient on an uneven grid (F6), threshold detection
(F7, F7b, G8), surface range and pathway edges (D27, D28), bootstrap
confidence intervals of the PD threshold (J11, H7), permutation importance
(J8), mean absolute contribution and top features (D26, G7).

With a column scorer, rows x grid points are generated with ``posexplode`` of a
per-feature grid array (a parameter-sized fan-out inside one stage, never a join of
data with data); a tree scorer adds the scores of whole batches instead and writes
no row per grid point (``functions.ensemble``).  Every PD value is an average of
partial sums.

The bootstrap scores each (row, grid point) once.  Per batch, the replicates'
weights are a (replicates x rows) matrix and the scores a (rows x grid) matrix;
their product is the batch's share of every replicate's curve, and products add up.

A permutation is a keyed bijection on row positions, so a row computes its donor's
position instead of sorting a shuffled copy of the rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskgrid.functions.exprs import TWO_POW_52, linspace
from riskgrid.functions.permute import donor_positions
from riskgrid.operators.curves import auc_ap, score_groups
from riskgrid.operators.sampling import poisson_cdf
from riskgrid.operators.stats import quantile_array, quantiles, quantiles_long
from riskgrid.plans.ordering import ordered
from riskgrid.session import checked_broadcast, cut_lineage


def pairs(features: Sequence[str]) -> list[tuple[str, str]]:
    """All unordered feature pairs in list order (a parameter, not data)."""
    return list(combinations(list(features), 2))


def grids(base: DataFrame, features: Sequence[str], n: int, q_low: float,
          q_high: float) -> dict[str, list[float]]:
    """Quantile grid per feature at linspace(q_low, q_high, n).

    One distributed exact-quantile job; the result is a parameter of
    ``features x n`` numbers and is brought to the driver once, so every
    later stage uses it as a literal array.
    """
    qt = quantiles(base, features, linspace(q_low, q_high, n))
    rows = quantile_array(qt, ["feature"], "grid").collect()
    return {r["feature"]: [float(v) for v in r["grid"]] for r in rows}


def _grid_of(g: dict[str, list[float]], feature: str):
    return F.array(*[F.lit(v) for v in g[feature]])


def _distinct_rest(base: DataFrame, features: Sequence[str], over: Sequence[str]) -> DataFrame:
    """The rows' distinct values of the features that are not overridden, and how many rows have them:
    all that a score at a grid point depends on."""
    rest = [f for f in features if f not in over]
    return base.groupBy(*rest).agg(F.count(F.lit(1)).alias("_n")).withColumns({f: F.lit(None).cast("double") for f in over})


def _weighted(col: str):
    return (F.sum(F.col(col) * F.col("_n")) / F.sum("_n")).alias("pd")


def pd_1d(base: DataFrame, features: Sequence[str], scorer, n: int = 40,
          q_low: float = 0.01, q_high: float = 0.99) -> DataFrame:
    """Mean predicted probability with one feature set to each grid
    value -> (feature, i, g, pd)."""
    g = grids(base, features, n, q_low, q_high)
    if hasattr(scorer, "partial_dependence"):
        return scorer.partial_dependence(base, {f: g[f] for f in features})
    out = None
    for f in features:
        rows = _distinct_rest(base, scorer.features, [f]).select("*", F.posexplode(_grid_of(g, f)).alias("i", "g"))
        s = scorer.score(rows, {f: F.col("g")})
        part = s.groupBy("i", "g").agg(_weighted("prob")) \
            .select(F.lit(f).alias("feature"), F.col("i").cast("int").alias("i"), "g", "pd")
        out = part if out is None else out.unionByName(part)
    return out


def pd_2d(base: DataFrame, feature_pairs: Sequence[tuple[str, str]], scorer, n: int = 25,
          q_low: float = 0.05, q_high: float = 0.95) -> DataFrame:
    """Surface per pair -> long (f1, f2, i1, i2, g1, g2, pd)."""
    feats = sorted({f for p in feature_pairs for f in p})
    g = grids(base, feats, n, q_low, q_high)
    if hasattr(scorer, "pair_dependence"):
        return scorer.pair_dependence(base, g, feature_pairs)
    out = None
    for f1, f2 in feature_pairs:
        rows = _distinct_rest(base, scorer.features, [f1, f2]).select("*", F.posexplode(_grid_of(g, f1)).alias("i1", "g1")) \
            .select("*", F.posexplode(_grid_of(g, f2)).alias("i2", "g2"))
        s = scorer.score(rows, {f1: F.col("g1"), f2: F.col("g2")})
        part = s.groupBy("i1", "i2", "g1", "g2").agg(_weighted("prob")).select(
            F.lit(f1).alias("f1"), F.lit(f2).alias("f2"), F.col("i1").cast("int").alias("i1"),
            F.col("i2").cast("int").alias("i2"), "g1", "g2", "pd")
        out = part if out is None else out.unionByName(part)
    return out


def gradient(curve: DataFrame, by: Sequence[str], x: str = "x", y: str = "y") -> DataFrame:
    """second-order gradient of y over an uneven grid (NumPy's rule),
    after collapsing repeated x values -> (by..., j, x, y, n, grad).  y is cut to
    9 decimals, so that a flat curve is flat in whatever order it was summed.

    Interior: ``(a^2 (y+ - y) + b^2 (y - y-)) / (a b (a + b))``; ends:
    one-sided differences.  The curve has a parameter-bounded number of
    points per group, so the windows here are small by construction.
    """
    by = list(by)
    d = curve.groupBy(*by, F.col(x).alias("x")).agg(F.round(F.min(y), 9).alias("y"))
    w = Window.partitionBy(*by).orderBy("x")
    d = d.select("*", (F.row_number().over(w) - 1).alias("j"),
                 F.count(F.lit(1)).over(Window.partitionBy(*by)).alias("n"),
                 F.lag("x").over(w).alias("xm"), F.lead("x").over(w).alias("xp"),
                 F.lag("y").over(w).alias("ym"), F.lead("y").over(w).alias("yp"))
    a = F.col("x") - F.col("xm")
    b = F.col("xp") - F.col("x")
    interior = (a * a * (F.col("yp") - F.col("y")) + b * b * (F.col("y") - F.col("ym"))) / (a * b * (a + b))
    grad = (F.when(F.col("n") < 2, F.lit(None).cast("double"))
             .when(F.col("j") == 0, (F.col("yp") - F.col("y")) / (F.col("xp") - F.col("x")))
             .when(F.col("j") == F.col("n") - 1, (F.col("y") - F.col("ym")) / (F.col("x") - F.col("xm")))
             .otherwise(interior))
    return d.select(*by, F.col("j").cast("int").alias("j"), "x", "y", "n", grad.alias("grad"))


def steepest(grad: DataFrame, by: Sequence[str]) -> DataFrame:
    """First arg-max of |grad| (lowest j on ties) -> (by..., j_star, x_star, y_star).
    Fewer than 3 distinct points -> medians of x and y."""
    by = list(by)
    w = Window.partitionBy(*by).orderBy(F.abs("grad").desc(), "j")
    top = grad.filter(F.col("n") >= 3).withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 1) \
        .select(*by, F.col("j").alias("j_star"), F.col("x").alias("x_star"), F.col("y").alias("y_star"))
    few = grad.filter(F.col("n") < 3).groupBy(*by).agg(
        F.lit(None).cast("int").alias("j_star"), F.median("x").alias("x_star"), F.median("y").alias("y_star"))
    return top.unionByName(few)


def detect_thresholds(pd_curve: DataFrame) -> DataFrame:
    """the steepest PD point and its two neighbours (clamped) ->
    (feature, x, pd, note); features with < 3 distinct points give no rows."""
    gr = gradient(pd_curve.withColumnRenamed("g", "x").withColumnRenamed("pd", "y"), ["feature"])
    st = steepest(gr, ["feature"]).filter(F.col("j_star").isNotNull())
    j = gr.join(st.select("feature", "j_star"), "feature")
    near = (F.col("j") >= F.col("j_star") - 1) & (F.col("j") <= F.col("j_star") + 1)
    return j.filter(near).select("feature", "x", F.col("y").alias("pd"),
                                 F.lit("slope_peak/edge").alias("note"))


def pair_delta(surface: DataFrame) -> DataFrame:
    """Range ``max - min`` of each surface."""
    return surface.groupBy("f1", "f2").agg((F.max("pd") - F.min("pd")).alias("delta"))


def pathways(delta: DataFrame) -> DataFrame:
    """Edge list weighted by the surface range, with the text form."""
    return delta.select(F.col("f1").alias("a"), F.col("f2").alias("b"), "delta",
                        F.format_string("%s -- %s : Δ=%.4f", "f1", "f2", "delta").alias("text"))


def _replicate_sums(replicates: int, frac: float, seed: int):
    """Per task: the weighted score sums of each replicate at each grid point; replicate -1 weighs all rows 1."""
    cdf = np.array(poisson_cdf(frac))
    salts = [f"{seed}|boot|{b}|".encode() for b in range(replicates)]

    def weights(keys: list[bytes]) -> np.ndarray:
        draw = b"".join(hashlib.md5(s + k).digest()[:8] for s in salts for k in keys)
        u = (np.frombuffer(draw, ">u8") >> np.uint64(12)).astype(float) / TWO_POW_52
        return np.searchsorted(cdf, u, side="left").reshape(replicates, len(keys)).astype(float)

    def rows(batches):
        num = den = None
        for b in batches:
            keys = [k.encode() for k in b.column(0).to_pylist()]
            if not keys:
                continue
            p = b.column(1).flatten().to_numpy().reshape(len(keys), -1)
            for lo in range(0, len(keys), 4096):
                part = p[lo:lo + 4096]
                w = np.vstack([np.ones((1, len(part))), weights(keys[lo:lo + 4096])])
                num = w @ part if num is None else num + w @ part
                den = w.sum(axis=1) if den is None else den + w.sum(axis=1)
        if num is not None:
            b, at = (x.ravel() for x in np.indices(num.shape))
            yield pa.RecordBatch.from_arrays([pa.array(b - 1, pa.int32()), pa.array(at, pa.int32()), pa.array(num.ravel()),
                                              pa.array(np.repeat(den, num.shape[1]))], ["b", "at", "num", "den"])
    return rows


def threshold_ci(base: DataFrame, features: Sequence[str], scorer, key: str, n: int = 40,
                 replicates: int = 200, frac: float = 0.8, seed: int = 42,
                 q_low: float = 0.01, q_high: float = 0.99) -> DataFrame:
    """PD threshold and its bootstrap 95 % interval in feature units and
    in quantiles -> (feature, thr_unit, thr_unit_lo, thr_unit_hi,
    thr_quantile, thr_q_lo, thr_q_hi, pd_at_thr).

    Each (row, grid point) is scored once; replicate b re-weights it with a
    Poisson(frac) draw ``w_rb`` (H7): ``PD_b(g) = sum w p / sum w``.  The plan is
    the same for any number of replicates.
    """
    g = grids(base, features, n, q_low, q_high)
    scores = scorer.with_grid(base, {f: g[f] for f in features}, "_scores").select(F.col(key).cast("string").alias("key"), "_scores")
    points = base.sparkSession.createDataFrame([(k, f, i, float(v)) for k, (f, i, v) in enumerate(
        (f, i, v) for f in features for i, v in enumerate(g[f]))], "at int, feature string, i int, g double")
    sums = scores.mapInArrow(_replicate_sums(replicates, frac, seed), "b int, at int, num double, den double") \
        .groupBy("b", "at").agg((F.sum("num") / F.sum("den")).alias("pd"))
    curves = sums.join(checked_broadcast(points, len(features) * n), "at").select("feature", "i", "g", "b", "pd")

    # features x (B + 1) x grid rows: small, and read by every branch below
    curves = cut_lineage(curves)
    gr = gradient(curves.withColumnRenamed("g", "x").withColumnRenamed("pd", "y"), ["feature", "b"])
    st = cut_lineage(steepest(gr, ["feature", "b"]))
    full = st.filter(F.col("b") == -1).select("feature", F.col("x_star").alias("thr_unit"),
                                              F.col("y_star").alias("pd_at_thr"))
    boots = st.filter(F.col("b") >= 0).select("feature", "b", F.col("x_star").alias("xb"))

    # ECDF of the base values at every threshold that occurs: grid points, so at most n + 1 a feature
    at = full.select("feature", F.col("thr_unit").alias("x")).unionByName(boots.select("feature", F.col("xb").alias("x"))).distinct()
    long = base.select(*features).unpivot([], list(features), "feature", "value")
    ecdf = long.join(checked_broadcast(at, len(features) * (n + 2)), "feature").groupBy("feature", "x") \
        .agg(F.avg(F.when(F.col("value") <= F.col("x"), 1.0).otherwise(0.0)).alias("q"))
    ecdf = cut_lineage(ecdf)
    ec = full.join(ecdf.withColumnRenamed("x", "thr_unit"), ["feature", "thr_unit"]).select("feature", F.col("q").alias("thr_quantile"))
    ec_long = boots.join(ecdf.withColumnRenamed("x", "xb"), ["feature", "xb"]).select("feature", F.col("q").alias("value"))
    # B values per feature (a parameter-sized table): the built-in exact percentile suffices
    q_ci = quantiles_long(ec_long.select("feature", "value"), [0.025, 0.975], by=["feature"],
                          method="percentile")
    x_ci = quantiles_long(boots.select("feature", F.col("xb").alias("value")), [0.025, 0.975],
                          by=["feature"], method="percentile")

    def wide2(t, lo, hi):
        return t.groupBy("feature").agg(F.max(F.when(F.col("q_idx") == 0, F.col("quantile"))).alias(lo),
                                        F.max(F.when(F.col("q_idx") == 1, F.col("quantile"))).alias(hi))
    return full.join(wide2(x_ci, "thr_unit_lo", "thr_unit_hi"), "feature", "left") \
        .join(ec.select("feature", "thr_quantile"), "feature", "left") \
        .join(wide2(q_ci, "thr_q_lo", "thr_q_hi"), "feature", "left") \
        .select("feature", "thr_unit", "thr_unit_lo", "thr_unit_hi", "thr_quantile", "thr_q_lo",
                "thr_q_hi", "pd_at_thr")


def permutation_importance(base: DataFrame, features: Sequence[str], scorer, key: str,
                           label: str = "label", repeats: int = 5, seed: int = 42) -> DataFrame:
    """Drop in average precision when one feature is shuffled, ``repeats``
    times -> (feature, importance_mean, importance_std) (population std).

    A repeat is one permutation for all features, as the usual implementation seeds
    each feature alike: the row at position i in key order takes each feature, one at
    a time, from the row at position ``bijection(i)``.  Rows are ordered once; a repeat
    costs one row per row in the shuffle that fetches donors.
    """
    feats = list(features)
    cols = list(dict.fromkeys([*scorer.features, *feats]))
    placed = cut_lineage(ordered(base.select(key, label, *cols), [(key, True)], sample_id=F.col(key))
                         .select((F.col("_rn") - 1).alias("pos"), label, *cols))
    total = placed.count()
    donors = placed.select(F.col("pos").alias("donor"), *[F.col(f).alias(f"_d_{f}") for f in feats])
    rows = placed.select("*", F.posexplode(donor_positions(F.col("pos"), total, seed, repeats)).alias("rep", "donor"))
    j = scorer.with_variants(rows.join(donors, "donor"), [{f: F.col(f"_d_{f}")} for f in feats], "_probs")
    names = F.array(*[F.lit(f) for f in feats])
    long = j.select("rep", label, F.posexplode("_probs").alias("_i", "prob")).withColumn("feature", F.get(names, F.col("_i")))
    # the order below reads its rows several times: scores are written once, by distinct value
    groups = cut_lineage(score_groups(long, "prob", label, ["feature", "rep"]))
    perm = auc_ap(groups, by=["feature", "rep"], grouped=True).select("feature", "rep", "average_precision")
    ref = auc_ap(cut_lineage(score_groups(scorer.score(base), "prob", label)), grouped=True).select(F.col("average_precision").alias("ap_base"))
    perm = perm.withColumn("ap_base", ref.select("ap_base").scalar())
    imp = perm.withColumn("imp", F.col("ap_base") - F.col("average_precision"))
    return imp.groupBy("feature").agg(F.avg("imp").alias("importance_mean"),
                                      F.stddev_pop("imp").alias("importance_std"))


def mean_abs(contrib: DataFrame) -> DataFrame:
    """Mean absolute contribution per feature, descending."""
    return contrib.groupBy("feature").agg(F.avg(F.abs("shap")).alias("mean_abs_shap")) \
        .orderBy(F.col("mean_abs_shap").desc(), "feature")


def top_features(importance: DataFrame, m: int, col: str = "mean_abs_shap") -> DataFrame:
    """The ``m`` most important features."""
    return importance.orderBy(F.col(col).desc(), "feature").limit(int(m))
