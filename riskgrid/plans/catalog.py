"""Registered queries: one DataFrame per operator of the inventory.

Each entry takes ``(spark, sf_dir)``, reads the driver tables under
``sf_dir`` and returns a lazy DataFrame whose columns are named exactly like
the DuckDB twin in ``riskgrid.plans.oracle``.  Doubles are rounded to 6 dp
and counts cast to bigint so both engines hash alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskgrid.functions.exprs import date_key
from riskgrid.operators import clean, ranking
from riskgrid.operators.split import split_summary
from riskgrid.plans import base as B
from riskgrid.session import checked_broadcast
from riskgrid.sources.fixtures import KEY, obs

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def r6(df: DataFrame) -> DataFrame:
    """Round every double column to 6 dp (engine-neutral comparison)."""
    return df.select(*[F.round(F.col(f.name), 6).alias(f.name)
                       if f.dataType.typeName() in ("double", "float") else F.col(f.name)
                       for f in df.schema.fields])


# ---------------------------------------------------------------- cleaning
@register("clean_bounds")
def q_clean_bounds(spark, sf):
    return clean.bounds(obs(spark, sf)).select(KEY, "grid_id", "lon", "lat")


@register("clean_dedup")
def q_clean_dedup(spark, sf):
    o = obs(spark, sf)
    doubled = o.unionByName(o)
    return clean.dedup(doubled).select(KEY, "grid_id", "label")


@register("calendar_parts")
def q_calendar_parts(spark, sf):
    cal = clean.calendar(obs(spark, sf))
    return cal.groupBy(date_key("valid_date").alias("valid_date"), "year", "month", "doy",
                       "week", "quarter").agg(F.count(F.lit(1)).alias("n"))


@register("clean_season")
def q_clean_season(spark, sf):
    return B.clean_obs(spark, sf).select(KEY, date_key("valid_date").alias("valid_date"), "month")


# ---------------------------------------------------------------- split
@register("time_split_counts")
def q_time_split_counts(spark, sf):
    return split_summary(B.split_obs(spark, sf))


@register("time_split_rows")
def q_time_split_rows(spark, sf):
    return B.split_obs(spark, sf).select(KEY, "split", F.col("split_rn").cast("long").alias("rn"))


# ---------------------------------------------------------------- ranking
@register("topk_grouped")
def q_topk_grouped(spark, sf):
    t = ranking.topk_grouped(B.scored_eval(spark, sf), list(B.GROUP_BY), B.GROUP_KS,
                             key=KEY, by=["split"])
    return r6(t)


@register("precision_recall_at_k")
def q_precision_recall_at_k(spark, sf):
    return r6(ranking.precision_recall_at_k(B.scored_eval(spark, sf), B.KS, key=KEY, by=["split"]))


@register("topk_global_k")
def q_topk_global_k(spark, sf):
    return r6(ranking.topk_by_k(B.scored_eval(spark, sf), B.KS, key=KEY, by=["split"]))


@register("topk_global_quantile")
def q_topk_global_quantile(spark, sf):
    return r6(ranking.topk_by_quantile(B.scored_eval(spark, sf), B.QS, by=["split"]))


@register("topk_lift")
def q_topk_lift(spark, sf):
    return r6(ranking.topk_lift(B.scored_eval(spark, sf), B.KS, key=KEY, by=["split"]))


# ---------------------------------------------------------------- quality
from riskgrid.operators import quality  # noqa: E402
from riskgrid.sources.fixtures import FEATURES  # noqa: E402


@register("missing_report")
def q_missing_report(spark, sf):
    return r6(quality.missing_report(obs(spark, sf)))


@register("describe_features")
def q_describe_features(spark, sf):
    return r6(quality.describe(B.clean_obs(spark, sf), FEATURES))


@register("class_balance")
def q_class_balance(spark, sf):
    return quality.class_balance(B.split_obs(spark, sf), "label", by=["split"])


@register("feature_histogram")
def q_feature_histogram(spark, sf):
    return r6(quality.histogram(B.clean_obs(spark, sf), FEATURES, B.HIST_BINS))


@register("log_histogram")
def q_log_histogram(spark, sf):
    return r6(quality.histogram(B.scored_eval(spark, sf), ["prob"], B.HIST_BINS, by=["split"],
                                clip_to=(1e-12, 1.0)))


@register("box_stats")
def q_box_stats(spark, sf):
    return r6(quality.box_stats(B.clean_obs(spark, sf), FEATURES))


@register("stratified_density")
def q_stratified_density(spark, sf):
    val = B.scored(spark, sf).filter(F.col("split") == "val")
    return r6(quality.stratified_density(val, FEATURES, "label", bins=20))


# ---------------------------------------------------------------- features
from riskgrid.operators import features  # noqa: E402

_FOUT = [KEY, *FEATURES]


@register("impute_global")
def q_impute_global(spark, sf):
    return r6(features.impute(B.clean_obs(spark, sf), FEATURES).select(*_FOUT))


@register("impute_monthwise")
def q_impute_monthwise(spark, sf):
    return r6(features.impute(B.clean_obs(spark, sf), FEATURES, monthwise=True).select(*_FOUT))


@register("month_dummies")
def q_month_dummies(spark, sf):
    d = features.add_month_dummies(B.clean_obs(spark, sf), B.KEEP_MONTHS)
    return d.select(KEY, "month", *[f"mon_{m:02d}" for m in B.KEEP_MONTHS])


@register("scale_minmax")
def q_scale_minmax(spark, sf):
    return r6(features.scale(B.clean_obs(spark, sf), FEATURES, "minmax").select(*_FOUT))


@register("scale_standard")
def q_scale_standard(spark, sf):
    return r6(features.scale(B.clean_obs(spark, sf), FEATURES, "standard").select(*_FOUT))


@register("scale_robust")
def q_scale_robust(spark, sf):
    return r6(features.scale(B.clean_obs(spark, sf), FEATURES, "robust").select(*_FOUT))


@register("prepared_features")
def q_prepared_features(spark, sf):
    p = features.prepare(B.clean_obs(spark, sf), FEATURES, B.KEEP_MONTHS, "minmax")
    return r6(p.select(*_FOUT, *[f"mon_{m:02d}" for m in B.KEEP_MONTHS]))


@register("class_weight")
def q_class_weight(spark, sf):
    return r6(features.class_weight(B.split_obs(spark, sf), "label", by=["split"]))


# ---------------------------------------------------------------- policy
from riskgrid.operators import curves, policy, stats  # noqa: E402
from riskgrid.functions.exprs import linspace  # noqa: E402


def _val(spark, sf):
    return B.scored(spark, sf).filter(F.col("split") == "val")


@register("policy_derive")
def q_policy_derive(spark, sf):
    return r6(policy.derive(_val(spark, sf), B.PRIMARY_Q, B.ANCHOR_K, key=KEY))


@register("policy_apply")
def q_policy_apply(spark, sf):
    pol = policy.derive(_val(spark, sf), B.PRIMARY_Q, B.ANCHOR_K, key=KEY)
    test = B.scored(spark, sf).filter(F.col("split") == "test")
    q = policy.apply(test, pol, key=KEY, mode="quantile").select(F.lit("quantile").alias("mode"), KEY, "prob", "label")
    t = policy.apply(test, pol, key=KEY, mode="topk").select(F.lit("topk").alias("mode"), KEY, "prob", "label")
    return r6(q.unionByName(t))


@register("anchor_threshold")
def q_anchor_threshold(spark, sf):
    return r6(ranking.kth_largest(B.scored_eval(spark, sf), B.ANCHOR_K, key=KEY, by=["split"]))


@register("quantile_grid")
def q_quantile_grid(spark, sf):
    qs = linspace(0.01, 0.99, B.PD_GRID)
    return r6(stats.quantiles(B.clean_obs(spark, sf), FEATURES, qs)
              .withColumn("q_idx", F.col("q_idx").cast("int")))


@register("ecdf_at")
def q_ecdf_at(spark, sf):
    """Share of each feature's rows at or below the feature mean."""
    df = B.clean_obs(spark, sf)
    long = stats.to_long(df, FEATURES, finite_only=False)
    means = long.groupBy("feature").agg(F.avg("value").alias("mean"))
    j = long.join(checked_broadcast(means, len(FEATURES)), "feature")
    return r6(stats.ecdf_at(j, "value", F.col("mean"), by=["feature"]))


# ---------------------------------------------------------------- curves
@register("auc")
def q_auc(spark, sf):
    return r6(curves.auc_ap(B.scored_eval(spark, sf), by=["split"]).select("split", "auc"))


@register("average_precision")
def q_average_precision(spark, sf):
    return r6(curves.auc_ap(B.scored_eval(spark, sf), by=["split"]).select("split", "average_precision"))


@register("brier")
def q_brier(spark, sf):
    return r6(curves.brier(B.scored_eval(spark, sf), by=["split"]))


@register("metrics_bundle")
def q_metrics_bundle(spark, sf):
    return r6(curves.metrics(B.scored_eval(spark, sf), by=["split"]))


@register("roc_points")
def q_roc_points(spark, sf):
    return r6(curves.roc_points(B.scored_eval(spark, sf), by=["split"]))


@register("pr_points")
def q_pr_points(spark, sf):
    return r6(curves.pr_points(B.scored_eval(spark, sf), by=["split"]))


@register("reliability_curve")
def q_reliability_curve(spark, sf):
    return r6(curves.reliability(B.scored_eval(spark, sf), n_bins=B.CAL_BINS, by=["split"]))


@register("calibration_table")
def q_calibration_table(spark, sf):
    return r6(curves.calibration_table(B.scored_eval(spark, sf), n_bins=B.CAL_BINS, by=["split"]))


@register("calibration_tail")
def q_calibration_tail(spark, sf):
    return r6(curves.calibration_tail(B.scored_eval(spark, sf), tail_q=B.TAIL_Q,
                                      n_bins=B.TAIL_BINS, by=["split"]))


@register("tail_summary")
def q_tail_summary(spark, sf):
    return r6(curves.tail_summary(B.scored_eval(spark, sf), tail_q=B.TAIL_Q,
                                  n_bins=B.TAIL_BINS, by=["split"]))


@register("ecdf_curve")
def q_ecdf_curve(spark, sf):
    return r6(curves.ecdf_curve(B.scored_eval(spark, sf), "prob", by=["split"]))


# ---------------------------------------------------------------- sampling
from riskgrid.operators import sampling  # noqa: E402


@register("sample_n")
def q_sample_n(spark, sf):
    return sampling.sample_n(B.clean_obs(spark, sf), B.SAMPLE_N, B.SEED, KEY).select(KEY)


@register("downsample")
def q_downsample(spark, sf):
    train = B.split_obs(spark, sf).filter(F.col("split") == "train")
    return sampling.downsample(train, "label", B.BALANCE_N, B.SEED, KEY).select(KEY, "label")


@register("oversample")
def q_oversample(spark, sf):
    train = B.split_obs(spark, sf).filter((F.col("split") == "train") & (F.col("label") == 1))
    return sampling.oversample(train.select(KEY), B.BALANCE_N, B.SEED, KEY).select("j", KEY)


@register("smote_knn")
def q_smote_knn(spark, sf):
    return r6(sampling.knn(B.train_positives(spark, sf), B.KNN_FEATURES, KEY, B.KNN_K))


@register("smote_rows")
def q_smote_rows(spark, sf):
    return r6(sampling.smote(B.train_positives(spark, sf), B.KNN_FEATURES, B.BALANCE_N, B.SEED,
                             KEY, B.KNN_K))


@register("balance_counts")
def q_balance_counts(spark, sf):
    p = B.prepared_split(spark, sf).filter(F.col("split") == "train")
    bal = sampling.balance(p, B.KNN_FEATURES, "label", B.BALANCE_N, B.SEED, KEY, k=B.KNN_K)
    return bal.groupBy("label", "synthetic").agg(F.count(F.lit(1)).alias("count"))


# ---------------------------------------------------------------- explain
from riskgrid.operators import explain  # noqa: E402
from riskgrid.session import stage_table  # noqa: E402


def _pd1(spark, sf):
    return stage_table(spark, "pd_curves", sf, lambda: explain.pd_1d(B.pd_base(spark, sf), B.PD_FEATURES, B.pd_scorer(), n=B.PD_GRID))


@register("pd_1d")
def q_pd_1d(spark, sf):
    return r6(_pd1(spark, sf))


@register("pd_gradient")
def q_pd_gradient(spark, sf):
    g = explain.gradient(_pd1(spark, sf).withColumnRenamed("g", "x").withColumnRenamed("pd", "y"), ["feature"])
    return r6(g.select("feature", "j", "x", F.col("y").alias("pd"), "grad"))


@register("detect_thresholds")
def q_detect_thresholds(spark, sf):
    return r6(explain.detect_thresholds(_pd1(spark, sf)))


def _pd2(spark, sf):
    return stage_table(spark, "pd_surfaces", sf, lambda: explain.pd_2d(B.pd_base(spark, sf), explain.pairs(B.PD_FEATURES), B.pd_scorer(),
                                                                       n=B.PD2_GRID))


@register("pd_2d")
def q_pd_2d(spark, sf):
    return r6(_pd2(spark, sf))


@register("pair_delta")
def q_pair_delta(spark, sf):
    return r6(explain.pair_delta(_pd2(spark, sf)))


@register("pathways")
def q_pathways(spark, sf):
    return r6(explain.pathways(explain.pair_delta(_pd2(spark, sf))))


@register("bootstrap_threshold_ci")
def q_bootstrap_threshold_ci(spark, sf):
    return r6(explain.threshold_ci(B.pd_base(spark, sf), B.PD_FEATURES, B.pd_scorer(), KEY,
                                   n=B.PD_GRID, replicates=B.BOOT_B, frac=B.BOOT_FRAC, seed=B.SEED))


@register("permutation_importance")
def q_permutation_importance(spark, sf):
    return r6(explain.permutation_importance(B.pd_base(spark, sf), B.PD_FEATURES, B.pd_scorer(), KEY,
                                             repeats=B.PERM_REPEATS, seed=B.SEED))


# ---------------------------------------------------------------- models (rows-only checks)
from riskgrid.operators import model as M  # noqa: E402


def _cal(spark, sf):
    m, mf = B.fitted_model(spark, sf)
    # scored once, read by every metric / policy branch
    return stage_table(spark, "calibrated", sf, lambda: M.calibrated_scores(
        m, mf.filter(F.col("split") == "val"), mf.filter(F.col("split") == "test"), B.KNN_FEATURES))


@register("gbt_scores")
def q_gbt_scores(spark, sf):
    m, mf = B.fitted_model(spark, sf)
    ev = mf.filter(F.col("split").isin(*B.EVAL_SPLITS))
    return r6(M.score(m, ev, B.KNN_FEATURES).select(KEY, "split", "label", "prob"))


@register("isotonic_calibrated")
def q_isotonic_calibrated(spark, sf):
    return r6(_cal(spark, sf).filter(F.col("calibrator") == "iso").select(KEY, "split", "label", "prob"))


@register("sigmoid_calibrated")
def q_sigmoid_calibrated(spark, sf):
    return r6(_cal(spark, sf).filter(F.col("calibrator") == "sig").select(KEY, "split", "label", "prob"))


@register("model_metrics")
def q_model_metrics(spark, sf):
    mets, _ = M.evaluate(_cal(spark, sf), B.KS, KEY)
    return r6(mets)


def _shap(spark, sf):
    m, mf = B.fitted_model(spark, sf)
    val = mf.filter(F.col("split") == "val")
    return M.tree_contributions(val, m, B.KNN_FEATURES, KEY)


@register("tree_shap")
def q_tree_shap(spark, sf):
    return r6(_shap(spark, sf))


@register("shap_importance")
def q_shap_importance(spark, sf):
    return r6(explain.mean_abs(_shap(spark, sf).filter(F.col("feature") != "__base__")))


def _explained(spark, sf):
    """The fitted model as a scorer and the validation rows it explains."""
    from riskgrid.functions.scorer import TreeScorer
    m, mf = B.fitted_model(spark, sf)
    return mf.filter(F.col("split") == "val"), TreeScorer(m, B.KNN_FEATURES)


@register("pd_1d_model")
def q_pd_1d_model(spark, sf):
    val, scorer = _explained(spark, sf)
    return r6(explain.pd_1d(val, FEATURES, scorer, n=B.PD_GRID))


@register("pd_2d_model")
def q_pd_2d_model(spark, sf):
    val, scorer = _explained(spark, sf)
    return r6(explain.pd_2d(val, explain.pairs(FEATURES), scorer, n=B.PD2_GRID))


@register("bootstrap_model")
def q_bootstrap_model(spark, sf):
    """J11 on the fitted model."""
    val, scorer = _explained(spark, sf)
    return r6(explain.threshold_ci(val, FEATURES, scorer, KEY, n=B.PD_GRID, replicates=B.BOOT_B, frac=B.BOOT_FRAC, seed=B.SEED))


@register("permutation_model")
def q_permutation_model(spark, sf):
    val, scorer = _explained(spark, sf)
    return r6(explain.permutation_importance(val, FEATURES, scorer, KEY, repeats=B.PERM_REPEATS, seed=B.SEED))


@register("grid_select")
def q_grid_select(spark, sf):
    return r6(B.selected_model(spark, sf)[0])


def _selected_scores(spark, sf):
    _, m, mf = B.selected_model(spark, sf)
    return stage_table(spark, "selected", sf, lambda: M.calibrated_scores(
        m, mf.filter(F.col("split") == "val"), mf.filter(F.col("split") == "test"), B.KNN_FEATURES))


@register("selected_precision")
def q_selected_precision(spark, sf):
    """Precision and recall at each k of both calibrators of the grid's winner."""
    return r6(M.evaluate(_selected_scores(spark, sf), B.KS, KEY)[1])


@register("fit_report")
def q_fit_report(spark, sf):
    from riskgrid.plans.workflow import fit_report
    _, m, mf = B.selected_model(spark, sf)
    cal = _selected_scores(spark, sf)
    val_iso = cal.filter((F.col("calibrator") == "iso") & (F.col("split") == "val"))
    pol = policy.derive(val_iso, B.PRIMARY_Q, B.ANCHOR_K, key=KEY, clip_floor=1e-15)
    method, importance = M.explain_importance(mf.filter(F.col("split") == "val"), m, B.KNN_FEATURES, KEY)
    report = fit_report(cal, pol, method, explain.top_features(importance, 10), B.TAIL_Q, B.TAIL_BINS)
    point = report.select("*", "operating_point.*").drop("operating_point")
    return r6(point.withColumn("top", F.array_join("top", ",")))
