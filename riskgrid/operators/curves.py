"""Score-quality curves: ROC-AUC (D18), average precision (D19), Brier (D20),
ROC and PR points (D21, D22), reliability curve (D23), calibration table
(D24), tail summary (D25, F9), three-metric bundle (D30), base rate (D10)
and the empirical CDF (F8).

Rows are first grouped by distinct score (map-side partial aggregation);
cumulative counts down the score order come from ``ordered`` (bucketed
running sums), and neighbouring points are found by joining on rank +/- 1,
so no window ever spans a whole split in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskgrid.functions.exprs import guarded_div
from riskgrid.operators.stats import quantiles_long
from riskgrid.plans.ordering import ordered
from riskgrid.session import counted_broadcast


def score_groups(scored: DataFrame, prob: str = "prob", label: str = "label",
                 by: Sequence[str] = ()) -> DataFrame:
    """One row per (group, distinct score): n, pos."""
    return scored.groupBy(*by, F.col(prob).alias("prob")).agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.col(label).cast("long")), F.lit(0)).alias("pos"))


def cumulative(scored: DataFrame, prob: str = "prob", label: str = "label",
               by: Sequence[str] = (), descending: bool = True, grouped: bool = False) -> DataFrame:
    """Distinct scores with running ``K`` (rows) and ``TP`` (positives) down the
    score order, totals ``K_total``/``TP_total`` and position ``rn``.  ``grouped``: the rows are
    ``score_groups`` already (written once, where the scores cost more than a scan)."""
    g = scored if grouped else score_groups(scored, prob, label, by)
    return ordered(g, [("prob", not descending)], sums={"K": F.col("n"), "TP": F.col("pos")},
                   within=list(by), rn_col="rn")


def base_rate(scored: DataFrame, label: str = "label", by: Sequence[str] = ()) -> DataFrame:
    """Mean label."""
    return scored.groupBy(*by).agg(F.avg(F.col(label).cast("double")).alias("base_rate"))


def auc_ap(scored: DataFrame, prob: str = "prob", label: str = "label",
           by: Sequence[str] = (), grouped: bool = False) -> DataFrame:
    """D18 + D19: ROC-AUC (ties count one half) and step-wise average precision.

    AUC = sum pos ((N - (K - TP)) + (n - pos) / 2) / (P N); AP = sum (TP / K)(pos / P).
    """
    c = cumulative(scored, prob, label, by, grouped=grouped)
    P, N = F.col("TP_total"), F.col("K_total") - F.col("TP_total")
    neg_below = N - (F.col("K") - F.col("TP"))
    auc_term = F.col("pos") * (neg_below + (F.col("n") - F.col("pos")) / 2.0)
    ap_term = (F.col("TP") / F.col("K")) * F.col("pos")
    agg = c.groupBy(*by).agg(F.sum(auc_term).alias("_auc_sum"), F.sum(ap_term).alias("_ap_sum"),
                             F.max(P).alias("_pos_tot"), F.max(N).alias("_neg_tot"))
    return agg.select(*by, (F.col("_auc_sum") / (F.col("_pos_tot") * F.col("_neg_tot"))).alias("auc"),
                      (F.col("_ap_sum") / F.col("_pos_tot")).alias("average_precision"))


def brier(scored: DataFrame, prob: str = "prob", label: str = "label",
          by: Sequence[str] = ()) -> DataFrame:
    """Mean squared error of the probability."""
    return scored.groupBy(*by).agg(
        F.avg(F.pow(F.col(prob) - F.col(label).cast("double"), 2)).alias("brier"))


def metrics(scored: DataFrame, prob: str = "prob", label: str = "label",
            by: Sequence[str] = ()) -> DataFrame:
    """{AUC, PR_AUC (average precision), Brier} in one row per group."""
    a = auc_ap(scored, prob, label, by)
    b = brier(scored, prob, label, by)
    # without groups both sides are one row: key them by a constant
    on = list(by) or ["_all"]
    if not by:
        a, b = a.withColumn("_all", F.lit(1)), b.withColumn("_all", F.lit(1))
    return a.join(b, on).select(*by, F.col("auc").alias("AUC"),
                                      F.col("average_precision").alias("PR_AUC"),
                                      F.col("brier").alias("Brier"))


def roc_points(scored: DataFrame, prob: str = "prob", label: str = "label",
               by: Sequence[str] = (), drop_intermediate: bool = True) -> DataFrame:
    """(threshold, fpr, tpr) per distinct threshold, descending, with the
    (inf, 0, 0) start point; collinear interior points dropped by default."""
    by = list(by)
    c = cumulative(scored, prob, label, by).select(
        *by, "prob", "rn", (F.col("K") - F.col("TP")).alias("fps"), F.col("TP").alias("tps"),
        (F.col("K_total") - F.col("TP_total")).alias("N"), F.col("TP_total").alias("P"),
        F.col("rn_total").alias("m"))
    keep = F.lit(True)
    if drop_intermediate:
        prv = c.select(*by, (F.col("rn") + 1).alias("rn"), F.col("fps").alias("fps_prev"),
                       F.col("tps").alias("tps_prev"))
        nxt = c.select(*by, (F.col("rn") - 1).alias("rn"), F.col("fps").alias("fps_next"),
                       F.col("tps").alias("tps_next"))
        c = c.join(prv, [*by, "rn"], "left").join(nxt, [*by, "rn"], "left")
        d2f = F.col("fps_prev") - 2 * F.col("fps") + F.col("fps_next")
        d2t = F.col("tps_prev") - 2 * F.col("tps") + F.col("tps_next")
        keep = (F.col("rn") == 1) | (F.col("rn") == F.col("m")) | (d2f != 0) | (d2t != 0)
    pts = c.filter(keep).select(*by, F.col("prob").alias("threshold"),
                                guarded_div(F.col("fps"), F.col("N"), 1e-300).alias("fpr"),
                                guarded_div(F.col("tps"), F.col("P"), 1e-300).alias("tpr"))
    start = scored.select(*by).distinct().select(
        *by, F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return start.unionByName(pts)


def pr_points(scored: DataFrame, prob: str = "prob", label: str = "label",
              by: Sequence[str] = ()) -> DataFrame:
    """(threshold, precision, recall) per distinct threshold plus the
    (precision 1, recall 0) end point with a null threshold."""
    by = list(by)
    c = cumulative(scored, prob, label, by)
    recall = F.when(F.col("TP_total") == 0, F.lit(1.0)).otherwise(F.col("TP") / F.col("TP_total"))
    pts = c.select(*by, F.col("prob").alias("threshold"),
                   (F.col("TP") / F.col("K")).alias("precision"), recall.alias("recall"))
    end = scored.select(*by).distinct().select(
        *by, F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"))
    return pts.unionByName(end)


def _edges(scored: DataFrame, prob: str, n_bins: int, by: list[str]) -> DataFrame:
    long = scored.select(*by, F.col(prob).cast("double").alias("value")).filter(F.col("value").isNotNull())
    qt = quantiles_long(long, [i / n_bins for i in range(n_bins + 1)], by=by)
    return qt.groupBy(*by).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("q_idx", "quantile"))),
                    lambda s: s["quantile"]).alias("edges"),
        F.min("quantile").alias("mn"), F.max("quantile").alias("mx"))


def reliability(scored: DataFrame, prob: str = "prob", label: str = "label", n_bins: int = 20,
                by: Sequence[str] = ()) -> DataFrame:
    """Quantile-binned reliability curve; bin = number of interior edges
    strictly below p; empty bins are absent."""
    by = list(by)
    if not by:
        return reliability(scored.withColumn("_all", F.lit(1)), prob, label, n_bins, ["_all"]).drop("_all")
    e = _edges(scored, prob, n_bins, by).select(
        *by, F.slice("edges", 2, n_bins - 1).alias("inner"))
    j = scored.select(*by, prob, label).join(counted_broadcast(e), by)   # one row per group
    p = F.col(prob)
    b = F.size(F.filter("inner", lambda t: t < p))
    return j.groupBy(*by, b.alias("bin")).agg(
        F.avg(F.col(label).cast("double")).alias("prob_true"), F.avg(p).alias("prob_pred"),
        F.count(F.lit(1)).alias("n"))


def calibration_table(scored: DataFrame, prob: str = "prob", label: str = "label",
                      n_bins: int = 20, tail_q: float | None = None,
                      by: Sequence[str] = ()) -> DataFrame:
    """Per-bin n / pos / rate / mean_pred / lift over the full base rate.

    Optional tail cut ``p >= quantile(p, tail_q)`` first; edges are the
    distinct quantiles of the kept scores (or ``min(n_bins, 5)`` equal-width
    edges over [min, max + 1e-15] when at most 2 are distinct);
    ``bin = #interior edges <= p``; bins are labelled by bin id.
    """
    by = list(by)
    if not by:
        return calibration_table(scored.withColumn("_all", F.lit(1)), prob, label, n_bins, tail_q, ["_all"]).drop("_all")
    base = base_rate(scored, label, by)
    rows = scored.select(*by, F.col(prob).alias("_p"), F.col(label).alias("_y"))
    if tail_q is not None:
        cut = quantiles_long(rows.select(*by, F.col("_p").alias("value")), [tail_q], by=by) \
            .select(*by, F.col("quantile").alias("_cut"))
        rows = rows.join(counted_broadcast(cut), by).filter(F.col("_p") >= F.col("_cut")).drop("_cut")
    e = _edges(rows, "_p", n_bins, by)
    n_eq = min(n_bins, 5)
    eq = F.transform(F.sequence(F.lit(0), F.lit(n_eq - 1)),
                     lambda i: F.col("mn") + (F.col("mx") + F.lit(1e-15) - F.col("mn")) * i / F.lit(n_eq - 1))
    uniq = F.array_sort(F.array_distinct("edges"))
    e = e.select(*by, F.when(F.size(uniq) <= 2, eq).otherwise(uniq).alias("edges"))
    e = e.join(base, by)
    j = rows.join(counted_broadcast(e), by)
    inner = F.slice("edges", 2, F.size("edges") - 2)
    b = F.size(F.filter(inner, lambda t: t <= F.col("_p")))
    agg = j.groupBy(*by, b.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("_y").cast("long")).alias("pos"),
        F.avg(F.col("_y").cast("double")).alias("rate"), F.avg("_p").alias("mean_pred"),
        F.first("edges").alias("edges"), F.first("base_rate").alias("base_rate"))
    return agg.select(*by, "bin", F.element_at("edges", F.col("bin") + 1).alias("bin_low"),
                      F.element_at("edges", F.col("bin") + 2).alias("bin_high"),
                      "n", "pos", "rate", "mean_pred",
                      (F.col("rate") / (F.col("base_rate") + F.lit(1e-15))).alias("lift"))


def calibration_tail(scored: DataFrame, prob: str = "prob", label: str = "label",
                     tail_q: float = 0.99, n_bins: int = 12, by: Sequence[str] = ()) -> DataFrame:
    """D24 on the tail plus F9: ``q_axis = linspace(tail_q, 1, #bins)`` over
    the surviving bins in bin order."""
    by = list(by)
    if not by:
        return calibration_tail(scored.withColumn("_all", F.lit(1)), prob, label, tail_q, n_bins, ["_all"]).drop("_all")
    t = calibration_table(scored, prob, label, n_bins, tail_q, by)
    # at most n_bins rows per group: the window sees a parameter-bounded table
    w = Window.partitionBy(*by).orderBy("bin")
    out = t.select("*", F.row_number().over(w).alias("_idx"),
                   F.count(F.lit(1)).over(Window.partitionBy(*by)).alias("_nb"))
    qaxis = F.when(F.col("_nb") == 1, F.lit(tail_q)).otherwise(
        F.lit(tail_q) + (F.lit(1.0) - F.lit(tail_q)) * (F.col("_idx") - 1) / (F.col("_nb") - 1))
    return out.select(*t.columns, qaxis.alias("q_axis"))


def tail_summary(scored: DataFrame, prob: str = "prob", label: str = "label",
                 tail_q: float = 0.99, n_bins: int = 12, by: Sequence[str] = ()) -> DataFrame:
    """Base rate, tail quantile, number of tail bins, max lift."""
    by = list(by)
    if not by:
        return tail_summary(scored.withColumn("_all", F.lit(1)), prob, label, tail_q, n_bins, ["_all"]).drop("_all")
    t = calibration_table(scored, prob, label, n_bins, tail_q, by)
    s = t.groupBy(*by).agg(F.count(F.lit(1)).alias("n_bins_tail"),
                           F.max("lift").alias("max_lift_tail"))
    return base_rate(scored, label, by).join(s, by, "left").select(
        *by, F.col("base_rate").alias("baseline_rate"), F.lit(float(tail_q)).alias("tail_q"),
        F.coalesce(F.col("n_bins_tail"), F.lit(0)).cast("long").alias("n_bins_tail"),
        F.coalesce(F.col("max_lift_tail"), F.lit(0.0)).alias("max_lift_tail"))


def ecdf_curve(scored: DataFrame, value: str = "prob", by: Sequence[str] = ()) -> DataFrame:
    """F8: empirical CDF at every distinct value: share of rows ``<= v``."""
    by = list(by)
    g = scored.groupBy(*by, F.col(value).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    c = ordered(g, [("value", True)], sums={"cum": F.col("n")}, within=by)
    return c.select(*by, "value", (F.col("cum") / F.col("cum_total")).alias("cdf"))
