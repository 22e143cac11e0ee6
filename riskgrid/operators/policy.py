"""Operating policy: derive (J12), apply (J13) and the threshold predicate
(B13).  The policy is a one-row table: primary quantile threshold on the
validation scores, a fixed top-k fallback, and the k-anchor's equivalent
threshold and quantile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskgrid.operators.ranking import kth_largest, lookup, order_desc
from riskgrid.operators.stats import quantiles_long


def flag(prob: str | Column, threshold: Column | float) -> Column:
    """Alert predicate ``prob >= threshold``."""
    p = F.col(prob) if isinstance(prob, str) else prob
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return p >= t


def derive(val_scored: DataFrame, primary_q: float = 0.999, anchor_k: int = 1000,
           prob: str = "prob", key: str = "key", clip_floor: float | None = None) -> DataFrame:
    """One row ``primary_mode, primary_q, backup_threshold, fallback_mode,
    fallback_k, anchor_k, anchor_q_equiv, anchor_threshold_equiv``.

    ``clip_floor`` clips scores from below before the quantile (the evaluator
    variant clips at 1e-15)."""
    p = F.col(prob).cast("double")
    if clip_floor is not None:
        p = F.greatest(p, F.lit(float(clip_floor)))
    q = quantiles_long(val_scored.select(p.alias("value")), [primary_q]) \
        .select(F.col("quantile").alias("backup_threshold"))
    a = kth_largest(val_scored, anchor_k, prob, key)
    get_q = lookup(q, [], ["backup_threshold"])
    return a.select(
        F.lit("quantile").alias("primary_mode"), F.lit(float(primary_q)).alias("primary_q"),
        get_q("backup_threshold").alias("backup_threshold"),
        F.lit("topk").alias("fallback_mode"), F.lit(int(anchor_k)).alias("fallback_k"),
        F.col("k").alias("anchor_k"), F.col("q_equiv").alias("anchor_q_equiv"),
        F.col("threshold_equiv").alias("anchor_threshold_equiv"))


def apply(scored: DataFrame, policy: DataFrame, prob: str = "prob", key: str = "key",
          mode: str = "quantile") -> DataFrame:
    """The alert rows under a policy row: ``prob >= backup_threshold``
    (quantile mode, one pass) or the best ``fallback_k`` rows (top-k mode)."""
    if mode == "quantile":
        thr = lookup(policy, [], ["backup_threshold"])("backup_threshold")
        return scored.filter(flag(prob, thr))
    if mode == "topk":
        k = policy.select("fallback_k").first()[0]   # one integer parameter
        return scored.orderBy(*order_desc(prob, key)).limit(int(k))
    raise ValueError(mode)
