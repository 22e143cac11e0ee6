"""Ranking tables: cumulative gain (F1), precision/recall at k (F2), the global
operating table (F3, F3b), grouped top-k (F4), top-k row selection (G3, G4,
C6) and the k-th largest score (G6).

Every order is ``prob desc, key asc`` so ties break reproducibly.  Global
top-k is ``orderBy().limit()`` (``TakeOrderedAndProject``: each task keeps a
k-row heap).  Top-k per split or calibrator, few groups with many rows each, first
finds a score that at least k rows of the group reach (``reached_scores``) and drops
all rows below it; what ties leave over is cut to k rows per task group before the
groups meet, so no task gets k rows from every task.  Top-k of many small groups is
``row_number() <= k`` (``WindowGroupLimit``, which also runs map-side).  Totals come
from one aggregation over all rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskgrid.functions.exprs import guarded_div
from riskgrid.operators.stats import quantiles_long


def lookup(small: DataFrame, by: Sequence[str], values: Sequence[str]) -> Callable[[str], Column]:
    """Per-group parameters as a scalar subquery (no join, no cartesian product).

    ``small`` holds one row per ``by`` group, a bounded set (splits,
    calibrators); the subquery runs once and is inlined as a literal map.
    """
    by = list(by)
    val = F.struct(*[F.col(v) for v in values])
    if by:
        # a single key column is the map key itself (struct keys only when needed)
        def k(cols):
            return cols[0] if len(cols) == 1 else F.struct(*cols)
        known = small.filter(F.col(by[0]).isNotNull()) if len(by) == 1 else small  # a null group has no entry
        m = known.select(F.map_from_entries(F.collect_list(
            F.struct(k([F.col(c) for c in by]).alias("k"), val.alias("v"))))).scalar()
        s = F.element_at(m, k([F.col(c) for c in by]))
    else:
        s = small.select(val.alias("v")).scalar()
    return lambda name: s[name]


def order_desc(prob: str, key: str) -> list[Column]:
    return [F.col(prob).desc(), F.col(key).asc()]


def totals(scored: DataFrame, by: Sequence[str], label: str = "label") -> DataFrame:
    """n, positives (D9, D10) per group in one aggregation."""
    return scored.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.col(label).cast("long")), F.lit(0)).alias("pos"))


def top_rows(scored: DataFrame, k: int, prob: str = "prob", key: str = "key",
             by: Sequence[str] = ()) -> DataFrame:
    """The best ``k`` rows per group with their position ``rn`` (1-based)."""
    by = list(by)
    if not by:
        top = scored.orderBy(*order_desc(prob, key)).limit(int(k))
        # at most k rows: the window below is bounded by the parameter
        return top.withColumn("rn", F.row_number().over(Window.orderBy(*order_desc(prob, key))))
    best = prune_to_top(scored, k, prob, key, by)
    w = Window.partitionBy(*by).orderBy(*order_desc(prob, key))
    return best.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= int(k))


LADDER = 40  # candidate scores per group: its 1 - 2^-j quantiles
TASK_GROUPS = 64


def reached_scores(scored: DataFrame, k: int, prob: str, by: Sequence[str]) -> DataFrame:
    """(by..., reached): the highest candidate score that at least ``k`` rows of the group
    reach; no row for a group with fewer.

    Candidates are quantiles from a mergeable sketch, whose error only makes the
    candidate worse: the rows that reach each are counted."""
    by = list(by)
    ladder = [1 - 2.0 ** -j for j in range(LADDER)]
    cand = scored.groupBy(*by).agg(F.percentile_approx(F.col(prob).cast("double"), ladder, 10_000).alias("c"))
    get = lookup(cand, by, ["c"])
    hits = scored.groupBy(*by).agg(*[F.count_if(F.col(prob) >= F.element_at(get("c"), j + 1)).alias(f"_n{j}") for j in range(LADDER)],
                                   F.first(get("c")).alias("c"))
    ok = F.filter(F.array(*[F.struct(F.element_at("c", j + 1).alias("s"), F.col(f"_n{j}").alias("n")) for j in range(LADDER)]),
                  lambda x: x["n"] >= int(k))
    return hits.select(*by, F.array_max(F.transform(ok, lambda x: x["s"])).alias("reached"))


def prune_to_top(scored: DataFrame, k: int, prob: str, key: str, by: Sequence[str]) -> DataFrame:
    """Rows that hold the best ``k`` of every group and few others.  ``by`` is a bounded set of groups
    (splits, calibrators, grid points)."""
    by = list(by)
    get = lookup(reached_scores(scored, k, prob, by), by, ["reached"])
    reached = get("reached")
    near = scored.filter(reached.isNull() | (F.col(prob) >= reached))
    w = Window.partitionBy(*by, "_tg").orderBy(*order_desc(prob, key))
    return near.withColumn("_tg", F.spark_partition_id() % TASK_GROUPS).withColumn("_tr", F.row_number().over(w)) \
        .filter(F.col("_tr") <= int(k)).drop("_tg", "_tr")


def cum_gain(scored: DataFrame, k: int, prob: str = "prob", label: str = "label",
             key: str = "key", by: Sequence[str] = ()) -> DataFrame:
    """F1: running true positives down the score order, for the first ``k`` rows."""
    top = top_rows(scored, k, prob, key, by)
    w = Window.partitionBy(*by).orderBy("rn").rowsBetween(Window.unboundedPreceding, 0)
    first_tie = Window.partitionBy(*by, prob)
    return top.select(*by, key, prob, label, "rn",
                      F.sum(F.col(label).cast("long")).over(w).alias("cum_tp"),
                      F.min("rn").over(first_tie).alias("tie_first_rn"))


def _k_frame(scored: DataFrame, ks: Sequence[int], by: Sequence[str], label: str,
             prob: str, key: str) -> DataFrame:
    """(by..., k, kk, n, pos, tp, threshold, quantile) for each k."""
    by = list(by)
    kmax = max(int(k) for k in ks)
    gain = cum_gain(scored, kmax, prob, label, key, by)
    tot = totals(scored, by, label)
    ks_arr = F.array(*[F.lit(int(k)) for k in ks])
    per_k = tot.select(*by, "n", "pos", F.explode(ks_arr).alias("k")) \
        .withColumn("kk", F.least(F.col("k"), F.col("n")))
    a, g = per_k.alias("_a"), gain.alias("_g")
    cond = F.col("_a.kk") == F.col("_g.rn")
    for c in by:
        cond = cond & F.col(f"_a.{c}").eqNullSafe(F.col(f"_g.{c}"))
    j = a.join(g, cond, "left")
    has = F.col("_a.kk") > 0
    thr = F.when(has, F.col(f"_g.{prob}")).otherwise(F.lit(1.0))
    above = F.col("_g.tie_first_rn") - 1  # rows scored strictly above the threshold
    n = F.col("_a.n")
    q = F.when(has, guarded_div(n - above, n)).otherwise(F.lit(1.0))
    return j.select(*[F.col(f"_a.{c}").alias(c) for c in by],
                    *[F.col(f"_a.{c}").alias(c) for c in ("k", "kk", "n", "pos")],
                    F.coalesce(F.col("_g.cum_tp"), F.lit(0)).cast("long").alias("tp"),
                    thr.cast("double").alias("threshold"), q.cast("double").alias("quantile"))


def precision_recall_at_k(scored: DataFrame, ks: Sequence[int], prob: str = "prob",
                          label: str = "label", key: str = "key",
                          by: Sequence[str] = ()) -> DataFrame:
    """F2: precision = tp / max(kk, 1), recall = tp / max(P, 1), kk = min(k, n)."""
    f = _k_frame(scored, ks, by, label, prob, key)
    return f.select(*by, "k", "kk", "tp",
                    guarded_div(F.col("tp"), F.col("kk")).alias("precision"),
                    guarded_div(F.col("tp"), F.col("pos")).alias("recall"))


def topk_by_k(scored: DataFrame, ks: Sequence[int], prob: str = "prob", label: str = "label",
              key: str = "key", by: Sequence[str] = ("split",)) -> DataFrame:
    """F3, k rows: type, k_or_q, precision, recall, tp, fp, fn, threshold, quantile."""
    f = _k_frame(scored, ks, by, label, prob, key)
    return f.select(F.lit("k").alias("type"), *by, F.col("k").cast("double").alias("k_or_q"),
                    guarded_div(F.col("tp"), F.col("kk")).alias("precision"),
                    guarded_div(F.col("tp"), F.col("pos")).alias("recall"),
                    F.col("tp"), (F.col("kk") - F.col("tp")).alias("fp"),
                    (F.greatest(F.col("pos"), F.lit(1)) - F.col("tp")).alias("fn"),
                    "threshold", "quantile")


def topk_by_quantile(scored: DataFrame, qs: Sequence[float], prob: str = "prob",
                     label: str = "label", by: Sequence[str] = ("split",),
                     method: str = "exact") -> DataFrame:
    """F3, quantile rows: alert every row with ``prob >= quantile(prob, q)``.

    Thresholds are exact linear quantiles per group; the alert counts for all
    q are conditional sums of a single pass over the rows.
    """
    by = list(by)
    long = scored.select(*by, F.col(prob).cast("double").alias("value")) \
        .filter(F.col("value").isNotNull())
    qt = quantiles_long(long, qs, by=by, method=method)
    thr_tab = qt.groupBy(*by).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("q_idx", "quantile"))),
                    lambda s: s["quantile"]).alias("thr"))
    get = lookup(thr_tab, by, ["thr"])
    thr = get("thr")
    aggs = [F.count(F.lit(1)).alias("n"),
            F.coalesce(F.sum(F.col(label).cast("long")), F.lit(0)).alias("pos")]
    for i in range(len(qs)):
        hit = F.col(prob) >= F.element_at(thr, i + 1)
        aggs += [F.sum(F.when(hit, 1).otherwise(0)).alias(f"_a{i}"),
                 F.sum(F.when(hit, F.col(label).cast("long")).otherwise(0)).alias(f"_t{i}"),
                 F.max(F.element_at(thr, i + 1)).alias(f"_h{i}")]
    wide = scored.groupBy(*by).agg(*aggs)
    rows = F.array(*[F.struct(F.lit(float(q)).alias("q"), F.col(f"_a{i}").cast("long").alias("alerts"),
                              F.col(f"_t{i}").cast("long").alias("tp"),
                              F.col(f"_h{i}").alias("threshold")) for i, q in enumerate(qs)])
    long_rows = wide.select(*by, "n", "pos", F.inline(rows))
    return long_rows.select(
        F.lit("quantile").alias("type"), *by, F.col("q").alias("k_or_q"),
        guarded_div(F.col("tp"), F.col("alerts")).alias("precision"),
        guarded_div(F.col("tp"), F.col("pos")).alias("recall"),
        F.col("tp"), (F.col("alerts") - F.col("tp")).alias("fp"),
        (F.greatest(F.col("pos"), F.lit(1)) - F.col("tp")).alias("fn"),
        F.col("threshold").cast("double").alias("threshold"), F.col("q").alias("quantile"))


def topk_global(scored: DataFrame, ks: Sequence[int], qs: Sequence[float], prob: str = "prob",
                label: str = "label", key: str = "key", by: Sequence[str] = ("split",)) -> DataFrame:
    """the k rows and the quantile rows of the operating table, stacked."""
    return topk_by_k(scored, ks, prob, label, key, by).unionByName(
        topk_by_quantile(scored, qs, prob, label, by))


def topk_lift(scored: DataFrame, ks: Sequence[int], prob: str = "prob", label: str = "label",
              key: str = "key", by: Sequence[str] = ("split",)) -> DataFrame:
    """Evaluator variant; ``k`` holds the clamped k, plus lift and base rate."""
    f = _k_frame(scored, ks, by, label, prob, key)
    base = guarded_div(F.col("pos"), F.col("n"))
    prec = guarded_div(F.col("tp"), F.col("kk"))
    return f.select(*by, F.col("kk").alias("k"), "tp", (F.col("kk") - F.col("tp")).alias("fp"),
                    prec.alias("precision"), guarded_div(F.col("tp"), F.col("pos")).alias("recall"),
                    (prec / F.greatest(base, F.lit(1e-12))).alias("lift"),
                    "threshold", base.alias("base_rate"))


def topk_grouped(scored: DataFrame, groupby: Sequence[str], ks: Sequence[int],
                 prob: str = "prob", label: str = "label", key: str = "key",
                 by: Sequence[str] = ("split",)) -> DataFrame:
    """best k rows of every group (null group kept), pooled per k.

    B12: grouping columns must exist (raises, unlike a silent skip).
    """
    missing = [c for c in groupby if c not in scored.columns]
    if missing:
        raise KeyError(f"group columns not found: {missing}")
    by = list(by)
    kmax = max(int(k) for k in ks)
    w = Window.partitionBy(*by, *groupby).orderBy(*order_desc(prob, key))
    limited = scored.select(*by, *groupby, prob, key, label) \
        .withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= kmax)
    aggs = []
    for i, k in enumerate(ks):
        inside = F.col("_rn") <= int(k)
        aggs += [F.sum(F.when(inside, 1).otherwise(0)).alias(f"_a{i}"),
                 F.sum(F.when(inside, F.col(label).cast("long")).otherwise(0)).alias(f"_t{i}")]
    wide = limited.groupBy(*by).agg(*aggs)
    get = lookup(totals(scored, by, label), by, ["pos"])
    rows = F.array(*[F.struct(F.lit(int(k)).alias("k_per_group"),
                              F.col(f"_a{i}").cast("long").alias("alerts"),
                              F.col(f"_t{i}").cast("long").alias("tp")) for i, k in enumerate(ks)])
    out = wide.select(*by, F.inline(rows)).withColumn("_pos", get("pos"))
    return out.select(*by, F.lit("+".join(groupby)).alias("groupby"), "k_per_group", "alerts", "tp",
                      (F.col("alerts") - F.col("tp")).alias("fp"),
                      (F.col("_pos") - F.col("tp")).alias("fn"),
                      guarded_div(F.col("tp"), F.col("alerts")).alias("precision"),
                      guarded_div(F.col("tp"), F.col("_pos")).alias("recall"))


def kth_largest(scored: DataFrame, k: int, prob: str = "prob", key: str = "key",
                by: Sequence[str] = ()) -> DataFrame:
    """The k-th largest score (k clamped to n) and its ECDF position."""
    f = _k_frame(scored.withColumn("_nolabel", F.lit(0)), [k], by, "_nolabel", prob, key)
    return f.select(*by, F.col("kk").alias("k"), F.col("threshold").alias("threshold_equiv"),
                    F.col("quantile").alias("q_equiv"))


def select_rows(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in ``keys`` (left semi join, no duplication)."""
    return df.join(keys.select(key), on=key, how="left_semi")
