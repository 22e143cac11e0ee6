"""Data-quality reports: missing report (D1), describe (D2), class balance
(D5), equal-width histograms (D14, D15), box statistics (D16), quantile-edge
stratified density (D17), the finite filter (B14) and the profile bundle
(J17).  Every report is one or two aggregations over the whole table; only
per-feature parameters (min/max, edges) travel as scalar subqueries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgrid.functions.exprs import clip, finite
from riskgrid.operators.ranking import lookup
from riskgrid.operators.stats import quantiles_long, to_long
from riskgrid.session import checked_broadcast, counted_broadcast


def finite_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows whose ``cols`` are all finite (not null, NaN or infinite)."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & finite(c)
    return df.filter(cond)


def missing_report(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per column null count and rate (0.0 on an empty table), rate desc.

    One aggregation pass with a ``count_if`` per column, then an unpivot.
    """
    cols = list(cols or df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("_n"),
                  *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_m{i}") for i, c in enumerate(cols)])
    stacked = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_m{i}").cast("long").alias("missing_count"))
                        for i, c in enumerate(cols)])
    out = wide.select("_n", F.inline(stacked))
    rate = F.when(F.col("_n") == 0, F.lit(0.0)).otherwise(F.col("missing_count") / F.col("_n"))
    return out.select("column", "missing_count", rate.alias("missing_rate")) \
        .orderBy(F.col("missing_rate").desc(), "column")


def describe(df: DataFrame, features: Sequence[str], interpolation: str = "nearest",
             by: Sequence[str] = ()) -> DataFrame:
    """Count, null_count, mean, std (sample), min, 25/50/75 %, max per feature.

    Quartiles use ``nearest`` rank by default (value at ``round(q (n-1))``),
    ``linear`` on request; both exact via ``quantiles_long``.
    """
    by = list(by)
    raw = to_long(df, features, by, finite_only=False)
    moments = raw.groupBy(*by, "feature").agg(
        F.count("value").alias("count"),
        F.count_if(F.col("value").isNull()).alias("null_count"),
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    qt = quantiles_long(raw.filter(F.col("value").isNotNull()), [0.25, 0.5, 0.75],
                        by=[*by, "feature"], interpolation=interpolation)
    qw = qt.groupBy(*by, "feature").agg(
        *[F.max(F.when(F.col("q_idx") == i, F.col("quantile"))).alias(n)
          for i, n in enumerate(["q25", "q50", "q75"])])
    return moments.join(qw, [*by, "feature"], "left").select(
        *by, "feature", "count", "null_count", "mean", "std", "min", "q25", "q50", "q75", "max")


def class_balance(df: DataFrame, target: str = "label", by: Sequence[str] = ()) -> DataFrame:
    """Row count per class (nulls kept as a class), ordered by class."""
    return df.groupBy(*by, target).agg(F.count(F.lit(1)).alias("count")).orderBy(*by, target)


def histogram(df: DataFrame, cols: Sequence[str], bins: int = 50, by: Sequence[str] = (),
              clip_to: tuple[float, float] | None = None) -> DataFrame:
    """Equal-width histogram per column -> (by..., feature, bin, bin_low, bin_high, count).

    Edges span [min, max] (a constant column gets [v - 0.5, v + 0.5]); the
    maximum falls in the last bin.  ``clip_to`` clips values first (log axes).
    Two passes: min/max per column, then one grouped count.  Every bin is
    emitted, empty ones with count 0.
    """
    by = list(by)
    long = to_long(df, cols, by)
    if clip_to is not None:
        long = long.withColumn("value", clip("value", *clip_to))
    rng = long.groupBy(*by, "feature").agg(F.min("value").alias("mn"), F.max("value").alias("mx"))
    rng = rng.select(*by, "feature",
                     F.when(F.col("mn") == F.col("mx"), F.col("mn") - 0.5).otherwise(F.col("mn")).alias("lo"),
                     F.when(F.col("mn") == F.col("mx"), F.col("mx") + 0.5).otherwise(F.col("mx")).alias("hi"))
    # one row per (group, feature): bounded by the parameters, broadcast to a
    # null-safe equi-join (a map lookup over the unpivot output trips Spark's
    # subexpression codegen and falls back to interpreted execution)
    keys = [*by, "feature"]
    r = rng.select(*[F.col(c).alias(f"_r_{c}") for c in keys], "lo", "hi")
    cond = None
    for c in keys:
        e = F.col(c).eqNullSafe(F.col(f"_r_{c}"))
        cond = e if cond is None else cond & e
    lo, hi = F.col("lo"), F.col("hi")
    b = F.least(F.floor((F.col("value") - lo) / (hi - lo) * bins).cast("int"), F.lit(bins - 1))
    counted = long.join(counted_broadcast(r) if by else checked_broadcast(r, len(cols)), cond, "inner") \
        .select(*[F.col(c).alias(f"_r_{c}") for c in keys], b.alias("_r_bin")) \
        .groupBy(*[f"_r_{c}" for c in keys], "_r_bin").agg(F.count(F.lit(1)).alias("_n"))
    grid = rng.select(*keys, "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    for c in [*keys, "bin"]:
        e = F.col(c).eqNullSafe(F.col(f"_r_{c}"))
        cond = e if c == keys[0] else cond & e
    w = (F.col("hi") - F.col("lo")) / bins
    return grid.join(counted, cond, "left").select(
        *by, "feature", "bin", (F.col("lo") + w * F.col("bin")).alias("bin_low"),
        (F.col("lo") + w * (F.col("bin") + 1)).alias("bin_high"), F.coalesce("_n", F.lit(0)).cast("long").alias("count"))


def box_stats(df: DataFrame, cols: Sequence[str], whis: float = 1.5,
              by: Sequence[str] = ()) -> DataFrame:
    """Quartiles (linear), whiskers at the most extreme values inside
    ``q1 - whis IQR`` / ``q3 + whis IQR``, and the outlier (flier) count."""
    by = list(by)
    long = to_long(df, cols, by)
    qt = quantiles_long(long, [0.25, 0.5, 0.75], by=[*by, "feature"])
    qw = qt.groupBy(*by, "feature").agg(
        *[F.max(F.when(F.col("q_idx") == i, F.col("quantile"))).alias(n)
          for i, n in enumerate(["q1", "median", "q3"])])
    get = lookup(qw, [*by, "feature"], ["q1", "q3"])
    q1, q3 = get("q1"), get("q3")
    lo_f, hi_f = q1 - (q3 - q1) * whis, q3 + (q3 - q1) * whis
    v = F.col("value")
    agg = long.groupBy(*by, "feature").agg(
        F.min(F.when(v >= lo_f, v)).alias("whisker_lo"),
        F.max(F.when(v <= hi_f, v)).alias("whisker_hi"),
        F.count_if((v < lo_f) | (v > hi_f)).alias("n_fliers"))
    return qw.join(agg, [*by, "feature"]).select(
        *by, "feature", "q1", "median", "q3", (F.col("q3") - F.col("q1")).alias("iqr"),
        "whisker_lo", "whisker_hi", F.col("n_fliers").cast("long").alias("n_fliers"))


def stratified_density(df: DataFrame, cols: Sequence[str], label: str = "label",
                       bins: int = 20, by: Sequence[str] = ()) -> DataFrame:
    """Quantile-edge histogram, max-normalised, overall and per class.

    Edges are the distinct linear quantiles at ``linspace(0, 1, bins + 1)``;
    with fewer than 3 distinct edges, ``min(bins, 5)`` equal-width edges over
    ``[min, max + 1e-12]``.  Bins are ``[e_i, e_i+1)``, the last one closed;
    every bin is emitted, empty ones with zero counts.
    """
    by = list(by)
    base = df.select(*by, F.col(label).alias("_y"), *cols)
    long = to_long(base, cols, [*by, "_y"])
    qs = [i / bins for i in range(bins + 1)]
    qt = quantiles_long(long.drop("_y"), qs, by=[*by, "feature"])
    edges_q = qt.groupBy(*by, "feature").agg(
        F.array_sort(F.array_distinct(F.collect_list("quantile"))).alias("qe"),
        F.min("quantile").alias("mn"), F.max("quantile").alias("mx"))
    n_eq = min(bins, 5)
    eq = F.transform(F.sequence(F.lit(0), F.lit(n_eq - 1)),
                     lambda i: F.col("mn") + (F.col("mx") + F.lit(1e-12) - F.col("mn")) * i / F.lit(n_eq - 1))
    edges = edges_q.select(*by, "feature",
                           F.when(F.size("qe") < 3, eq).otherwise(F.col("qe")).alias("edges"))
    # one row per (group, feature): hinted when there are no groups, else sized by AQE
    long = long.join(counted_broadcast(edges) if by else checked_broadcast(edges, len(cols)), [*by, "feature"])
    e = F.col("edges")
    x = F.col("value")
    idx = F.size(F.filter(e, lambda t: t <= x)) - 1
    idx = F.when(x == F.element_at(e, -1), F.size(e) - 2).otherwise(idx)
    inside = (x >= F.element_at(e, 1)) & (x <= F.element_at(e, -1))
    counted = long.filter(inside).groupBy(*by, "feature", idx.alias("bin")).agg(
        F.count(F.lit(1)).alias("count"),
        F.count_if(F.col("_y") == 1).alias("pos_count"),
        F.count_if(F.col("_y") == 0).alias("neg_count"))
    grid = edges.select(*by, "feature", "edges",
                        F.explode(F.sequence(F.lit(0), F.size("edges") - 2)).alias("bin"))
    full = grid.join(counted, [*by, "feature", "bin"], "left").select(
        *by, "feature", "bin",
        F.element_at("edges", F.col("bin") + 1).alias("edge_lo"),
        F.element_at("edges", F.col("bin") + 2).alias("edge_hi"),
        *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("count", "pos_count", "neg_count")])
    from pyspark.sql import Window
    g = Window.partitionBy(*by, "feature")
    return full.select(
        *by, "feature", "bin", "edge_lo", "edge_hi", "count",
        (F.col("count") / (F.max("count").over(g) + F.lit(1e-12))).alias("density"),
        "pos_count", "neg_count",
        (F.col("pos_count") / (F.max("pos_count").over(g) + F.lit(1e-12))).alias("pos_density"),
        (F.col("neg_count") / (F.max("neg_count").over(g) + F.lit(1e-12))).alias("neg_density"))


def group_sizes(df: DataFrame, groupby: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows per group (null group kept), as groups, smallest, mean and largest size."""
    sizes = df.groupBy(*by, *groupby).agg(F.count(F.lit(1)).alias("n"))
    return sizes.groupBy(*by).agg(F.count(F.lit(1)).alias("groups"), F.min("n").alias("least"), F.avg("n").alias("mean"), F.max("n").alias("most"))


def profile(df: DataFrame, features: Sequence[str], bins: int = 50) -> dict[str, DataFrame]:
    """Missing report, describe, histogram and box stats of all rows."""
    return {"missing": missing_report(df), "describe": describe(df, features),
            "histogram": histogram(df, features, bins), "box": box_stats(df, features)}
