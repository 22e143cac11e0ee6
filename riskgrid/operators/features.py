"""Feature preparation: medians (D3, D4), impute (C1, C2, I6), month one-hot
(I5), scaler fit (D6-D8) and transform (I7-I9, I9b), the prepare chain
(J18), feature pick / label cast (B5, B6) and the class weight (D9).

Fitted state is a small parameter table (one row per feature, or per
feature x month); it is applied as a scalar subquery or a broadcast join on
a bounded key, never by collecting the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgrid.functions.exprs import month_dummies
from riskgrid.operators.ranking import lookup
from riskgrid.operators.stats import quantiles_long, to_long
from riskgrid.schema import require_columns
from riskgrid.session import checked_broadcast, cut_lineage


def _wide(qt: DataFrame, by: Sequence[str], feats: Sequence[str], names: dict[int, str]) -> DataFrame:
    """(by..., feature, q_idx, quantile) -> one row per ``by`` with ``<feat>_<name>``."""
    aggs = [F.max(F.when((F.col("feature") == f) & (F.col("q_idx") == i), F.col("quantile")))
            .alias(f"{f}_{n}") for f in feats for i, n in names.items()]
    return qt.groupBy(*by).agg(*aggs)


def fit_median(df: DataFrame, feats: Sequence[str], by: Sequence[str] = (),
               method: str = "exact") -> DataFrame:
    """Exact median of each feature (nulls ignored), optionally per ``by``."""
    by = list(by)
    qt = quantiles_long(to_long(df, feats, by), [0.5], by=[*by, "feature"], method=method)
    return _wide(qt, by, feats, {0: "median"})


def impute(df: DataFrame, feats: Sequence[str], monthwise: bool = False,
           month_col: str = "month", method: str = "exact") -> DataFrame:
    """C1/C2 + I6: fill nulls with the global (or per-month) median.

    Global medians are one row, inlined as a scalar subquery.  Per-month
    medians have at most 12 rows per year in the data and are broadcast to
    a left join on the month; a month whose feature is all null stays null.
    """
    return apply_medians(df, fit_median(df, feats, [month_col] if monthwise else [], method), feats, monthwise, month_col)


def apply_medians(df: DataFrame, med: DataFrame, feats: Sequence[str], monthwise: bool = False, month_col: str = "month") -> DataFrame:
    """Fill nulls from fitted medians, one row or one per month."""
    if not monthwise:
        get = lookup(med, [], [f"{f}_median" for f in feats])
        return df.withColumns({f: F.coalesce(F.col(f), get(f"{f}_median").cast(df.schema[f].dataType))
                               for f in feats})
    joined = df.join(checked_broadcast(med, 12), on=month_col, how="left")   # calendar months
    out = joined.withColumns({f: F.coalesce(F.col(f), F.col(f"{f}_median").cast(df.schema[f].dataType))
                              for f in feats})
    return out.select(*df.columns)


def add_month_dummies(df: DataFrame, months: Sequence[int], month_col: str = "month",
                      prefix: str = "mon_") -> DataFrame:
    """One tinyint 0/1 column per month in ``months``."""
    return df.withColumns(month_dummies(months, month_col, prefix))


def fit_scaler(df: DataFrame, feats: Sequence[str], kind: str = "minmax") -> DataFrame:
    """One row with ``<feat>_center`` and ``<feat>_scale`` per feature.

    minmax: (min, max - min); standard: (mean, population std); robust:
    (median, q75 - q25) with exact linear quantiles.  A zero scale becomes 1,
    so a constant column maps to 0.
    """
    def safe(x):
        return F.when((x == 0) | x.isNull(), F.lit(1.0)).otherwise(x)
    if kind == "minmax":
        aggs = []
        for f in feats:
            c = F.col(f).cast("double")
            aggs += [F.min(c).alias(f"{f}_center"), (F.max(c) - F.min(c)).alias(f"{f}_range")]
        p = df.agg(*aggs)
        return p.select(*[x for f in feats for x in
                          (F.col(f"{f}_center"), safe(F.col(f"{f}_range")).alias(f"{f}_scale"))])
    if kind == "standard":
        aggs = []
        for f in feats:
            c = F.col(f).cast("double")
            aggs += [F.avg(c).alias(f"{f}_center"), F.stddev_pop(c).alias(f"{f}_sd")]
        p = df.agg(*aggs)
        return p.select(*[x for f in feats for x in
                          (F.col(f"{f}_center"), safe(F.col(f"{f}_sd")).alias(f"{f}_scale"))])
    if kind == "robust":
        qt = quantiles_long(to_long(df, feats), [0.25, 0.5, 0.75], by=["feature"])
        w = _wide(qt, [], feats, {0: "q25", 1: "center", 2: "q75"})
        return w.select(*[x for f in feats for x in
                          (F.col(f"{f}_center"),
                           safe(F.col(f"{f}_q75") - F.col(f"{f}_q25")).alias(f"{f}_scale"))])
    raise ValueError(f"unknown scaler: {kind}")


def transform_scaler(df: DataFrame, params: DataFrame, feats: Sequence[str]) -> DataFrame:
    """``(x - center) / scale`` with the fitted one-row parameters."""
    get = lookup(params, [], [f"{f}_{s}" for f in feats for s in ("center", "scale")])
    return df.withColumns({f: (F.col(f).cast("double") - get(f"{f}_center")) / get(f"{f}_scale")
                           for f in feats})


def scale(df: DataFrame, feats: Sequence[str], kind: str = "minmax",
          fit_on: DataFrame | None = None) -> DataFrame:
    """Fit on ``fit_on`` (default: the same rows, as the reference) and transform."""
    return transform_scaler(df, fit_scaler(fit_on if fit_on is not None else df, feats, kind), feats)


def prepare(df: DataFrame, feats: Sequence[str], months: Sequence[int], scaler: str = "minmax",
            monthwise: bool = False) -> DataFrame:
    """Impute -> month one-hot -> scale the continuous features.

    The imputed table is written once (the step-2 hand-over) so that the
    scaler fit and the transform read files instead of re-running the
    median job inside every scalar subquery."""
    imputed = cut_lineage(impute(df, feats, monthwise=monthwise))
    return scale(add_month_dummies(imputed, months), feats, scaler)


def pick(df: DataFrame, feats: Sequence[str], dtype: str = "float") -> DataFrame:
    """Require the columns, coerce to numbers (bad text -> null), cast."""
    require_columns(df, list(feats))
    return df.withColumns({f: F.col(f).try_cast(dtype) for f in feats})


def label_int(df: DataFrame, label: str, dtype: str = "tinyint") -> DataFrame:
    """The label as a small integer."""
    return df.withColumn(label, F.col(label).cast(dtype))


def class_weight(df: DataFrame, label: str = "label", by: Sequence[str] = ()) -> DataFrame:
    """Positives, negatives and the imbalance weight ``neg / max(1, pos)``."""
    agg = df.groupBy(*by).agg(F.coalesce(F.sum(F.col(label).cast("long")), F.lit(0)).alias("pos"),
                              F.count(F.lit(1)).alias("n"))
    return agg.select(*by, "pos", (F.col("n") - F.col("pos")).alias("neg"),
                      ((F.col("n") - F.col("pos")) / F.greatest(F.col("pos"), F.lit(1))).alias("weight"))
