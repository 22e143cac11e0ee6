"""Scalar statistics: exact quantiles (D12), ECDF at a value (D13), row count
and emptiness (D31), and the small-parameter plumbing they share."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskgrid.functions.exprs import finite
from riskgrid.session import checked_broadcast, cut_lineage


def to_long(df: DataFrame, value_cols: Sequence[str], by: Sequence[str] = (),
            name_col: str = "feature", value_col: str = "value",
            finite_only: bool = True) -> DataFrame:
    """Unpivot ``value_cols`` to (by..., feature, value) as doubles."""
    cast = df.select(*by, *[F.col(c).cast("double").alias(c) for c in value_cols])
    long = cast.unpivot(list(by), list(value_cols), name_col, value_col)
    if finite_only:
        long = long.filter(finite(value_col))
    return long


def quantiles_long(long: DataFrame, qs: Sequence[float], by: Sequence[str] = (),
                   value_col: str = "value", method: str = "exact",
                   interpolation: str = "linear", accuracy: int = 5000,
                   group_bound: int | None = None) -> DataFrame:
    """Quantiles of ``value_col`` per ``by`` group -> (by..., q_idx, q, quantile).

    ``exact`` cuts each group at sketched values around the wanted ranks,
    counts rows per cut and orders only the cuts that hold a wanted position
    (``_near_ranks``); ``linear`` equals NumPy's default and DuckDB ``quantile_cont``,
    ``nearest`` takes the value at rank ``round(q (n-1))``.  ``approx`` uses
    ``percentile_approx`` (one pass, bounded memory, not bit-equal).
    """
    by = list(by)
    qs = [float(q) for q in qs]
    if method == "approx":
        agg = long.groupBy(*by).agg(
            F.percentile_approx(value_col, qs, accuracy).alias("_qa"))
        return agg.select(*by, F.posexplode("_qa").alias("q_idx", "quantile")) \
            .withColumn("q", F.element_at(F.array(*[F.lit(q) for q in qs]), F.col("q_idx") + 1))
    if method == "percentile":
        agg = long.groupBy(*by).agg(F.percentile(value_col, F.array(*[F.lit(q) for q in qs])).alias("_qa"))
        return agg.select(*by, F.posexplode("_qa").alias("q_idx", "quantile")) \
            .withColumn("q", F.element_at(F.array(*[F.lit(q) for q in qs]), F.col("q_idx") + 1))

    cum = _near_ranks(long, qs, by, value_col, accuracy, group_bound)
    first = F.col("_cum") - F.col("_c")          # 0-based first position of the value
    last = F.col("_cum") - 1
    nm1 = (F.col("_cum_total") - 1).cast("double")

    def covers(pos: Column) -> Column:
        return (first <= pos) & (pos <= last)

    positions = []
    for q in qs:
        p = F.lit(q) * nm1
        if interpolation == "nearest":
            positions.append([F.round(p).cast("long")])
        else:
            positions.append([F.floor(p).cast("long"), F.ceil(p).cast("long")])
    hit = F.lit(False)
    for ps in positions:
        for pos in ps:
            hit = hit | covers(pos)
    picked = cum.filter(hit)
    aggs = []
    for i, q in enumerate(qs):
        p = F.lit(q) * nm1
        if interpolation == "nearest":
            aggs.append(F.max(F.when(covers(positions[i][0]), F.col(value_col))).alias(f"_q{i}"))
        else:
            lo = F.max(F.when(covers(positions[i][0]), F.col(value_col)))
            hi = F.max(F.when(covers(positions[i][1]), F.col(value_col)))
            frac = F.max(p - F.floor(p))
            aggs.append((lo + (hi - lo) * frac).alias(f"_q{i}"))
    wide = picked.groupBy(*by).agg(*aggs)
    stacked = F.array(*[F.struct(F.lit(i).alias("q_idx"), F.lit(q).alias("q"),
                                 F.col(f"_q{i}").alias("quantile")) for i, q in enumerate(qs)])
    return wide.select(*by, F.inline(stacked))


def _near_ranks(long: DataFrame, qs: Sequence[float], by: list[str], value_col: str,
                accuracy: int, group_bound: int | None) -> DataFrame:
    """(by..., value, _c, _cum, _cum_total): the distinct values near the
    positions of ``qs`` with their count, running count and group size.

    A mergeable sketch (one map-side aggregation) gives values just below and
    above each wanted rank; they cut a group's value range into intervals,
    which are counted map-side.  Only rows of intervals that hold a wanted
    position are shuffled and ordered, some ``4 len(qs) / accuracy`` of all.
    The sketch steers that share alone: positions come from exact counts.
    """
    rows = long.select(*by, value_col).filter(F.col(value_col).isNotNull())
    off = 2.0 / accuracy
    marks = sorted({min(1.0, max(0.0, q + d)) for q in qs for d in (-off, off)})
    sketch = F.percentile_approx(value_col, F.array(*[F.lit(m) for m in marks]), F.lit(accuracy))
    cuts = F.array_sort(F.array_distinct(sketch))
    if by:
        # written and counted: an unhinted join would sort all rows of a group in one task
        edges = cut_lineage(rows.groupBy(*by).agg(cuts.alias("_edges")))
        groups = edges.count()
        base = _by_group(rows, checked_broadcast(edges, groups), by)
    else:
        groups = 1
        base = rows.withColumn("_edges", rows.agg(cuts).scalar())
    base = base.select(*by, value_col, _edges_not_above(F.col(value_col), F.col("_edges"), len(marks)).alias("_cut"))
    counted = base.groupBy(*by, "_cut").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*by).orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.select(*by, "_cut", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_below"),
                            F.sum("_n").over(Window.partitionBy(*by)).alias("_cum_total"))
    nm1 = (F.col("_cum_total") - 1).cast("double")
    held = F.lit(False)
    for q in qs:
        # floor, ceil and round of the position
        held = held | ((F.col("_below") <= F.ceil(F.lit(q) * nm1)) & (F.floor(F.lit(q) * nm1) < F.col("_below") + F.col("_n")))
    need = placed.filter(held).drop("_n")
    near = _by_group(base, checked_broadcast(need, groups * (len(marks) + 1)), [*by, "_cut"])
    values = near.groupBy(*by, "_cut", "_below", "_cum_total", value_col).agg(F.count(F.lit(1)).alias("_c"))
    upto = Window.partitionBy(*by, "_cut").orderBy(value_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return values.select(*by, value_col, "_c", (F.col("_below") + F.sum("_c").over(upto)).alias("_cum"), "_cum_total")


def _by_group(rows: DataFrame, small: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with the other columns of ``small``, joined null-safely on ``keys``."""
    named = small.select(*[F.col(k).alias(f"_g_{k}") for k in keys], *[c for c in small.columns if c not in keys])
    cond = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_g_{k}")) for k in keys])
    return rows.join(named, cond).drop(*[f"_g_{k}" for k in keys])


def _edges_not_above(value: Column, edges: Column, most: int) -> Column:
    """How many of the ascending ``edges`` (``most`` at most) are <= ``value``,
    by halved steps."""
    if most <= 8:
        return F.size(F.filter(edges, lambda e: e <= value))

    def climb(at: Column, step: Column) -> Column:
        return F.when(F.get(edges, at + step - 1) <= value, at + step).otherwise(at)  # no edge there: null
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(most.bit_length()))])
    return F.aggregate(steps, F.lit(0), climb)


def quantiles(df: DataFrame, value_cols: Sequence[str], qs: Sequence[float],
              by: Sequence[str] = (), **kw) -> DataFrame:
    """Quantiles of several columns -> (by..., feature, q_idx, q, quantile)."""
    long = to_long(df, value_cols, by)
    return quantiles_long(long, qs, by=[*by, "feature"], **kw)


def quantile_array(qtab: DataFrame, by: Sequence[str], name: str = "edges") -> DataFrame:
    """Collapse (by..., q_idx, quantile) to one array per group, in q order."""
    return qtab.groupBy(*by).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("q_idx", "quantile"))),
                    lambda s: s["quantile"]).alias(name))


def ecdf_at(df: DataFrame, value_col: str, at: Column, by: Sequence[str] = ()) -> DataFrame:
    """Share of rows with ``value <= at`` (null/NaN rows count as False)."""
    return df.groupBy(*by).agg(
        F.avg(F.when(F.col(value_col) <= at, 1.0).otherwise(0.0)).alias("ecdf"))


def n_rows(df: DataFrame) -> int:
    """Row count (an action)."""
    return df.count()


def is_empty(df: DataFrame) -> bool:
    return df.isEmpty()


def param_map(small: DataFrame, key: str, value: str) -> Column:
    """Turn a small (key, value) table into a map-valued scalar subquery.

    The subquery runs once and is inlined as a literal, so rows can look up
    per-group parameters with ``element_at`` instead of a join.  ``small``
    must hold one row per parameter group (a bounded number).
    """
    return small.select(F.map_from_entries(F.collect_list(F.struct(key, value)))).scalar()


def param_value(small: DataFrame, value: str | Column) -> Column:
    """A one-row, one-value table as a scalar subquery."""
    v = F.col(value) if isinstance(value, str) else value
    return small.select(v).scalar()
