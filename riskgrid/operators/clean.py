"""Cleaning stage: coordinate bounds (B1), de-duplication (E1), calendar parts
(B8, I1, I2) and the season filter (B2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgrid.functions.exprs import calendar_columns

KEEP_MONTHS = (5, 6, 7, 8)


def bounds(df: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """B1: keep -180 <= lon <= 180 and -90 <= lat <= 90 (null and NaN drop).

    A plain comparison on scan columns, so Catalyst pushes it into the
    Parquet reader as ``PushedFilters``.
    """
    return df.filter(F.col(lon).between(-180.0, 180.0) & F.col(lat).between(-90.0, 90.0))


def dedup(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop exact duplicate rows over ``subset`` (all columns by default).

    Null equals null, as in the grouping semantics.  Planned as a hash
    aggregate with a map-side partial step, so a hot duplicated row collapses
    before the shuffle.
    """
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def calendar(df: DataFrame, ts: str = "valid_time") -> DataFrame:
    """B8 + I1 + I2: microsecond timestamp, day truncation and calendar parts."""
    out = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return out.withColumns(calendar_columns(ts))


def keep_months(df: DataFrame, months: Sequence[int] = KEEP_MONTHS,
                month_col: str = "month") -> DataFrame:
    """B2: keep rows whose month is in ``months``."""
    return df.filter(F.col(month_col).isin([int(m) for m in months]))


def basic_clean(df: DataFrame, months: Sequence[int] = KEEP_MONTHS,
                subset: Sequence[str] | None = None) -> DataFrame:
    """bounds -> dedup -> calendar -> season, one lazy plan.

    Catalyst moves the month predicate below the dedup aggregate, so the
    shuffle only carries in-season rows.
    """
    return keep_months(calendar(dedup(bounds(df), subset)), months)
