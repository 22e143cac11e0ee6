"""Sources and sinks: CSV scan with typed, header-ordered columns (A1, A2),
Parquet scan and zstd sink (A3, A4), report sinks (A5, A8), metadata
document (A6) and artifact resolution with fallback keys (A7), long-format
surfaces (A9), split-partitioned dataset export (A12)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskgrid.functions.exprs import nan_to_null
from riskgrid.schema import ALL_COLUMNS, declared_type


def read_observations(spark: SparkSession, path: str, columns: Sequence[str] = ALL_COLUMNS,
                      on_missing: str = "error") -> DataFrame:
    """A1 + A2: header CSV -> declared columns that exist, in declared order.

    Every field is read as text under a schema built from the file's own
    header, so values are matched by name, never by position; each column is
    then converted with ``try_cast`` / ``try_to_timestamp`` (bad field ->
    null) and NaN is mapped to null.  Absent declared columns raise
    (``on_missing="error"``) or become typed nulls (``"null"``).
    """
    header = spark.read.option("header", True).option("inferSchema", False).csv(path).columns
    text = spark.read.schema(T.StructType([T.StructField(h, T.StringType()) for h in header])) \
        .option("header", True).option("mode", "PERMISSIVE").csv(path)
    missing = [c for c in columns if c not in header]
    if missing and on_missing == "error":
        raise KeyError(f"missing columns: {missing[:10]}")
    out = []
    for c in columns:
        dt = declared_type(c)
        if c not in header:
            if on_missing == "null":
                out.append(F.lit(None).cast(dt).alias(c))
            continue
        raw = F.trim(F.col(f"`{c}`"))
        if isinstance(dt, T.TimestampType):
            v = F.try_to_timestamp(raw)
        elif isinstance(dt, T.StringType):
            v = raw
        else:
            v = raw.try_cast(dt)
            if isinstance(dt, (T.FloatType, T.DoubleType)):
                v = nan_to_null(v)
        out.append(v.alias(c))
    return text.select(*out)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A3: Parquet scan (filters and projections push into the reader)."""
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> str:
    """Zstd Parquet (footer statistics are always written), optionally partitioned."""
    w = df.write.mode(mode).option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_report(df: DataFrame, path: str, fmt: str = "csv") -> str:
    """A small report as header CSV or JSON lines (one file)."""
    w = df.coalesce(1).write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.json(path)
    return path


def write_json(spark: SparkSession, path: str, record: dict) -> str:
    """One JSON document."""
    import json
    spark.createDataFrame([(json.dumps(record),)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return path


META_SCHEMA = T.StructType([
    T.StructField("config", T.MapType(T.StringType(), T.StringType())),
    T.StructField("classification_target", T.StringType()),
    T.StructField("regression_targets", T.ArrayType(T.StringType())),
    T.StructField("feature_columns", T.ArrayType(T.StringType())),
    T.StructField("excluded_from_features", T.ArrayType(T.StringType())),
    T.StructField("id_columns", T.ArrayType(T.StringType())),
    T.StructField("time_column", T.StringType()),
    T.StructField("artifacts", T.MapType(T.StringType(), T.StringType())),
])


def write_meta(spark: SparkSession, path: str, config: dict, classification_target: str,
               regression_targets: Sequence[str], feature_columns: Sequence[str],
               excluded: Sequence[str], id_columns: Sequence[str], time_column: str,
               artifacts: dict[str, str]) -> str:
    """The one-row metadata document (config, column roles, artifact map)."""
    row = ({str(k): str(v) for k, v in config.items()}, classification_target, list(regression_targets),
           list(feature_columns), list(excluded), list(id_columns), time_column, dict(artifacts))
    spark.createDataFrame([row], META_SCHEMA).coalesce(1).write.mode("overwrite").json(path)
    return path


def read_meta(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(META_SCHEMA).json(path)


def resolve_artifact(meta: DataFrame, *names: str) -> Column:
    """The first present artifact key wins (``coalesce`` over map lookups)."""
    return F.coalesce(*[F.col("artifacts")[n] for n in names])
