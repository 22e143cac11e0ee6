"""Ordered time split (F5, G1, G5) and the six-way export."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgrid.plans.ordering import ordered


def time_split(df: DataFrame, key: str, time_col: str = "valid_time",
               test_size: float = 0.20, val_within: float = 0.375,
               split_col: str = "split", sample_from: DataFrame | None = None) -> DataFrame:
    """Positional split in the total order (time, key): train / val / test.

    ``te = int(n (1 - test_size))``, ``v = int(te val_within)``; rows
    ``rn <= te - v`` are train, ``rn <= te`` val, the rest test.  The order is
    made total by the key, so ties at the cut are resolved reproducibly; the
    global position comes from value-defined buckets (``ordered``), never one
    task.
    """
    ranked = ordered(df, [(time_col, True), (key, True)], sample_id=F.col(key),
                     sample_from=sample_from)
    te = F.floor(F.col("_rn_total").cast("double") * F.lit(1.0 - test_size))
    v = F.floor(te * F.lit(val_within))
    split = (F.when(F.col("_rn") <= te - v, F.lit("train"))
              .when(F.col("_rn") <= te, F.lit("val"))
              .otherwise(F.lit("test")))
    return ranked.withColumn(split_col, split).drop("_rn_total").withColumnRenamed("_rn", "split_rn")


def split_summary(split_df: DataFrame, label: str = "label", time_col: str = "valid_time",
                  split_col: str = "split") -> DataFrame:
    return split_df.groupBy(split_col).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col(label).cast("long")).alias("positives"),
        F.date_format(F.min(time_col), "yyyy-MM-dd HH:mm:ss").alias("first_time"),
        F.date_format(F.max(time_col), "yyyy-MM-dd HH:mm:ss").alias("last_time"),
    )


def export_sets(split_df: DataFrame, path: str, features: Sequence[str], cls_target: str,
                reg_targets: Sequence[str], carry: Sequence[str] = (),
                split_col: str = "split") -> dict[str, str]:
    """Classification and regression sets, each partitioned by split.

    ``carry`` keeps key / time / cell columns so later grouped operators work.
    Partition pruning on ``split`` then makes reading one split cheap.
    """
    out = {}
    for kind, targets in (("cls", [cls_target]), ("reg", list(reg_targets))):
        dest = f"{path.rstrip('/')}/{kind}"
        cols = [*carry, *features, *targets, split_col]
        split_df.select(*cols).write.mode("overwrite").option("compression", "zstd") \
            .partitionBy(split_col).parquet(dest)
        out[kind] = dest
    return out
