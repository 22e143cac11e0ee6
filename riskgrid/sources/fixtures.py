"""The ``obs`` view: a gridded fact table derived from the driver's ``lineitem``.

Same shape as the observation table of the data model: a time column, a cell
id, coordinates (some out of range), four features (two with nulls, two
discrete), a rare 0/1 label and an outcome amount.  ``obs_key`` is built from
integers only, so it hashes the same in every SQL engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FEATURES = ["f_qty", "f_price", "f_disc", "f_tax"]
KEY = "obs_key"


def read_source(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_source(spark, sf_dir, "lineitem")
    return obs_from_lineitem(li)


def obs_from_lineitem(li: DataFrame) -> DataFrame:
    c = F.col
    key = F.concat_ws(
        "|", c("l_orderkey").cast("string"), c("l_linenumber").cast("string"),
        c("l_partkey").cast("string"), c("l_suppkey").cast("string"),
        F.round(c("l_extendedprice") * 100).cast("bigint").cast("string"))
    positive = (c("l_returnflag") == "R") & (c("l_linenumber") == 7)
    return li.select(
        key.alias(KEY),
        c("l_shipdate").cast("timestamp").alias("valid_time"),
        c("l_suppkey").cast("int").alias("grid_id"),
        F.when(c("l_partkey") % 97 == 0, F.lit(181.0))
         .otherwise(F.lit(115.0) + c("l_suppkey") % 20).alias("lon"),
        (F.lit(40.0) + c("l_suppkey") % 15).alias("lat"),
        F.when(c("l_partkey") % 11 == 0, F.lit(None).cast("double"))
         .otherwise(c("l_quantity")).alias("f_qty"),
        F.when(c("l_orderkey") % 29 == 0, F.lit(None).cast("double"))
         .otherwise(c("l_extendedprice")).alias("f_price"),
        c("l_discount").alias("f_disc"),
        c("l_tax").alias("f_tax"),
        F.when(positive, 1).otherwise(0).alias("label"),
        F.when(positive, c("l_extendedprice") / 1000).otherwise(F.lit(0.0)).alias("burned_area"),
    )


def logistic_score(qty: Column | None = None, disc: Column | None = None,
                   tax: Column | None = None) -> Column:
    """Closed-form scorer over the ``obs`` features, rounded to 9 dp.

    Inputs are discrete, so scores tie heavily; rounding first keeps last-bit
    differences of ``exp`` from splitting ties.
    """
    qty = F.col("f_qty") if qty is None else qty
    disc = F.col("f_disc") if disc is None else disc
    tax = F.col("f_tax") if tax is None else tax
    z = F.lit(-2.0) + F.lit(0.04) * F.coalesce(qty, F.lit(25.0)) \
        + F.lit(4.0) * disc - F.lit(6.0) * tax
    return F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(-z)), 9)
