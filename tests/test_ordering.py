"""The bucketed global order: exact positions and running sums, invariant
to the bucket count and the shuffle partition count."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskgrid.plans.ordering import ordered


def _frame(spark, n=500):
    pdf = pd.DataFrame({"g": [i % 3 for i in range(n)], "k": [f"{i:05d}" for i in range(n)],
                        "v": [(i * 37) % 101 for i in range(n)], "w": [i % 7 for i in range(n)]})
    return spark.createDataFrame(pdf), pdf


@pytest.mark.parametrize("buckets", [1, 4, 16])
def test_positions_and_running_sums(spark, buckets):
    df, pdf = _frame(spark)
    out = ordered(df, [("v", True), ("k", True)], sums={"cw": F.col("w")}, within=["g"],
                  n_buckets=buckets).toPandas()
    exp = pdf.sort_values(["g", "v", "k"]).copy()
    exp["rn"] = exp.groupby("g").cumcount() + 1
    exp["cw"] = exp.groupby("g")["w"].cumsum()
    got = out.set_index("k").loc[exp["k"]]
    assert list(got["_rn"]) == list(exp["rn"])
    assert list(got["cw"]) == list(exp["cw"])
    assert (got["_rn_total"].values == exp.groupby("g")["k"].transform("size").values).all()


def test_descending_order(spark):
    df, pdf = _frame(spark, 200)
    out = ordered(df, [("v", False), ("k", True)], n_buckets=8).toPandas()
    exp = pdf.sort_values(["v", "k"], ascending=[False, True]).reset_index(drop=True)
    got = out.sort_values("_rn").reset_index(drop=True)
    assert list(got["k"]) == list(exp["k"])


@pytest.mark.parametrize("buckets", [1, 7, 400, 4000])
def test_any_bucket_count_gives_the_same_order(spark, buckets):
    """Two keys with nulls and ties; 4000 buckets still compile to small code."""
    df = spark.range(90_000).selectExpr("id", "if(id % 97 = 0, null, cast(id * 7919 % 1013 as double)) as x", "cast(id * 31 % 7 as string) as s")
    got = ordered(df, [("x", True), ("s", True), ("id", True)], n_buckets=buckets)
    rows = got.select("id", "_rn").toPandas().sort_values("_rn")
    want = sorted(range(90_000), key=lambda i: ((i % 97 != 0), 0 if i % 97 == 0 else i * 7919 % 1013, str(i * 31 % 7), i))
    assert rows["id"].tolist() == want


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_split_invariant_to_partitions(spark, parts):
    from riskgrid.operators.split import time_split
    from riskgrid.plans import base as B
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        s = time_split(B.clean_obs(spark, "/root/testdata/sf0.001"), key=B.KEY).groupBy("split").count().toPandas()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    counts = dict(zip(s["split"], s["count"]))
    n = sum(counts.values())
    te = int(n * 0.8)
    v = int(te * 0.375)
    assert counts == {"train": te - v, "val": v, "test": n - te}
