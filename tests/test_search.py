"""Search of a row's place among sorted boundaries: as many as are not greater, one comparison a step."""

import math

from pyspark.sql import functions as F

from riskgrid.operators.stats import _edges_not_above
from riskgrid.plans.ordering import _bucket_expr


def _cases(df, col):
    """Conditionals that a step evaluates; four when it narrowed a struct of two ends."""
    return df.select(col)._jdf.queryExecution().optimizedPlan().toString().count("CASE WHEN")


def test_bucket_of_a_row_counts_boundaries_not_above(spark):
    values = [None, -1.5, -0.0, 0.0, 2.0, 7.25, math.nan]
    names = [None, "", "a", "b", "é"]
    rows = spark.createDataFrame([(v, n) for v in values for n in names], "v double, n string")
    keys = [F.col("v"), F.col("n")]
    for bounds in ([(None, "a")], [(None, None), (0.0, "a"), (0.0, "b")],
                   [(None, "a"), (None, "b"), (-1.5, None), (0.0, "a"), (0.0, "b"), (2.0, ""), (3.0, "a"), (7.25, "é"), (math.nan, "a")]):
        table = F.array(*[F.struct(F.lit(a).cast("double").alias("_k0"), F.lit(b).cast("string").alias("_k1")) for a, b in bounds])
        plain = F.size(F.filter(table, lambda b: b <= F.struct(F.col("v").alias("_k0"), F.col("n").alias("_k1"))))
        found = _bucket_expr(rows, keys, bounds)
        assert rows.filter(found != plain).count() == 0
        assert rows.filter(found.isNull()).count() == 0
    assert _cases(rows, found) <= 2  # a step's choice, and one of ``get``


def test_cut_of_a_value_counts_edges_not_above(spark):
    rows = spark.createDataFrame([(v, [float(x) for x in range(n)]) for v in (-1.0, 0.0, 0.5, 8.0, 11.0, 99.0, math.nan) for n in (0, 1, 2, 7, 12)],
                                 "v double, e array<double>")
    for most in (12, 15, 16, 40):
        found = _edges_not_above(F.col("v"), F.col("e"), most)
        assert rows.filter(found != F.size(F.filter("e", lambda e: e <= F.col("v")))).count() == 0
        assert _cases(rows, found) <= 2  # a step's choice, and one of ``get``
