"""Scorers: anything that adds a ``prob`` column to a DataFrame, optionally
with some feature columns overridden (partial dependence, permutation).

``ColumnScorer`` wraps a Column expression builder (JVM-side, stays inside
whole-stage codegen); ``ModelScorer`` wraps a fitted ``pyspark.ml`` model
(J5: P(class 1) from the probability vector, or the raw prediction when the
model has no probability); ``TreeScorer`` holds a tree ensemble as arrays and
scores Arrow batches.

``with_variants`` scores every row under several sets of overrides at once,
``with_grid`` at every grid point of several features; both add one array."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskgrid.functions.ensemble import TreeEnsemble


class ColumnScorer:
    def __init__(self, build: Callable[[dict[str, Column]], Column], features: Sequence[str]):
        self.build = build
        self.features = list(features)

    def _with(self, overrides: dict[str, Column]) -> Column:
        return self.build({f: F.col(f) for f in self.features} | overrides)

    def score(self, df: DataFrame, overrides: dict[str, Column] | None = None,
              out: str = "prob") -> DataFrame:
        return df.withColumn(out, self._with(overrides or {}))

    def with_variants(self, df: DataFrame, variants: Sequence[dict[str, Column]], out: str) -> DataFrame:
        return df.withColumn(out, F.array(*[self._with(v).cast("double") for v in variants]))

    def with_grid(self, df: DataFrame, grids: dict[str, list[float]], out: str) -> DataFrame:
        def along(f: str, grid: list[float]) -> Column:
            points = F.array(*[F.lit(float(g)) for g in grid])
            return F.transform(points, lambda g: self._with({f: g}).cast("double"))
        return df.withColumn(out, F.concat(*[along(f, g) for f, g in grids.items()]))


class ModelScorer:
    def __init__(self, model, features: Sequence[str], vector_col: str = "features"):
        self.model = model
        self.features = list(features)
        self.vector_col = vector_col

    def score(self, df: DataFrame, overrides: dict[str, Column] | None = None,
              out: str = "prob") -> DataFrame:
        from pyspark.ml.feature import VectorAssembler
        from pyspark.ml.functions import vector_to_array
        base = df.withColumns(overrides) if overrides else df
        vec = VectorAssembler(inputCols=self.features, outputCol=self.vector_col,
                              handleInvalid="keep").transform(base)
        res = self.model.transform(vec)
        if "probability" in res.columns:
            p = vector_to_array("probability")[1]
        else:
            p = F.col("prediction").cast("double")
        keep = [c for c in base.columns if c != out]
        return res.select(*keep, p.alias(out))

    def with_variants(self, df: DataFrame, variants: Sequence[dict[str, Column]], out: str) -> DataFrame:
        names = [f"_v{i}" for i in range(len(variants))]
        cols = df.columns
        for name, v in zip(names, variants):
            held = {f"_held_{f}": F.col(f) for f in v}
            df = self.score(df.withColumns(held), v, name).withColumns({f: F.col(f"_held_{f}") for f in v}).drop(*held)
        return df.select(*[F.col(f"`{c}`") for c in cols], F.array(*names).alias(out))

    def with_grid(self, df: DataFrame, grids: dict[str, list[float]], out: str) -> DataFrame:
        return self.with_variants(df, [{f: F.lit(float(g))} for f, grid in grids.items() for g in grid], out)


class TreeScorer:
    """A fitted GBT model or ``BoostedTrees``: the trees are shipped with the tasks."""

    def __init__(self, model, features: Sequence[str]):
        self.ensemble = TreeEnsemble.of(model, features)
        self.features = self.ensemble.features

    def _values(self, overrides: dict[str, Column] | None = None) -> Column:
        over = overrides or {}
        return F.struct(*[over.get(f, F.col(f)).cast("double").alias(f) for f in self.features])

    def score(self, df: DataFrame, overrides: dict[str, Column] | None = None, out: str = "prob") -> DataFrame:
        trees = self.ensemble

        @F.pandas_udf("double")
        def prob(x: pd.DataFrame) -> pd.Series:
            return pd.Series(trees.score(x.to_numpy(dtype=float)))
        return df.withColumns({**(overrides or {}), out: prob(self._values(overrides))})

    def with_variants(self, df: DataFrame, variants: Sequence[dict[str, Column]], out: str) -> DataFrame:
        """Each variant scores only the trees that read one of its features anew."""
        trees, features = self.ensemble, self.features
        names = [[features.index(f) for f in v] for v in variants]
        new = F.struct(*[c.cast("double").alias(f"v{i}_{k}") for i, v in enumerate(variants) for k, c in enumerate(v.values())])

        @F.pandas_udf("array<double>")
        def probs(x: pd.DataFrame, y: pd.DataFrame) -> pd.Series:
            x, y = x.to_numpy(dtype=float), y.to_numpy(dtype=float)
            res, at = np.empty((len(x), len(names))), 0
            for i, own in enumerate(names):
                z = x.copy()
                z[:, own] = y[:, at:at + len(own)]
                at += len(own)
                res[:, i] = trees.score(z)
            return pd.Series(list(res))
        return df.withColumn(out, probs(self._values(), new))

    def with_grid(self, df: DataFrame, grids: dict[str, list[float]], out: str) -> DataFrame:
        trees = self.ensemble
        at = [(self.features.index(f), np.array(g, dtype=float)) for f, g in grids.items()]

        @F.pandas_udf("array<double>")
        def probs(x: pd.DataFrame) -> pd.Series:
            x = x.to_numpy(dtype=float)
            return pd.Series(list(np.concatenate([trees.along(x, f, g) for f, g in at]).T))
        return df.withColumn(out, probs(self._values()))

    def _summed(self, base: DataFrame, jobs: list[tuple]) -> DataFrame:
        """(job, i1, i2, sum, n): sums over all rows, one scan for all jobs."""
        trees = self.ensemble

        def rows(batches):
            total, n = None, 0
            for b in batches:
                x = b.to_numpy(dtype=float)
                n += len(x)
                sums = [trees.sums_along(x, *job)[:, None] if len(job) == 2 else trees.sums_over(x, *job) for job in jobs]
                total = sums if total is None else [s + t for s, t in zip(total, sums)]
            for k, s in enumerate(total or []):
                i1, i2 = (i.ravel() for i in np.indices(s.shape))
                yield pd.DataFrame({"job": k, "i1": i1, "i2": i2, "sum": s.ravel(), "n": n})
        cols = [F.col(f).cast("double").alias(f) for f in self.features]
        part = base.select(*cols).mapInPandas(rows, "job int, i1 int, i2 int, sum double, n long")
        return part.groupBy("job", "i1", "i2").agg((F.sum("sum") / F.sum("n")).alias("pd"))

    def partial_dependence(self, base: DataFrame, grids: dict[str, list[float]]) -> DataFrame:
        """(feature, i, g, pd)."""
        names = list(grids)
        found = self._summed(base, [(self.features.index(f), np.array(grids[f], dtype=float)) for f in names])
        points = base.sparkSession.createDataFrame([(k, f, i, float(g)) for k, f in enumerate(names) for i, g in enumerate(grids[f])],
                                                   "job int, feature string, i1 int, g double")
        return found.join(F.broadcast(points), ["job", "i1"]).select("feature", F.col("i1").alias("i"), "g", "pd")

    def pair_dependence(self, base: DataFrame, grids: dict[str, list[float]], pairs: Sequence[tuple[str, str]]) -> DataFrame:
        """(f1, f2, i1, i2, g1, g2, pd)."""
        side = {f: (self.features.index(f), np.array(g, dtype=float)) for f, g in grids.items()}
        found = self._summed(base, [(*side[a], *side[b]) for a, b in pairs])
        spark = base.sparkSession
        names = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(pairs)], "job int, f1 string, f2 string")
        points = spark.createDataFrame([(f, i, float(v)) for f, g in grids.items() for i, v in enumerate(g)], "f string, i int, g double")
        one, two = (points.select(F.col("f").alias(f"f{k}"), F.col("i").alias(f"i{k}"), F.col("g").alias(f"g{k}")) for k in (1, 2))
        return found.join(F.broadcast(names), "job").join(F.broadcast(one), ["f1", "i1"]).join(F.broadcast(two), ["f2", "i2"]) \
            .select("f1", "f2", "i1", "i2", "g1", "g2", "pd")
