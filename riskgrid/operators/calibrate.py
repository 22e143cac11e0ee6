"""Probability calibration with a frozen base model: isotonic (J3) and sigmoid /
Platt with soft targets (J4), fitted for every group of ``by`` at once.

Both fits start from one row per (group, distinct score).

Isotonic: pooling adjacent violators is mergeable.  Pooling each run of scores by
itself and then pooling the pooled blocks gives the same fit, as the blocks of the
whole never end inside a block of a part.  So each bucket of the score order is
pooled by itself, then ``FAN`` neighbouring buckets at a time, until a group is one
run.  A merge reads blocks, not rows: with 0 / 1 labels n rows make at most some
n^(2/3) blocks, as their means are different fractions.

Sigmoid: damped Newton steps on two numbers per group; a step is one aggregation
for all groups.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from riskgrid.operators.curves import score_groups
from riskgrid.plans.ordering import bucketed
from riskgrid.session import BROADCAST_MAX_ROWS, cut_lineage

FAN = 64


def pool(lo: np.ndarray, hi: np.ndarray, n: np.ndarray, s: np.ndarray) -> list[tuple[float, float, float, float]]:
    """Pool adjacent violators over blocks (first score, last score, weight, label sum) in score order."""
    out: list[list[float]] = []
    for block in zip(lo.tolist(), hi.tolist(), n.tolist(), s.tolist()):
        block = list(block)
        while out and out[-1][3] * block[2] >= block[3] * out[-1][2]:  # mean not below the next
            a = out.pop()
            block = [a[0], block[1], a[2] + block[2], a[3] + block[3]]
        out.append(block)
    return [tuple(b) for b in out]


def fit_isotonic(scored: DataFrame, prob: str = "prob", label: str = "label", by: Sequence[str] = ()) -> DataFrame:
    """(by..., lo, hi, n, value): the blocks of the fit, ``value`` rising with the score."""
    by = list(by)
    groups = score_groups(scored.filter(F.col(prob).isNotNull()), prob, label, by).withColumn("prob", F.col("prob").cast("double"))
    groups = cut_lineage(groups)
    blocks = bucketed(groups, [*by, "prob"])[0].select(
        *by, F.col("_bkt").cast("int").alias("run"), F.col("prob").alias("lo"), F.col("prob").alias("hi"),
        F.col("n").cast("double").alias("n"), F.col("pos").cast("double").alias("s"))
    schema = T.StructType([blocks.schema[c] for c in [*by, "run", "lo", "hi", "n", "s"]])

    def pooled(run: pd.DataFrame) -> pd.DataFrame:
        run = run.sort_values("lo")
        found = pd.DataFrame(pool(*[run[c].to_numpy() for c in ("lo", "hi", "n", "s")]), columns=["lo", "hi", "n", "s"])
        for c in [*by, "run"]:
            found[c] = run[c].iat[0]
        return found[schema.names]

    blocks = cut_lineage(blocks.groupBy(*by, "run").applyInPandas(pooled, schema))
    runs = int(blocks.agg(F.coalesce(F.max("run"), F.lit(0))).first()[0]) + 1
    while runs > 1:
        blocks = blocks.withColumn("run", (F.col("run") / FAN).cast("int"))
        blocks = cut_lineage(blocks.groupBy(*by, "run").applyInPandas(pooled, schema))
        runs = -(-runs // FAN)
    return blocks.select(*by, "lo", "hi", "n", (F.col("s") / F.col("n")).alias("value"))


def apply_isotonic(scored: DataFrame, blocks: DataFrame, prob: str = "prob", out: str = "prob_cal", by: Sequence[str] = (),
                   most: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """The fitted value; between blocks on the line from the last score of one to the first
    of the next, beyond the ends that of the end.  Null scores and groups without a fit give null.

    Up to ``most`` blocks are shipped to the tasks; more are joined by score bucket, each
    bucket with its blocks and one from either side.
    """
    by = list(by)
    if blocks.limit(most + 1).count() <= most:
        name = F.to_json(F.struct(*by)) if by else F.lit("")
        fits: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for g, own in blocks.select(name.alias("_g"), "lo", "hi", "value").toPandas().groupby("_g"):
            own = own.sort_values("lo")
            fits[g] = (own[["lo", "hi"]].to_numpy().ravel(), np.repeat(own["value"].to_numpy(), 2))

        @pandas_udf("double")
        def value(p: pd.Series, group: pd.Series) -> pd.Series:
            x, res = p.to_numpy(dtype=float), np.full(len(p), np.nan)
            for g, rows in pd.Series(range(len(p))).groupby(group.to_numpy()):
                if g in fits:
                    res[rows] = np.interp(x[rows], *fits[g])
            return pd.Series(res).where(~np.isnan(res), None)
        return scored.withColumn(out, value(F.col(prob).cast("double"), name))
    return _joined_isotonic(scored, blocks, prob, out, by)


def _joined_isotonic(scored: DataFrame, blocks: DataFrame, prob: str, out: str, by: list[str]) -> DataFrame:
    key = [f"_g{i}" for i in range(len(by))]
    knots = blocks.select(*[F.col(c).alias(k) for c, k in zip(by, key)], F.col("lo").alias("_p"), "lo", "hi", "value")
    placed, cut = bucketed(knots, [*key, "_p"])
    per = placed.groupBy(*key, "_bkt").agg(
        F.array_sort(F.collect_list(F.struct("lo", "hi", "value"))).alias("own"),
        F.max(F.struct("lo", "hi", "value")).alias("last"), F.min(F.struct("lo", "hi", "value")).alias("first"))
    # a score may lie in a bucket without a block: give every bucket the block before and after it
    ids = F.sequence(F.lit(0), F.lit(len(cut)))
    every = per.select(*key).distinct().withColumn("_bkt", F.explode(ids)) if key else \
        blocks.sparkSession.range(len(cut) + 1).select(F.col("id").cast("int").alias("_bkt"))
    w = Window.partitionBy(*key).orderBy("_bkt")
    per = every.join(per, [*key, "_bkt"], "left").select(
        *key, "_bkt", "own", F.last("last", True).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("before"),
        F.first("first", True).over(w.rowsBetween(1, Window.unboundedFollowing)).alias("after"))
    per = per.withColumn("fit", F.filter(F.concat(F.array("before"), F.coalesce("own", F.array().cast("array<struct<lo:double,hi:double,value:double>>")),
                                                  F.array("after")), lambda x: x.isNotNull())).select(*key, "_bkt", "fit")
    rows = scored.withColumns({"_p": F.col(prob).cast("double"), **{k: F.col(c) for c, k in zip(by, key)}})
    rows, _ = bucketed(rows, [*key, "_p"], cut)

    def line(x: Column, fit: Column) -> Column:
        left = F.element_at(F.filter(fit, lambda b: b["lo"] <= x), -1)
        right = F.get(F.filter(fit, lambda b: b["lo"] > x), 0)
        between = left["value"] + (right["value"] - left["value"]) * (x - left["hi"]) / (right["lo"] - left["hi"])
        return F.when(left.isNull(), right["value"]).when((x <= left["hi"]) | right.isNull(), left["value"]).otherwise(between)
    guarded = F.when(F.size("fit") > 0, F.concat(F.col("fit")))
    fitted = rows.join(per, [*key, "_bkt"], "left").withColumn("_fit", guarded)
    low = F.when(F.exists("_fit", lambda b: b["lo"] <= F.col("_p")), line(F.col("_p"), F.col("_fit")))
    value = F.when(F.col("_p").isNull() | F.col("_fit").isNull(), F.lit(None).cast("double")) \
        .otherwise(F.coalesce(low, F.get("_fit", 0)["value"]))
    return fitted.withColumn(out, value).drop("_p", "_bkt", "fit", "_fit", *key)


def fit_sigmoid(scored: DataFrame, prob: str = "prob", label: str = "label", by: Sequence[str] = (),
                steps: int = 50, tol: float = 1e-10) -> dict[tuple, tuple[float, float]]:
    """(a, b) of ``1 / (1 + exp(a p + b))`` per group, the positives' targets being
    ``(P + 1) / (P + 2)`` and the negatives' ``1 / (N + 2)``.  The groups are parameters of
    a query (calibrators, grid points): their numbers come to the driver."""
    by = list(by)
    rows = cut_lineage(score_groups(scored.filter(F.col(prob).isNotNull()), prob, label, by).withColumn("prob", F.col("prob").cast("double")))
    name = F.concat_ws("|", *[F.col(c).cast("string") for c in by]) if by else F.lit("")
    rows = rows.withColumn("_g", name)
    counts = {r["_g"]: (float(r["p"]), float(r["n"] - r["p"]), tuple(r[c] for c in by)) for r in
              rows.groupBy("_g", *by).agg(F.sum("pos").alias("p"), F.sum("n").alias("n")).collect()}
    theta = {g: (0.0, math.log((n + 1) / (p + 1))) for g, (p, n, _) in counts.items()}
    best: dict[str, tuple[float, tuple[float, float], tuple[float, float]]] = {}
    open_ = set(theta)
    for _ in range(steps):
        if not open_:
            break
        par = {g: (*theta[g], (counts[g][0] + 1) / (counts[g][0] + 2), 1 / (counts[g][1] + 2)) for g in open_}
        a, b, tp, tn = (F.create_map(*[x for g, v in par.items() for x in (F.lit(g), F.lit(v[i]))])[F.col("_g")] for i in range(4))
        d = rows.filter(F.col("_g").isin(*open_)).select("_g", "prob", "n", "pos", a.alias("a"), b.alias("b"), tp.alias("tp"), tn.alias("tn"))
        z = F.col("a") * F.col("prob") + F.col("b")
        t = F.col("pos") * F.col("tp") + (F.col("n") - F.col("pos")) * F.col("tn")  # the targets' sum
        d = d.select("_g", "prob", "n", z.alias("z"), t.alias("t")).withColumn("p", 1 / (1 + F.exp("z")))
        soft = F.greatest(F.col("z"), F.lit(0.0)) + F.log1p(F.exp(-F.abs("z")))  # log(1 + e^z)
        h = F.col("n") * F.col("p") * (1 - F.col("p"))
        g = F.col("t") - F.col("n") * F.col("p")
        sums = d.groupBy("_g").agg(F.sum(F.col("n") * soft - (F.col("n") - F.col("t")) * F.col("z")).alias("loss"), F.sum(g * F.col("prob")).alias("ga"),
                                   F.sum(g).alias("gb"), F.sum(h * F.col("prob") ** 2).alias("haa"), F.sum(h * F.col("prob")).alias("hab"),
                                   F.sum(h).alias("hbb")).collect()
        for r in sums:
            k = r["_g"]
            if k in best and r["loss"] > best[k][0] + 1e-12 * abs(best[k][0]):
                step = tuple(x / 2 for x in best[k][2])  # too far: half the last step from the best point
                theta[k] = tuple(x - y for x, y in zip(best[k][1], step))
                best[k] = (best[k][0], best[k][1], step)
                if max(map(abs, step)) < tol:
                    theta[k] = best[k][1]
                    open_.discard(k)
                continue
            ridge = 1e-12 * (1 + r["haa"] + r["hbb"])
            det = (r["haa"] + ridge) * (r["hbb"] + ridge) - r["hab"] ** 2
            step = (((r["hbb"] + ridge) * r["ga"] - r["hab"] * r["gb"]) / det, ((r["haa"] + ridge) * r["gb"] - r["hab"] * r["ga"]) / det)
            best[k] = (r["loss"], theta[k], step)
            if max(map(abs, step)) < tol * (1 + max(map(abs, theta[k]))):
                open_.discard(k)
            else:
                theta[k] = tuple(x - y for x, y in zip(theta[k], step))
    return {counts[k][2]: v for k, v in theta.items()}


def apply_sigmoid(scored: DataFrame, fits: dict[tuple, tuple[float, float]], prob: str = "prob", out: str = "prob_cal",
                  by: Sequence[str] = ()) -> DataFrame:
    by = list(by)
    if not fits:
        return scored.withColumn(out, F.lit(None).cast("double"))
    if by:
        name = F.concat_ws("|", *[F.col(c).cast("string") for c in by])
        a, b = (F.create_map(*[x for g, v in fits.items() for x in (F.lit("|".join(map(str, g))), F.lit(v[i]))])[name] for i in range(2))
    else:
        a, b = (F.lit(x) for x in fits[()])
    return scored.withColumn(out, 1 / (1 + F.exp(a * F.col(prob).cast("double") + b)))


class IsotonicCalibrator:
    """J3 without groups: ``fit`` on validation scores, ``transform`` any scores."""

    def __init__(self, prob: str = "prob", label: str = "label"):
        self.prob, self.label = prob, label
        self.model: DataFrame | None = None

    def fit(self, scored: DataFrame) -> IsotonicCalibrator:
        self.model = fit_isotonic(scored, self.prob, self.label)
        return self

    def transform(self, scored: DataFrame, out: str = "prob_cal") -> DataFrame:
        return apply_isotonic(scored, self.model, self.prob, out)


class SigmoidCalibrator:
    """J4 without groups."""

    def __init__(self, prob: str = "prob", label: str = "label"):
        self.prob, self.label = prob, label
        self.model: dict | None = None

    def fit(self, scored: DataFrame) -> SigmoidCalibrator:
        self.model = fit_sigmoid(scored, self.prob, self.label)
        return self

    def transform(self, scored: DataFrame, out: str = "prob_cal") -> DataFrame:
        return apply_sigmoid(scored, self.model, self.prob, out)
