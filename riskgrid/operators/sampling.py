"""Sampling and rebalancing: hash-order sample (H1, H2), per-class downsample
(H3), exact k-NN on the minority class (C5), SMOTE rows (H4), oversampling
with replacement (H5), the balanced N:N set (H6) and bootstrap weights (H7).

Every draw is a deterministic hash uniform of (seed, tag, key or draw index),
so results do not depend on partitioning or task order, and a recomputed
partition after an executor loss draws the same rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskgrid.functions.exprs import hash_uniform
from riskgrid.operators.neighbours import knn
from riskgrid.plans.ordering import ordered
from riskgrid.session import cut_lineage


def sample_n(df: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    """H1/H2: at most ``n`` rows without replacement: the ``n`` smallest hash
    draws (all rows when ``n`` >= height).  A top-n heap per task."""
    u = hash_uniform(seed, key)
    return df.withColumn("_u", u).orderBy("_u", key).limit(int(n)).drop("_u")


def downsample(df: DataFrame, label: str, n: int, seed: int, key: str,
               classes: Sequence[int] = (0, 1)) -> DataFrame:
    """H3: at most ``n`` rows of every class of ``classes``, by hash order; rows
    of other classes, and without a class, are left out.

    One ``orderBy().limit()`` per class of the (bounded) class list, so the
    majority class is reduced with per-task heaps instead of one window task.
    """
    out = None
    for c in classes:
        part = sample_n(df.filter(F.col(label) == F.lit(c)), n, seed, key)
        out = part if out is None else out.unionByName(part)
    return out


def numbered(df: DataFrame, key: str) -> DataFrame:
    """Rows with a 0-based position ``idx`` in key order and the row count ``cnt``."""
    r = ordered(df, [(key, True)], sample_id=F.col(key))
    return r.withColumn("idx", F.col("_rn") - 1).withColumnRenamed("_rn_total", "cnt").drop("_rn")


def draws(spark: SparkSession, how_many: int, seed: int, tag: str) -> DataFrame:
    """Draws ``j = 0 .. how_many - 1`` with three hash uniforms ``u1, u2, u3`` each, made in as many tasks as the session has."""
    d = spark.range(max(0, how_many)).select(F.col("id").alias("j"))
    return d.select("j", *[hash_uniform(seed, F.lit(tag), F.col("j"), t).alias(f"u{t}") for t in (1, 2, 3)])


def oversample(minority: DataFrame, target: int, seed: int, key: str) -> DataFrame:
    """H5: ``target - P`` extra rows drawn with replacement from the minority
    (row ``floor(u1 P)`` in key order); returns the drawn rows with ``j``."""
    num = numbered(minority, key)
    P = minority.count()      # one scalar: the size of the index range
    d = draws(minority.sparkSession, int(target) - P, seed, "oversample")
    d = d.withColumn("idx", F.floor(F.col("u1") * F.lit(P)).cast("long"))
    return d.join(num.drop("cnt"), "idx").drop("u1", "u2", "u3")


def smote(minority: DataFrame, feats: Sequence[str], target: int, seed: int, key: str,
          k: int = 5) -> DataFrame:
    """H4: ``target - P`` synthetic rows ``x + u (nn - x)``.

    Draw j: base row ``floor(u1 P)`` in key order, neighbour ``floor(u2 k') + 1``
    among its ``k' = min(k, P - 1)`` nearest, ``u = u3``.  P = 1 falls back to
    oversampling (H5); P = 0 raises.
    """
    P = minority.count()       # one scalar decides the algorithm branch
    if P == 0:
        raise ValueError("SMOTE needs at least one minority row")
    if P == 1:
        return oversample(minority, target, seed, key).select("j", *feats)
    kk = min(k, P - 1)
    num = cut_lineage(numbered(minority.select(key, *feats), key))
    d = draws(minority.sparkSession, int(target) - P, seed, "smote") \
        .withColumn("idx", F.floor(F.col("u1") * F.lit(P)).cast("long")) \
        .withColumn("nn_rank", (F.floor(F.col("u2") * F.lit(kk)) + 1).cast("int"))
    base = cut_lineage(d.join(num.select("idx", F.col(key).alias("_bk"), *[F.col(f).alias(f"x_{f}") for f in feats]), "idx"))
    # only drawn rows look for neighbours
    drawn = num.join(base.select("idx").distinct(), "idx", "left_semi")
    nn = knn(num, feats, key, kk, queries=drawn)
    pick = base.join(nn.select(F.col(key).alias("_bk"), "nn_rank", "nn_key"), ["_bk", "nn_rank"])
    nbr = num.select(F.col(key).alias("nn_key"), *[F.col(f).alias(f"n_{f}") for f in feats])
    full = pick.join(nbr, "nn_key")
    return full.select("j", *[(F.col(f"x_{f}") + F.col("u3") * (F.col(f"n_{f}") - F.col(f"x_{f}"))).alias(f)
                              for f in feats])


def balance(df: DataFrame, feats: Sequence[str], label: str, n: int, seed: int, key: str,
            use_smote: bool = True, k: int = 5) -> DataFrame:
    """H6: an N:N set (N drops to the negative count when negatives are short).

    Negatives and surplus positives are downsampled by hash order; missing
    positives are synthesised by SMOTE (or drawn with replacement).
    Output: features, label (tinyint), ``synthetic`` flag.
    """
    neg_n = df.filter(F.col(label) == 0).count()
    n = min(int(n), neg_n)
    neg = sample_n(df.filter(F.col(label) == 0), n, seed, key)
    pos_all = df.filter(F.col(label) == 1)
    P = pos_all.count()
    if P >= n:
        pos = sample_n(pos_all, n, seed, key).select(*feats).withColumn("synthetic", F.lit(False))
    else:
        extra = smote(pos_all, feats, n, seed, key, k) if use_smote and P >= 2 else \
            oversample(pos_all, n, seed, key).select("j", *feats)
        pos = pos_all.select(*feats).withColumn("synthetic", F.lit(False)).unionByName(
            extra.select(*feats).withColumn("synthetic", F.lit(True)))
    return neg.select(*feats).withColumn("synthetic", F.lit(False)).withColumn(label, F.lit(0).cast("tinyint")) \
        .unionByName(pos.withColumn(label, F.lit(1).cast("tinyint")))


# ---- bootstrap weights (H7) -------------------------------------------------------
def poisson_cdf(lam: float, kmax: int = 20) -> list[float]:
    """CDF of Poisson(lam) at 0..kmax (driver-side constants)."""
    out, p, acc = [], math.exp(-lam), 0.0
    for k in range(kmax + 1):
        acc += p
        out.append(acc)
        p *= lam / (k + 1)
    return out


def poisson_weight(u: Column, lam: float, kmax: int = 20) -> Column:
    """Inverse-CDF Poisson draw: ``#{k : u > CDF(k)}`` (weights of one replicate)."""
    w = None
    for c in poisson_cdf(lam, kmax):
        t = F.when(u > F.lit(c), 1).otherwise(0)
        w = t if w is None else w + t
    return w


def bootstrap_weights(df: DataFrame, key: str, replicates: int, frac: float, seed: int) -> dict[str, Column]:
    """H7: per-row draw counts for every replicate as columns ``_w0 .. _w{B-1}``.

    Poisson(frac) per row and replicate: the distribution of the multinomial
    count of ``frac n`` draws with replacement, without a global row index or
    a join; the expected replicate size is ``frac n``.
    """
    return {f"_w{b}": poisson_weight(hash_uniform(seed, F.lit("boot"), b, F.col(key)), frac)
            for b in range(replicates)}
