import numpy as np
import pytest
from conftest import SF001
from pyspark.sql import functions as F
from riskgrid.llm.mixing import TARGETS, MissedTargets, mix, mixed_documents, quality_domains


def tables(spark):
    return (spark.read.parquet(f"{SF001}/{t}.parquet") for t in ("documents", "labels"))


def projected_gradient(t, p, weights, headroom, tolerance=1e-4):
    r, mass = np.ones(len(t)), t @ p
    w = weights / weights.sum()
    total = headroom * (mass / w).max()
    for _ in range(200):
        gap = (t * r) @ p - w * total
        if np.abs(gap).max() <= tolerance * total:
            break
        r = np.maximum(0, r - p @ (gap / mass))
    return r, w * total


def test_rates_against_a_driver_side_fit(spark):
    docs, labels = tables(spark)
    out = mix(docs, quality_domains(docs, labels), TARGETS).orderBy("id").collect()
    assert len(out) == docs.count()
    t, p = np.array([float(r.n_tokens) for r in out]), np.array([r.posterior for r in out])
    assert np.allclose(p.sum(axis=1), 1) and (p >= 0).all()
    names = sorted({r.domain for r in quality_domains(docs, labels).collect()} & set(TARGETS))
    want, goal = projected_gradient(t, p, np.array([TARGETS[d] for d in names]), 1.1)
    rate = np.array([r.rate for r in out])
    assert np.abs(rate - want).max() < 1e-6 and (rate >= 0).all()
    assert np.abs((t * rate) @ p - goal).max() <= 2e-4 * goal.sum()
    copies = np.array([r.copies for r in out])
    assert (np.abs(copies - rate) < 1).all() and abs(copies.mean() - rate.mean()) < 0.15


def test_posteriors_recover_held_out_domains(spark):
    docs, labels = tables(spark)
    truth = quality_domains(docs, labels)
    fold = F.xxhash64("id") % 3 == 0
    guess = mix(docs, truth.filter(~fold), TARGETS).join(truth.filter(fold).withColumnRenamed("domain", "truth"), "id")
    right = guess.agg(F.avg((F.col("domain") == F.col("truth")).cast("double"))).first()[0]
    assert right > 0.75


def test_shrinking_needs_the_projection(spark):
    docs = spark.createDataFrame([(i, "ä " * (5 + i) if i % 2 else "é " * 50) for i in range(20)], "doc_id bigint, text string")
    known = docs.selectExpr("doc_id as id", "if(doc_id % 2 = 1, 'a', 'b') as domain")
    out = mix(docs, known, {"a": 0.999, "b": 0.001}, budget=100.0).collect()
    assert min(r.rate for r in out) >= 0 and {r.copies for r in out if r.domain == "b"} == {0}


def test_edges(spark):
    docs, labels = tables(spark)
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "xx", "s", 0), (1, "", "xx", "s", 0), (9999, "w " * 90_000, None, "s", 1)], docs.schema)
    both = docs.limit(50).unionByName(odd).withColumn("rate", F.lit("mine"))
    domains = quality_domains(both, labels)
    assert mix(both, domains, TARGETS).count() == 54
    assert {r.rate for r in mix(both, domains.limit(0), TARGETS).collect()} == {1.0}
    kept = mixed_documents(both, domains.limit(0), TARGETS)
    assert kept.count() == 54 and dict(kept.dtypes)["rate"] == "double"
    assert mix(docs.limit(0), domains, TARGETS).count() == 0
    assert mixed_documents(docs.limit(0), domains.limit(0), TARGETS).count() == 0


def test_targets_out_of_reach_end_at_the_least_squares_rates_with_a_sign(spark):
    """Both domains look alike, so no rates can tell their totals apart."""
    docs = spark.createDataFrame([(i, "w " * (20 + i)) for i in range(12)], "doc_id bigint, text string")
    known = docs.selectExpr("doc_id as id", "if(doc_id % 2 = 1, 'a', 'b') as domain")
    with pytest.warns(MissedTargets) as seen:
        out = mix(docs, known, {"a": 0.9, "b": 0.1}, budget=500.0).orderBy("id").collect()
    said = seen.pop(MissedTargets).message
    t, p = np.array([float(r.n_tokens) for r in out]), np.array([r.posterior for r in out])
    goal, mass = np.array([450.0, 50.0]), t @ p
    r = np.ones(len(t))
    for _ in range(20_000):
        r = np.maximum(0, r - p @ (((t * r) @ p - goal) / mass))
    loss = lambda x: ((((t * x) @ p - goal) ** 2) / mass).sum()
    got = np.array([x.rate for x in out])
    assert loss(got) <= loss(r) * (1 + 1e-3) and said.passes < 200
    assert np.allclose([said.gaps["a"], said.gaps["b"]], ((t * got) @ p - goal) / 500.0, atol=1e-6)
    with pytest.raises(MissedTargets):
        mix(docs, known, {"a": 0.9, "b": 0.1}, budget=500.0, strict=True, most_passes=3)
