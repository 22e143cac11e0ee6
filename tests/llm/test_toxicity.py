import random
import zlib

import numpy as np
from conftest import SF001
from riskgrid.llm.toxicity_fm import Machine, drop_toxic, fit, slots_of, toxicity, train


def test_machine_learns_an_interaction():
    """A pair of terms is toxic together and harmless apart."""
    rng = random.Random(5)
    rows = []
    for _ in range(3000):
        words = [f"n{rng.randrange(40)}" for _ in range(6)]
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        words += ["insult"] * insult + ["group"] * group
        rows.append((int(insult and group), slots_of(" ".join(words))))
    kept = np.unique(np.concatenate([s for _, s in rows]))
    m = fit([(y, np.searchsorted(kept, s)) for y, s in rows], kept)
    say = lambda t: m.score(slots_of(t))
    assert say("insult group n1 n2") > 0.5 > max(say("insult n1 n2"), say("group n1 n2"), say(""))


def test_score_is_the_sum_over_all_pairs():
    """The linear-time score against weights and every pair's product, written out."""
    rng = np.random.default_rng(3)
    kept = np.sort(rng.choice(1 << 12, 60, replace=False))
    m = Machine(-0.3, kept, rng.normal(size=60), rng.normal(size=(60, 4)) / 4)
    for n in (0, 1, 2, 30):
        slots = np.sort(np.concatenate([rng.choice(kept, n, replace=False), np.setdiff1d(rng.choice(1 << 12, 20), kept)]))
        at = [i for i, s in enumerate(kept) if s in slots]
        z = m.w0 + sum(m.w[i] for i in at) + sum(float(m.v[i] @ m.v[j]) for a, i in enumerate(at) for j in at[a + 1:])
        assert abs(m.score(slots) - 1 / (1 + np.exp(-z))) < 1e-12


def test_rows_without_a_slot():
    none, one = np.empty(0, np.int32), np.array([0], np.int32)
    m = fit([(0, none)] * 640 + [(1, one)] * 64, np.array([3]))
    assert m.score(np.array([3])) > 0.5 > m.score(np.array([4]))


def data(spark, n=600):
    rng = random.Random(2)
    docs, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        words = [f"w{rng.randrange(300)}" for _ in range(40)] + (["Moron!"] if bad else [])
        rng.shuffle(words)
        docs.append((i, " ".join(words), f"s{i}"))
        labels.append((i, int(bad)))
    return (spark.createDataFrame(docs, "doc_id bigint, text string, score string"),
            spark.createDataFrame(labels, "doc_id bigint, toxic int"))


def test_held_out_accuracy_and_folds(spark):
    docs, labels = data(spark)
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    out = toxicity(docs, labels).collect()
    assert len(out) == 600
    for r in out:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in out if r.held_out]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.98 * len(held)
    kept = drop_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.filter("text like '%Moron%'").count() <= 3 and kept.count() >= 445


def test_labels_of_the_held_out_fold_are_never_read(spark):
    docs, labels = data(spark)
    other = labels.selectExpr("doc_id", "case when crc32(cast(doc_id as string)) % 5 = 0 then 1 - toxic else toxic end as toxic")
    score = lambda l: {r.doc_id: r.score for r in toxicity(docs, l).collect()}
    assert score(labels) == score(other)


def test_an_id_with_many_rows_trains_once(spark):
    """Copies of a labelled row neither pass the bound on training rows nor shift the scores."""
    docs, labels = data(spark, 200)
    many = docs.unionByName(docs.filter("doc_id = 3").crossJoin(spark.range(300)).select(*docs.columns))
    score = lambda d: {r.doc_id: r.score for r in toxicity(d, labels).collect()}
    assert score(docs) == score(many)


def test_a_pair_of_balanced_terms_is_learned(spark):
    """Each of four terms is as frequent in both classes; only the pairs tell."""
    rng, docs, labels = random.Random(9), [], []
    for i in range(3000):
        one, two = rng.random() < 0.5, rng.random() < 0.5
        words = [f"n{rng.randrange(400)}" for _ in range(30)] + ["insult" if one else "praise", "people" if two else "weather"]
        rng.shuffle(words)
        docs.append((i, " ".join(words)))
        labels.append((i, int(one == two)))
    docs, labels = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    m = train(docs, labels)
    say = lambda t: m.score(slots_of(t)) >= 0.5
    assert say("n1 insult people n2") and say("praise n7 weather") and not say("insult n3 weather") and not say("n5 praise people")
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    held = [r for r in toxicity(docs, labels).collect() if r.held_out]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)


def test_a_few_rows_train(spark):
    docs = spark.createDataFrame([(i, "vile words" if i % 2 else "kind words") for i in range(24)], "doc_id bigint, text string")
    m = train(docs, docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as toxic"))
    assert m.score(slots_of("vile words")) > 0.5 > m.score(slots_of("kind words"))


def test_edges(spark):
    docs, labels = data(spark, 100)
    odd = docs.unionByName(spark.createDataFrame([(None, None, None), (5, "", "x"), (5, "", "x"), (900, "w1 " * 90_000, "y")], docs.schema))
    assert toxicity(odd, labels).count() == 104
    assert {r.score < 1e-9 for r in toxicity(docs, labels.limit(0)).collect()} == {True}
    assert toxicity(docs.limit(0), labels).count() == 0


def test_on_the_given_tables(spark):
    docs, labels = (spark.read.parquet(f"{SF001}/{t}.parquet") for t in ("documents", "labels"))
    assert toxicity(docs, labels).count() == docs.count()
