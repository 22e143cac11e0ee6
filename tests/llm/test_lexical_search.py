import math
import random
import re

import numpy as np
from riskgrid.llm import lexical_search
from riskgrid.llm.lexical_search import evaluate, search, share_terms

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text):
    return re.findall(TERM, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, most=10):
    docs = [(i, words(t)) for i, t in docs]
    held = [w for _, w in docs if w]
    n_docs, length = len(held), sum(map(len, held))
    df = {}
    for w in held:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    queries = {}
    for i, t in items:
        queries.setdefault(i, set()).update(words(t))
    out = []
    for q, terms in queries.items():
        scores = []
        for i, w in docs:
            s = 0
            for t in terms & set(w):
                tf, m = w.count(t), 10 + (90 * len(w) * n_docs) // length
                s += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * tf) // (1000 * tf + 8 * m))
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(q, r + 1, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scores)[:most])]
    return sorted(out, key=str)


def table(spark):
    rng = random.Random(3)
    bag = [f"w{int(rng.paretovariate(0.7))}" for _ in range(4000)] + ["É", "é", "Über", "x_y", "AB"]
    docs = [(i, " ".join(rng.choices(bag, k=rng.randint(1, 60)))) for i in range(150)]
    docs += [(150 + i, docs[7][1]) for i in range(30)]                    # equal scores
    docs += [(200, None), (201, ""), (202, "!!"), (None, docs[7][1]), (203, "w1 " * 100_000), (5, docs[5][1])]
    shared = " ".join(rng.choices(bag, k=12))
    items = [(k, f"{shared} {' '.join(rng.choices(bag, k=8))}") for k in range(12)]
    items += [(20, None), (21, ""), (22, "nowhereword"), (3, "w9 É"), (None, "w1 w2 x_y"), (23, docs[7][1])]
    d = spark.createDataFrame([(i, t, "c", 1) for i, t in docs], "doc_id bigint, text string, item string, n int")
    return docs, items, d, spark.createDataFrame([(i, t, "c") for i, t in items], "item_id bigint, text string, term string")


def test_against_brute_force(spark):
    docs, items, d, q = table(spark)
    want = brute(docs, items)
    for block in (200_000, 40):
        got = search(d.repartition(5), q, block_terms=block)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted(map(tuple, got.collect()), key=str) == want
    assert search(d.limit(0), q).count() == 0 and search(d, q.limit(0)).count() == 0


def test_slices_and_few_best(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "SLICE_CELLS", 1)  # 16 documents a slice
    docs, items, d, q = table(spark)
    assert sorted(map(tuple, search(d, q, most=3).collect()), key=str) == brute(docs, items, 3)


def leaves(nodes, k):
    return [nodes[k][0]] if len(nodes[k]) == 1 else leaves(nodes, nodes[k][0]) + leaves(nodes, nodes[k][1])


def test_sharing():
    rng = random.Random(1)
    common = list(range(10))
    items = [sorted({*common, *rng.sample(range(10, 80), 6), *([90, 91, 92] if i % 2 else [])}) for i in range(40)]
    nodes, uses = share_terms(items)
    for terms, used in zip(items, uses):
        assert sorted(t for u in used for t in leaves(nodes, u)) == terms  # each term once
    assert all(max(p) < k for k, p in enumerate(nodes) if len(p) == 2)
    # every inner node outside a class stands in two items or more, and sums shrink
    steps = sum(len(p) == 2 for p in nodes) + sum(len(u) - 1 for u in uses)
    assert steps < 0.6 * sum(len(t) - 1 for t in items)
    none = share_terms([[0], [1], []])
    assert none[1] == [[0], [1], []]
    w, m = np.arange(1, 100), np.array([10, 20, 30])
    doc, term, tf = np.array([0, 0, 2]), np.array([3, 90, 5]), np.array([1, 2, 3])
    got = evaluate(nodes, uses, w, m, doc, term, tf)
    for i, terms in enumerate(items):
        assert got[i].tolist() == [sum(int(w[t]) * ((10**9 * int(f)) // (1000 * int(f) + 8 * int(m[d]))) for d, t, f in zip(doc, term, tf)
                                       if d == k and t in terms) for k in range(3)]
