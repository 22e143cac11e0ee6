import random
import re
from collections import Counter

import pytest
from riskgrid.llm import source_divergence
from riskgrid.llm.source_divergence import divergence

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"


def brute(rows, least):
    docs = []
    for text, lang, source in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        docs.append((lang or "", source or "", Counter(re.findall(TERM, low))))
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = Counter(t for _, _, c in own for t in c)
        kept = [t for t, n in df.items() if n >= least]
        total = Counter()
        count = {s: Counter() for s in {d[1] for d in own}}
        for _, s, c in own:
            count[s] += c
            total += c

        def share(c):
            n = sum(c[t] for t in kept) + 5 * len(kept)
            return {t: 1 + (10**9 * (c[t] + 5)) // n for t in kept}
        p, q = {s: share(c) for s, c in count.items()}, share(total)
        for s in count:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in count if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if count[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, 50)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, t, v, r + 1) for r, (t, v) in enumerate(found[:most])]
    return sorted(out)


def rows():
    rng = random.Random(5)
    bag = ["".join(rng.choices("abcdeéÉ漢", k=rng.randint(1, 3))) for _ in range(300)]
    out = []
    for i in range(400):
        s = f"s{min(i % 9, 4)}"
        own = rng.sample(bag, 40) if s == "s1" else bag
        out.append((" ".join(rng.choices(own, k=rng.randint(0, 60))) + ("1X_" if i % 7 else "\n"), "en" if i % 3 else "de", s))
    out += [("A b", None, None), (None, "en", "empty"), ("", "solo", "s1"), ("word", "few", "a"), ("other", "few", "b"), (None, None, "s9")]
    return out + out[:40] + [("a b " * 100_000, "en", "s2")]


@pytest.mark.parametrize("bits", [64, 5])
def test_against_brute_force(spark, bits, monkeypatch):
    data = rows()
    docs = spark.createDataFrame([(*r, "x", 1, 2) for r in data], "text string, lang string, source string, term string, digest int, sub int")
    got = divergence(docs.repartition(6), least_docs=8, bits=bits)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    want = brute(data, 8)
    assert sorted(map(tuple, got.collect())) == want
    assert any(r[2] == "term" for r in want) and ("few", "a", "pair", "b", 0, 1) in want
    # nothing shipped, many blocks
    monkeypatch.setattr(source_divergence, "MOST_SHIPPED", -1)
    monkeypatch.setattr(source_divergence, "BLOCK_CELLS", 50)
    monkeypatch.setattr(source_divergence, "CHUNK", 300)
    assert sorted(map(tuple, divergence(docs, least_docs=8, bits=bits).collect())) == want


def test_empty(spark):
    docs = spark.createDataFrame([], "text string, lang string, source string")
    assert divergence(docs).count() == 0


def test_only_digests_move(spark):
    docs = spark.createDataFrame([(1, b"a b"), (2, b"")], "gid long, text binary")
    assert [f.dataType.typeName() for f in source_divergence.count_rows(docs).schema] == ["long"] * 4


def test_hashes_follow_the_bytes():
    hasher = source_divergence.TermHasher()
    data = "Ab ab 1ab\x00ÄB äb ab_AB  b ba ".encode()
    low, start, end = hasher.terms(data)
    words = [low[a:z].tobytes() for a, z in zip(start, end)]
    assert words == re.findall(rb"[a-z\x80-\xff]+", data.lower())
    for which in (0, 1):
        h = hasher.hashes(low, start, end, which).tolist()
        assert len(set(zip(words, h))) == len(set(words)) == len(set(h))
    assert hasher.terms(b"")[1].tolist() == [] and hasher.terms(b"x")[2].tolist() == [1]
