import re
from math import log2, sqrt

from conftest import SF001
from pyspark.sql import functions as F
from riskgrid.llm.quality_divergence import ANY, COMMON_WORDS, _js_distance, quality_rules


def brute(text):
    text = text or ""
    word = r"[^\x20\x09-\x0D]+"
    w = re.findall(word, text)
    lines = [x for x in text.split("\n") if re.search(word, x)]
    spots = {}
    for i in range(len(w) - 7):
        spots.setdefault(tuple(w[i:i + 8]), []).append(i)
    rep = {j for s in spots.values() if len(s) > 1 for i in s for j in range(i, i + 8)}
    n = len(w)
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(rep),
            n < 20 or 100 * len(rep) > 30 * n)


CASES = [None, "", " \n\t", "one", "a b c d e f g h " * 4, "x y " * 30, "a b c d e f g h\n a b c d e f g h\na b c d e f g h\n\n\n",
         "w " * 30_000, " ".join(f"é{i % 40}" for i in range(100)) + " #*$ <b> | & %", "é ü 😀 \x85 \x1c z\r\nq\r\n",
         " ".join(map(str, range(50))) + " 3 4 5 6 7 8 9 10 " + " ".join(map(str, range(60)))]


def test_base_counts_against_brute_force(spark):
    rows = [(i, t, "en", 1) for i, t in enumerate(CASES)] + [(0, CASES[8], None, 2), (None, CASES[8], "xx", 3), (0, CASES[8], None, 2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, n_words int")
    got = sorted((tuple(r)[:7] for r in quality_rules(docs).collect()), key=str)
    assert got == sorted(((i, *brute(t)) for i, t, _, _ in rows), key=str)
    assert quality_rules(docs.limit(0)).count() == 0


def test_whole_table_and_verdicts(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    out = quality_rules(docs).collect()
    assert len(out) == len(text)
    for r in out:
        assert tuple(r)[1:7] == brute(text[r.doc_id]), r.doc_id
        assert not (r.base_failed and r.kept)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()}
    good = [r.kept for r in out if labels.get(r.doc_id) == 1 and not r.base_failed]
    bad = [r.kept for r in out if labels.get(r.doc_id) == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.35 * len(bad)


def test_distance(spark):
    p, q = [3.0, 0.0, 5.0], [1.0, 2.0, 1.0]
    df = spark.range(1).select(_js_distance(F.array(*map(F.lit, p)), F.array(*map(F.lit, q)), F.lit(sum(p)), F.lit(sum(q))))
    a, b = [x / sum(p) for x in p], [x / sum(q) for x in q]
    kl = lambda u, v: sum(x * log2(2 * x / (x + y)) for x, y in zip(u, v) if x)
    assert abs(df.first()[0] - sqrt((kl(a, b) + kl(b, a)) / 2)) < 1e-12


def histograms(text, words):
    """Character classes and shares of ``words``, counted one by one."""
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    n = {c: 0 for c in ("upper", "lower", "digit", "wide", "symbol", "space", "other")}
    for c in text:
        n["upper" if "A" <= c <= "Z" else "lower" if "a" <= c <= "z" else "digit" if "0" <= c <= "9" else "wide" if c > "\x7f"
          else "symbol" if c in "#*$%&|<>" else "space" if c in " \t\n\v\f\r" else "other"] += 1
    hits = [sum(x in (w, w.capitalize()) for x in found) for w in words]
    return list(n.values()), hits + [len(found) - sum(hits)]


def distance(p, q):
    a, b = [x / sum(p) for x in p], [x / sum(q) for x in q]
    return sqrt(max(0.0, sum(u * log2(2 * u / (u + v)) for u, v in [*zip(a, b), *zip(b, a)] if u) / 2))


def test_verdicts_against_brute_force_references(spark):
    """References summed and distances taken row by row, on whole texts."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = {r.doc_id: (r.text or "", r.lang if r.lang in COMMON_WORDS else "*") for r in docs.collect()}
    facts = {i: (brute(t), *histograms(t, COMMON_WORDS.get(key, ANY)), key) for i, (t, key) in rows.items()}
    refs = {}
    for base, chars, words, key in facts.values():
        if not base[-1]:
            old = refs.get(key, ([0] * len(chars), [0] * len(words)))
            refs[key] = tuple([x + y for x, y in zip(o, h)] for o, h in zip(old, (chars, words)))
    seen = {True: 0, False: 0}
    for r in quality_rules(docs).collect():
        base, chars, words, key = facts[r.doc_id]
        kept = not base[-1]
        for h, ref, most, long_enough, got in ((chars, refs[key][0], 0.30, len(rows[r.doc_id][0]) >= 300, r.js_char),
                                               (words, refs[key][1], 0.24, base[0] >= 100, r.js_word)):
            if sum(h):
                want = distance(h, ref)
                assert abs(got - want) < 1e-9, r.doc_id
                kept = kept and (not long_enough or want <= most)
        assert r.kept == kept, r.doc_id
        seen[kept] += 1
    assert seen[True] and seen[False]
