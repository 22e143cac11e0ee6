import random
import re
import time

from riskgrid.llm import license_scan
from riskgrid.llm.license_scan import BASE, GAP, NOTICES, gram_hashes, license_report, scan

PHRASES = {"cc-by": "cc by", "gpl": "general public license", "reserved": "all rights reserved"}
CASES = [
    "All rights reserved. CC-BY cc by", "All rights, reserved all RIGHTS reserved\nall rights", None, "", "cc", "é cc by É",
    "This work is licensed under the GNU General Public License, version 3.",
    "Licensed under the (new) Apache License, Version 2.0. x", "Licensed under CC BY-NC 4.0.", "Released under the MIT License",
    "word " * 50_000 + "general public license " * 3, "by cc by cc by cc", "the mit under released license",
]


def brute(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    at = [(i, k) for k, p in PHRASES.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
    s = [i for i, _ in at]
    return len(w), len(at), min(s, default=None), max(s, default=None), ",".join(sorted({k for _, k in at}))


def test_base_against_brute_force(spark):
    rows = [(i, t, "h") for i, t in enumerate(CASES)] + [(3, "again all rights reserved", "h"), (0, CASES[0], "h"), (None, CASES[1], None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, h string")
    out = license_report(docs).collect()
    assert len(out) == len(rows)
    got = sorted((tuple(r)[:6] for r in out), key=str)
    assert got == sorted(((i, *brute(t)) for i, t, _ in rows), key=str)
    assert license_report(docs.limit(0)).count() == 0


def test_notices_and_scores(spark):
    docs = spark.createDataFrame(list(enumerate(CASES)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in license_report(docs).collect()}
    assert got[6].labels == "gpl,gpl-3.0" and got[6].score == 1.0
    assert got[7].labels == "apache-2.0" and 0.75 <= got[7].score < 1  # one word inserted
    assert got[8].labels == "cc-by,cc-by-nc" and got[9].labels == "mit"
    assert got[12].labels == "" and got[3].score == 0.0
    assert all(0 <= r.score <= 1 for r in got.values())


def loose(text):
    """The labels of the notices by their votes, word by word."""
    w = [x.encode() for x in words_of(text)]
    out = set()
    for t in NOTICES:
        need, votes = len(t.words) - 1, {}
        for i in range(len(w) - 1):
            for p in range(need):
                if (w[i], w[i + 1]) == (t.words[p], t.words[p + 1]):
                    votes.setdefault(i - p, set()).add(p)
        run = []
        for d in [*sorted(votes), None]:
            if run and (d is None or d - run[-1] > GAP):
                first, last = min(x + min(votes[x]) for x in run), max(x + max(votes[x]) + 1 for x in run)
                if len(set().union(*(votes[x] for x in run))) >= 0.75 * need and last - first <= 1.5 * need + GAP:
                    out.add(t.label)
                run = []
            run.append(d)
    return out


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def test_loose_spans_against_votes(spark):
    rng = random.Random(7)
    texts = []
    for _ in range(300):
        parts = []
        for t in rng.sample(NOTICES, rng.randint(0, 3)):
            w = [x.decode() for x in t.words]
            for _ in range(rng.randint(0, 4)):
                i = rng.randrange(len(w))
                if rng.random() < 0.5:
                    w.insert(i, rng.choice(["very", "the", "license"]))
                elif len(w) > 2:
                    del w[i]
            parts.append(" ".join(w))
            parts.append(" ".join(rng.choices(["and", "the", "license", "under", "x"], k=rng.randint(0, 12))))
        texts.append(". ".join(parts))
    got = {r.id: r for r in scan(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()}
    for i, t in enumerate(texts):
        assert {s.label for s in got[i].spans if s.tid >= len(BASE)} == loose(t), t
    assert any(loose(t) for t in texts)


def test_colliding_hashes_do_not_vote(spark, monkeypatch):
    monkeypatch.setattr(license_scan, "gram_hashes", lambda words, known: gram_hashes(words, known) % 3 + 1)
    docs = spark.createDataFrame(list(enumerate(CASES)), "doc_id bigint, text string")
    got = {r.doc_id: tuple(r)[1:6] for r in license_report(docs, templates=BASE).collect()}
    assert got == {i: brute(t) for i, t in enumerate(CASES)}


def test_long_matching_texts(spark):
    notice = "This work is licensed under the GNU General Public License, version 3. Released under the MIT License. "
    began = time.time()
    r = license_report(spark.createDataFrame([(1, notice * 12_000), (2, "general public license " * 70_000)], "doc_id bigint, text string")).collect()
    assert time.time() - began < 60
    got = {x.doc_id: x for x in r}
    assert got[1].n_base == 12_000 and "gpl-3.0" in got[1].labels and got[2].n_base == 70_000
