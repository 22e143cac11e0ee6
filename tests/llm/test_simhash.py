import random

import numpy as np
import pytest
import xxhash
from riskgrid.llm.components import connected_components
from riskgrid.llm.simhash_dedup import covering_masks, keep_one, links, near_duplicates, text_fingerprint


def brute_fp(text):
    w = [x.translate({i: i + 32 for i in range(65, 91)}) for x in __import__("re").findall(r"[^\x20\x09-\x0D]+", text or "")]
    sh = [" ".join(w[i:i + 4]) for i in range(len(w) - 3)] or ([" ".join(w)] if w else [])
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def parts(fps, radius=4):
    """Brute-force component label (smallest member) of each fingerprint."""
    root = {f: f for f in fps}
    changed = True
    while changed:
        changed = False
        for a in fps:
            for b in fps:
                if (a ^ b).bit_count() <= radius:
                    m = min(root[a], root[b])
                    if root[a] != m or root[b] != m:
                        root[a] = root[b] = m
                        changed = True
    return root


@pytest.mark.parametrize("text", ["", " \t\n", "One", "a b c d", "A b\tC d\x0be É x y z", "x " * 300 + "É" * 5000])
def test_fingerprint_is_the_contract(text):
    assert text_fingerprint(text) == brute_fp(text)


def test_masks_cover_every_pair_of_radius():
    masks = covering_masks(4)
    assert len(masks) == 31
    rng = random.Random(1)
    for _ in range(3000):
        diff = sum(1 << i for i in rng.sample(range(64), 4))
        assert any(not diff & m for m in masks)


@pytest.mark.parametrize("pair_bucket", [32768, 2])
def test_links_give_the_brute_force_components(spark, pair_bucket):
    rng = random.Random(7)
    fps = set()
    for _ in range(12):
        x = rng.getrandbits(64)
        for _ in range(9):
            fps.add(x)
            for i in rng.sample(range(64), rng.randint(1, 5)):
                x ^= 1 << i
    signed = [int(np.uint64(f).view(np.int64)) for f in fps]
    want = parts([int(s) & (2**64 - 1) for s in signed])
    nodes = spark.createDataFrame([(s,) for s in signed], "fp bigint")
    star = {r.node: r.root for r in connected_components(links(nodes, 4, pair_bucket)).collect()}
    got = {}
    for s in signed:
        got.setdefault(star.get(s, s), set()).add(s & (2**64 - 1))
    brute = {}
    for f, r in want.items():
        brute.setdefault(r, set()).add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, brute.values()))


def test_documents_edges_and_keep(spark):
    base = " ".join(f"w{i}" for i in range(400))
    rows = [(5, base, "x"), (3, base, "y"), (9, base.replace("w7 ", "W7  "), "z"), (4, "other words here now please", "x"),
            (1, None, "x"), (2, "", None), (7, "  ", "q"), (None, base, "x"), (8, "other words here now please", None),
            (8, "other words here now please", None), (None, "alone " * 3, "n")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, th string")  # th clashes with an inner name
    got = {(r.id, r.fp): r.component_id for r in near_duplicates(docs).collect()}
    comp = lambda i: {c for (k, _), c in got.items() if k == i}
    assert comp(5) == comp(9) == {3} and comp(2) == comp(7) == {1} and comp(8) == {4}
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, 3, 4, None]
    assert near_duplicates(docs.limit(0)).count() == 0
    assert keep_one(docs.limit(0)).count() == 0
