import re
from collections import Counter

from conftest import SF001
from riskgrid.llm.decontaminate import drop_contaminated, leaked_passages


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())


def shingles(w):
    k = min(5, len(w))
    return Counter(" ".join(w[i:i + k]) for i in range(len(w) - k + 1)) if w else Counter()


def brute(docs, items, least=0.8):
    out = {}
    for d, text in docs:
        w = words(text)
        for i, it in items:
            iw = words(it)
            if not iw:
                continue
            b = shingles(iw)
            starts = range(max(len(w) - len(iw), 0) + 1)
            best = max((sum((a & b).values()) / max(1, sum((a | b).values())) for a in (shingles(w[s:s + len(iw)]) for s in starts)), default=0)
            if best >= least:
                out[d, i] = max(best, out.get((d, i), 0))
    return out


ITEM = " ".join(f"k{i}" for i in range(50))
ITEMS = [(1, ITEM), (2, "alpha beta gamma delta epsilon zeta eta theta"), (3, None), (4, ""), (5, "Two words"), (6, ITEM), (7, "one")]


def test_pairs_against_brute_force(spark):
    inner = ITEM.split()
    docs = [(1, "x y z " * 50 + ITEM.upper().replace(" ", "*** ") + " tail " * 30), (2, " ".join(inner[:25] + ["NEW"] + inner[26:])),
            (3, " ".join(inner[:30])), (4, " ".join(inner[:20] + ["in"] + inner[20:])), (5, None), (6, ""), (7, "two, words"), (8, "three two words one"),
            (9, "alpha beta gamma delta epsilon zeta eta"), (10, "q alpha beta gamma delta epsilon zeta eta theta"), (11, "w " * 60_000 + ITEM),
            (12, " ".join(inner[1:] + ["end"])), (None, ITEM), (13, ITEM), (13, ITEM), (13, "clean")]
    df = spark.createDataFrame([(d, t, "c") for d, t in docs], "doc_id bigint, text string, th string")
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    want = brute(docs, ITEMS)
    got = {(r["id"], r["item_id"]): r["similarity"] for r in leaked_passages(df, items).collect()}
    assert set(got) == set(want)
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)
    kept = drop_contaminated(df, items)
    assert kept.columns == df.columns
    bad = {d for d, _ in want}
    assert sorted((r.doc_id, r.text) for r in kept.collect() if r.text) == sorted(
        (d, t) for d, t in docs if t and (d not in bad or t == "clean"))
    assert leaked_passages(df.limit(0), items).count() == 0
    assert leaked_passages(df, items.limit(0)).count() == 0


def test_passages_out_of_order_against_brute_force(spark):
    """Shared shingles far from their place in the item still make up a window."""
    w = [f"m{i}" for i in range(59)]
    items = [(1, " ".join(w)), (2, " ".join(f"m{i}" for i in range(2, 61))), (3, " ".join(["a", "b", "c", "d"] * 10)), (4, " ".join(f"s{i}" for i in range(8)))]
    front, back = [f"f{i}" for i in range(70)], [f"g{i}" for i in range(45)]
    docs = [(1, front + w[29:] + w[:29] + back), (2, w[29:] + w[:29]), (3, front + w[12:] + w[:12] + back), (4, front + w[47:] + w[:47]),
            (5, w[40:] + w[20:40] + w[:20] + back), (6, front + w[:29] + back + w[29:]), (7, front + w[2:] + ["m59", "m60"] + back + w),
            (8, ["a", "b", "c", "d"] * 30), (9, ["c", "d", "a", "b"] * 9 + back), (10, front + [f"s{i}" for i in range(8)]), (11, w[5:])]
    docs = [(d, " ".join(t)) for d, t in docs]
    want = brute(docs, items)
    assert {(1, 1), (2, 1), (3, 1), (4, 1)} <= set(want) and (6, 1) not in want
    got = {(r["id"], r["item_id"]): r for r in leaked_passages(spark.createDataFrame(docs, "doc_id bigint, text string"),
                                                               spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    assert set(got) == set(want)
    assert all(abs(got[k]["similarity"] - want[k]) < 1e-12 for k in want)


def test_given_tables_against_brute_force(spark):
    docs, items = (spark.read.parquet(f"{SF001}/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute([(r.doc_id, r.text) for r in docs.collect() if len(r.text) < 1200], [(r.item_id, r.text) for r in items.limit(40).collect()])
    got = {(r["id"], r["item_id"]) for r in leaked_passages(docs.filter("length(text) < 1200"), items.limit(40)).collect()}
    assert want and got == set(want)


def test_items_of_the_same_words_and_without_an_id(spark):
    items = [(1, ITEM), (1, ITEM), (2, ITEM.upper() + "!"), (None, ITEM), (3, "one two three"), (3, ITEM)]
    docs = [(1, "x " * 9 + ITEM), (2, "one two three"), (3, "nothing")]
    got = [tuple(r) for r in leaked_passages(spark.createDataFrame(docs, "doc_id bigint, text string"),
                                             spark.createDataFrame(items, "item_id bigint, text string"))
           .select("id", "item_id", "similarity", "start_word").collect()]
    assert sorted(got, key=str) == sorted([(1, 1, 1.0, 9), (1, 2, 1.0, 9), (1, 3, 1.0, 9), (1, None, 1.0, 9), (2, 3, 1.0, 0)], key=str)
