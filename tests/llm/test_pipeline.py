"""The pipeline's rows against a brute-force run of its stages."""

import re
from collections import Counter

import __spark_entry__
import corpus_pipeline
from conftest import SF001
from pyspark.sql import functions as F
from riskgrid.llm.mixing import TARGETS, mix, quality_domains
from riskgrid.llm.secret_ledger import scan_text
from riskgrid.llm.simhash_dedup import text_fingerprint
from riskgrid.llm.toxicity_fm import train, slots_of


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())


def shingles(w):
    return Counter(" ".join(w[i:i + 5]) for i in range(len(w) - 4))


def leaked(text, items):
    w = words(text)
    seen = set(shingles(w))
    for iw in items:
        b = shingles(iw)
        if sum(k in seen for k in b) < 0.8 * len(b):
            continue  # too few shared shingles for 0.8 in any window
        for s in range(max(len(w) - len(iw), 0) + 1):
            a = shingles(w[s:s + len(iw)])
            if sum((a & b).values()) >= 0.8 * sum((a | b).values()):
                return True
    return False


def redacted(text):
    out, at = "", 0
    for a, b in sorted((a, b) for _, a, b in scan_text(text)):
        if a >= at:
            out += text[at:a] + "[secret]"
        at = max(at, b)
    return out + text[at:]


def test_stages_against_brute_force(spark):
    docs, labels, items = (spark.read.parquet(f"{SF001}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    model = train(docs, labels)
    rows = {r.doc_id: r for r in docs.collect()}
    keep = {i for i, r in rows.items() if model.score(slots_of(r.text or "")) < 0.5}
    fp = {i: text_fingerprint(rows[i].text or "") for i in keep}
    root = {i: i for i in keep}
    changed = True
    while changed:
        changed = False
        for a in sorted(keep):
            for b in keep:
                if root[a] < root[b] and (fp[a] ^ fp[b]).bit_count() <= 4:
                    root[b], changed = root[a], True
    keep = {i for i in keep if root[i] == i}
    bench = [words(r.text) for r in items.collect()]
    keep = {i for i in keep if not leaked(rows[i].text, bench)}
    text = {i: redacted(rows[i].text or "") for i in keep}
    out = corpus_pipeline.run(spark, SF001).collect()
    assert set(docs.columns) < set(out[0].asDict())
    assert {r.doc_id for r in out} <= keep and len(out) >= 0.97 * len(keep) and len(out) == len({r.doc_id for r in out})
    for r in out:
        assert r.text == text[r.doc_id] and r.n_chars == len(r.text) and r.copies >= 1
    # the last stage decides as its operator does on the same input
    clean = spark.createDataFrame([(i, text[i], rows[i].lang) for i in sorted(keep)], "doc_id bigint, text string, lang string")
    want = {r.id: (r.rate, r.copies) for r in mix(clean, quality_domains(clean, labels), TARGETS).collect() if r.copies > 0}
    assert {r.doc_id: r.copies for r in out} == {i: c for i, (_, c) in want.items()}
    assert all(abs(r.rate - want[r.doc_id][0]) < 1e-6 for r in out)


def test_empty_tables_and_odd_rows(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    odd = docs.limit(30).unionByName(spark.createDataFrame([(None, None, None, None, None), (None, "", None, None, 0)], docs.schema))
    odd = odd.selectExpr("*", "'mine' as blob_", "1 as th")
    for name, stage in corpus_pipeline.STAGES:
        for df in (odd, odd.limit(0)):
            out = stage(spark, df, SF001)
            assert set(odd.columns) <= set(out.columns)
            assert out.count() <= df.count()


def test_registered():
    names = __spark_entry__.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)) and "pipeline" in names


def test_stages_with_clashing_columns(spark):
    """Names that the stages use inside, in another case too, come through with their values."""
    own = ["blob", "Findings", "__score", "__ID", "__id", "__th", "__kid", "rows", "fp", "root"]
    own = [c for i, c in enumerate(own) if c.lower() not in [x.lower() for x in own[:i]]]
    plain = spark.read.parquet(f"{SF001}/documents.parquet")
    docs = plain.select("*", *[F.concat(F.lit(c), F.col("doc_id")).alias(c) for c in own])
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF001)
        assert out.columns[:len(docs.columns)] == docs.columns, name
        rows = out.collect()
        assert rows and all(r[c] == f"{c}{r.doc_id}" for r in rows for c in own), name
        assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in stage(spark, plain, SF001).collect()), name
    mixed = corpus_pipeline.STAGES[-1][1](spark, plain.withColumn("Rate", F.lit("x")), SF001)
    assert mixed.columns == [*plain.columns, "rate", "copies"] and dict(mixed.dtypes)["rate"] == "double"
