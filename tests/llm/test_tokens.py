import numpy as np
import pytest
from conftest import SF001
from riskgrid.llm.token_counts import VOCABULARY, document_lengths, flat_file_blocks, encode, token_counts, tokenizer


def test_counts_against_the_tokenizer(spark, tmp_path):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").repartition(3)
    odd = spark.createDataFrame([(None, "null id"), (-1, None), (-2, ""), (-3, "long " * 50_000), (-4, "same"), (-4, "same"), (2**60 + 1, "<|endoftext|>")], docs.schema)
    docs = docs.unionByName(odd)
    encode = tokenizer(VOCABULARY).encode_ordinary
    want = sorted(((r.doc_id, len(encode(r.text or ""))) for r in docs.collect()), key=str)
    got = token_counts(docs, str(tmp_path / "a"), block_bytes=512).collect()
    assert sorted(((r.doc_id, r.n_tokens) for r in got), key=str) == want
    assert token_counts(docs.limit(0), str(tmp_path / "b")).count() == 0


@pytest.mark.parametrize("block", [2, 6, 64, 4096])
def test_flat_files_against_a_split(spark, tmp_path, block, monkeypatch):
    monkeypatch.setattr("riskgrid.llm.token_counts.GROUP", 5)
    rng = np.random.default_rng(block)
    want = {}
    for k in range(3):
        ids = rng.integers(0, 4, 700).astype("<u2")
        if k == 1:
            ids[ids == 3] = 1  # a file without a separator
        if k == 2:
            ids[-1] = 3
        ids.tofile(tmp_path / f"f{k}.bin")
        ends = [-1, *np.flatnonzero(ids == 3).tolist()]
        lens = [(b - a - 1, True) for a, b in zip(ends, ends[1:])]
        if ends[-1] < len(ids) - 1:
            lens.append((len(ids) - 1 - ends[-1], False))
        want[f"f{k}.bin"] = lens
    (tmp_path / "empty.bin").touch()
    got = {}
    for r in document_lengths(flat_file_blocks(spark, str(tmp_path), block), 3).collect():
        got.setdefault(r.shard.rsplit("/", 1)[1], {})[r.seq] = (r.n_tokens, r.closed)
    assert {f: [d[i] for i in range(len(d))] for f, d in got.items()} == want


def test_long_white_space(spark, tmp_path, monkeypatch):
    encoding = tokenizer(VOCABULARY)
    cases = [a + b + c for a in ("", "x", "it's", "\u3000") for c in ("", "y", "'s", "7", "\u3000z")
             for b in (" " * 5000, "\n" * 5000, " \n" * 2500, "\t" * 4097 + " ", "\u3000" * 4096, "\x1c" * 5000 + " " * 4096)]
    for t in cases + ["a" + " " * 6000 + "b" + "\n" * 5000 + "c"]:
        assert encode(encoding, t) == encoding.encode_ordinary(t)
    docs = spark.createDataFrame([(1, " " * 10_000_000), (2, "x" + "\n" * 10_000_000 + "y")], "doc_id bigint, text string")
    got = {r.doc_id: r.n_tokens for r in token_counts(docs, str(tmp_path / "w")).collect()}
    assert got == {1: 10_000_000, 2: 1 + (10_000_000 - 1 + 1) // 2 + 1 + 1}
