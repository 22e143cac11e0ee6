import hashlib
import re

from riskgrid.llm.secret_ledger import RULES, Rule, redact, scan_versions, span_digest


def brute(text):
    text = text or ""
    out = []
    pat = r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD])|(?:[pP][aA][sS][sS][wW][dD])|(?:[sS][eE][cC][rR][eE][tT])|(?:[tT][oO][kK][eE][nN])|(?:[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out += [(m.start(), 0, m.end()) for m in re.finditer(pat, text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


CASES = ["token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\"", "PassWD:short password='longer/one=' é AKIA" + "Z" * 16,
         "API_KEY=abcdef apikey: x api-key=abcdefg", "AKIA" + "A" * 15 + " " + "f" * 24 + "g" + "a" * 23, None, "", "x" * 200_000 + "ſecret=abcdefgh",
         "secret=secret=secret=abc token=ab token:=abcdefg", "-----BEGIN RSA PRIVATE KEY----- ghp_" + "a1" * 18, "toKen=abcdefgh"]


def test_spans_against_brute_force_and_all_paths(spark, tmp_path):
    rows = [(i, c, "p") for i, c in enumerate(CASES)] + [(100, CASES[0], "q"), (100, CASES[0], "q"), (None, CASES[1], None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, blob string")  # blob clashes with an inner name
    out = span_digest(scan_versions(docs, str(tmp_path / "ledger"), ["doc_id"]), ["doc_id"])
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(rows)
    kinds = ("assign", "access", "hex")
    for i, text, _ in rows:
        want = brute(text)
        joined = ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in want)
        r = next(x for x in got if x[0] == i)
        assert r[1:4] == tuple(sum(k == n for _, k, _ in want) for n in range(3))
        assert r[4] == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(r[5].split(","))


def test_only_unseen_pairs_are_scanned(spark, tmp_path):
    path = str(tmp_path / "ledger")
    docs = spark.createDataFrame([(i, c) for i, c in enumerate(CASES)], "doc_id bigint, text string")
    scan_versions(docs, path, ["doc_id"]).collect()
    first = spark.read.parquet(path).count()
    again = docs.unionByName(spark.createDataFrame([(50, "token=brandnew"), (51, CASES[0])], docs.schema))
    scan_versions(again, path, ["doc_id"]).collect()
    assert first == len(set(c or "" for c in CASES)) and spark.read.parquet(path).count() == first + 1
    newer = (*RULES[:2], Rule("hex", 2, r"[0-9a-f]{30,}"), *RULES[3:])
    found = scan_versions(again, path, ["doc_id"], rules=newer).collect()
    added = spark.read.parquet(path).filter("array_contains(rules, 'hex@2')")
    assert added.count() == first + 1 and added.filter("size(rules) > 1").count() == 0
    assert not [f for r in found for f in r.findings if f.rule == "hex@1"]
    assert scan_versions(docs.limit(0), path, ["doc_id"]).count() == 0


def test_redaction_replaces_exactly_the_spans(spark, tmp_path):
    docs = spark.createDataFrame([(i, c, "k") for i, c in enumerate(CASES)], "doc_id bigint, text string, kind string")
    out = redact(scan_versions(docs, str(tmp_path / "l"), docs.columns))
    assert out.columns == docs.columns
    found = {r.doc_id: r.findings for r in scan_versions(docs, str(tmp_path / "l"), ["doc_id"]).collect()}
    for r in out.collect():
        text, want, at = CASES[r.doc_id], "", 0
        for a, b in sorted((f.start, f.end) for f in found[r.doc_id]):
            want, at = (want + text[at:a] + "[secret]", b) if a >= at else (want, max(at, b))
        assert r.text == (want + text[at:] if text is not None else None)


def test_no_part_of_a_private_key_remains(spark, tmp_path):
    lines = [("MIIEpAIBAAKCAQEA/+" + "Zz9xK4" * 8)[:64] for _ in range(5)] + ["Qm9keQ=="]
    begin, end = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    info = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,00FF00FF00FF00FF\n\n"
    body = "\n".join(lines)
    cases = [(f"a {begin}\n{body}\n{end} z", "a [secret] z"), (f"a {begin}\n{info}{body}\n{end}\nz", "a [secret]\nz"),
             (f"a {begin}\r\n" + "\r\n".join(lines) + f"\r\n{end}", "a [secret]"), (f'k = "{begin}\\n' + "\\n".join(lines) + f'\\n{end}\\n"', 'k = "[secret]\\n"'),
             (f"a {begin}\n{body}\nThe end of it", "a [secret]\nThe end of it"), (f"a {begin}\n{info}{body}", "a [secret]"),
             ("\n".join(["# " + x for x in [begin, *lines]]) + "\n# more words", "# [secret]\n# more words"),
             (f"{begin}\n{body}\n\n{begin}\n{body}\n{end}", "[secret]\n\n[secret]"), (f"{begin} is how a key begins", "[secret] is how a key begins"),
             (f"{begin}\n{lines[0]}\n{lines[1][:30]}", "[secret]"), (begin.replace("RSA ", "") + f"\n{body}\n" + end.replace("RSA ", ""), "[secret]"),
             (f"{begin}\n" + "words and more\n" * 20_000, "[secret]\n" + "words and more\n" * 20_000),
             ((begin + "\n") * 3_000, "[secret]\n" * 3_000)]
    docs = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(cases)], "doc_id bigint, text string")
    got = {r.doc_id: r.text for r in redact(scan_versions(docs, str(tmp_path / "l"), docs.columns)).collect()}
    assert [got[i] for i in range(len(cases))] == [want for _, want in cases]


def test_jwt_in_one_pass():
    import random
    import re
    import time

    from riskgrid.llm.secret_ledger import MORE_RULES, find_jwt
    rule = next(r for r in MORE_RULES if r.kind == "jwt")
    rng = random.Random(2)
    for _ in range(4000):
        t = "".join(rng.choices(["eyJ", "abcdefgh", "a", ".", "-", " ", "eyJabcdefgh.abcdefgh.abcdefgh"], k=rng.randint(1, 14)))
        assert find_jwt(t) == [m.span() for m in re.finditer(rule.pattern, t, re.A)], t
    began = time.time()
    assert find_jwt("eyJ" * 1_000_000) == []
    assert time.time() - began < 5
