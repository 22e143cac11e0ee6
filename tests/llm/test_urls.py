import random

import pytest
from riskgrid.llm.url_rules import RULES, judge_urls


def brute(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else default


CASES = ["http://EXAMPLE.org/es/x?y#z", "https://a.b.example.org/en/12", "http://notexample.org/es/", "x://com/fr/", "http://a.com/fr",
         "http://a.com/de/1", None, "", "no scheme.org/", "http://", "http://?q", "http://org", "http://org/", "http://.org/a",
         "http://a..org/b", "http://Ünï.org/É/", "a://b://c.com/de/", "http://x.y,z.org:80/", "http://u@example.org/es/\n/de/", "\nhttp://q.org/z"]


def test_contract_rules_against_brute_force(spark):
    rows = [(i, u, "k") for i, u in enumerate(CASES)] + [(0, CASES[0], "k"), (None, CASES[1], None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, key string")
    got = sorted(map(tuple, judge_urls(pages).collect()), key=str)
    assert got == sorted(((i, *brute(u, RULES)) for i, u, _ in rows), key=str)
    assert judge_urls(pages.limit(0)).count() == 0
    assert {r.verdict for r in judge_urls(pages, rules=[], default="block").collect()} == {"block"}


@pytest.mark.parametrize("parts", ["3", "17"])
def test_nested_random_rules(spark, parts):
    rng = random.Random(3)
    labels = ["a", "b", "ab", "c-", "z", "é"]
    host = lambda n: ".".join(rng.choice(labels) for _ in range(n))
    rules = list({(host(rng.randint(1, 4)), rng.choice(["/", "/x", "/x/y", "/é/"])): rng.choice(["allow", "block"]) for _ in range(60)}.items())
    rules = [(h, p, v) for (h, p), v in rules]
    urls = [f"http://{host(rng.randint(1, 6))}{rng.choice(['', '/', '/x/y/z', '/x?x', '/é/1', '/y'])}" for _ in range(600)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    was = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = {r[0]: r for r in judge_urls(pages, rules).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    for i, u in enumerate(urls):
        assert tuple(got[i])[1:] == brute(u, rules), u
