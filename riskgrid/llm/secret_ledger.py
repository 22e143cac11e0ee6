"""Secret scans over an incremental blob ledger (operator 2).

Every version of every path is content-addressed (SHA-256 of its text).  The
ledger is a Parquet table of blobs with the rule versions already run on each
and what they found.  A scan

1. reduces the versions to distinct blobs (copies collapse before the move),
2. subtracts the (blob, rule version) pairs the ledger holds,
3. runs the missing rules on the remaining blobs and appends ledger rows,
4. joins the findings of the current rule versions back to all paths.

Appending is one committed Parquet write, so a scan that dies leaves the ledger
as it was and the next one picks up the unseen pairs.

Null content counts as empty.  Repeated rows each get their findings.  Empty
tables give empty results.  Only the named columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, path_exists, text_or_empty


@dataclass(frozen=True)
class Rule:
    """One kind of secret.  ``anchor`` must occur in any text the pattern can
    match ("" where there is no such literal); ``least`` is the smallest length
    of group ``group``."""
    kind: str
    version: int
    pattern: str
    anchor: tuple[str, ...] = ()
    group: int = 0
    least: int = 0
    any_case: bool = False
    finder: Callable[[str], list[tuple[int, int]]] | None = None

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"

    def find(self, text: str, folded: str) -> list[tuple[int, int]]:
        if self.anchor and not any(a in folded for a in self.anchor):
            return []
        if self.finder:
            return self.finder(text)
        found = re.finditer(self.pattern, text, re.A | (re.I if self.any_case else 0))
        return [m.span() for m in found if m.end(self.group) - m.start(self.group) >= self.least]


# fixed values: the base kinds (assign, access, hex), in their listed order, then added ones
BASE_RULES = (
    Rule("assign", 1, r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         ("password", "passwd", "secret", "token", "api"), 2, 6, True),
    Rule("access", 1, r"AKIA[A-Z0-9]+", ("akia",), 0, 20),
    Rule("hex", 1, r"[0-9a-f]{24,}"),
)
# a private key runs to its END line; where that is lost, through its header lines and base64 lines, which may stand in
# quotes, behind comment signs or in one line with \n written out.  Gaps are possessive, so no text is read twice.
_GAP = r"""(?:[\s"'`,;>#*|+]|\\[nrt])++"""
_PEM = (r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----(?:"
        r"(?:(?!-----BEGIN )[\s\S])*?-----END [A-Z ]{0,40}PRIVATE KEY-----"
        rf"|(?:{_GAP}[A-Za-z][A-Za-z-]{{0,40}}:[^\n\\]{{0,200}}){{0,8}}(?:{_GAP}[A-Za-z0-9+/]{{16,}}+={{0,2}})+"
        r"""(?:["'+\x20\t]*(?:\r?\n|\\n)[\x20\t"'>#*|]*[A-Za-z0-9+/]++={0,2}(?![^\s"'`,;\\]))?)?""")


def find_jwt(text: str) -> list[tuple[int, int]]:
    """What the rule's pattern finds, in one pass: runs of its characters are cut at their
    dots, so no run is read again for every start in it."""
    out = []
    for run in re.finditer(r"[A-Za-z0-9_.-]+", text):
        parts, at, i = run.group().split("."), run.start(), 0
        while i + 2 < len(parts):
            head = parts[i].find("eyJ")
            if 0 <= head <= len(parts[i]) - 11 and len(parts[i + 1]) >= 8 and len(parts[i + 2]) >= 8:
                out.append((at + head, at + len(".".join(parts[i:i + 3]))))
                at += len(".".join(parts[i:i + 3])) + 1
                i += 3
            else:
                at += len(parts[i]) + 1
                i += 1
    return out


MORE_RULES = (
    Rule("pem", 2, _PEM, ("-----begin",)),
    Rule("github", 1, r"gh[pousr]_[A-Za-z0-9]{36,}", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", ("eyj",), finder=find_jwt),
)
RULES = BASE_RULES + MORE_RULES

_FINDINGS = "array<struct<rule:string,start:int,end:int>>"
_HEX = bytes(120 if chr(i) in "0123456789abcdef" else 32 for i in range(256))


def scan_text(text: str, rules: tuple[Rule, ...] = RULES) -> list[tuple[str, int, int]]:
    """(rule key, start, end) of every match; offsets are code points."""
    folded = text.lower()
    out = []
    for rule in rules:
        if rule.kind == "hex" and b"x" * 24 not in text.encode("utf-8").translate(_HEX):
            continue  # no run of 24 hex digits: the pattern cannot match
        out += [(rule.key, a, b) for a, b in rule.find(text, folded)]
    return out


def read_ledger(spark, path: str) -> DataFrame | None:
    return spark.read.parquet(path) if path_exists(spark, path) else None


def scan_versions(versions: DataFrame, ledger_path: str, paths: list[str], content: str = "text",
                  rules: tuple[Rule, ...] = RULES, blob: str = "blob", findings: str = "findings") -> DataFrame:
    """``paths`` columns, the columns named by ``blob`` and ``findings`` for every row
    of ``versions``; the ledger at ``ledger_path`` gains the pairs it lacked."""
    spark = versions.sparkSession
    keys = [r.key for r in rules]
    wanted = F.array(*[F.lit(k) for k in keys])
    text = text_or_empty(content)
    if {blob.lower(), findings.lower()} & {p.lower() for p in paths}:
        raise ValueError(f"paths may not be named {blob} or {findings}")
    blobs = (versions.select(F.sha2(text, 256).alias("blob"), text.alias("content"))
             .groupBy("blob").agg(F.first("content").alias("content")))
    ledger = read_ledger(spark, ledger_path)
    if ledger is None:
        todo = blobs.withColumn("todo", wanted)
    else:
        seen = ledger.groupBy("blob").agg(F.flatten(F.collect_set("rules")).alias("seen"))
        todo = (blobs.join(seen, "blob", "left")
                .withColumn("todo", F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>"))))
                .filter(F.size("todo") > 0))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [[{"rule": k, "start": s, "end": e} for k, s, e in
                      scan_text(c, tuple(r for r in rules if r.key in set(t)))]
                     for c, t in zip(b["content"], b["todo"])]
            yield pd.DataFrame({"blob": b["blob"], "rules": b["todo"], "findings": found})

    (todo.select("blob", "content", "todo")
     .mapInPandas(run, f"blob string, rules array<string>, findings {_FINDINGS}")
     .write.mode("append").parquet(ledger_path))
    state = cut_lineage(read_ledger(spark, ledger_path)
                        .filter(F.size("findings") > 0)
                        .select("blob", F.explode("findings").alias("f"))
                        .filter(F.col("f.rule").isin(keys))
                        .groupBy("blob").agg(F.sort_array(F.collect_set("f")).alias("findings")))
    rows = versions.select(*[F.col(f"`{p}`") for p in paths], F.sha2(text, 256).alias(blob))
    return (rows.join(state.select(F.col("blob").alias(blob), F.col("findings").alias(findings)), blob, "left")
            .select(*[F.col(f"`{p}`") for p in paths], blob,
                    F.coalesce(findings, F.array().cast(_FINDINGS)).alias(findings)))


def redact(found: DataFrame, content: str = "text", mark: str = "[secret]", blob: str = "blob",
           findings: str = "findings") -> DataFrame:
    """``found`` with every finding's span in ``content`` replaced by ``mark``
    (overlapping spans by one) and without its blob and findings columns."""
    text = F.col(f"`{content}`")
    spans = F.array_sort(F.transform(findings, lambda f: F.struct(f["start"].alias("a"), f["end"].alias("b"))))
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    # copy the text up to each span, then the mark; spans that begin inside the last one only extend it
    done = F.aggregate(spans, start, lambda acc, s: F.struct(
        F.when(s["a"] >= acc["at"], F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["a"] - acc["at"]), F.lit(mark)))
        .otherwise(acc["out"]).alias("out"), F.greatest(acc["at"], s["b"]).alias("at")),
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return found.withColumn(content, F.when(F.size(findings) > 0, done).otherwise(text)).drop(blob, findings)


def span_digest(found: DataFrame, keep: list[str], rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per row the base kinds' counts, the hash of their spans and all spans,
    ordered by start, then kind as listed."""
    order = F.array(*[F.lit(r.key) for r in rules])
    base = [r.key for r in BASE_RULES]
    spans = F.array_sort(F.transform("findings", lambda f: F.struct(
        f["start"].alias("start"), F.array_position(order, f["rule"]).alias("at"), f["end"].alias("end"),
        F.substring_index(f["rule"], "@", 1).alias("kind"))))
    text = lambda xs: F.array_join(F.transform(xs, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")
    n = lambda key: F.size(F.filter("findings", lambda f: f["rule"] == key)).cast("long")
    return (found.withColumn("spans_", spans)
            .select(*keep, *[n(r.key).alias(f"n_{r.kind}") for r in BASE_RULES],
                    F.sha2(text(F.filter("spans_", lambda f: f["at"] <= len(base))), 256).alias("base_sha256"),
                    text(F.col("spans_")).alias("spans")))
