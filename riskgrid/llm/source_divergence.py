r"""Source divergence audit (operator 13) with late string materialisation.

How far apart the sources of a language are in the words they use.  Texts leave
their task as fixed-width rows only: (group, 64-bit term digest, occurrences,
documents), summed per batch of texts, then map-side, then by a shuffle; a group is
a hash of (lang, source), drawn anew should two groups share it.  Terms in
``least_docs`` documents of their language are kept.  A second reading gets the
strings of kept digests alone, as their smallest and largest term.  Where these
differ, two terms share the digest: such digests, and only those, are counted again
by string and told apart by a number beside the digest.  Strings are then joined to
the rows that are put out.

Terms are found and hashed by whole chunks of texts: one table gives each byte's
term byte or 0, prefix sums of bytes times powers give every term's polynomial hash.
Only in the second reading are bytes cut out, once per digest and task; a second
hash tells whether a term is another one with the same digest.

Each group's share of a kept term is ``p = 1 + (10^9 (count + 5)) div (N + 5 V)``
in exact decimals.  Part ``term``: the terms that a source overuses most against
its language.  Part ``pair``: the summed difference of two sources over all kept
terms.  Kept terms are dealt to blocks by digest; a block holds a terms x sources
matrix of bounded size and gives one partial sum for each pair of sources, so the
work per pair is one vectorised pass and no task sees a whole vocabulary.

Null text, lang and source read as ''.  Each row is a document, repeated rows too.
Groups without terms keep their ``pair`` rows.  Equal values rank by item.  A
language without kept terms has pairs of value 0.  An empty table gives an empty
result.  No column but these three is read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskgrid.session import checked_broadcast

from .common import cut_lineage, text_or_empty

TERM = rb"[a-z\x80-\xff]+"  # in lower-cased UTF-8: letters and whole non-ASCII characters
LEAST_DOCS = 30
TOP_TERMS = 50
MOST_SHIPPED = 1_000_000  # digests that are shipped to the tasks to filter there (8 MB)
CHUNK = 1_500_000  # bytes of text hashed at once
BLOCK_CELLS = 100_000
SCALE = 1_000_000_000
# each byte's term byte, A-Z lowered, or 0
TABLE = np.array([i + 32 if 65 <= i <= 90 else i if 97 <= i <= 122 or i >= 128 else 0 for i in range(256)], dtype=np.uint8)
FACTORS = (0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1)


class TermHasher:
    """Finds the terms of byte strings and their 64-bit hashes, with arrays kept for the next chunk."""

    def __init__(self):
        self.powers: dict[tuple[int, bool], np.ndarray] = {}

    def _power(self, which: int, inverse: bool, n: int) -> np.ndarray:
        """1, f, f^2, ... modulo 2^64, or of the inverse of f."""
        found = self.powers.get((which, inverse))
        if found is None or len(found) < n:
            f = pow(FACTORS[which], -1, 2**64) if inverse else FACTORS[which]
            steps = np.full(max(n, 1), f, dtype=np.uint64)
            steps[0] = 1
            found = self.powers[which, inverse] = np.cumprod(steps, dtype=np.uint64)
        return found

    def terms(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bytes as term bytes, start and end of each term)."""
        low = TABLE[np.frombuffer(data, np.uint8)]
        inside = np.empty(len(low) + 2, dtype=bool)
        inside[0] = inside[-1] = False
        np.not_equal(low, 0, out=inside[1:-1])
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        return low, edge[::2], edge[1::2]

    def hashes(self, low: np.ndarray, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
        """Sum of byte_j f^(j - start), then mixed; equal for equal terms wherever they stand."""
        with np.errstate(over="ignore"):
            sums = np.empty(len(low) + 1, dtype=np.uint64)
            sums[0] = 0
            np.cumsum(low * self._power(which, False, len(low))[:len(low)], out=sums[1:])
            h = (sums[end] - sums[start]) * self._power(which, True, len(low) + 1)[start]
            for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                h = (h ^ (h >> np.uint64(shift))) * np.uint64(by)
            return h ^ (h >> np.uint64(31))


def _digest(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> np.uint64(64 - bits)).view(np.int64)


def _chunks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``CHUNK`` bytes; a longer text is a range of its own."""
    first, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > CHUNK:
            yield first, i
            first, held = i, 0
        held += len(t) + 1
    if first < len(texts):
        yield first, len(texts)


def _summed(key: np.ndarray, second: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Rows of equal (key, second) added up; ``second`` is not negative and small."""
    order = np.lexsort((second, key))
    key, second = key[order], second[order]
    first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (second[1:] != second[:-1])]) if len(key) else np.zeros(0, int)
    return key[first], second[first], *(np.add.reduceat(v[order], first) if len(first) else v for v in values)


def count_rows(docs: DataFrame, bits: int = 64) -> DataFrame:
    """(gid, digest, n, docs) of docs' (gid, text), summed per batch of texts."""
    def rows(batches):
        hasher = TermHasher()
        for b in batches:
            names, group = np.unique(b.column(0).to_numpy(), return_inverse=True)
            texts, sums = b.column(1).to_pylist(), []
            for lo, hi in _chunks(texts):
                part = texts[lo:hi]
                if len(part) == 1 and len(part[0]) > CHUNK:  # a very long text: its distinct terms only
                    found = Counter(re.findall(TERM, part[0].lower()))
                    part, times = [b" ".join(found)], np.fromiter(found.values(), np.int64, len(found))
                else:
                    times = None
                low, start, end = hasher.terms(b"\x00".join(part))
                digest = _digest(hasher.hashes(low, start, end), bits)
                at = np.cumsum([0] + [len(t) + 1 for t in part[:-1]])
                doc = np.searchsorted(at, start, side="right") - 1
                digest, doc, n = _summed(digest, doc, np.ones(len(start), np.int64) if times is None else times)
                sums.append(_summed(digest, group[lo:hi][doc], n, np.ones(len(n), np.int64)))
            if sums:
                digest, place, n, df = _summed(*map(np.concatenate, zip(*sums)))
                yield pa.RecordBatch.from_arrays([pa.array(names[place]), pa.array(digest), pa.array(n), pa.array(df)], ["gid", "digest", "n", "docs"])
    return docs.select("gid", "text").mapInArrow(rows, "gid long, digest long, n long, docs long")


def _shipped(wanted: DataFrame):
    """The digests as a broadcast array, or None where they are too many."""
    if wanted.count() > MOST_SHIPPED:
        return None
    return wanted.sparkSession.sparkContext.broadcast(np.sort(np.array([r[0] for r in wanted.collect()], dtype=np.int64)))


def _among(digest: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if not len(wanted):
        return np.zeros(len(digest), bool)
    return wanted[np.minimum(np.searchsorted(wanted, digest), len(wanted) - 1)] == digest


def term_strings(docs: DataFrame, wanted: DataFrame, bits: int = 64) -> DataFrame:
    """(digest, term): the strings of the wanted digests, each at least once.  Digests are
    filtered in the tasks where a count shows that they can be shipped, else by a join."""
    shipped = _shipped(wanted)

    def rows(batches):
        hasher, known = TermHasher(), (np.zeros(0, np.int64), np.zeros(0, np.uint64))
        for b in batches:
            texts = b.column(0).to_pylist()
            for lo, hi in _chunks(texts):
                part = texts[lo:hi]
                if len(part) == 1 and len(part[0]) > CHUNK:
                    part = [b" ".join(set(re.findall(TERM, part[0].lower())))]
                low, start, end = hasher.terms(b"\x00".join(part))
                digest = _digest(hasher.hashes(low, start, end), bits)
                if shipped is not None:
                    keep = _among(digest, shipped.value)
                    digest, start, end = digest[keep], start[keep], end[keep]
                other = hasher.hashes(low, start, end, 1)
                new = []
                rest = np.arange(len(digest))
                while len(rest):  # one string per digest; then the strings that differ from it, if any
                    d, first, back = np.unique(digest[rest], return_index=True, return_inverse=True)
                    new.append(rest[first])
                    rest = rest[other[rest] != other[rest[first]][back]]
                new = np.concatenate(new) if new else rest
                place = np.searchsorted(known[0], digest[new])
                old = _among(digest[new], known[0])
                old[old] = known[1][place[old]] == other[new[old]]
                new = new[~old]
                text = low.tobytes()
                yield pa.RecordBatch.from_arrays([pa.array(digest[new]), pa.array([text[a:z].decode() for a, z in zip(start[new], end[new])], pa.string())],
                                                 ["digest", "term"])
                if len(new) and len(known[0]) < 2_000_000:  # what this task has put out, one string per digest
                    d, first = np.unique(np.concatenate([known[0], digest[new]]), return_index=True)
                    known = d, np.concatenate([known[1], other[new]])[first]
    out = docs.select("text").mapInArrow(rows, "digest long, term string")
    return out.join(wanted.select("digest"), "digest", "left_semi") if shipped is None else out


def string_counts(docs: DataFrame, wanted: DataFrame, bits: int = 64) -> DataFrame:
    """(gid, digest, term, n, docs) of the few digests that terms share, counted by string."""
    shipped = _shipped(wanted)

    def rows(batches):
        hasher = TermHasher()
        for b in batches:
            sums: dict[tuple[int, int, bytes], list[int]] = {}
            for gid, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found = Counter(re.findall(TERM, text.lower()))
                low, start, end = hasher.terms(b" ".join(found))
                digest = _digest(hasher.hashes(low, start, end), bits)
                keep = _among(digest, shipped.value) if shipped is not None else np.ones(len(digest), bool)
                for k, (term, n), d in zip(keep, found.items(), digest.tolist()):
                    if k:
                        s = sums.setdefault((gid, d, term), [0, 0])
                        s[0] += n
                        s[1] += 1
            yield pa.RecordBatch.from_pylist([{"gid": g, "digest": d, "term": t.decode(), "n": n, "docs": m} for (g, d, t), (n, m) in sums.items()],
                                             pa.schema([("gid", pa.int64()), ("digest", pa.int64()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())]))
    out = docs.select("gid", "text").mapInArrow(rows, "gid long, digest long, term string, n long, docs long")
    return out.join(wanted.select("digest"), "digest", "left_semi") if shipped is None else out


def _kept(counts: DataFrame, groups: DataFrame, least_docs: int) -> DataFrame:
    return counts.join(groups.select("gid", "lid"), "gid").groupBy("lid", "digest", "sub") \
        .agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).filter(F.col("docs") >= least_docs).select("lid", "digest", "sub", "lang_n")


def vocabulary(docs: DataFrame, groups: DataFrame, least_docs: int = LEAST_DOCS, bits: int = 64) -> tuple[DataFrame, DataFrame]:
    """Counts (gid, lid, digest, sub, n, lang_n) of the kept terms, and the terms (digest, sub, term)."""
    counts = cut_lineage(count_rows(docs, bits).groupBy("gid", "digest").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"), F.lit(0).alias("sub")))
    kept = cut_lineage(_kept(counts, groups, least_docs))
    ends = cut_lineage(term_strings(docs, kept.select("digest").distinct(), bits).groupBy("digest")
                       .agg(F.min("term").alias("term"), F.max("term").alias("last")))
    shared = ends.filter("term <> last").select("digest")
    terms = ends.select("digest", F.lit(0).alias("sub"), "term")
    if not shared.isEmpty():
        by_text = cut_lineage(string_counts(docs, shared, bits).groupBy("gid", "digest", "term")
                              .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
        # the few terms of one digest, numbered
        told = cut_lineage(by_text.select("digest", "term").distinct()
                           .withColumn("sub", F.row_number().over(Window.partitionBy("digest").orderBy("term"))))
        split = by_text.join(told, ["digest", "term"]).select("gid", "digest", "n", "docs", "sub")
        counts = counts.join(shared, "digest", "left_anti").select("gid", "digest", "n", "docs", "sub").unionByName(split)
        terms = terms.join(shared, "digest", "left_anti").unionByName(told.select("digest", "sub", "term"))
        kept = cut_lineage(_kept(counts, groups, least_docs))
    return counts.drop("docs").join(groups.select("gid", "lid"), "gid").join(kept, ["lid", "digest", "sub"]), terms


def _share(count: Column, total: Column) -> Column:
    """p, exact beyond 64 bits on the way."""
    whole = (F.lit(SCALE).cast("decimal(10,0)") * (count.cast("decimal(19,0)") + F.lit(5).cast("decimal(1,0)"))).cast("decimal(38,0)")
    return F.lit(1) + F.call_function("div", whole, total.cast("decimal(38,0)"))


def _pair_sums(block: pd.DataFrame) -> pd.DataFrame:
    """One block's part of every pair's sum.  Rows without a digest name the groups and their share of a term they lack."""
    own = block["digest"].isna().to_numpy()
    names, zero = block["gid"][own].to_numpy(np.int64), block["p"][own].to_numpy(np.int64)
    order = np.argsort(names)
    names, zero = names[order], zero[order]
    rows = block[~own]
    term = rows.groupby(["digest", "sub"], sort=False).ngroup().to_numpy()
    shares = np.tile(zero, (int(term.max()) + 1 if len(term) else 0, 1))
    shares[term, np.searchsorted(names, rows["gid"].to_numpy(np.int64))] = rows["p"].to_numpy(np.int64)
    parts = []
    for g, name in enumerate(names):
        others = np.arange(len(names)) != g
        parts.append(pd.DataFrame({"gid": name, "other": names[others],
                                   "value": np.abs(shares - shares[:, g:g + 1]).sum(axis=0)[others]}))
    return pd.concat(parts)


def group_table(docs: DataFrame) -> tuple[DataFrame, int]:
    """(lang, source, gid, lid) of every occurring group, and the seed under which no two share a hash."""
    names = cut_lineage(docs.select("lang", "source").distinct())
    for seed in range(100):
        groups = names.select("lang", "source", group_hash(seed).alias("gid"), F.xxhash64(F.lit(seed), "lang").alias("lid"))
        n = groups.agg(F.count("*"), F.count_distinct("gid"), F.count_distinct("lang"), F.count_distinct("lid")).first()
        if n[0] == n[1] and n[2] == n[3]:
            return cut_lineage(groups), seed
    raise RuntimeError("no seed tells the groups apart")


def group_hash(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.octet_length("lang"), "lang", "source")


def divergence(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
               least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS, bits: int = 64) -> DataFrame:
    """(lang, source, part, item, value, rank)."""
    docs = docs.select(text_or_empty(lang_col).alias("lang"), text_or_empty(source_col).alias("source"),
                       text_or_empty(text_col).cast("binary").alias("text"))
    groups, seed = group_table(docs)
    groups = checked_broadcast(groups, groups.count())
    docs = docs.select(group_hash(seed).alias("gid"), "text")
    counts, terms = vocabulary(docs, groups, least_docs, bits)
    counts = cut_lineage(counts)
    size = counts.select("lid", "digest", "sub", "lang_n").distinct().groupBy("lid") \
        .agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    sources = F.count("*").over(Window.partitionBy("lid"))
    # a block's terms x sources, but no fewer terms than some multiple of the pairs it puts out
    cells = F.greatest(F.lit(BLOCK_CELLS), 16 * sources * sources)
    group = (groups.join(counts.groupBy("gid").agg(F.sum("n").alias("total")), "gid", "left").join(size, "lid", "left").na.fill(0)
             .withColumn("blocks", (1 + F.col("v") * sources / cells).cast("int")))
    group = cut_lineage(group.select("gid", "lid", "v", "blocks", (F.col("total") + 5 * F.col("v")).alias("room"),
                                     (F.col("lang_total") + 5 * F.col("v")).alias("lang_room")))
    rows = cut_lineage(counts.join(group.drop("lid"), "gid").select(
        "gid", "lid", "digest", "sub", "blocks", _share(F.col("n"), F.col("room")).alias("p"),
        _share(F.col("lang_n"), F.col("lang_room")).alias("q")))

    # without strings first: all that can be among the first, ties included
    over = rows.filter("p > q").select("gid", "digest", "sub", (F.col("p") - F.col("q")).alias("value"))
    by_value = Window.partitionBy("gid").orderBy(F.col("value").desc())
    over = over.withColumn("near", F.rank().over(by_value)).filter(F.col("near") <= top_terms).join(terms, ["digest", "sub"])
    best = Window.partitionBy("gid").orderBy(F.col("value").desc(), F.col("item"))
    by_term = over.select("gid", F.lit("term").alias("part"), F.col("term").alias("item"), "value") \
        .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top_terms)

    absent = F.when(F.col("v") > 0, _share(F.lit(0), F.col("room"))).otherwise(F.lit(0))
    named = group.select("gid", "lid", F.lit(None).cast("long").alias("digest"), F.lit(0).alias("sub"), absent.alias("p"),
                         F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    dealt = rows.select("gid", "lid", "digest", "sub", "p", F.pmod(F.xxhash64("digest"), "blocks").cast("int").alias("block"))
    sums = (named.unionByName(dealt).groupBy("lid", "block").applyInPandas(_pair_sums, "gid long, other long, value long")
            .groupBy("gid", "other").agg(F.sum("value").alias("value")))
    by_pair = (sums.join(groups.select(F.col("gid").alias("other"), F.col("source").alias("item")), "other")
               .select("gid", F.lit("pair").alias("part"), "item", "value").withColumn("rank", F.row_number().over(best)))
    return by_pair.unionByName(by_term).join(groups, "gid").select("lang", "source", "part", "item", "value", "rank")


#: DuckDB twin of ``op13_source_divergence``.
ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS (SELECT rid, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY ALL HAVING count(DISTINCT rid) >= 30),
size AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
grp AS (SELECT DISTINCT lang, source FROM d),
cells AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
dense AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS lang_n, s.v, s.total
    FROM grp g JOIN kept k USING (lang) JOIN size s USING (lang) LEFT JOIN cells c USING (lang, source, term)),
p AS (SELECT lang, source, term, n,
    1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY lang, source) + 5 * v) AS p,
    1 + (1000000000::HUGEINT * (lang_n + 5)) // (total + 5 * v) AS q FROM dense),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0) AS value
    FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
    LEFT JOIN p y ON y.lang = a.lang AND y.source = b.source AND y.term = x.term GROUP BY ALL),
terms AS (SELECT lang, source, term AS item, p - q AS value FROM p WHERE n > 0 AND p > q),
everything AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs
    UNION ALL SELECT lang, source, 'term', item, value FROM terms),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM everything)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""
