"""SimHash near-dedup by covering locality-sensitive hashing (operator 5).

1. Fingerprint every whole text in Arrow-fed tasks (``fingerprints``).
2. Pre-aggregate exact repeats of a fingerprint to one node.
3. Covering tables: for radius r every bit position gets a nonzero vector of
   r + 1 bits; table v (one per nonzero v) keeps the positions whose vector has
   odd inner product with v.  Any r differing positions leave some v orthogonal
   to all of them, so two fingerprints within r agree on table v's mask:
   every link collides in one of the 2^(r+1) - 1 tables.
4. A bucket never becomes a list of all its pairs.  Two members: one distance
   test on its min and max.  Up to ``pair_bucket`` members: one task step finds
   the bucket's spanning links.  Larger buckets: members meet at every value
   within r/2 flips of both, inside the bucket's unmasked bits; two members
   share such a value exactly when they are within r, and each value links its
   members in a star to the smallest.  Both ways are exact, the second is
   linear in the bucket.
5. Connected components by alternating large-star / small-star rounds, each
   round written to the shared checkpoint folder.

Null text counts as empty (fingerprint zero).  Empty input gives an empty
result.  Rows with a null id are fingerprinted and linked like any other; a
component's id is its smallest non-null id, null if it has none.  Repeated rows
each get their row.  Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, free_names, text_or_empty
from .components import connected_components

BITS = 64


def text_fingerprint(text: str, shingle: int = 4, seed: int = 42) -> int:
    """64-bit SimHash over ``shingle``-word shingles, repeats included."""
    words = text.encode("utf-8").lower().split()  # bytes: folds A-Z, splits at ASCII space
    if not words:
        return 0
    norm = b" ".join(words)
    if len(words) <= shingle:
        return _vote([xxhash.xxh64_intdigest(norm, seed)])
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-shingle] + 1))
    digest = xxhash.xxh64_intdigest
    return _vote([digest(norm[a:b], seed) for a, b in zip(starts.tolist(), ends[shingle - 1:].tolist())])


def _vote(hashes: list[int]) -> int:
    h = np.array(hashes, dtype="<u8")
    ones = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 4, seed: int = 42) -> DataFrame:
    """(id, th, fp): ``th`` is a hash of the text that tells rows of one id apart."""
    src = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    src = src.withColumn("th", F.xxhash64("text"))
    id_type = dict(src.dtypes)["id"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fp = np.array([text_fingerprint(t, shingle, seed) for t in b["text"]], dtype=np.uint64).view(np.int64)
            yield pd.DataFrame({"id": b["id"], "th": b["th"], "fp": fp})

    if id_type in ("bigint", "int"):
        # nullable integers would reach pandas as floats; carry them as text
        src = src.withColumn("id", F.col("id").cast("string"))
        out = src.mapInPandas(run, "id string, th bigint, fp bigint")
        return out.withColumn("id", F.col("id").cast(id_type))
    return src.mapInPandas(run, f"id {id_type}, th bigint, fp bigint")


def covering_masks(radius: int) -> list[int]:
    """2^(radius+1) - 1 masks over 64 bits that cover every ``radius`` positions."""
    width = 2 ** (radius + 1) - 1
    vectors = [i % width + 1 for i in range(BITS)]  # all nonzero vectors in turn
    return [sum(1 << i for i, u in enumerate(vectors) if (u & v).bit_count() & 1) for v in range(1, width + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _table_rows(nodes: DataFrame, masks: list[int]) -> DataFrame:
    """(t, key, fp): every node in every covering table."""
    tables = F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
                       for t, m in enumerate(masks)])
    return nodes.select("fp", F.explode(tables).alias("e")).select("e.t", "e.key", "fp")


def _bucket_links(radius: int):
    """Spanning links inside one bucket of bounded size, block by block."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            a, b = [], []
            for fps in batch["fps"]:
                x = np.sort(np.asarray(fps, dtype=np.int64))
                u = x.view(np.uint64)
                left = np.ones(len(x), dtype=bool)
                # grow each linked part from its smallest member
                while left.any():
                    front = [int(np.flatnonzero(left)[0])]
                    left[front[0]] = False
                    while front:
                        i = front.pop()
                        near = np.flatnonzero(left & (np.bitwise_count(u ^ u[i]) <= radius))
                        left[near] = False
                        a += [int(x[i])] * len(near)
                        b += x[near].tolist()
                        front += near.tolist()
            yield pd.DataFrame({"a": np.array(a, dtype=np.int64), "b": np.array(b, dtype=np.int64)})
    return run


def _flips(mask: int, most: int) -> list[int]:
    """XOR masks of up to ``most`` flips among the bits ``mask`` leaves free."""
    free = [i for i in range(BITS) if not mask >> i & 1]
    return [sum(1 << i for i in c) for k in range(most + 1) for c in combinations(free, k)]


def _meeting_links(hot: DataFrame, masks: list[int], radius: int) -> DataFrame:
    """Links of over-full buckets: members within radius of each other share a
    value within radius / 2 flips of both; each value links its members to the
    smallest of them."""
    spark = hot.sparkSession
    flips = spark.createDataFrame([(t, _signed(f)) for t, m in enumerate(masks) for f in _flips(m, radius // 2)],
                                  "t int, flip bigint")  # some 529 rows a table, fixed by the radius
    met = hot.join(F.broadcast(flips), "t").select("t", "key", "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("at"))
    hubs = cut_lineage(met.groupBy("t", "key", "at").agg(F.min("fp").alias("hub"), F.count("*").alias("n"))
                       .filter("n > 1").drop("n"))
    return (met.join(hubs, ["t", "key", "at"]).filter("fp <> hub")
            .select(F.col("hub").alias("a"), F.col("fp").alias("b")))


def links(nodes: DataFrame, radius: int = 4, pair_bucket: int = 32768) -> DataFrame:
    """(a, b) links over the distinct ``fp`` of ``nodes``; their components are
    those of all pairs within ``radius`` bits (0, 2 or 4).  ``nodes`` is read
    several times and should be a stored table."""
    if radius not in (0, 2, 4):
        raise ValueError("the radius must be 0, 2 or 4 bits")
    masks = covering_masks(radius)
    rows = _table_rows(nodes, masks)
    buckets = cut_lineage(rows.groupBy("t", "key")
                          .agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
                          .filter("n > 1"))
    two = buckets.filter("n = 2").filter(_distance(F.col("a"), F.col("b")) <= radius).select("a", "b")
    members = rows.join(buckets.filter("n > 2").select("t", "key", "n"), ["t", "key"])
    small = (members.filter(F.col("n") <= pair_bucket).groupBy("t", "key").agg(F.collect_list("fp").alias("fps"))
             .select("fps").mapInPandas(_bucket_links(radius), "a bigint, b bigint"))
    hot = _meeting_links(members.filter(F.col("n") > pair_bucket).select("t", "key", "fp"), masks, radius)
    return two.unionByName(small).unionByName(hot)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                    radius: int = 4, seed: int = 42, pair_bucket: int = 32768) -> DataFrame:
    """One row per document: (id, th, fp, root, component_id).

    ``root`` names the component by its smallest fingerprint; ``component_id``
    is the smallest id in it."""
    rows = cut_lineage(fingerprints(docs, id_col, text_col, shingle, seed))
    nodes = cut_lineage(rows.groupBy("fp").agg(F.min("id").alias("least_id")))
    star = connected_components(links(nodes, radius, pair_bucket))
    linked = star.unionByName(star.select(F.col("root").alias("node"), "root").distinct())
    named = cut_lineage(nodes.join(linked.withColumnRenamed("node", "fp"), "fp", "left")
                        .select("fp", F.coalesce("root", "fp").alias("root"), "least_id"))
    least = cut_lineage(named.groupBy("root").agg(F.min("least_id").alias("component_id")))
    named = cut_lineage(named.drop("least_id").join(least, "root"))
    return rows.join(named, "fp").select("id", "th", "fp", "root", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the row
    with the smallest id stays (of rows with that id, the one with the smallest
    text hash; of identical rows, one)."""
    found = near_duplicates(docs, id_col, text_col, **how).filter(F.col("id").eqNullSafe(F.col("component_id")))
    kid = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("\u0000"))
    i, h = free_names(docs, "__id", "__th")
    keep = cut_lineage(found.groupBy("root").agg(F.min("th").alias(h), F.first(kid("id")).alias(i)).select(i, h))
    marked = docs.withColumn(i, kid(id_col)).withColumn(h, F.xxhash64(text_or_empty(text_col)))
    return (marked.join(keep, [i, h], "left_semi").dropDuplicates([i, h])
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
