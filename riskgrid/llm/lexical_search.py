r"""Ranked lexical search (operator 12) by multi-query common-subexpression evaluation.

All items of a block of queries are answered in one evaluation.  A score is a sum
over an item's terms, so items that share terms share parts of their sums.
``share_terms`` mines those term sets: terms that stand in exactly the same items
form one class; then, round by round, the pairs of neighbouring nodes that two or
more items have in common become a node of their own.  The result is a directed
graph whose leaves are terms, whose inner nodes are shared term sets, and whose
roots are the items.

A first pass over the texts stores one narrow row per document: its length and the
frequencies of query terms.  Document counts and lengths are summed from it.  A
second pass evaluates the graph for a slice of documents at a time: every node's
accumulator is made once, from two others, whichever items use it.  A task keeps
each item's best rows as it goes; these meet first by (item, salt), then by item,
so no task gets the best rows of all tasks.

Queries come in blocks of about ``BLOCK_TERMS`` (item, term) pairs.  Each block's
graph is bounded by that number and is shipped to the tasks; more queries make more
blocks, never a larger one (but for a single item that is larger by itself).

Items that share an id are one item with the terms of all; a null id is an item.
Null text has no terms, and a document without terms does not count.  Each row of
``docs`` is a document, so repeated rows each hold a rank.  Equal scores rank by
ascending id, nulls last; rows that share their id too, in any order.  Fewer rows
with a score above 0 than asked for: all of them.  An empty table on either side
gives an empty result.  Only ids and texts are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import cut_lineage, text_or_empty

TERM = rb"[0-9A-Za-z\x80-\xff]+"  # in UTF-8: digits, letters and whole non-ASCII characters
BEST = 10
BLOCK_TERMS = 200_000
SLICE_CELLS = 4_000_000
SALTS = 32


def terms_of(text: bytes) -> list[bytes]:
    return re.findall(TERM, text.lower())  # bytes.lower folds A-Z only


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, term), each pair once."""
    kind = items.schema[id_col].dataType
    schema = T.StructType([T.StructField("item", kind), T.StructField("term", T.BinaryType())])

    def rows(batches):
        for b in batches:
            found = [(i, t) for i, text in enumerate(b.column(1).to_pylist()) for t in set(terms_of(text))]
            at = pa.array([i for i, _ in found], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), pa.array([t for _, t in found], pa.binary())], ["item", "term"])

    return items.select(F.col(id_col).alias("item"), text_or_empty(text_col).cast("binary").alias("text")).mapInArrow(rows, schema).distinct()


def share_terms(items: list[list[int]]) -> tuple[list[tuple[int, ...]], list[list[int]]]:
    """From each item's term numbers: the nodes, in an order in which parts come first,
    and each item's nodes.  A node is (term,) or (node, node)."""
    holders = defaultdict(list)
    for i, terms in enumerate(items):
        for t in sorted(terms):
            holders[t].append(i)
    nodes: list[tuple[int, ...]] = []
    classes = defaultdict(list)
    for t, at in sorted(holders.items()):
        classes[tuple(at)].append(t)
    uses: list[list[int]] = [[] for _ in items]
    # classes of many items first, so that items with the same common terms begin alike
    for at, terms in sorted(classes.items(), key=lambda x: (-len(x[0]), x[1])):
        top = None
        for t in terms:
            nodes.append((t,))
            if top is not None:
                nodes.append((top, len(nodes) - 1))
            top = len(nodes) - 1
        for i in at:
            uses[i].append(top)
    while True:
        pairs = Counter(p for seq in uses for p in set(zip(seq, seq[1:])))
        common = {p: None for p, n in pairs.items() if n > 1}
        if not common:
            return nodes, uses
        for i, seq in enumerate(uses):
            out, k = [], 0
            while k < len(seq):
                p = tuple(seq[k:k + 2])
                # of two pairs that overlap the more frequent one is taken
                if p in common and not (k + 2 < len(seq) and pairs[seq[k + 1], seq[k + 2]] > pairs[p]):
                    if common[p] is None:
                        nodes.append(p)
                        common[p] = len(nodes) - 1
                    out.append(common[p])
                    k += 2
                else:
                    out.append(seq[k])
                    k += 1
            uses[i] = out


def postings(docs: DataFrame, id_col: str, text_col: str, numbers: dict[bytes, int]) -> DataFrame:
    """Per document with a term: id, n (all its terms), and the query terms it holds with their frequencies."""
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("id", kind), T.StructField("n", T.LongType()), T.StructField("terms", T.ArrayType(T.IntegerType())),
                           T.StructField("tf", T.ArrayType(T.LongType()))])
    shipped = docs.sparkSession.sparkContext.broadcast(numbers)

    def rows(batches):
        wanted = shipped.value
        for b in batches:
            at, n, terms, tf = [], [], [], []
            for i, text in enumerate(b.column(1).to_pylist()):
                words = terms_of(text)
                if words:
                    held = Counter(w for w in words if w in wanted)
                    at.append(i)
                    n.append(len(words))
                    terms.append([wanted[w] for w in held])
                    tf.append(list(held.values()))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), pa.array(n, pa.int64()),
                                              pa.array(terms, pa.list_(pa.int32())), pa.array(tf, pa.list_(pa.int64()))], ["id", "n", "terms", "tf"])

    return docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).cast("binary").alias("text")).mapInArrow(rows, schema)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def evaluate(nodes: list[tuple[int, ...]], uses: list[list[int]], weights: np.ndarray, m: np.ndarray, doc: np.ndarray,
             term: np.ndarray, tf: np.ndarray) -> np.ndarray:
    """Scores (item, document) of one slice: each node's accumulator is made once."""
    by_term = np.zeros((len(weights), len(m)), dtype=np.int64)
    by_term[term, doc] = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
    acc = np.empty((len(nodes), len(m)), dtype=np.int64)
    for k, parts in enumerate(nodes):
        if len(parts) == 1:
            acc[k] = by_term[parts[0]]
        else:
            np.add(acc[parts[0]], acc[parts[1]], out=acc[k])
    return np.stack([acc[u].sum(axis=0) for u in uses])


def _best(rows: pa.Table, most: int) -> pa.Table:
    """The ``most`` best rows of each item."""
    rows = rows.take(pc.sort_indices(rows, [("item", "ascending"), ("score", "descending"), ("id", "ascending")], null_placement="at_end"))
    item = rows["item"].to_numpy()
    first = np.r_[True, item[1:] != item[:-1]] if len(item) else np.zeros(0, bool)
    place = np.arange(len(item)) - np.maximum.accumulate(np.where(first, np.arange(len(item)), 0))
    return rows.filter(pa.array(place < most))


def _search_block(docs: DataFrame, pairs: list, doc_id: str, doc_text: str, item_kind: T.DataType, most: int) -> DataFrame:
    """(item_id, id, score): the best rows of every item of the block, two steps of selection done."""
    spark = docs.sparkSession
    numbers = {t: k for k, t in enumerate(sorted({bytes(r["term"]) for r in pairs}))}
    of = defaultdict(list)
    for r in pairs:
        of[r["item"]].append(numbers[bytes(r["term"])])
    names = list(of)
    nodes, uses = share_terms([of[i] for i in names])
    found = cut_lineage(postings(docs, doc_id, doc_text, numbers))
    n_docs, length = found.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(numbers), dtype=np.int64)
    for r in found.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # a row per query term of the block
        df[r["t"]] = r["count"]
    graph = spark.sparkContext.broadcast((nodes, uses, np.array([weight(n_docs, int(x)) for x in df], dtype=np.int64),
                                          pa.array(names, to_arrow_type(item_kind))))
    kind = to_arrow_type(found.schema["id"].dataType)
    schema = T.StructType([T.StructField("item_id", item_kind), found.schema["id"], T.StructField("score", T.LongType())])

    def rows(batches):
        nodes, uses, weights, names = graph.value
        step = max(16, SLICE_CELLS // (len(nodes) + len(weights) + len(uses)))
        empty = pa.table({"item": pa.array([], pa.int64()), "id": pa.array([], kind), "score": pa.array([], pa.int64())})
        best, floor = empty, np.ones(len(uses), dtype=np.int64)
        for b in batches:
            for lo in range(0, b.num_rows, step):
                part = b.slice(lo, step)
                n = part.column(1).to_pylist()
                m = np.array([10 + (90 * x * n_docs) // length for x in n], dtype=np.int64)
                held = part.column(2)
                doc = np.repeat(np.arange(len(n)), pc.list_value_length(held).to_numpy(zero_copy_only=False))
                scores = evaluate(nodes, uses, weights, m, doc, held.flatten().to_numpy(), part.column(3).flatten().to_numpy())
                item, at = np.nonzero(scores >= floor[:, None])  # what can still be among the best, ties included
                if len(item):
                    new = pa.table({"item": pa.array(item, pa.int64()), "id": part.column(0).take(pa.array(at)).cast(kind),
                                    "score": pa.array(scores[item, at], pa.int64())})
                    best = _best(pa.concat_tables([best, new]), most)
                    have, which, score = np.bincount(best["item"].to_numpy(), minlength=len(uses)), best["item"].to_numpy(), best["score"].to_numpy()
                    last = np.cumsum(have) - 1
                    full = have >= most
                    floor[full] = score[last[full]]
                    assert (which[last[full]] == np.nonzero(full)[0]).all()
        best = best.combine_chunks()
        for x in best.to_batches():
            yield pa.RecordBatch.from_arrays([names.take(x.column(0)), x.column(1), x.column(2)], ["item_id", "id", "score"])

    return found.mapInArrow(rows, schema)


def search(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id",
           item_text: str = "text", most: int = BEST, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score) for every item, by those names."""
    spark = docs.sparkSession
    kind = items.schema[item_id].dataType
    pairs = cut_lineage(item_terms(items, item_id, item_text))
    blocks = max(1, -(-pairs.count() // block_terms))
    out = None
    for k in range(blocks):
        rows = pairs.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == k).collect()  # about block_terms rows
        if not rows:
            continue
        part = _search_block(docs, rows, doc_id, doc_text, kind, most)
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = spark.createDataFrame([], T.StructType([T.StructField("item_id", kind), T.StructField("id", docs.schema[doc_id].dataType),
                                                      T.StructField("score", T.LongType())]))
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    salted = Window.partitionBy("item_id", "salt").orderBy(*order)
    near = out.withColumn("salt", F.spark_partition_id() % SALTS).withColumn("near", F.row_number().over(salted)).filter(F.col("near") <= most)
    return (near.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order))).filter(F.col("rank") <= most)
            .select("item_id", "rank", F.col("id").alias("doc_id"), "score"))


#: DuckDB twin of ``op12_lexical_search``.
ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
n AS (SELECT rid, count(*) AS n FROM d GROUP BY rid),
tot AS (SELECT count(*) AS nd, sum(n) AS len FROM n),
tf AS (SELECT rid, doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
w AS (SELECT term, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM df, tot),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
part AS (SELECT rid, doc_id, term, w.w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nd) // len))) AS s
    FROM tf JOIN n USING (rid) JOIN w USING (term), tot),
score AS (SELECT item_id, rid, doc_id, sum(s) AS score FROM q JOIN part USING (term) GROUP BY ALL HAVING sum(s) > 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, rid) AS rank FROM score)
SELECT item_id, rank::INTEGER AS rank, doc_id, score::BIGINT AS score FROM ranked WHERE rank <= 10
"""
