"""Benchmark decontamination by SimHash of item-sized windows (operator 4).

1. Screen: a window with weighted-shingle similarity ``least`` to an item shares
   at least that share of the item's shingles with it.  One pass matches every
   text shingle against the items' shingles (broadcast after a count, else a
   shuffled join); texts in which fewer of an item's shingles occur are left out.
2. Windows: in those texts, every window of the item's size, at whatever start,
   that holds so many shared shingles, with the SimHash of its shingles.  The
   order of the shared shingles plays no part, as it plays none in the
   similarity, so no window that can reach ``least`` is left out.  A window
   carries the item whose shingles it holds.
3. Multi-index Hamming blocks: 64 bits in 8 blocks; fingerprints within 23 bits
   agree in some block up to 2 flips.  Items are indexed under every key within
   2 flips of each block, so a window looks up 8 exact keys and meets its item
   whenever that is within the radius.  At this radius the block keys of any two
   fingerprints meet often, so the item is part of the key: a window meets the
   items of the screen, not all of its size.
4. Verify: exact similarity sum(min) / sum(max) over shingle counts.  At
   similarity 0.8 fingerprints differ in some 10 bits of 64 (standard deviation
   3), far inside the radius.

Words are lower-cased runs of digits, letters and non-ASCII characters, so
symbols and case cannot hide a passage.  Shingles have five words (an item with
fewer words is one shingle).  Only DataFrame functions are used.

Null text counts as empty; empty items match nothing.  Rows and items with a null
id are checked like any other.  Items of the same words are searched once and each
gets its pairs.  Repeated rows and items give one pair per (id, item).
Empty tables give empty results.  Extra columns are carried by
``drop_contaminated`` and ignored elsewhere.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import alnum_words, cut_lineage, free_names, text_or_empty

BLOCKS, BLOCK_BITS, RADIUS = 8, 8, 23
BROADCAST_SHINGLES = 500_000
SLICE = 32  # window starts a row holds at once; words are cut for one such row at a time


def _shingle_hashes(word_hashes: Column, k: int) -> Column:
    n = F.size(word_hashes)
    spots = F.when(n >= k, F.sequence(F.lit(0), n - k)).otherwise(F.array().cast("array<int>"))
    return F.transform(spots, lambda i: F.xxhash64(*[F.get(word_hashes, i + j) for j in range(k)]))


def _shingles(words: Column, shingle: int) -> Column:
    """array<string> of shingles; fewer words than a shingle: one of them all."""
    n = F.size(words)
    k = F.least(n, F.lit(shingle))
    spots = F.when(n > 0, F.sequence(F.lit(0), n - k)).otherwise(F.array().cast("array<int>"))
    return F.transform(spots, lambda i: F.array_join(F.slice(words, i + 1, k), " "))


def simhash(shingles: Column) -> Column:
    """64-bit fingerprint: a bit is set if over half the shingle hashes set it."""
    hashes = F.transform(shingles, lambda s: F.xxhash64(s))
    one = F.lit(1).cast("bigint")
    # binding the hashes to a lambda variable computes them once a row
    return F.transform(F.array(hashes), lambda hs: F.aggregate(
        F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("bigint"),
        lambda acc, b: acc.bitwiseOR(F.when(
            2 * F.size(F.filter(hs, lambda h: F.getbit(h, b) == 1)) > F.size(hs),
            F.call_function("shiftleft", one, b)).otherwise(F.lit(0).cast("bigint")))))[0]


def weighted_similarity(a: Column, b: Column) -> Column:
    """sum(min(count)) / sum(max(count)) over the shingles of two lists."""
    shared = F.aggregate(F.array_distinct(a), F.lit(0), lambda s, x: s + F.least(
        F.size(F.filter(a, lambda y: y == x)), F.size(F.filter(b, lambda y: y == x))))
    return shared / F.nullif(F.size(a) + F.size(b) - shared, F.lit(0))


def _block_keys(fp: Column) -> list[Column]:
    return [F.call_function("shiftrightunsigned", fp, F.lit(BLOCK_BITS * i)).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).cast("int")
            for i in range(BLOCKS)]


def _index(fp: Column, flips: list[int]) -> Column:
    """array<struct<block, key>>: the block keys, each XORed with every flip."""
    masks = F.array(*[F.lit(f) for f in flips])

    def block(i: int, key: Column) -> Column:
        return F.transform(masks, lambda f: F.struct(F.lit(i).alias("block"), key.bitwiseXOR(f).alias("key")))
    return F.flatten(F.array(*[block(i, key) for i, key in enumerate(_block_keys(fp))]))


def _starts(spots: Column, length: Column, enough: Column, last: Column) -> Column:
    """Every start up to ``last``, once, from which ``length`` places hold
    ``enough`` of the ascending ``spots``."""
    def run(p: Column, i: Column) -> Column:  # holds p[i] .. p[i + enough - 1], and not p[i - 1]
        lo = F.greatest(F.lit(0), F.get(p, i + enough - 1) - length + 1, F.coalesce(F.get(p, i - 1), F.lit(-1)) + 1)
        hi = F.least(F.get(p, i), last)
        return F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))
    # binding the spots to a lambda variable computes them once a row
    return F.transform(F.array(spots), lambda p: F.flatten(F.transform(
        F.when(F.size(p) >= enough, F.sequence(F.lit(0), F.size(p) - enough)).otherwise(F.array().cast("array<int>")),
        lambda i: run(p, i))))[0]


def _key(id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("string"), F.lit("\u0000"))


def item_table(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item_id, key, iw) of the items that have words; ``key`` names the words."""
    return (items.select(F.col(id_col).alias("item_id"), alnum_words(text_or_empty(text_col)).alias("iw"))
            .filter(F.size("iw") > 0).distinct().withColumn("key", F.sha2(F.array_join("iw", " "), 256)))


def passage_table(members: DataFrame, shingle: int) -> DataFrame:
    """One row per different item: a number (fixed once written), its words'
    hashes, shingles and fingerprint."""
    return (members.select("key", "iw").dropDuplicates(["key"]).withColumn("item", F.monotonically_increasing_id())
            .withColumn("size", F.size("iw")).withColumn("k", F.least("size", F.lit(shingle)))
            .withColumn("ish", _shingles(F.col("iw"), shingle)).withColumn("ifp", simhash(F.col("ish")))
            .withColumn("iwh", F.transform("iw", lambda x: F.xxhash64(x))).drop("iw"))


def leaked_passages(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    item_id: str = "item_id", item_text: str = "text", shingle: int = 5, least: float = 0.8) -> DataFrame:
    """(kid, th, id, item_id, similarity, start_word, n_words, distance): every
    row of ``docs`` and item for which a window reaches ``least``, with the best
    window.  (kid, th) name the row: its id as text and a hash of its text."""
    members = cut_lineage(item_table(items, item_id, item_text))
    table = cut_lineage(passage_table(members, shingle))
    members = members.join(table.select("key", "item"), "key").select("item", "item_id")
    sizes = [r["k"] for r in table.select("k").distinct().collect()]  # at most ``shingle`` values
    parts = [table.filter(F.col("k") == k).select("item", "size", "k", F.posexplode(_shingle_hashes(F.col("iwh"), k)).alias("tpos", "h"))
             for k in sizes]
    if not parts:
        kinds = {f.name: f.dataType.simpleString() for f in [docs.schema[id_col], members.schema["item_id"]]}
        return docs.sparkSession.createDataFrame(
            [], f"kid string, th bigint, id {kinds[id_col]}, item_id {kinds['item_id']}, similarity double,"
                " start_word int, n_words int, distance int")
    probes = parts[0]
    for p in parts[1:]:
        probes = probes.unionByName(p)
    probes = cut_lineage(probes)
    if probes.count() <= BROADCAST_SHINGLES:
        probes = F.broadcast(probes)

    text = text_or_empty(text_col)
    rows = (docs.select(_key(id_col).alias("kid"), F.xxhash64(text).alias("th"), alnum_words(text).alias("w"))
            .select("kid", "th", F.size("w").alias("n"), F.transform("w", lambda x: F.xxhash64(x)).alias("wh")))
    grams = None
    for k in sizes:
        g = rows.select("kid", "th", "n", F.lit(k).alias("k"), F.posexplode(_shingle_hashes(F.col("wh"), k)).alias("pos", "h"))
        grams = g if grams is None else grams.unionByName(g)
    # what any window that reaches ``least`` has in common with the item, at least
    enough = F.ceil(F.lit(least) * (F.col("size") - F.col("k") + 1)).cast("int")
    hits = (grams.join(probes, ["k", "h"])
            .groupBy("kid", "th", "item", "size", "k", "n")
            .agg(F.size(F.collect_set("tpos")).alias("at"), F.sort_array(F.collect_set("pos")).alias("spots"))
            .withColumn("enough", enough).filter(F.col("at") >= F.col("enough")))
    # rows of at most SLICE starts
    windows = cut_lineage(hits.select("kid", "th", "item", "size", F.explode(_starts(
        F.col("spots"), F.col("size") - F.col("k") + 1, F.col("enough"), F.greatest(F.col("n") - F.col("size"), F.lit(0)))).alias("start"))
        .groupBy("kid", "th", "item", "size", F.floor(F.col("start") / SLICE).cast("int").alias("part")).agg(F.collect_set("start").alias("starts"))
        .groupBy("kid", "th").agg(F.collect_list(F.struct("item", "size", "part", "starts")).alias("wins")))

    cut = (docs.select(_key(id_col).alias("kid"), F.col(id_col).alias("id"), text.alias("t"), F.xxhash64(text).alias("th"))
           .join(windows, ["kid", "th"])
           .select("kid", "th", "id", "wins", alnum_words(F.col("t")).alias("w"))
           .select("kid", "th", "id", "w", F.explode("wins").alias("x"))
           .select("kid", "th", "id", "x.item", "x.size", "x.part", "x.starts",
                   F.slice("w", F.col("x.part") * SLICE + 1, F.col("x.size") + SLICE - 1).alias("w"))
           .select("kid", "th", "id", "item", "size", "part", "w", F.explode("starts").alias("start"))
           .select("kid", "th", "id", "item", "size", "start",
                   _shingles(F.slice("w", F.col("start") - F.col("part") * SLICE + 1, F.col("size")), shingle).alias("sh"))
           .withColumn("fp", simhash(F.col("sh"))))
    most = RADIUS // BLOCKS
    flips = [sum(1 << i for i in c) for r in range(most + 1) for c in combinations(range(BLOCK_BITS), r)]
    # the index holds keys and fingerprints; shingles join the few survivors
    index = table.select("item", "ifp", F.explode(_index(F.col("ifp"), flips)).alias("e"))
    near = (cut.withColumn("e", F.explode(_index(F.col("fp"), [0]))).join(index, ["item", "e"])
            .withColumn("distance", F.bit_count(F.col("fp").bitwiseXOR(F.col("ifp"))).cast("int"))
            .filter(F.col("distance") <= RADIUS)
            .dropDuplicates(["kid", "th", "start", "item"])
            .join(table.select("item", "ish"), "item")
            .withColumn("similarity", weighted_similarity(F.col("sh"), F.col("ish")))
            .filter(F.col("similarity") >= least))
    best = F.max(F.struct("similarity", (-F.col("start")).alias("s"), F.col("size").alias("n"), (-F.col("distance")).alias("d")))
    return (near.groupBy("kid", "th", "id", "item").agg(best.alias("b")).join(members, "item")
            .select("kid", "th", "id", "item_id", "b.similarity", (-F.col("b.s")).alias("start_word"),
                    F.col("b.n").alias("n_words"), (-F.col("b.d")).alias("distance")))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` in which no item was found."""
    i, h = free_names(docs, "__kid", "__th")
    found = cut_lineage(leaked_passages(docs, items, id_col, text_col, **how)
                        .select(F.col("kid").alias(i), F.col("th").alias(h)).distinct())
    return (docs.withColumn(i, _key(id_col)).withColumn(h, F.xxhash64(text_or_empty(text_col)))
            .join(found, [i, h], "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns]))
