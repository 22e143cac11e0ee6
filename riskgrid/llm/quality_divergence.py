"""Quality rules by distribution divergence (operator 9).

Each whole text becomes two histograms: character classes, and the common words
of its language (with one bin for all other words).  The language references
are the summed histograms of all documents of the language that pass the base
rules.  A document whose Jensen-Shannon distance to its reference is too large
in either histogram is dropped, unless it is too short for that histogram to
mean anything.

Two passes: the histograms are written once as a narrow table, summed into the
references (a row per language key), and compared.  No text is shuffled.
Only DataFrame functions are used.

Null text counts as empty (fails the word minimum).  A null or unlisted language
is compared under the key ``*``, with the leading words of all lists.  Repeated
rows each get their row.  Empty tables give empty results.  Only the id, text
and language columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_WORD, cut_lineage, text_or_empty

WINDOW = 8
BINS = 12
# parameters: the common words whose shares are compared
COMMON_WORDS = {
    "de": ["der", "die", "und", "den", "das", "in", "von", "zu", "mit", "sich", "auf", "ist"],
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "was", "on"],
    "es": ["de", "la", "que", "el", "en", "y", "los", "se", "del", "las", "un", "por"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est"],
}
ANY = [w for words in zip(*COMMON_WORDS.values()) for w in words][:BINS]
CHAR_CLASSES = ("n_upper", "n_lower", "n_digit", "n_wide", "n_symbols", "n_space", "n_other")


def _windows_hash(words: Column, hashes: Column) -> Column:
    """One hash per 8-word window (empty if there are fewer words)."""
    n = F.size(words)
    return F.when(n >= WINDOW, F.transform(
        F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)]))
    ).otherwise(F.array().cast("array<bigint>"))


def text_profile(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Base counts and histograms of every row."""
    lang = F.col(lang_col).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("t"),
                       F.when(lang.isin(*COMMON_WORDS), lang).otherwise("*").alias("lang_key"))
    rows = rows.withColumn("w", F.regexp_extract_all("t", F.lit(SPACE_WORD), F.lit(0)))
    length_of = lambda drop: F.length(F.regexp_replace("t", drop, "")).cast("long")
    lines = F.filter(F.split("t", "\n", -1), lambda x: x.rlike(SPACE_WORD))
    both = sorted({f for ws in COMMON_WORDS.values() for w in ws for f in (w, w.capitalize())})
    vocab = F.lit(None).cast("array<string>")
    for key, words in {**COMMON_WORDS, "*": ANY}.items():
        vocab = F.when(F.col("lang_key") == key, F.array(*[F.lit(x) for x in words])).otherwise(vocab)
    rows = (rows.withColumn("lines", lines)
            .withColumn("wh", F.transform("w", lambda x: F.xxhash64(x)))
            .withColumn("common", F.transform(F.filter("w", lambda x: x.isin(both)), F.lower))
            .withColumn("vocab", vocab))
    rows = rows.select(
        "id", "lang_key", F.size("w").cast("long").alias("n_words"), F.length("t").cast("long").alias("n_chars"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        length_of("[^A-Z]+").alias("n_upper"), length_of("[^a-z]+").alias("n_lower"), length_of("[^0-9]+").alias("n_digit"),
        length_of(r"[\x00-\x7F]+").alias("n_wide"),
        F.transform("vocab", lambda v: F.size(F.filter("common", lambda x: x == v))).alias("hits"),
        _windows_hash(F.col("w"), F.col("wh")).alias("g"))
    # windows whose hash occurs again, by sorting (hash, place) only where there are any
    at = F.when(F.size(F.array_distinct("g")) < F.size("g"), F.array_sort(F.transform(
        "g", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    rows = rows.withColumn("at", at)
    again = F.array_sort(F.filter(F.transform("at", lambda x, k: F.when(
        (F.get("at", k + 1)["h"] == x["h"]) | (F.get("at", k - 1)["h"] == x["h"]), x["i"])), lambda i: i.isNotNull()))
    rows = rows.withColumn("again", again)
    # each such window covers its words up to the next such window
    cover = F.aggregate(F.zip_with("again", F.slice("again", 2, F.greatest(F.size("again"), F.lit(1))),
                                   lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW)))),
                        F.lit(0).cast("long"), lambda s, x: s + x)
    return rows.select(
        "id", "lang_key", "n_words", "n_chars", "word_chars", "n_symbols", "n_dup_lines",
        F.coalesce(cover, F.lit(0).cast("long")).alias("n_repeat_words"),
        "n_upper", "n_lower", "n_digit", "n_wide", (F.col("n_chars") - F.col("word_chars")).alias("n_space"),
        F.greatest(F.col("word_chars") - F.col("n_upper") - F.col("n_lower") - F.col("n_digit") - F.col("n_wide")
                   - F.col("n_symbols"), F.lit(0)).alias("n_other"),
        F.transform("hits", lambda x: x.cast("long")).alias("hits"))


def _js_distance(p: Column, q: Column, tp: Column, tq: Column) -> Column:
    """Jensen-Shannon distance (base 2) of two count arrays with their totals,
    0 to 1; null if a total is 0.  Array functions keep the generated code small."""
    def bits(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)
    terms = F.zip_with(p, q, lambda x, y: (bits(x / tp, y / tq) + bits(y / tq, x / tp)) / 2)
    return F.when((tp > 0) & (tq > 0), F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda s, x: s + x), F.lit(0.0))))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  max_char: float = 0.30, max_word: float = 0.24, least_chars: int = 300, least_words: int = 100) -> DataFrame:
    """Base counts, the two distances and the verdict for every row."""
    rows = cut_lineage(text_profile(docs, id_col, text_col, lang_col)
                       .withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))))
    classes = F.array(*[F.col(c).cast("double") for c in CHAR_CLASSES])
    words = F.concat(F.transform("hits", lambda x: x.cast("double")),
                     F.array((F.col("n_words") - F.aggregate("hits", F.lit(0).cast("long"), lambda s, x: s + x)).cast("double")))
    rows = (rows.withColumn("p_char", classes).withColumn("p_word", words)
            .withColumn("t_char", sum([F.col(c) for c in CHAR_CLASSES[1:]], F.col(CHAR_CLASSES[0])).cast("double"))
            .withColumn("t_word", F.col("n_words").cast("double")))
    refs = (rows.filter("not base_failed").groupBy("lang_key")
            .agg(F.array(*[F.sum(F.get("p_char", F.lit(i))) for i in range(len(CHAR_CLASSES))]).alias("q_char"),
                 F.array(*[F.sum(F.get("p_word", F.lit(i))) for i in range(BINS + 1)]).alias("q_word"),
                 F.sum("t_char").alias("s_char"), F.sum("t_word").alias("s_word")))
    # one row per listed language and one for the rest
    both = (rows.join(F.broadcast(refs), "lang_key", "left")
            .withColumn("js_char", _js_distance(F.col("p_char"), F.col("q_char"), F.col("t_char"), F.col("s_char")))
            .withColumn("js_word", _js_distance(F.col("p_word"), F.col("q_word"), F.col("t_word"), F.col("s_word"))))
    fits = (((F.col("n_chars") < least_chars) | F.coalesce(F.col("js_char") <= max_char, F.lit(True)))
            & ((F.col("n_words") < least_words) | F.coalesce(F.col("js_word") <= max_word, F.lit(True))))
    return both.select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       "base_failed", (~F.col("base_failed") & fits).alias("kept"), "js_char", "js_word")
