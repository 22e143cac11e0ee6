"""Mixing sources to target weights by soft membership (operator 1).

1. Every whole text becomes a few numbers (letters that mark a language, symbol,
   case and digit shares, word length, share of distinct words).
2. A Gaussian naive Bayes classifier learns the domains from all rows of the
   labelled table and gives every document a posterior over them, tempered
   because its features depend on each other.
3. Each document gets a rate r_i >= 0, its expected number of copies.  With t_i
   tokens and posterior p_i, domain d expects T_d = sum_i r_i t_i p_id tokens.
   Projected gradient minimises sum_d (T_d - G_d)^2 / S_d over r >= 0, where
   G_d is the target and S_d the tokens at rate 1, from r = 1.  In the metric
   that weighs documents by tokens the step is r_i <- max(0, r_i - sum_d p_id
   (T_d - G_d) / S_d); as posteriors sum to 1 its matrix is stochastic, so the
   unit step needs no search.
4. An iteration is one pass over the narrow table (tokens, posterior, rate) that
   returns one number per domain; every ``STORE_EVERY`` passes the rates are
   written, so plans stay short.
5. The passes end when every domain is within ``tolerance`` of its target, or when
   a step lowers the squares by less than their share ``still``: then no rates near
   come closer.  Missed targets are named in a ``MissedTargets`` warning, or raised
   as one with ``strict``.

Without ``budget`` the total is ``headroom`` times the smallest at which no
domain has to shrink, so that soft members of a full domain keep a rate near 1.
``copies`` is the rate rounded up or down by a hash of id and text, so it is the
same on every run and its mean is the rate.

Only DataFrame functions are used; the driver sees parameter-sized sums.

Null text counts as empty (no tokens).  Rows with a null id, language or label
are not used for training but get a rate; an id labelled twice takes its larger
label.  Domains without a labelled row or without tokens are left out and the
other weights scaled up.  Without any domain every rate is 1.  Repeated rows each
count and get their row.  Empty tables give empty results.
"""

from __future__ import annotations

import math
import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_WORD, cut_lineage, free_names, text_or_empty

STORE_EVERY = 6
# parameters: target shares by language and quality label
TARGETS = {"en-1": 0.50, "en-0": 0.04, "de-1": 0.14, "de-0": 0.01, "fr-1": 0.14, "fr-0": 0.01, "es-1": 0.15, "es-0": 0.01}
# characters counted together, as shares of the text's bytes
MARKS = {"m_de": "äöüß", "m_es": "ñóí", "m_fr": "éèêç", "m_symbol": "%&#*$", "m_bang": "!", "m_bar": "|"}
FEATURES = (*MARKS, "upper", "digit", "word_bytes", "distinct")


class MissedTargets(UserWarning):
    """The rates do not reach the targets; ``gaps`` has, by domain, the expected
    tokens less the target, as a share of all target tokens."""

    def __init__(self, gaps: dict[str, float], passes: int):
        self.gaps, self.passes = gaps, passes
        super().__init__(f"targets missed after {passes} passes by " + ", ".join(f"{d} {g:+.2%}" for d, g in gaps.items()))


def text_numbers(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, th, n_tokens, x): the row's id, a hash of its text, its words and
    its feature array."""
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("t")).withColumn("th", F.xxhash64("t"))
    rows = rows.withColumn("w", F.regexp_extract_all("t", F.lit(SPACE_WORD), F.lit(0)))
    size = F.greatest(F.octet_length("t"), F.lit(1)).cast("double")
    lost = lambda c: F.octet_length("t") - F.octet_length(F.replace(F.col("t"), F.lit(c), F.lit("")))
    share = lambda n: F.log1p(1000 * n / size)
    marks = [share(sum([lost(c) for c in cs[1:]], lost(cs[0]))) for cs in MARKS.values()]
    n = F.greatest(F.size("w"), F.lit(1)).cast("double")
    return rows.select("id", "th", F.size("w").cast("long").alias("n_tokens"), F.array(
        *marks, share(F.octet_length(F.regexp_replace("t", "[^A-Z]+", ""))), share(F.octet_length(F.regexp_replace("t", "[^0-9]+", ""))),
        F.log1p(size / n), F.size(F.array_distinct("w")) / n).alias("x"))


def fit_domains(numbers: DataFrame, domains_of: DataFrame, domains: list[str], floor: float = 0.05) -> list[dict]:
    """Per learned domain its share, feature means and variances.  ``domains_of``
    has (id, domain); the result is bounded by ``domains``."""
    known = domains_of.filter(F.col("domain").isin(domains) & F.col("id").isNotNull())
    k = range(len(FEATURES))
    rows = (numbers.join(known, "id").groupBy("domain")
            .agg(F.count("*").alias("n"), *[F.avg(F.get("x", F.lit(i))).alias(f"m{i}") for i in k],
                 *[F.var_pop(F.get("x", F.lit(i))).alias(f"v{i}") for i in k]).collect())
    total = sum(r["n"] for r in rows)
    return [{"domain": r["domain"], "share": r["n"] / total, "mean": [r[f"m{i}"] for i in k], "var": [r[f"v{i}"] + floor for i in k]}
            for r in sorted(rows, key=lambda r: r["domain"])]


def _posterior(model: list[dict], temper: float) -> Column:
    """array<double> over the domains of ``model``, from the feature array x."""
    def score(d: dict) -> Column:
        terms = F.zip_with("x", F.array(*[F.struct(F.lit(m).alias("m"), F.lit(v).alias("v")) for m, v in zip(d["mean"], d["var"])]),
                           lambda x, g: (x - g["m"]) * (x - g["m"]) / g["v"])
        base = math.log(d["share"]) - 0.5 * temper * sum(math.log(v) for v in d["var"])
        return F.lit(base) - 0.5 * temper * F.aggregate(terms, F.lit(0.0), lambda s, t: s + t)
    z = F.array(*[score(d) for d in model])
    # lambda variables bind the scores, their maximum and the sum once a row
    e = F.transform(F.array(z), lambda zs: F.transform(F.array(F.array_max(zs)), lambda top: F.transform(zs, lambda v: F.exp(v - top)))[0])[0]
    return F.transform(F.array(e), lambda es: F.transform(
        F.array(F.aggregate(es, F.lit(0.0), lambda s, v: s + v)), lambda t: F.transform(es, lambda v: v / t))[0])[0]


def _rates(base: Column, p: list[Column], steps: list[list[float]]) -> Column:
    r = base
    for g in steps:
        r = F.greatest(F.lit(0.0), r - sum([c * F.lit(x) for c, x in zip(p[1:], g[1:])], p[0] * F.lit(g[0])))
    return r


def mix(docs: DataFrame, domains_of: DataFrame, targets: dict[str, float], id_col: str = "doc_id", text_col: str = "text",
        budget: float | None = None, headroom: float = 1.1, temper: float = 0.5, tolerance: float = 1e-4, still: float = 1e-4, most_passes: int = 1000,
        strict: bool = False) -> DataFrame:
    """(id, th, n_tokens, domain, posterior, rate, copies) for every row;
    ``domain`` is the likeliest one.  ``tolerance`` is a share of all target tokens."""
    numbers = cut_lineage(text_numbers(docs, id_col, text_col))
    model = fit_domains(numbers, domains_of, [d for d, w in targets.items() if w > 0])
    names = [d["domain"] for d in model]
    p = [F.col(f"p{i}") for i in range(len(names))]
    if names:
        state = (numbers.withColumn("p", _posterior(model, temper))
                 .select("id", "th", "n_tokens", *[F.get("p", F.lit(i)).alias(f"p{i}") for i in range(len(names))], F.lit(1.0).alias("r")))
    else:
        state = numbers.select("id", "th", "n_tokens", F.lit(1.0).alias("r"))
    state = cut_lineage(state)

    def totals(rate: Column) -> list[float]:
        sums = state.agg(*[F.coalesce(F.sum(F.col("n_tokens") * c * rate), F.lit(0.0)).alias(f"s{i}") for i, c in enumerate(p)]).first()
        return [float(x) for x in sums]

    steps: list[list[float]] = []
    if names:
        mass = totals(F.col("r"))
        weights = [targets[d] if m > 0 else 0.0 for d, m in zip(names, mass)]
        scale = sum(weights)
        if scale > 0:
            weights = [w / scale for w in weights]
            total = budget if budget is not None else headroom * max(m / w for m, w in zip(mass, weights) if w > 0)
            goal, now, last, done = [w * total for w in weights], mass, math.inf, 0
            squares = lambda sums: sum((a - b) ** 2 / m for a, b, m in zip(sums, goal, mass) if m > 0)
            while missed := max(abs(a - b) for a, b in zip(now, goal)) > tolerance * total:
                if squares(now) > (1 - still) * last or done >= most_passes:
                    break
                last, done = squares(now), done + 1
                steps.append([(a - b) / m if m > 0 else 0.0 for a, b, m in zip(now, goal, mass)])
                now = totals(_rates(F.col("r"), p, steps))
                if len(steps) == STORE_EVERY:
                    state = cut_lineage(state.withColumn("r", _rates(F.col("r"), p, steps)))
                    steps = []
            if missed:
                missing = MissedTargets({d: (a - b) / total for d, a, b in zip(names, now, goal)}, done)
                if strict:
                    raise missing
                warnings.warn(missing, stacklevel=2)
    rate = F.round(_rates(F.col("r"), p, steps), 9)
    draw = F.shiftrightunsigned(F.xxhash64("id", "th", F.lit("copies")), 11) / F.lit(float(1 << 53))
    out = state.withColumn("rate", rate)
    likeliest = F.array_max(F.array(*[F.struct(c.alias("p"), F.lit(d).alias("d")) for c, d in zip(p, names)]))["d"] if names else F.lit(None).cast("string")
    return out.select("id", "th", "n_tokens", likeliest.alias("domain"),
                      F.array(*p).cast("array<double>").alias("posterior"), "rate",
                      (F.floor("rate") + F.when(draw < F.col("rate") - F.floor("rate"), 1).otherwise(0)).cast("long").alias("copies"))


def quality_domains(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", lang_col: str = "lang",
                    label_col: str = "quality") -> DataFrame:
    """(id, domain): language and quality label of the labelled documents."""
    label = (labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
             .agg(F.max(F.col(label_col).cast("int")).alias("y")))
    langs = docs.filter(F.col(lang_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.min(F.col(lang_col).cast("string")).alias("lang"))
    return langs.join(label, "id").select("id", F.concat_ws("-", "lang", "y").alias("domain"))


def mixed_documents(docs: DataFrame, domains_of: DataFrame, targets: dict[str, float], id_col: str = "doc_id",
                    text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` that get a copy, with ``rate`` and ``copies`` (in place of an
    input's own columns of these names, in any case)."""
    kid = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("\u0000"))
    i, h, r, c = free_names(docs, "__kid", "__th", "__rate", "__copies")
    rated = cut_lineage(mix(docs, domains_of, targets, id_col, text_col, **how)
                        .select(kid("id").alias(i), F.col("th").alias(h), F.col("rate").alias(r), F.col("copies").alias(c))
                        .dropDuplicates([i, h]).filter(F.col(c) > 0))
    return (docs.withColumn(i, kid(id_col)).withColumn(h, F.xxhash64(text_or_empty(text_col)))
            .join(rated, [i, h])
            .select(*[F.col(f"`{x}`") for x in docs.columns if x.lower() not in ("rate", "copies")],
                    F.col(r).alias("rate"), F.col(c).alias("copies")))
