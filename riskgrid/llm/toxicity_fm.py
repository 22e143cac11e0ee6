"""Toxicity by a factorization machine over hashed terms (operator 8).

A text's distinct lower-cased words and word beginnings are hashed into ``2 ** bits`` slots.  Its
score is the logistic of  w0 + sum w_j x_j + sum_{j<k} <v_j, v_k> x_j x_k : linear
weights plus the learned interaction of every two terms present, such as an
insult with the mention of a group, which linear weights add up separately.

Training takes at most ``max_rows`` labelled rows (a documented bound), chosen
by hash of the id among the rows outside the held-out fold.  Their terms are
hashed in Spark.  Adagrad passes fit the terms that tell the classes apart by
themselves, then all terms, as one that is as frequent in both classes can be
half of a toxic pair; there a stronger penalty handles noise.  The model has at most ``2 ** bits`` x (rank + 1) numbers and is
broadcast to the tasks that score every whole text.

Null text counts as empty and scores sigmoid(w0).  A null id is in no fold and
not held out.  Conflicting labels of one id count as toxic; an id with several
texts trains on the one with the smallest hash.  Without labelled
rows of both kinds every score is the share of toxic labels (0.0 without any).
Repeated rows each get their row.  Empty tables give empty results.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, free_names, text_or_empty

BITS = 20
PREFIXES = (4, 5, 6)
RANK = 4
MAX_ROWS = 20_000
_TERM = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@dataclass
class Machine:
    """Weights of the ``slots`` met in training (ascending); all others are 0."""
    w0: float
    slots: np.ndarray
    w: np.ndarray  # (kept,)
    v: np.ndarray  # (kept, rank)

    def score(self, slots: np.ndarray) -> float:
        z = self.w0
        at = _among(slots, self.slots)
        if len(at):
            vs = self.v[at]
            s = vs.sum(axis=0)
            z += float(self.w[at].sum() + 0.5 * (s @ s - (vs * vs).sum()))
        return float(1.0 / (1.0 + np.exp(-min(max(z, -40.0), 40.0))))


def _among(slots: np.ndarray, kept: np.ndarray) -> np.ndarray:
    """Places in ``kept`` of those ``slots`` that are kept; both ascend."""
    if not len(kept):
        return np.empty(0, np.int64)
    at = np.searchsorted(kept, slots)
    at[at == len(kept)] = 0
    return at[kept[at] == slots]


def slots_of(text: str, bits: int = BITS) -> np.ndarray:
    """Slots of the distinct terms, ascending.  Terms are the words and, for
    inflected and compound forms, their prefixes of a few UTF-8 bytes."""
    words = set(_TERM.findall(text.encode("utf-8").lower()))
    terms = set(words)
    for n in PREFIXES:
        terms.update(w[:n] + b"*" for w in words if len(w) >= n)
    mask = (1 << bits) - 1
    return np.unique(np.fromiter((zlib.crc32(t) & mask for t in terms), np.int64, len(terms)))


def fold(id_col: Column, folds: int = 5) -> Column:
    return F.crc32(id_col.cast("string")) % folds


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          max_rows: int = MAX_ROWS, bits: int = BITS, least_df: int = 5, least_z: float = 5.0) -> Machine:
    """The machine fitted on up to ``max_rows`` labelled rows outside the
    held-out fold, on every slot in at least ``least_df`` of them (a slot in
    fewer only fits noise)."""
    picked = (labels.filter(F.col(label_col).isNotNull() & (fold(F.col(id_col)) != 0))
              .groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("y"))
              .orderBy(F.xxhash64("id"), "id").limit(max_rows))  # max_rows bounds the broadcast below

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"id": b["id"], "y": b["y"], "slots": [slots_of(t, bits).astype(np.int32).tobytes() for t in b["text"]]})

    rows = cut_lineage(docs.select(F.col(id_col).cast("string").alias("id"), text_or_empty(text_col).alias("text"))
                       .join(F.broadcast(picked.withColumn("id", F.col("id").cast("string"))), "id")
                       # one text an id: however often an id repeats, max_rows holds
                       .groupBy("id").agg(F.max("y").alias("y"), F.min_by("text", F.xxhash64("text")).alias("text"))
                       .select("id", "y", "text").mapInPandas(hashed, "id string, y int, slots binary"))
    n, toxic = rows.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    if not 0 < toxic < n:
        share = toxic / n if n else 0.0
        return Machine(-40.0 if share == 0 else 40.0, np.empty(0, np.int64), np.empty(0), np.empty((0, RANK)))
    data = sorted((zlib.crc32(r["id"].encode()), r["id"], r["slots"], int(r["y"])) for r in rows.toLocalIterator())
    df = np.zeros(1 << bits, np.int64)
    for _, _, slots, _ in data:
        df[np.frombuffer(slots, np.int32)] += 1  # a row's slots are distinct
    kept = np.flatnonzero(df >= least_df)
    return fit([(y, _among(np.frombuffer(slots, np.int32), kept).astype(np.int32)) for _, _, slots, y in data], kept, least_z=least_z)


def _tells_apart(rows: list[tuple[int, np.ndarray]], size: int, least_z: float) -> np.ndarray:
    """Whether a slot's frequencies in the two classes differ by a two-sample z of ``least_z``."""
    n, toxic = len(rows), sum(y for y, _ in rows)
    df, pos = np.zeros(size), np.zeros(size)
    for y, slots in rows:
        df[slots] += 1
        pos[slots] += y
    spread = np.sqrt(df / n * (1 - df / n) * (1 / toxic + 1 / (n - toxic)))
    return (spread > 0) & (np.abs(pos / toxic - (df - pos) / (n - toxic)) >= least_z * spread)


def fit(rows: list[tuple[int, np.ndarray]], kept: np.ndarray, rank: int = RANK, passes: int = 30, rate: float = 0.5,
        l2: float = 1e-5, batch: int = 64, seed: int = 7, least_z: float = 5.0, all_passes: int = 10,
        weak_l2: float = 10.0, weak_start: float = 30.0) -> Machine:
    """Adagrad on the logistic loss over (label, places in ``kept``), in
    mini-batches of a fixed order.  Both labels must occur.

    ``passes`` go over the slots that tell the classes apart alone, then
    ``all_passes`` over all slots from there.  A text has hundreds of other
    slots, so these take a stronger penalty (``weak_l2``) and smaller first
    steps (``weak_start``); weights and factors of a pair grow all the same.
    """
    size, toxic = len(kept), sum(y for y, _ in rows)
    rng = np.random.default_rng(seed)
    w, v = np.zeros(size), rng.normal(0, 0.01, (size, rank))
    w0 = float(np.log(toxic / (len(rows) - toxic)))
    strong = _tells_apart(rows, size, least_z)
    gw, g0 = np.where(strong, 1e-6, weak_start), 1e-6
    gv, decay = np.repeat(gw[:, None], rank, axis=1), np.where(strong, l2, weak_l2)
    met, place = np.zeros(size, bool), np.zeros(size, np.int64)

    def one_pass(rows: list[tuple[int, np.ndarray]]) -> None:
        nonlocal w0, g0
        order = rng.permutation(len(rows))
        for lo in range(0, len(order), batch):
            part = [rows[i] for i in order[lo:lo + batch]]
            y = np.array([p[0] for p in part], dtype=float)
            slots = np.concatenate([p[1] for p in part])
            doc = np.repeat(np.arange(len(part)), [len(p[1]) for p in part])
            # the batch's slots, ascending, and where each entry's stands among them
            met[slots] = True
            u = np.flatnonzero(met)
            met[u] = False
            place[u] = np.arange(len(u))
            at = place[slots]
            vs = v[u]
            s = np.stack([np.bincount(doc, vs[at, r], len(part)) for r in range(rank)], axis=1)
            sq = np.bincount(doc, (vs * vs).sum(axis=1)[at], len(part))
            z = w0 + np.bincount(doc, w[slots], len(part)) + 0.5 * ((s * s).sum(axis=1) - sq)
            err = 1 / (1 + np.exp(-np.clip(z, -40, 40))) - y
            g0 += err.sum() ** 2
            w0 -= rate * err.sum() / np.sqrt(g0)
            sums = np.bincount(at, err[doc], len(u))
            dw = sums + decay[u] * w[u]
            dv = np.stack([np.bincount(at, (err * s[:, r])[doc], len(u)) for r in range(rank)], axis=1) + (decay[u] - sums)[:, None] * vs
            gw[u] += dw * dw
            gv[u] += dv * dv
            w[u] -= rate * dw / np.sqrt(gw[u])
            v[u] -= 0.2 * rate * dv / np.sqrt(gv[u])

    if strong.any():
        alone = [(y, slots[strong[slots]]) for y, slots in rows]
        for _ in range(passes):
            one_pass(alone)
    for _ in range(all_passes if strong.any() else passes):
        one_pass(rows)
    return Machine(w0, kept, w, v)


def score_rows(docs: DataFrame, model: Machine, text_col: str = "text", bits: int = BITS, out: str = "__score") -> DataFrame:
    """``docs`` with a last column ``out``, which they must not have."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    cols = docs.columns

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        m = shared.value
        return pd.Series([m.score(slots_of(t, bits)) for t in text], dtype=float)

    return docs.select(*[F.col(f"`{c}`") for c in cols], score(text_or_empty(text_col)).alias(out))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic", max_rows: int = MAX_ROWS) -> DataFrame:
    """(id, held_out, score, predicted) for every row of ``docs``."""
    model = train(docs, labels, id_col, text_col, label_col, max_rows)
    return score_rows(docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")), model, text_col).select(
        id_col, F.coalesce(fold(F.col(id_col)) == 0, F.lit(False)).alias("held_out"), F.col("__score").alias("score"),
        F.when(F.col("__score") >= 0.5, 1).otherwise(0).alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               label_col: str = "toxic", max_rows: int = MAX_ROWS) -> DataFrame:
    """The rows of ``docs`` that the machine does not reject."""
    model = train(docs, labels, id_col, text_col, label_col, max_rows)
    name, = free_names(docs, "__score")
    return score_rows(docs, model, text_col, out=name).filter(F.col(name) < 0.5).drop(name)
