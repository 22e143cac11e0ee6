"""Global order without a single-partition window.

``Window.orderBy`` with no ``partitionBy`` pulls every row into one task.
``ordered`` instead cuts the total order into value-defined buckets, numbers
rows (and accumulates sums) inside each bucket with an ordinary partitioned
window, and adds the totals of all earlier buckets of the same group from a
small offsets table (one row per group x bucket).

Bucket boundaries come from a deterministic hash sample whose size follows the
number of buckets, not of rows or tasks, and are picked from it in one task: the
driver gets one list.  A row finds its bucket by a binary search in that list, held
as one literal, so a row's bucket is a pure function of its values: every branch of
the plan and every recomputation after a lost executor agree on it.  (A physical
range partition would not: Spark samples its input in arrival order, which is not
stable after a shuffle.)

The order must be unique within each group (add the key as the last sort
column, or aggregate to distinct values first, which also absorbs hot
values).  Used by the time split (F5), exact quantiles (D2-D4, D8, D12, D16,
D17, D23, D24) and cumulative curves (D18-D22, F8).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskgrid.session import checked_broadcast, shuffle_partitions

MAX_BUCKETS = 8192
SAMPLE_PER_BUCKET = 20


def _sort_key(df: DataFrame, name: str, asc: bool) -> Column:
    c = F.col(name)
    if asc:
        return c
    numeric = df.schema[name].dataType.typeName() in (
        "double", "float", "long", "integer", "short", "byte", "decimal")
    if not numeric:
        raise TypeError(f"descending order needs a numeric column: {name}")
    return -c.cast("double")


def _bucket_expr(df: DataFrame, keys: list[Column], bounds: list[tuple]) -> Column:
    """How many boundaries are not greater than the row.

    A binary search over one literal array, by halved steps that carry one number:
    the generated code has the same size for any number of boundaries.  The first
    fields decide most steps; else structs compare field by field with nulls first,
    as the windows sort.
    """
    key = F.struct(*[k.alias(f"_k{i}") for i, k in enumerate(keys)])
    kind = df.select(F.array(key).alias("b")).schema["b"].dataType
    table = F.array(*[F.struct(*[F.lit(v) for v in b]) for b in bounds]).cast(kind)

    def climb(at: Column, step: Column) -> Column:
        first = F.get(table["_k0"], at + step - 1)
        return F.when(first < keys[0], at + step).when(first > keys[0], at) \
            .when(F.get(table, at + step - 1) <= key, at + step).otherwise(at)  # no boundary there: null
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(bounds).bit_length()))])
    return F.aggregate(steps, F.lit(0), climb)


def bucket_bounds(df: DataFrame, keys: list[Column], sample_id: Column,
                  n_buckets: int | None = None) -> list[tuple]:
    """Boundaries of ~equal-count buckets from a bounded deterministic sample.

    The rows are counted; those whose ``xxhash64(sample_id)`` lies below a threshold
    that lets about ``2 n_buckets SAMPLE_PER_BUCKET`` through, however many tasks
    hold them, are sorted in one task, which picks the boundaries.  Few rows make one
    bucket.
    """
    if n_buckets is None:
        n_buckets = 2 * shuffle_partitions(df.sparkSession)
    n_buckets = max(1, min(MAX_BUCKETS, int(n_buckets)))
    want = n_buckets * SAMPLE_PER_BUCKET
    total = df.count() if n_buckets > 1 else 0
    if total < want or n_buckets == 1:
        return []
    share = int(min(1.0, 2.0 * want / total) * (1 << 53))
    near = df.filter(F.pmod(F.xxhash64(sample_id), F.lit(1 << 53)) <= F.lit(share)) \
        .select(F.struct(*[k.alias(f"_k{i}") for i, k in enumerate(keys)]).alias("k"))
    size = F.size("s")
    every = F.transform(F.sequence(F.lit(1), F.lit(n_buckets - 1)),
                        lambda i: F.get("s", F.least(size - 1, F.floor(i * size / n_buckets).cast("int"))))
    picked = near.agg(F.array_sort(F.collect_list("k")).alias("s")).filter(size >= n_buckets).select(every.alias("b")).first()
    return list(dict.fromkeys(tuple(r) for r in picked["b"])) if picked else []


def bucketed(df: DataFrame, columns: Sequence[str], bounds: list[tuple] | None = None) -> tuple[DataFrame, list[tuple]]:
    """``df`` with the bucket ``_bkt`` of each row in the order of ``columns``, and the boundaries
    (or those given)."""
    keys = [F.col(c) for c in columns]
    if bounds is None:
        bounds = bucket_bounds(df, keys, F.concat_ws("|", *[k.cast("string") for k in keys]))
    return df.withColumn("_bkt", _bucket_expr(df, keys, bounds).cast("int") if bounds else F.lit(0)), bounds


def ordered(df: DataFrame, order: Sequence[tuple[str, bool]],
            sums: dict[str, Column] | None = None, within: Sequence[str] = (),
            sample_id: Column | None = None, rn_col: str = "_rn",
            n_buckets: int | None = None, group_bound: int | None = None,
            sample_from: DataFrame | None = None) -> DataFrame:
    """Add ``rn_col`` (1-based position in ``order`` inside ``within``) and its
    group size ``<rn_col>_total``; for each ``sums`` entry an inclusive running
    sum ``<name>`` and its group total ``<name>_total``.

    ``order`` is a list of ``(column, ascending)``; descending is allowed for
    numeric columns.  ``sample_id`` identifies rows for the boundary sample
    (defaults to the order columns).  The offsets table has groups x buckets
    rows; it is hinted for broadcast when that is bounded by parameters (no
    ``within``, or ``group_bound`` groups at most), else AQE sizes the join.
    ``sample_from`` may name a cheaper relation with the same key columns
    (e.g. the scan before a de-duplication shuffle) to draw the boundary
    sample from; boundaries only steer balance, never the result.
    """
    within = list(within)
    sums = dict(sums or {})
    keys = [F.col(c) for c in within] + [_sort_key(df, c, a) for c, a in order]
    if sample_id is None:
        sample_id = F.concat_ws("|", *[F.col(c).cast("string") for c, _ in order])
    src = df if sample_from is None else sample_from
    src_keys = [F.col(c) for c in within] + [_sort_key(src, c, a) for c, a in order]
    bounds = bucket_bounds(src, src_keys, sample_id, n_buckets)

    win_order = [F.col(c).asc_nulls_first() if a else F.col(c).desc_nulls_first()
                 for c, a in order]
    base = df.select("*", *[e.alias(f"_v_{n}") for n, e in sums.items()],
                     _bucket_expr(df, keys, bounds).alias("_bkt") if bounds else F.lit(0).alias("_bkt"))
    local_w = Window.partitionBy(*within, "_bkt").orderBy(*win_order)
    run_w = local_w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = base.select("*", F.row_number().over(local_w).alias("_l_rn"),
                        *[F.sum(f"_v_{n}").over(run_w).alias(f"_l_{n}") for n in sums])

    stats = base.groupBy(*within, "_bkt").agg(
        F.count(F.lit(1)).alias("_t_rn"), *[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums])
    before = Window.partitionBy(*within).orderBy("_bkt") \
        .rowsBetween(Window.unboundedPreceding, -1)
    group = Window.partitionBy(*within)
    off_cols = [*within, "_bkt"]
    for n in ["rn", *sums]:
        off_cols += [F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}"),
                     F.sum(f"_t_{n}").over(group).alias(f"_g_{n}")]
    offsets = stats.select(*off_cols)
    groups = 1 if not within else group_bound
    offsets = checked_broadcast(offsets, None if groups is None else groups * (len(bounds) + 1))

    if not bounds and not within:
        # one bucket, no groups: offsets are zero and the totals are scalar
        # subqueries (a join on a constant bucket would fold to a cross join)
        out = [F.col(f"`{c}`") for c in df.columns]
        out += [F.col("_l_rn").cast("long").alias(rn_col),
                base.agg(F.count(F.lit(1))).scalar().alias(f"{rn_col}_total")]
        for n in sums:
            out += [F.col(f"_l_{n}").alias(n), base.agg(F.sum(f"_v_{n}")).scalar().alias(f"{n}_total")]
        return local.select(*out)

    lo, of = local.alias("_lo"), offsets.alias("_of")
    cond = (F.col("_lo._bkt") == F.col("_of._bkt")) if bounds else None
    for c in within:
        e = F.col(f"_lo.{c}").eqNullSafe(F.col(f"_of.{c}"))
        cond = e if cond is None else cond & e
    joined = lo.join(of, cond, "inner")
    out = [F.col(f"_lo.`{c}`").alias(c) for c in df.columns]
    out += [(F.col("_lo._l_rn") + F.col("_of._o_rn")).alias(rn_col),
            F.col("_of._g_rn").alias(f"{rn_col}_total")]
    for n in sums:
        out += [(F.col(f"_lo._l_{n}") + F.col(f"_of._o_{n}")).alias(n),
                F.col(f"_of._g_{n}").alias(f"{n}_total")]
    return joined.select(*out)
