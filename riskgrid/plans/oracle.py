"""Independent DuckDB SQL for every registered query that SQL can express.

Written from the operator semantics, not generated from the DataFrame code.
The driver pre-registers the source tables as views; the derived tables are
CTEs.  Same tie-break everywhere: ``prob desc, obs_key asc``; time order
``valid_time, obs_key``.
"""

from __future__ import annotations

from riskgrid.functions.permute import round_keys

OBS = """
obs AS (
  SELECT concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
                   CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR),
                   CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR)) AS obs_key,
         CAST(l_shipdate AS TIMESTAMP) AS valid_time,
         CAST(l_suppkey AS INTEGER) AS grid_id,
         CASE WHEN l_partkey % 97 = 0 THEN CAST(181.0 AS DOUBLE)
              ELSE CAST(115.0 AS DOUBLE) + l_suppkey % 20 END AS lon,
         CAST(40.0 AS DOUBLE) + l_suppkey % 15 AS lat,
         CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE l_quantity END AS f_qty,
         CASE WHEN l_orderkey % 29 = 0 THEN NULL ELSE l_extendedprice END AS f_price,
         l_discount AS f_disc, l_tax AS f_tax,
         CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN 1 ELSE 0 END AS label,
         CASE WHEN l_returnflag = 'R' AND l_linenumber = 7
              THEN l_extendedprice / 1000 ELSE CAST(0.0 AS DOUBLE) END AS burned_area
  FROM lineitem)"""

CLEAN = OBS + """,
in_bounds AS (
  SELECT * FROM obs WHERE lon BETWEEN -180 AND 180 AND lat BETWEEN -90 AND 90),
dedup AS (SELECT DISTINCT * FROM in_bounds),
cal AS (
  SELECT *, date_trunc('day', valid_time) AS valid_date,
         year(valid_time) AS year, month(valid_time) AS month,
         dayofyear(valid_time) AS doy, weekofyear(valid_time) AS week,
         quarter(valid_time) AS quarter
  FROM dedup),
clean AS (SELECT * FROM cal WHERE month IN (5, 6, 7, 8))"""

SPLIT = CLEAN + """,
ranked AS (
  SELECT *, row_number() OVER (ORDER BY valid_time, obs_key) AS rn,
         count(*) OVER () AS n_all
  FROM clean),
cuts AS (
  SELECT *, floor(n_all * CAST(0.8 AS DOUBLE)) AS te FROM ranked),
splitted AS (
  SELECT *, CASE WHEN rn <= te - floor(te * 0.375) THEN 'train'
                 WHEN rn <= te THEN 'val' ELSE 'test' END AS split
  FROM cuts)"""

SCORED = SPLIT + """,
scored AS (
  SELECT *, round(1 / (1 + exp(-(-2 + 0.04 * coalesce(f_qty, 25) + 4 * f_disc - 6 * f_tax))), 9)
            AS prob
  FROM splitted),
ev AS (SELECT * FROM scored WHERE split IN ('val', 'test')),
ev_tot AS (
  SELECT split, count(*) AS n, CAST(sum(label) AS BIGINT) AS pos FROM ev GROUP BY split)"""

KLIST = "(VALUES (50), (100), (500), (1000)) AS kl(k)"
QLIST = "(VALUES (0.9), (0.99), (0.999)) AS ql(q)"

# the k-part of every top-k table: clamped k, tp at the clamp, threshold and its ECDF
K_FRAME = SCORED + f""",
ev_rank AS (
  SELECT split, obs_key, prob, label,
         row_number() OVER (PARTITION BY split ORDER BY prob DESC, obs_key) AS rn
  FROM ev),
ev_cum AS (
  SELECT *, sum(label) OVER (PARTITION BY split ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING
                             AND CURRENT ROW) AS cum_tp
  FROM ev_rank),
kf AS (
  SELECT t.split, kl.k, least(kl.k, t.n) AS kk, t.n, t.pos
  FROM ev_tot t, {KLIST}),
kres AS (
  SELECT kf.split, kf.k, kf.kk, kf.n, kf.pos,
         CAST(coalesce(c.cum_tp, 0) AS BIGINT) AS tp,
         CASE WHEN kf.kk > 0 THEN c.prob ELSE 1.0 END AS threshold,
         CASE WHEN kf.kk > 0
              THEN (SELECT count(*) FROM ev e WHERE e.split = kf.split AND e.prob <= c.prob)
                   / CAST(kf.n AS DOUBLE)
              ELSE 1.0 END AS quantile
  FROM kf LEFT JOIN ev_cum c ON c.split = kf.split AND c.rn = kf.kk)"""

SQL: dict[str, str] = {}

SQL["clean_bounds"] = f"WITH {OBS}, b AS (SELECT * FROM obs WHERE lon BETWEEN -180 AND 180 " \
                      "AND lat BETWEEN -90 AND 90) SELECT obs_key, grid_id, lon, lat FROM b"

SQL["clean_dedup"] = f"""WITH {OBS}
SELECT DISTINCT obs_key, grid_id, label FROM (
  SELECT DISTINCT * FROM (SELECT * FROM obs UNION ALL SELECT * FROM obs))"""

SQL["calendar_parts"] = f"""WITH {OBS}
SELECT strftime(date_trunc('day', valid_time), '%Y-%m-%d') AS valid_date,
       CAST(year(valid_time) AS INTEGER) AS year, CAST(month(valid_time) AS INTEGER) AS month,
       CAST(dayofyear(valid_time) AS INTEGER) AS doy, CAST(weekofyear(valid_time) AS INTEGER) AS week,
       CAST(quarter(valid_time) AS INTEGER) AS quarter, count(*) AS n
FROM obs GROUP BY ALL"""

SQL["clean_season"] = f"""WITH {CLEAN}
SELECT obs_key, strftime(valid_date, '%Y-%m-%d') AS valid_date, CAST(month AS INTEGER) AS month
FROM clean"""

SQL["time_split_counts"] = f"""WITH {SPLIT}
SELECT split, count(*) AS n, CAST(sum(label) AS BIGINT) AS positives,
       strftime(min(valid_time), '%Y-%m-%d %H:%M:%S') AS first_time,
       strftime(max(valid_time), '%Y-%m-%d %H:%M:%S') AS last_time
FROM splitted GROUP BY split"""

SQL["time_split_rows"] = f"""WITH {SPLIT}
SELECT obs_key, split, CAST(rn AS BIGINT) AS rn FROM splitted"""

SQL["topk_grouped"] = f"""WITH {SCORED},
g AS (
  SELECT split, label,
         row_number() OVER (PARTITION BY split, month, grid_id ORDER BY prob DESC, obs_key) AS rn
  FROM ev),
kl AS (SELECT * FROM (VALUES (5), (10), (20)) AS t(k)),
agg AS (
  SELECT g.split, kl.k AS k_per_group, count(*) AS alerts, CAST(sum(g.label) AS BIGINT) AS tp
  FROM g JOIN kl ON g.rn <= kl.k GROUP BY g.split, kl.k)
SELECT a.split, 'month+grid_id' AS groupby, CAST(a.k_per_group AS INTEGER) AS k_per_group,
       a.alerts, a.tp, a.alerts - a.tp AS fp, t.pos - a.tp AS fn,
       round(a.tp / greatest(a.alerts, 1), 6) AS precision,
       round(a.tp / greatest(t.pos, 1), 6) AS recall
FROM agg a JOIN ev_tot t USING (split)"""

SQL["precision_recall_at_k"] = f"""WITH {K_FRAME}
SELECT split, CAST(k AS INTEGER) AS k, CAST(kk AS BIGINT) AS kk, tp,
       round(tp / greatest(kk, 1), 6) AS precision, round(tp / greatest(pos, 1), 6) AS recall
FROM kres"""

SQL["topk_global_k"] = f"""WITH {K_FRAME}
SELECT 'k' AS type, split, CAST(k AS DOUBLE) AS k_or_q,
       round(tp / greatest(kk, 1), 6) AS precision, round(tp / greatest(pos, 1), 6) AS recall,
       tp, CAST(kk - tp AS BIGINT) AS fp, CAST(greatest(pos, 1) - tp AS BIGINT) AS fn,
       round(threshold, 6) AS threshold, round(quantile, 6) AS quantile
FROM kres"""

SQL["topk_global_quantile"] = f"""WITH {SCORED},
thr0 AS (SELECT split, quantile_cont(prob, [0.9, 0.99, 0.999]) AS t FROM ev GROUP BY split),
thr AS (
  SELECT split, q, t[i] AS threshold
  FROM thr0, (VALUES (1, 0.9), (2, 0.99), (3, 0.999)) AS ql(i, q)),
hits AS (
  SELECT t.split, t.q, t.threshold, count(e.prob) AS alerts,
         CAST(coalesce(sum(e.label), 0) AS BIGINT) AS tp
  FROM thr t LEFT JOIN ev e ON e.split = t.split AND e.prob >= t.threshold
  GROUP BY t.split, t.q, t.threshold)
SELECT 'quantile' AS type, h.split, CAST(h.q AS DOUBLE) AS k_or_q,
       round(h.tp / greatest(h.alerts, 1), 6) AS precision,
       round(h.tp / greatest(o.pos, 1), 6) AS recall,
       h.tp, h.alerts - h.tp AS fp, CAST(greatest(o.pos, 1) - h.tp AS BIGINT) AS fn,
       round(h.threshold, 6) AS threshold, round(CAST(h.q AS DOUBLE), 6) AS quantile
FROM hits h JOIN ev_tot o USING (split)"""

SQL["topk_lift"] = f"""WITH {K_FRAME}
SELECT split, CAST(kk AS BIGINT) AS k, tp, CAST(kk - tp AS BIGINT) AS fp,
       round(tp / greatest(kk, 1), 6) AS precision, round(tp / greatest(pos, 1), 6) AS recall,
       round((tp / greatest(kk, 1)) / greatest(pos / greatest(n, 1), 1e-12), 6) AS lift,
       round(threshold, 6) AS threshold, round(pos / greatest(n, 1), 6) AS base_rate
FROM kres"""

FEATS = ["f_qty", "f_price", "f_disc", "f_tax"]


def _long(src: str, feats=FEATS, extra: str = "") -> str:
    """UNION ALL unpivot that keeps null values."""
    sep = ", " if extra else ""
    return " UNION ALL ".join(
        f"SELECT {extra}{sep}'{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM {src}" for f in feats)


OBS_COLS = ["obs_key", "valid_time", "grid_id", "lon", "lat", "f_qty", "f_price", "f_disc",
            "f_tax", "label", "burned_area"]

SQL["missing_report"] = f"""WITH {OBS},
m AS ({" UNION ALL ".join(f'''SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} IS NULL) AS missing_count FROM obs''' for c in OBS_COLS)}),
n AS (SELECT count(*) AS n FROM obs)
SELECT "column", missing_count,
       round(CASE WHEN n = 0 THEN 0.0 ELSE missing_count / n END, 6) AS missing_rate
FROM m, n"""

SQL["describe_features"] = f"""WITH {CLEAN},
long AS ({_long("clean")}),
mom AS (
  SELECT feature, count(value) AS count, count(*) FILTER (WHERE value IS NULL) AS null_count,
         avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min, max(value) AS max
  FROM long GROUP BY feature),
rk AS (
  SELECT feature, value, row_number() OVER (PARTITION BY feature ORDER BY value) - 1 AS pos,
         count(*) OVER (PARTITION BY feature) AS n
  FROM long WHERE value IS NOT NULL),
qq AS (
  SELECT feature,
         max(CASE WHEN pos = round(0.25 * (n - 1)) THEN value END) AS q25,
         max(CASE WHEN pos = round(0.50 * (n - 1)) THEN value END) AS q50,
         max(CASE WHEN pos = round(0.75 * (n - 1)) THEN value END) AS q75
  FROM rk GROUP BY feature)
SELECT feature, count, null_count, round(mean, 6) AS mean, round(std, 6) AS std,
       round(min, 6) AS min, round(q25, 6) AS q25, round(q50, 6) AS q50, round(q75, 6) AS q75,
       round(max, 6) AS max
FROM mom LEFT JOIN qq USING (feature)"""

SQL["class_balance"] = f"""WITH {SPLIT}
SELECT split, label, count(*) AS count FROM splitted GROUP BY split, label"""

HIST = """
rng AS (
  SELECT {by}feature,
         CASE WHEN min(value) = max(value) THEN min(value) - 0.5 ELSE min(value) END AS lo,
         CASE WHEN min(value) = max(value) THEN max(value) + 0.5 ELSE max(value) END AS hi
  FROM long GROUP BY {by}feature),
b AS (
  SELECT {lby}l.feature, r.lo, r.hi,
         least(CAST(floor((l.value - r.lo) / (r.hi - r.lo) * 50) AS INTEGER), 49) AS bin
  FROM long l JOIN rng r ON l.feature = r.feature {on}),
grid AS (SELECT {by}feature, lo, hi, CAST(unnest(range(50)) AS INTEGER) AS bin, 0 AS n FROM rng),
every AS (SELECT {by}feature, lo, hi, bin, 1 AS n FROM b UNION ALL SELECT * FROM grid)
SELECT {by}feature, bin, round(lo + (hi - lo) / 50 * bin, 6) AS bin_low,
       round(lo + (hi - lo) / 50 * (bin + 1), 6) AS bin_high, CAST(sum(n) AS BIGINT) AS count
FROM every GROUP BY {by}feature, bin, lo, hi"""

SQL["feature_histogram"] = f"""WITH {CLEAN},
long AS (SELECT * FROM ({_long("clean")}) WHERE value IS NOT NULL AND NOT isnan(value)),
""" + HIST.format(by="", lby="", on="")

SQL["log_histogram"] = f"""WITH {SCORED},
long AS (SELECT split, 'prob' AS feature, least(greatest(prob, 1e-12), 1.0) AS value FROM ev),
""" + HIST.format(by="split, ", lby="l.split, ", on="AND l.split = r.split")

SQL["box_stats"] = f"""WITH {CLEAN},
long AS (SELECT * FROM ({_long("clean")}) WHERE value IS NOT NULL AND NOT isnan(value)),
q AS (
  SELECT feature, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
         quantile_cont(value, 0.75) AS q3
  FROM long GROUP BY feature),
w AS (
  SELECT l.feature,
         min(CASE WHEN l.value >= q.q1 - (q.q3 - q.q1) * 1.5 THEN l.value END) AS whisker_lo,
         max(CASE WHEN l.value <= q.q3 + (q.q3 - q.q1) * 1.5 THEN l.value END) AS whisker_hi,
         count(*) FILTER (WHERE l.value < q.q1 - (q.q3 - q.q1) * 1.5
                           OR l.value > q.q3 + (q.q3 - q.q1) * 1.5) AS n_fliers
  FROM long l JOIN q USING (feature) GROUP BY l.feature)
SELECT feature, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(q3 - q1, 6) AS iqr, round(whisker_lo, 6) AS whisker_lo,
       round(whisker_hi, 6) AS whisker_hi, n_fliers
FROM q JOIN w USING (feature)"""

_QS21 = ", ".join(str(i / 20) for i in range(21))
SQL["stratified_density"] = f"""WITH {SCORED},
val AS (SELECT * FROM scored WHERE split = 'val'),
long AS (SELECT * FROM ({_long("val", extra="label")}) WHERE value IS NOT NULL AND NOT isnan(value)),
eq AS (
  SELECT feature, list_sort(list_distinct(quantile_cont(value, [{_QS21}]))) AS qe,
         min(value) AS mn, max(value) AS mx
  FROM long GROUP BY feature),
edges AS (
  SELECT feature,
         CASE WHEN len(qe) < 3
              THEN [mn + (mx + 1e-12 - mn) * i / 4 FOR i IN range(0, 5)]
              ELSE qe END AS edges
  FROM eq),
binned AS (
  SELECT l.feature, l.label,
         CASE WHEN l.value = e.edges[len(e.edges)] THEN len(e.edges) - 2
              ELSE len(list_filter(e.edges, lambda t: t <= l.value)) - 1 END AS bin
  FROM long l JOIN edges e USING (feature)
  WHERE l.value >= e.edges[1] AND l.value <= e.edges[len(e.edges)]),
cnt AS (
  SELECT feature, bin, count(*) AS count, count(*) FILTER (WHERE label = 1) AS pos_count,
         count(*) FILTER (WHERE label = 0) AS neg_count
  FROM binned GROUP BY feature, bin),
grid AS (SELECT feature, edges, unnest(range(0, len(edges) - 1)) AS bin FROM edges),
full_ AS (
  SELECT g.feature, CAST(g.bin AS INTEGER) AS bin, g.edges[g.bin + 1] AS edge_lo,
         g.edges[g.bin + 2] AS edge_hi,
         CAST(coalesce(c.count, 0) AS BIGINT) AS count,
         CAST(coalesce(c.pos_count, 0) AS BIGINT) AS pos_count,
         CAST(coalesce(c.neg_count, 0) AS BIGINT) AS neg_count
  FROM grid g LEFT JOIN cnt c ON c.feature = g.feature AND c.bin = g.bin)
SELECT feature, bin, round(edge_lo, 6) AS edge_lo, round(edge_hi, 6) AS edge_hi, count,
       round(count / (max(count) OVER (PARTITION BY feature) + 1e-12), 6) AS density,
       pos_count, neg_count,
       round(pos_count / (max(pos_count) OVER (PARTITION BY feature) + 1e-12), 6) AS pos_density,
       round(neg_count / (max(neg_count) OVER (PARTITION BY feature) + 1e-12), 6) AS neg_density
FROM full_"""

_MED = ", ".join(f"median({f}) AS m_{f}" for f in FEATS)
SQL["impute_global"] = f"""WITH {CLEAN}, med AS (SELECT {_MED} FROM clean)
SELECT obs_key, {", ".join(f"round(coalesce({f}, m_{f}), 6) AS {f}" for f in FEATS)}
FROM clean, med"""

SQL["impute_monthwise"] = f"""WITH {CLEAN}, med AS (SELECT month, {_MED} FROM clean GROUP BY month)
SELECT obs_key, {", ".join(f"round(coalesce({f}, m_{f}), 6) AS {f}" for f in FEATS)}
FROM clean LEFT JOIN med USING (month)"""

SQL["month_dummies"] = f"""WITH {CLEAN}
SELECT obs_key, CAST(month AS INTEGER) AS month,
       {", ".join(f"coalesce(CAST(month = {m} AS TINYINT), 0) AS mon_{m:02d}" for m in (5, 6, 7, 8))}
FROM clean"""


def _scaled(params: str, center: str, scale: str) -> str:
    return f"""WITH {CLEAN}, p AS (SELECT {params} FROM clean)
SELECT obs_key, {", ".join(f"round(({f} - {center.format(f=f)}) / {scale.format(f=f)}, 6) AS {f}" for f in FEATS)}
FROM clean, p"""


def _nz(x: str) -> str:
    return f"(CASE WHEN {x} = 0 OR {x} IS NULL THEN 1.0 ELSE {x} END)"


SQL["scale_minmax"] = _scaled(", ".join(f"min({f}) AS lo_{f}, max({f}) - min({f}) AS rg_{f}" for f in FEATS),
                              "lo_{f}", _nz("rg_{f}"))
SQL["scale_standard"] = _scaled(", ".join(f"avg({f}) AS mu_{f}, stddev_pop({f}) AS sd_{f}" for f in FEATS),
                                "mu_{f}", _nz("sd_{f}"))
SQL["scale_robust"] = _scaled(
    ", ".join(f"quantile_cont({f}, 0.5) AS md_{f}, quantile_cont({f}, 0.75) - quantile_cont({f}, 0.25) AS iq_{f}"
              for f in FEATS), "md_{f}", _nz("iq_{f}"))

SQL["prepared_features"] = f"""WITH {CLEAN}, med AS (SELECT {_MED} FROM clean),
imp AS (
  SELECT obs_key, month, {", ".join(f"coalesce({f}, m_{f}) AS {f}" for f in FEATS)} FROM clean, med),
p AS (SELECT {", ".join(f"min({f}) AS lo_{f}, max({f}) - min({f}) AS rg_{f}" for f in FEATS)} FROM imp)
SELECT obs_key, {", ".join(f"round(({f} - lo_{f}) / {_nz(f'rg_{f}')}, 6) AS {f}" for f in FEATS)},
       {", ".join(f"coalesce(CAST(month = {m} AS TINYINT), 0) AS mon_{m:02d}" for m in (5, 6, 7, 8))}
FROM imp, p"""

SQL["class_weight"] = f"""WITH {SPLIT}
SELECT split, CAST(sum(label) AS BIGINT) AS pos, CAST(count(*) - sum(label) AS BIGINT) AS neg,
       round((count(*) - sum(label)) / greatest(sum(label), 1), 6) AS weight
FROM splitted GROUP BY split"""

# ---------------------------------------------------------------- policy
SQL["policy_derive"] = f"""WITH {SCORED},
val AS (SELECT * FROM scored WHERE split = 'val'),
vr AS (SELECT prob, row_number() OVER (ORDER BY prob DESC, obs_key) AS rn, count(*) OVER () AS n FROM val),
a AS (SELECT least(1000, max(n)) AS kk FROM vr),
thr AS (SELECT vr.prob AS t FROM vr, a WHERE vr.rn = a.kk)
SELECT 'quantile' AS primary_mode, CAST(0.999 AS DOUBLE) AS primary_q,
       round((SELECT quantile_cont(prob, 0.999) FROM val), 6) AS backup_threshold,
       'topk' AS fallback_mode, CAST(1000 AS INTEGER) AS fallback_k, CAST(a.kk AS BIGINT) AS anchor_k,
       round((SELECT count(*) FROM val WHERE prob <= (SELECT t FROM thr)) / (SELECT count(*) FROM val), 6)
         AS anchor_q_equiv,
       round((SELECT t FROM thr), 6) AS anchor_threshold_equiv
FROM a"""

SQL["policy_apply"] = f"""WITH {SCORED},
pol AS (SELECT quantile_cont(prob, 0.999) AS thr FROM scored WHERE split = 'val'),
test AS (SELECT * FROM scored WHERE split = 'test')
SELECT 'quantile' AS mode, obs_key, round(prob, 6) AS prob, label FROM test, pol WHERE prob >= thr
UNION ALL
SELECT 'topk' AS mode, obs_key, round(prob, 6) AS prob, label
FROM (SELECT * FROM test ORDER BY prob DESC, obs_key LIMIT 1000)"""

SQL["anchor_threshold"] = f"""WITH {K_FRAME.replace(KLIST, "(VALUES (1000)) AS kl(k)")}
SELECT split, CAST(kk AS BIGINT) AS k, round(threshold, 6) AS threshold_equiv,
       round(quantile, 6) AS q_equiv
FROM kres"""


def _qlist(qs) -> str:
    return "[" + ", ".join(repr(float(q)) for q in qs) + "]"


_PDQ = [0.01 + (0.99 - 0.01) * i / 39 for i in range(40)]
SQL["quantile_grid"] = f"""WITH {CLEAN},
long AS (SELECT * FROM ({_long("clean")}) WHERE value IS NOT NULL AND NOT isnan(value)),
qa AS (SELECT feature, quantile_cont(value, {_qlist(_PDQ)}) AS qv FROM long GROUP BY feature)
SELECT feature, CAST(i - 1 AS INTEGER) AS q_idx, round(ql[i], 6) AS q, round(qv[i], 6) AS quantile
FROM qa, (SELECT {_qlist(_PDQ)} AS ql), range(1, 41) AS r(i)"""

SQL["ecdf_at"] = f"""WITH {CLEAN},
long AS ({_long("clean")}),
m AS (SELECT feature, avg(value) AS mean FROM long GROUP BY feature)
SELECT feature, round(avg(CASE WHEN value <= mean THEN 1.0 ELSE 0.0 END), 6) AS ecdf
FROM long JOIN m USING (feature) GROUP BY feature"""

# ---------------------------------------------------------------- curves
CUM = SCORED + """,
g AS (SELECT split, prob, count(*) AS n, CAST(sum(label) AS BIGINT) AS pos FROM ev GROUP BY split, prob),
c AS (
  SELECT *, sum(n) OVER w AS K, sum(pos) OVER w AS TP,
         sum(n) OVER (PARTITION BY split) AS Kt, sum(pos) OVER (PARTITION BY split) AS Pt,
         row_number() OVER (PARTITION BY split ORDER BY prob DESC) AS rn,
         count(*) OVER (PARTITION BY split) AS m
  FROM g
  WINDOW w AS (PARTITION BY split ORDER BY prob DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""

_AUC = "sum(pos * ((Kt - Pt) - (K - TP) + (n - pos) / 2.0)) / (max(Pt) * max(Kt - Pt))"
_AP = "sum(TP / K * pos) / max(Pt)"
SQL["auc"] = f"WITH {CUM} SELECT split, round({_AUC}, 6) AS auc FROM c GROUP BY split"
SQL["average_precision"] = f"WITH {CUM} SELECT split, round({_AP}, 6) AS average_precision FROM c GROUP BY split"
SQL["brier"] = f"WITH {SCORED} SELECT split, round(avg(pow(prob - label, 2)), 6) AS brier FROM ev GROUP BY split"
SQL["metrics_bundle"] = f"""WITH {CUM},
b AS (SELECT split, avg(pow(prob - label, 2)) AS brier FROM ev GROUP BY split),
a AS (SELECT split, {_AUC} AS auc, {_AP} AS ap FROM c GROUP BY split)
SELECT split, round(auc, 6) AS AUC, round(ap, 6) AS PR_AUC, round(brier, 6) AS Brier FROM a JOIN b USING (split)"""

SQL["roc_points"] = f"""WITH {CUM},
d AS (
  SELECT split, prob, rn, m, K - TP AS fps, TP AS tps, Kt - Pt AS N, Pt AS P,
         lag(K - TP) OVER s AS fp_prev, lead(K - TP) OVER s AS fp_next,
         lag(TP) OVER s AS tp_prev, lead(TP) OVER s AS tp_next
  FROM c WINDOW s AS (PARTITION BY split ORDER BY rn))
SELECT split, round(prob, 6) AS threshold, round(fps / greatest(N, 1e-300), 6) AS fpr,
       round(tps / greatest(P, 1e-300), 6) AS tpr
FROM d
WHERE rn = 1 OR rn = m OR fp_prev - 2 * fps + fp_next <> 0 OR tp_prev - 2 * tps + tp_next <> 0
UNION ALL
SELECT DISTINCT split, CAST('inf' AS DOUBLE) AS threshold, 0.0 AS fpr, 0.0 AS tpr FROM ev"""

SQL["pr_points"] = f"""WITH {CUM}
SELECT split, round(prob, 6) AS threshold, round(TP / K, 6) AS precision,
       round(CASE WHEN Pt = 0 THEN 1.0 ELSE TP / Pt END, 6) AS recall
FROM c
UNION ALL
SELECT DISTINCT split, CAST(NULL AS DOUBLE) AS threshold, 1.0 AS precision, 0.0 AS recall FROM ev"""

_Q21 = _qlist([i / 20 for i in range(21)])
_Q13 = _qlist([i / 12 for i in range(13)])
SQL["reliability_curve"] = f"""WITH {SCORED},
e AS (SELECT split, quantile_cont(prob, {_Q21}) AS edges FROM ev GROUP BY split),
b AS (
  SELECT ev.split, ev.prob, ev.label,
         len(list_filter(e.edges[2:20], lambda t: t < ev.prob)) AS bin
  FROM ev JOIN e USING (split))
SELECT split, CAST(bin AS INTEGER) AS bin, round(avg(label), 6) AS prob_true,
       round(avg(prob), 6) AS prob_pred, count(*) AS n
FROM b GROUP BY split, bin"""


def _caltab(src: str, qlist: str) -> str:
    """Calibration-table CTE chain over ``src(split, prob, label)``; base rate on ``ev``."""
    return f"""
e0 AS (
  SELECT split, list_sort(list_distinct(quantile_cont(prob, {qlist}))) AS qe,
         min(prob) AS mn, max(prob) AS mx
  FROM {src} GROUP BY split),
e AS (
  SELECT split, CASE WHEN len(qe) <= 2 THEN [mn + (mx + 1e-15 - mn) * i / 4 FOR i IN range(0, 5)]
                     ELSE qe END AS edges
  FROM e0),
br AS (SELECT split, avg(label) AS base_rate FROM ev GROUP BY split),
b AS (
  SELECT s.split, s.prob, s.label, e.edges,
         len(list_filter(e.edges[2:len(e.edges) - 1], lambda t: t <= s.prob)) AS bin
  FROM {src} s JOIN e USING (split)),
tab AS (
  SELECT split, CAST(bin AS INTEGER) AS bin, edges[bin + 1] AS bin_low, edges[bin + 2] AS bin_high,
         count(*) AS n, CAST(sum(label) AS BIGINT) AS pos, avg(label) AS rate,
         avg(prob) AS mean_pred, avg(label) / (base_rate + 1e-15) AS lift
  FROM b JOIN br USING (split) GROUP BY split, bin, edges, base_rate)"""


SQL["calibration_table"] = f"""WITH {SCORED}, {_caltab("ev", _Q21)}
SELECT split, bin, round(bin_low, 6) AS bin_low, round(bin_high, 6) AS bin_high, n, pos,
       round(rate, 6) AS rate, round(mean_pred, 6) AS mean_pred, round(lift, 6) AS lift
FROM tab"""

TAIL = f"""{SCORED},
cut AS (SELECT split, quantile_cont(prob, 0.99) AS c FROM ev GROUP BY split),
tail AS (SELECT ev.* FROM ev JOIN cut USING (split) WHERE ev.prob >= cut.c),
{_caltab("tail", _Q13)}"""

SQL["calibration_tail"] = f"""WITH {TAIL},
ax AS (
  SELECT *, row_number() OVER (PARTITION BY split ORDER BY bin) AS idx,
         count(*) OVER (PARTITION BY split) AS nb
  FROM tab)
SELECT split, bin, round(bin_low, 6) AS bin_low, round(bin_high, 6) AS bin_high, n, pos,
       round(rate, 6) AS rate, round(mean_pred, 6) AS mean_pred, round(lift, 6) AS lift,
       round(CASE WHEN nb = 1 THEN 0.99 ELSE 0.99 + (1.0 - 0.99) * (idx - 1) / (nb - 1) END, 6) AS q_axis
FROM ax"""

SQL["tail_summary"] = f"""WITH {TAIL},
s AS (SELECT split, count(*) AS n_bins_tail, max(lift) AS max_lift_tail FROM tab GROUP BY split)
SELECT br.split, round(br.base_rate, 6) AS baseline_rate, CAST(0.99 AS DOUBLE) AS tail_q,
       CAST(coalesce(s.n_bins_tail, 0) AS BIGINT) AS n_bins_tail,
       round(coalesce(s.max_lift_tail, 0.0), 6) AS max_lift_tail
FROM br LEFT JOIN s USING (split)"""

SQL["ecdf_curve"] = f"""WITH {SCORED},
g AS (SELECT split, prob AS value, count(*) AS n FROM ev GROUP BY split, prob)
SELECT split, round(value, 6) AS value,
       round(sum(n) OVER (PARTITION BY split ORDER BY value) / sum(n) OVER (PARTITION BY split), 6) AS cdf
FROM g"""

# ---------------------------------------------------------------- sampling
def _u(*parts: str) -> str:
    """Hash uniform of parts joined by '|' (md5, first 13 hex digits / 2^52)."""
    s = "concat_ws('|', " + ", ".join(parts) + ")"
    return f"(CAST(('0x' || substr(md5({s}), 1, 13)) AS BIGINT) / 4503599627370496::DOUBLE)"


KNN_F = FEATS + ["mon_05", "mon_06", "mon_07", "mon_08"]
PREP = SPLIT + f""",
med AS (SELECT {_MED} FROM splitted),
imp AS (
  SELECT obs_key, split, label, month, {", ".join(f"coalesce({f}, m_{f}) AS {f}" for f in FEATS)}
  FROM splitted, med),
mm AS (SELECT {", ".join(f"min({f}) AS lo_{f}, max({f}) - min({f}) AS rg_{f}" for f in FEATS)} FROM imp),
prep AS (
  SELECT obs_key, split, label,
         {", ".join(f"({f} - lo_{f}) / {_nz(f'rg_{f}')} AS {f}" for f in FEATS)},
         {", ".join(f"coalesce(CAST(month = {m} AS TINYINT), 0) AS mon_{m:02d}" for m in (5, 6, 7, 8))}
  FROM imp, mm),
pos AS (SELECT * FROM prep WHERE split = 'train' AND label = 1),
knn AS (
  SELECT a.obs_key, b.obs_key AS nn_key,
         sqrt({" + ".join(f"pow(a.{f} - b.{f}, 2)" for f in KNN_F)}) AS dist
  FROM pos a JOIN pos b ON a.obs_key <> b.obs_key),
knn_r AS (
  SELECT *, row_number() OVER (PARTITION BY obs_key ORDER BY dist, nn_key) AS nn_rank FROM knn)"""

SQL["sample_n"] = f"""WITH {CLEAN}
SELECT obs_key FROM clean ORDER BY {_u("'42'", "obs_key")}, obs_key LIMIT 5000"""

SQL["downsample"] = f"""WITH {SPLIT},
r AS (
  SELECT obs_key, label,
         row_number() OVER (PARTITION BY label ORDER BY {_u("'42'", "obs_key")}, obs_key) AS rn
  FROM splitted WHERE split = 'train')
SELECT obs_key, label FROM r WHERE rn <= 1000"""

SQL["oversample"] = f"""WITH {SPLIT},
pos AS (SELECT obs_key FROM splitted WHERE split = 'train' AND label = 1),
num AS (SELECT obs_key, row_number() OVER (ORDER BY obs_key) - 1 AS idx FROM pos),
cnt AS (SELECT count(*) AS P FROM pos),
d AS (SELECT unnest(range(0, greatest(1000 - P, 0))) AS j, P FROM cnt)
SELECT CAST(d.j AS BIGINT) AS j, num.obs_key
FROM d JOIN num ON num.idx = floor({_u("'42'", "'oversample'", "CAST(d.j AS VARCHAR)", "'1'")} * d.P)"""

SQL["smote_knn"] = f"""WITH {PREP}
SELECT obs_key, CAST(nn_rank AS INTEGER) AS nn_rank, nn_key, round(dist, 6) AS dist
FROM knn_r WHERE nn_rank <= 5"""

SQL["smote_rows"] = f"""WITH {PREP},
num AS (SELECT *, row_number() OVER (ORDER BY obs_key) - 1 AS idx FROM pos),
cnt AS (SELECT count(*) AS P, least(5, count(*) - 1) AS kk FROM pos),
d AS (
  SELECT j, P, kk,
         {_u("'42'", "'smote'", "CAST(j AS VARCHAR)", "'1'")} AS u1,
         {_u("'42'", "'smote'", "CAST(j AS VARCHAR)", "'2'")} AS u2,
         {_u("'42'", "'smote'", "CAST(j AS VARCHAR)", "'3'")} AS u3
  FROM (SELECT unnest(range(0, greatest(1000 - P, 0))) AS j, P, kk FROM cnt)),
pick AS (
  SELECT d.j, d.u3, x.obs_key AS base_key, r.nn_key
  FROM d JOIN num x ON x.idx = floor(d.u1 * d.P)
         JOIN knn_r r ON r.obs_key = x.obs_key AND r.nn_rank = floor(d.u2 * d.kk) + 1)
SELECT CAST(p.j AS BIGINT) AS j,
       {", ".join(f"round(x.{f} + p.u3 * (n.{f} - x.{f}), 6) AS {f}" for f in KNN_F)}
FROM pick p JOIN pos x ON x.obs_key = p.base_key JOIN pos n ON n.obs_key = p.nn_key"""

SQL["balance_counts"] = f"""WITH {SPLIT},
tr AS (SELECT label FROM splitted WHERE split = 'train'),
c AS (SELECT count(*) FILTER (WHERE label = 0) AS neg, count(*) FILTER (WHERE label = 1) AS pos FROM tr),
n AS (SELECT least(1000, neg) AS n, pos FROM c)
SELECT CAST(0 AS TINYINT) AS label, false AS synthetic, n AS count FROM n
UNION ALL SELECT CAST(1 AS TINYINT), false, least(pos, n) FROM n
UNION ALL SELECT CAST(1 AS TINYINT), true, n - pos FROM n WHERE pos < n"""

# ---------------------------------------------------------------- explain
PD_F = ["f_qty", "f_price", "f_disc", "f_tax"]


def _score(q: str = "f_qty", d: str = "f_disc", t: str = "f_tax") -> str:
    return f"round(1 / (1 + exp(-(-2 + 0.04 * coalesce({q}, 25) + 4 * {d} - 6 * {t}))), 9)"


def _score_with(feat: str, expr: str) -> str:
    args = {"f_qty": "f_qty", "f_disc": "f_disc", "f_tax": "f_tax"}
    args[feat] = expr
    return _score(args["f_qty"], args["f_disc"], args["f_tax"])


_PD2Q = [0.05 + (0.95 - 0.05) * i / 24 for i in range(25)]
PD_BASE = SCORED + f""",
val AS (SELECT * FROM scored WHERE split = 'val'),
grid AS ({" UNION ALL ".join(f"SELECT '{f}' AS feature, quantile_cont({f}, {_qlist(_PDQ)}) AS grid FROM val" for f in PD_F)}),
grid2 AS ({" UNION ALL ".join(f"SELECT '{f}' AS feature, quantile_cont({f}, {_qlist(_PD2Q)}) AS grid FROM val" for f in PD_F)}),
pd AS ({" UNION ALL ".join(
    f"SELECT '{f}' AS feature, CAST(r.i - 1 AS INTEGER) AS i, g.grid[r.i] AS g, "
    f"avg({_score_with(f, 'g.grid[r.i]')}) AS pd "
    f"FROM val, grid g, range(1, 41) AS r(i) WHERE g.feature = '{f}' GROUP BY r.i, g.grid[r.i]" for f in PD_F)})"""


def _grad_sql(src: str, by: str) -> str:
    """Gradient CTEs over ``src(by..., x, y)`` after collapsing equal x."""
    return f"""
col AS (SELECT {by}, x, round(min(y), 9) AS y FROM {src} GROUP BY {by}, x),
gw AS (
  SELECT *, row_number() OVER w - 1 AS j, count(*) OVER (PARTITION BY {by}) AS n,
         lag(x) OVER w AS xm, lead(x) OVER w AS xp, lag(y) OVER w AS ym, lead(y) OVER w AS yp
  FROM col WINDOW w AS (PARTITION BY {by} ORDER BY x)),
gr AS (
  SELECT {by}, CAST(j AS INTEGER) AS j, x, y, n,
         CASE WHEN n < 2 THEN NULL
              WHEN j = 0 THEN (yp - y) / (xp - x)
              WHEN j = n - 1 THEN (y - ym) / (x - xm)
              ELSE ((x - xm) * (x - xm) * (yp - y) + (xp - x) * (xp - x) * (y - ym)) / ((x - xm) * (xp - x) * ((x - xm) + (xp - x))) END AS grad
  FROM gw),
st AS (
  SELECT {by}, j AS j_star, x AS x_star, y AS y_star FROM (
    SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY abs(grad) DESC, j) AS r FROM gr WHERE n >= 3)
  WHERE r = 1
  UNION ALL
  SELECT {by}, NULL AS j_star, median(x) AS x_star, median(y) AS y_star FROM gr GROUP BY {by} HAVING max(n) < 3)"""


SQL["pd_1d"] = f"WITH {PD_BASE} SELECT feature, i, round(g, 6) AS g, round(pd, 6) AS pd FROM pd"

SQL["pd_gradient"] = f"""WITH {PD_BASE}, curve AS (SELECT feature, g AS x, pd AS y FROM pd),
{_grad_sql("curve", "feature")}
SELECT feature, j, round(x, 6) AS x, round(y, 6) AS pd, round(grad, 6) AS grad FROM gr"""

SQL["detect_thresholds"] = f"""WITH {PD_BASE}, curve AS (SELECT feature, g AS x, pd AS y FROM pd),
{_grad_sql("curve", "feature")}
SELECT gr.feature, round(gr.x, 6) AS x, round(gr.y, 6) AS pd, 'slope_peak/edge' AS note
FROM gr JOIN st USING (feature)
WHERE st.j_star IS NOT NULL AND gr.j BETWEEN st.j_star - 1 AND st.j_star + 1"""

_PAIRS = [(a, b) for i, a in enumerate(PD_F) for b in PD_F[i + 1:]]


def _score_with2(f1: str, e1: str, f2: str, e2: str) -> str:
    args = {"f_qty": "f_qty", "f_disc": "f_disc", "f_tax": "f_tax"}
    args[f1], args[f2] = e1, e2
    return _score(args["f_qty"], args["f_disc"], args["f_tax"])


PD2 = PD_BASE + f""",
surf AS ({" UNION ALL ".join(
    f"SELECT '{a}' AS f1, '{b}' AS f2, CAST(r1.i - 1 AS INTEGER) AS i1, CAST(r2.i - 1 AS INTEGER) AS i2, "
    f"ga.grid[r1.i] AS g1, gb.grid[r2.i] AS g2, "
    f"avg({_score_with2(a, 'ga.grid[r1.i]', b, 'gb.grid[r2.i]')}) AS pd "
    f"FROM val, grid2 ga, grid2 gb, range(1, 26) AS r1(i), range(1, 26) AS r2(i) "
    f"WHERE ga.feature = '{a}' AND gb.feature = '{b}' "
    f"GROUP BY r1.i, r2.i, ga.grid[r1.i], gb.grid[r2.i]" for a, b in _PAIRS)}),
delta AS (SELECT f1, f2, max(pd) - min(pd) AS delta FROM surf GROUP BY f1, f2)"""

SQL["pd_2d"] = f"""WITH {PD2}
SELECT f1, f2, i1, i2, round(g1, 6) AS g1, round(g2, 6) AS g2, round(pd, 6) AS pd FROM surf"""
SQL["pair_delta"] = f"WITH {PD2} SELECT f1, f2, round(delta, 6) AS delta FROM delta"
SQL["pathways"] = f"""WITH {PD2}
SELECT f1 AS a, f2 AS b, round(delta, 6) AS delta, printf('%s -- %s : Δ=%.4f', f1, f2, delta) AS text
FROM delta"""


def _poisson_sql(u: str, lam: float = 0.8, kmax: int = 20) -> str:
    import math
    cdf, p, acc = [], math.exp(-lam), 0.0
    for k in range(kmax + 1):
        acc += p
        cdf.append(acc)
        p *= lam / (k + 1)
    return "(" + " + ".join(f"CASE WHEN {u} > {c!r} THEN 1 ELSE 0 END" for c in cdf) + ")"


SQL["bootstrap_threshold_ci"] = f"""WITH {PD_BASE},
wt AS (
  SELECT obs_key, b, {_poisson_sql(_u("'42'", "'boot'", "CAST(b AS VARCHAR)", "obs_key"))} AS w
  FROM val, range(0, 200) AS rb(b)),
sc AS ({" UNION ALL ".join(
    f"SELECT '{f}' AS feature, r.i - 1 AS i, g.grid[r.i] AS x, val.obs_key, "
    f"{_score_with(f, 'g.grid[r.i]')} AS p "
    f"FROM val, grid g, range(1, 41) AS r(i) WHERE g.feature = '{f}'" for f in PD_F)}),
curves AS (
  SELECT feature, -1 AS b, i, x, avg(p) AS y FROM sc GROUP BY feature, i, x
  UNION ALL
  SELECT sc.feature, wt.b, sc.i, sc.x, sum(wt.w * sc.p) / sum(wt.w) AS y
  FROM sc JOIN wt USING (obs_key) GROUP BY sc.feature, wt.b, sc.i, sc.x),
{_grad_sql("curves", "feature, b")},
fullthr AS (SELECT feature, x_star AS thr_unit, y_star AS pd_at_thr FROM st WHERE b = -1),
boots AS (SELECT feature, b, x_star AS xb FROM st WHERE b >= 0),
xci AS (SELECT feature, quantile_cont(xb, 0.025) AS thr_unit_lo, quantile_cont(xb, 0.975) AS thr_unit_hi
        FROM boots GROUP BY feature),
long AS ({_long("val", PD_F)}),
eb AS (
  SELECT bt.feature, bt.b, avg(CASE WHEN l.value <= bt.xb THEN 1.0 ELSE 0.0 END) AS e
  FROM boots bt JOIN long l USING (feature) GROUP BY bt.feature, bt.b),
qci AS (SELECT feature, quantile_cont(e, 0.025) AS thr_q_lo, quantile_cont(e, 0.975) AS thr_q_hi
        FROM eb GROUP BY feature),
tq AS (
  SELECT f.feature, avg(CASE WHEN l.value <= f.thr_unit THEN 1.0 ELSE 0.0 END) AS thr_quantile
  FROM fullthr f JOIN long l USING (feature) GROUP BY f.feature)
SELECT feature, round(thr_unit, 6) AS thr_unit, round(thr_unit_lo, 6) AS thr_unit_lo,
       round(thr_unit_hi, 6) AS thr_unit_hi, round(thr_quantile, 6) AS thr_quantile,
       round(thr_q_lo, 6) AS thr_q_lo, round(thr_q_hi, 6) AS thr_q_hi, round(pd_at_thr, 6) AS pd_at_thr
FROM fullthr LEFT JOIN xci USING (feature) LEFT JOIN tq USING (feature) LEFT JOIN qci USING (feature)"""


def _ap_sql(src: str, by: str) -> str:
    return f"""(
  SELECT {by}, sum(TP / K * pos) / max(Pt) AS ap FROM (
    SELECT *, sum(n) OVER w AS K, sum(pos) OVER w AS TP, sum(pos) OVER (PARTITION BY {by}) AS Pt
    FROM (SELECT {by}, prob, count(*) AS n, sum(label) AS pos FROM {src} GROUP BY {by}, prob)
    WINDOW w AS (PARTITION BY {by} ORDER BY prob DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
  GROUP BY {by})"""


# the bijection of functions.permute, one step per recursion; its keys are constants
_P = 2147483647


def _perm_hash(src: str) -> str:
    t0 = f"(({src} % {_P} * k0 + k1) % {_P})"
    t1 = f"(({t0} * {t0} + k2) % {_P})"
    return f"(({t1} * xor(k0, k2) + k1) % {_P})"


_PERM_KEYS = ", ".join(f"({rep}, {j}, {k0}::BIGINT, {k1}::BIGINT, {k2}::BIGINT)" for rep in range(5)
                       for j, (k0, k1, k2) in enumerate(round_keys(42, rep)))
SQL["permutation_importance"] = f"""WITH RECURSIVE {SCORED},
val AS (SELECT *, 1 AS one FROM scored WHERE split = 'val'),
placed AS (SELECT *, row_number() OVER (ORDER BY obs_key) - 1 AS pos FROM val),
dim AS (SELECT count(*) AS n, floor(sqrt(count(*) - 1))::BIGINT + 1 AS a FROM val),
dims AS (SELECT n, a, CASE WHEN n % a = 0 THEN n // a ELSE n // a + 1 END AS b FROM dim),
keys(rep, j, k0, k1, k2) AS (VALUES {_PERM_KEYS}),
walk(rep, pos, l, r, j) AS (
  SELECT rep, pos, pos // b, pos % b, 0 FROM placed, dims, range(0, 5) AS reps(rep)
  UNION ALL
  SELECT w.rep, w.pos, CASE WHEN w.j % 2 = 0 THEN (w.l + {_perm_hash("w.r")}) % a ELSE w.l END,
         CASE WHEN w.j % 2 = 1 THEN (w.r + {_perm_hash("w.l")}) % b ELSE w.r END, w.j + 1
  FROM walk w JOIN keys k ON k.rep = w.rep AND k.j = w.j % 6, dims
  WHERE NOT (w.j > 0 AND w.j % 6 = 0 AND w.l * b + w.r < n)),
moved AS (SELECT rep, pos, l * b + r AS donor FROM walk, dims WHERE j > 0 AND j % 6 = 0 AND l * b + r < n),
feats(feature) AS (VALUES ('f_qty'), ('f_price'), ('f_disc'), ('f_tax')),
perm AS (
  SELECT f.feature, m.rep, t.label,
         {_score("CASE WHEN f.feature = 'f_qty' THEN d.f_qty ELSE t.f_qty END",
                 "CASE WHEN f.feature = 'f_disc' THEN d.f_disc ELSE t.f_disc END",
                 "CASE WHEN f.feature = 'f_tax' THEN d.f_tax ELSE t.f_tax END")} AS prob
  FROM placed t JOIN moved m USING (pos) JOIN placed d ON d.pos = m.donor, feats f),
ap_perm AS {_ap_sql("perm", "feature, rep")},
ap_base AS {_ap_sql("val", "one")}
SELECT feature, round(avg(b.ap - p.ap), 6) AS importance_mean, round(stddev_pop(b.ap - p.ap), 6) AS importance_std
FROM ap_perm p, ap_base b GROUP BY feature"""
