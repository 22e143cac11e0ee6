"""The whole workflow from the CSV to the fit report (J16) and the roll-ups it writes:
the training record (J14) and the fit report (D29).

Every step's output is a hand-over table named by its content (``plans.stages``): a
run that broke goes on where it stopped, a changed parameter rebuilds what depends
on it, and tables of earlier parameters are deleted at the end.  Reports are header
CSV or JSON in ``reports/``."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskgrid.functions.scorer import TreeScorer
from riskgrid.operators import (boosting, clean, curves, explain, features, model, policy, prepared_model, quality, ranking,
                                sampling, split, stats)
from riskgrid.plans.stages import Stages
from riskgrid.schema import (CLS_TARGET, CONTINUOUS_FEATURES, ID_COLS, OUTCOME_COLS, REG_TARGETS,
                             TIME_COL, model_inputs)
from riskgrid.sources import io


@dataclass
class RunConfig:
    input_csv: str
    out_dir: str
    key: str = "obs_key"
    scaler: str = "minmax"
    monthwise_impute: bool = False
    test_size: float = 0.20
    val_within: float = 0.375
    final_samples: int = 2000
    seed: int = 42
    keep_months: tuple = (5, 6, 7, 8)
    features: list = field(default_factory=lambda: list(CONTINUOUS_FEATURES))
    points: list = field(default_factory=boosting.grid)
    n_trees: int = 2000
    patience: int = 100
    select_k: int = 1000
    ks: tuple = (50, 100, 200, 500, 1000, 2000, 5000, 10000, 20000)
    quantiles: tuple = (0.999, 0.9995, 0.9999, 0.99995)
    groupby: tuple = ("valid_date", "grid_id")
    group_ks: tuple = (5, 10, 20)
    primary_q: float = 0.9995
    tail_q: float = 0.99
    tail_bins: int = 12
    top_m: int = 6
    pd_points: int = 40
    pd2_points: int = 25
    replicates: int = 200


def with_key(df: DataFrame, key: str) -> DataFrame:
    """Carry a row key through every stage.  Rows are distinct over all columns, so the
    key is time and cell and a hash of the row: two rows of one cell and time stay apart."""
    if key in df.columns:
        return df
    row = F.substring(F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))), 1, 16)
    return df.withColumn(key, F.concat_ws("|", F.date_format(TIME_COL, "yyyy-MM-dd HH:mm:ss"), F.col("grid_id").cast("string"), row))


STEPS = ("clean", "prepare", "profile", "split", "balance", "meta", "select", "evaluate", "explain", "report")


def run(spark: SparkSession, cfg: RunConfig, stop_after: str = STEPS[-1]) -> dict[str, str]:
    """The steps of ``STEPS`` up to ``stop_after`` -> path of every artifact."""
    if stop_after not in STEPS:
        raise ValueError(f"stop_after must be one of {STEPS}")
    st = Stages(spark, cfg.out_dir)
    arts: dict[str, str] = {}

    def report(name: str, params, reads, build, fmt: str = "csv") -> None:
        arts[name] = st.write(name, [params, fmt], reads, lambda p: io.write_report(build(), f"{p}/data", fmt)) + "/data"

    def table(name: str, params, reads, build) -> DataFrame:
        df = st.table(name, params, reads, build)
        arts[name] = st.table_path(name) + "/data"
        return df

    for name, step in (("clean", _clean), ("prepare", _prepare), ("profile", _profile), ("split", _split), ("balance", _balance),
                       ("meta", _meta), ("select", _select), ("evaluate", _evaluate), ("explain", _explain), ("report", _report)):
        step(spark, cfg, st, table, report, arts)
        if name == stop_after:
            break
    st.finish()
    return arts


def _clean(spark, cfg, st, table, report, arts) -> None:
    st.source("input", cfg.input_csv)

    def build():
        raw = io.read_observations(spark, cfg.input_csv)
        return with_key(clean.basic_clean(raw, cfg.keep_months, subset=raw.columns), cfg.key)
    s1 = table("clean", [cfg.keep_months, cfg.key], ["input"], build)
    if stats.is_empty(s1):
        raise ValueError("no row is left after cleaning")


def _read(spark, arts, name: str) -> DataFrame:
    return spark.read.parquet(arts[name])


def _prepare(spark, cfg, st, table, report, arts) -> None:
    s1 = _read(spark, arts, "clean")
    table("prepare", [cfg.features, cfg.keep_months, cfg.scaler, cfg.monthwise_impute], ["clean"],
          lambda: features.prepare(s1, cfg.features, cfg.keep_months, cfg.scaler, cfg.monthwise_impute))


def _profile(spark, cfg, st, table, report, arts) -> None:
    """Each table of the profile before and after the treatment."""
    for when, source in (("before", "clean"), ("after", "prepare")):
        for part, df in quality.profile(_read(spark, arts, source), cfg.features).items():
            flat = df.select(*[F.to_json(c).alias(c) if dict(df.dtypes)[c].startswith(("array", "struct")) else F.col(c) for c in df.columns])
            report(f"profile_{when}_{part}", cfg.features, [source], lambda d=flat: d)


def _split(spark, cfg, st, table, report, arts) -> None:
    s2 = _read(spark, arts, "prepare")
    sizes = [cfg.test_size, cfg.val_within]
    sp = table("split", sizes, ["prepare"], lambda: split.time_split(s2, cfg.key, TIME_COL, cfg.test_size, cfg.val_within))
    carry = [c for c in dict.fromkeys([cfg.key, TIME_COL, "grid_id", "month", *cfg.groupby]) if c in sp.columns]
    targets = [r for r in REG_TARGETS if r in sp.columns]
    path = st.write("sets", [cfg.features, targets], ["split"], lambda p: split.export_sets(
        sp, p, model_inputs(sp, cfg.features), CLS_TARGET, targets, carry))
    arts |= {f"{kind}_{s}": f"{path}/{kind}/split={s}" for kind in ("cls", "reg") for s in ("train", "val", "test")}
    report("class_balance", [], ["split"], lambda: quality.class_balance(sp, CLS_TARGET, ["split"]))
    report("group_sizes", cfg.groupby, ["split"], lambda: quality.group_sizes(sp, [c for c in cfg.groupby if c in sp.columns], ["split"]))


def _labelled(spark, arts, name: str) -> DataFrame:
    return features.label_int(_read(spark, arts, f"cls_{name}").withColumnRenamed(CLS_TARGET, "label"), "label")


def _inputs(spark, cfg, arts) -> list[str]:
    return model_inputs(_read(spark, arts, "split"), cfg.features)


def _balance(spark, cfg, st, table, report, arts) -> None:
    train = _labelled(spark, arts, "train")
    table("cls_train_balanced", [cfg.final_samples, cfg.seed], ["sets"],
          lambda: sampling.balance(train, _inputs(spark, cfg, arts), "label", cfg.final_samples, cfg.seed, cfg.key))


def _meta(spark, cfg, st, table, report, arts) -> None:
    known = dict(arts)
    arts["meta"] = st.write("meta", asdict(cfg), ["sets", "cls_train_balanced"], lambda p: io.write_meta(
        spark, f"{p}/data", asdict(cfg), CLS_TARGET, REG_TARGETS, _inputs(spark, cfg, arts), OUTCOME_COLS, ID_COLS, TIME_COL, known)) + "/data"


def _select(spark, cfg, st, table, report, arts) -> None:
    """The grid, the winner with its preparation and calibrators, the training record."""
    train, val, feats = _labelled(spark, arts, "train"), _labelled(spark, arts, "val"), _inputs(spark, cfg, arts)
    params = [cfg.points, cfg.n_trees, cfg.patience, cfg.select_k, cfg.seed, cfg.features, cfg.scaler, cfg.monthwise_impute]

    def put(path: str) -> None:
        grid, best = model.grid_select(train, val, feats, cfg.key, cfg.select_k, cfg.points, "label", cfg.n_trees, cfg.patience, seed=cfg.seed)
        io.write_report(grid, f"{path}/grid")
        whole = prepared_model.fit(train, val, _read(spark, arts, "clean"), cfg.features, cfg.keep_months, best, cfg.scaler, cfg.monthwise_impute)
        whole.write().overwrite().save(f"{path}/model")
        c = features.class_weight(train).first()
        record = {"features_used": feats, "train_pos": c["pos"], "train_neg": c["neg"], "scale_pos_weight": c["weight"],
                  "best_params": {**asdict(best.point), "n_trees": len(best.trees)}, "select_k": cfg.select_k, "topk_list": list(cfg.ks),
                  "quantiles": list(cfg.quantiles), "groupby": list(cfg.groupby), "group_k": list(cfg.group_ks)}
        io.write_json(spark, f"{path}/train_meta", record)
    path = st.write("select", params, ["sets", "clean"], put)
    arts |= {"model": f"{path}/model", "grid": f"{path}/grid", "train_meta": f"{path}/train_meta"}


def _evaluate(spark, cfg, st, table, report, arts) -> None:
    """Predictions of both calibrators on val and test, metrics, operating tables, thresholds."""
    m = prepared_model.PreparedModel.load(arts["model"])

    def build():
        out = None
        for name in ("val", "test"):
            d = _labelled(spark, arts, name)
            s = m.calibrated(m.trees.score(d, "prob_raw")).withColumn("split", F.lit(name))
            keep = [c for c in d.columns if c in (cfg.key, "label", *cfg.groupby)]
            for cal in ("iso", "sig"):
                part = s.select(*keep, "split", F.lit(cal).alias("calibrator"), F.col(f"prob_{cal}").alias("prob"))
                out = part if out is None else out.unionByName(part)
        return out
    scored = table("scored", [cfg.groupby], ["select"], build)
    by = ["calibrator", "split"]
    mets, at_k = model.evaluate(scored, cfg.ks, cfg.key)
    report("metrics", [], ["scored"], lambda: mets, "json")
    report("precision_at_k", cfg.ks, ["scored"], lambda: at_k)
    report("topk_global", [cfg.ks, cfg.quantiles], ["scored"], lambda: ranking.topk_global(scored, cfg.ks, cfg.quantiles, key=cfg.key, by=by))
    groups = [c for c in cfg.groupby if c in scored.columns]
    if groups:
        report("topk_grouped", [groups, cfg.group_ks], ["scored"], lambda: ranking.topk_grouped(scored, groups, cfg.group_ks, key=cfg.key, by=by))
    report("calibration", [], ["scored"], lambda: curves.calibration_table(scored, by=by))
    report("calibration_tail", [cfg.tail_q, cfg.tail_bins], ["scored"], lambda: curves.calibration_tail(scored, tail_q=cfg.tail_q, n_bins=cfg.tail_bins, by=by))
    iso = scored.filter("calibrator = 'iso' and split = 'val'")
    report("thresholds", [cfg.quantiles, cfg.select_k], ["scored"], lambda: policy.derive(iso, cfg.quantiles[0], cfg.select_k, key=cfg.key), "json")
    arts["predictions"] = st.write("predictions", [], ["scored"], lambda p: model.export_predictions(scored, f"{p}/data", cfg.key)) + "/data"


def _explain(spark, cfg, st, table, report, arts) -> None:
    """Contributions, then curves, thresholds and surfaces of the first features."""
    m = prepared_model.PreparedModel.load(arts["model"])
    val, feats = _labelled(spark, arts, "val"), m.trees.features
    method, imp = model.explain_importance(val, m.trees, feats, cfg.key)
    imp = table("importance", method, ["select"], lambda: imp)
    top = [r["feature"] for r in explain.top_features(imp, cfg.top_m).collect() if r["feature"] in cfg.features]  # top_m names
    scorer = TreeScorer(m.trees, feats)
    curve = table("pd_curves", [top, cfg.pd_points], ["importance"], lambda: explain.pd_1d(val, top, scorer, cfg.pd_points))
    report("pd_thresholds", [], ["pd_curves"], lambda: explain.detect_thresholds(curve))
    report("threshold_ci", [top, cfg.pd_points, cfg.replicates, cfg.seed], ["importance"], lambda: explain.threshold_ci(
        val, top, scorer, cfg.key, cfg.pd_points, cfg.replicates, seed=cfg.seed))
    if len(top) > 1:
        surface = table("pd_surfaces", [top, cfg.pd2_points], ["importance"], lambda: explain.pd_2d(val, explain.pairs(top), scorer, cfg.pd2_points))
        report("pathways", [], ["pd_surfaces"], lambda: explain.pathways(explain.pair_delta(surface)))


def _report(spark, cfg, st, table, report, arts) -> None:
    scored, imp = _read(spark, arts, "scored"), _read(spark, arts, "importance")
    iso = scored.filter("calibrator = 'iso' and split = 'val'")
    point = policy.derive(iso, cfg.primary_q, cfg.select_k, key=cfg.key, clip_floor=1e-15)
    report("fit_report", [cfg.primary_q, cfg.select_k, cfg.tail_q, cfg.tail_bins], ["scored", "importance"], lambda: fit_report(
        scored, point, "tree_contributions", explain.top_features(imp, 10), cfg.tail_q, cfg.tail_bins), "json")


def fit_report(scored: DataFrame, policy: DataFrame, explain_method: str, importance: DataFrame, tail_q: float = 0.99,
               tail_bins: int = 12, label: str = "label") -> DataFrame:
    """One row per calibrator: AUC / AP / Brier and tail summaries for val and test, the
    operating point, the explanation method and the features it ranks first."""
    m = curves.metrics(scored, "prob", label, ["calibrator", "split"])
    t = curves.tail_summary(scored, "prob", label, tail_q, tail_bins, ["calibrator", "split"])
    both = m.join(t, ["calibrator", "split"])
    aggs = []
    for sp in ("val", "test"):
        for src, name in (("AUC", "auc"), ("PR_AUC", "ap"), ("Brier", "brier"), ("baseline_rate", "baseline_rate"),
                          ("max_lift_tail", "max_lift_tail"), ("n_bins_tail", "n_bins_tail")):
            aggs.append(F.max(F.when(F.col("split") == sp, F.col(src))).alias(f"{name}_{sp}"))
    pack = both.groupBy("calibrator").agg(*aggs)
    pol = policy.select(F.struct(*policy.columns).alias("operating_point"))
    weight = [c for c in importance.columns if c != "feature"][0]
    top = importance.agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col(weight)).alias("w"), "feature"))), lambda x: x["feature"]).alias("t"))
    return pack.withColumn("operating_point", pol.scalar()) \
        .withColumn("explain", F.lit(explain_method)).withColumn("top", top.scalar())
