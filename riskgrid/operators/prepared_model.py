"""A fitted preparation and model as one ``pyspark.ml`` stage.

``PreparedModel`` holds what step 2 and the training step fitted: medians, scaler,
months, trees and both calibrators.  It transforms raw observations into scores and is
saved and loaded like any other ML stage, alone or inside a ``PipelineModel``: the
metadata as ``pyspark.ml`` writes it, each table as Parquet beside it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession

from riskgrid.operators import boosting, calibrate, features
from riskgrid.operators.boosting import BoostedTrees


class PreparedModel(Model, MLWritable, MLReadable):
    """Adds ``prob_raw``, ``prob_iso`` and ``prob_sig``; the features come out imputed and scaled."""

    def __init__(self, feats: Sequence[str] = (), months: Sequence[int] = (), monthwise: bool = False, medians: DataFrame | None = None,
                 scaler: DataFrame | None = None, trees: BoostedTrees | None = None, blocks: DataFrame | None = None,
                 sigmoid: tuple[float, float] | None = None):
        super().__init__()
        self.feats, self.months, self.monthwise = list(feats), list(months), monthwise
        self.medians, self.scaler, self.trees, self.blocks, self.sigmoid = medians, scaler, trees, blocks, sigmoid

    def prepare(self, df: DataFrame) -> DataFrame:
        """Impute, month indicators, scale, by the fitted parameters."""
        imputed = features.apply_medians(df, self.medians, self.feats, self.monthwise)
        return features.transform_scaler(features.add_month_dummies(imputed, self.months), self.scaler, self.feats)

    def calibrated(self, scored: DataFrame) -> DataFrame:
        iso = calibrate.apply_isotonic(scored, self.blocks, "prob_raw", "prob_iso")
        return calibrate.apply_sigmoid(iso, {(): self.sigmoid}, "prob_raw", "prob_sig")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.calibrated(self.trees.score(self.prepare(dataset), "prob_raw"))

    def write(self) -> MLWriter:
        return PreparedModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return PreparedModelReader()


class PreparedModelWriter(MLWriter):
    def __init__(self, model: PreparedModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:  # noqa: N802, the ML interface's name
        m, spark = self.model, SparkSession.getActiveSession()
        DefaultParamsWriter.saveMetadata(m, path, spark, {"feats": m.feats, "months": m.months, "monthwise": m.monthwise, "sigmoid": list(m.sigmoid)})
        for name in ("medians", "scaler", "blocks"):
            getattr(m, name).write.mode("overwrite").parquet(f"{path}/{name}")
        boosting.save(m.trees, f"{path}/trees", spark)


class PreparedModelReader(MLReader):
    def load(self, path: str) -> PreparedModel:
        spark = SparkSession.getActiveSession()
        meta = DefaultParamsReader.loadMetadata(path, spark)
        tables = {name: spark.read.parquet(f"{path}/{name}") for name in ("medians", "scaler", "blocks")}
        model = PreparedModel(meta["feats"], meta["months"], meta["monthwise"], trees=boosting.load(f"{path}/trees", spark),
                              sigmoid=tuple(meta["sigmoid"]), **tables)
        model._resetUid(meta["uid"])
        return model


def fit(train: DataFrame, val: DataFrame, raw: DataFrame, feats: Sequence[str], months: Sequence[int], trees: BoostedTrees,
        scaler: str = "minmax", monthwise: bool = False, label: str = "label") -> PreparedModel:
    """The stage around fitted ``trees``: medians and scaler of ``raw`` (all cleaned rows, as step 2
    fits them), calibrators of the prepared validation rows."""
    med = features.fit_median(raw, feats, ["month"] if monthwise else [])
    model = PreparedModel(feats, months, monthwise, med, None, trees)
    model.scaler = features.fit_scaler(features.apply_medians(raw, med, feats, monthwise), feats, scaler)
    scored = trees.score(val, "prob_raw")
    model.blocks = calibrate.fit_isotonic(scored, "prob_raw", label)
    model.sigmoid = calibrate.fit_sigmoid(scored, "prob_raw", label)[()]
    return model
