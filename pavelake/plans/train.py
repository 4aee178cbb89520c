"""Fit the contenders on the fact table, compare them, keep the best."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from pavelake.config import LakeConfig
from pavelake.operators import regression
from pavelake.operators.ensembles import PARTITION_ROWS, ROW_ID, applied, load_pipeline, save_pipeline
from pavelake.operators.regression import FEATURES, LABEL, TARGET, WEIGHT
from pavelake.schemas import FACT, LEADERBOARD
from pavelake.session import use_checkpoints
from pavelake.sources.tables import path_exists, read_table

METRICS = ("train_r2", "test_r2", "test_rmse", "test_mae")


@dataclass(frozen=True)
class Training:
    models: dict[str, PipelineModel]
    scores: dict[str, dict[str, float]]
    best_name: str

    @property
    def best(self) -> PipelineModel:
        return self.models[self.best_name]

    def leaderboard(self, spark: SparkSession) -> DataFrame:
        rows = [Row(model_name=name, **values) for name, values in self.scores.items()]
        return spark.createDataFrame(rows, LEADERBOARD).orderBy(F.desc("test_r2"), "model_name")


def fit_all(fact: DataFrame, models: Mapping[str, Estimator] | None = None) -> Training:
    """Fit each model on the training side and measure it on both.

    The fact table is read into collapsed rows whose number is bounded by the feature domains; indexing, weighted fits
    and evaluation work on those, encoded once for all models.
    """
    models = dict(models or regression.regressors())
    use_checkpoints(fact.sparkSession)
    rows = regression.labelled(regression.with_split(regression.training_rows(fact)))
    held = small = regression.collapse(rows, LABEL).persist()
    weighted = None
    try:
        count, cores = small.count(), fact.sparkSession.sparkContext.defaultParallelism
        small = small.coalesce(max(1 + count // PARTITION_ROWS, cores))  # the shuffle's partitions may be many for few rows
        features = regression.feature_pipeline().fit(small.filter("is_train"))
        weighted = features.transform(small).select("is_train", "features", LABEL, WEIGHT, ROW_ID).persist()
        fitted, scores = {}, {}
        for name, model in models.items():
            last = model.copy({model.weightCol: WEIGHT}).fit(weighted.filter("is_train"))
            fitted[name] = PipelineModel(stages=[*features.stages, last])
            scores[name] = _scores(applied(last, weighted))
    finally:
        for frame in (held, weighted):
            if frame is not None:
                frame.unpersist()
    return Training(fitted, scores, max(scores, key=lambda name: scores[name]["test_r2"]))


def together(parts: Sequence[Training]) -> Training:
    """Fits made one by one, compared as if made in one run."""
    models = {name: model for part in parts for name, model in part.models.items()}
    scores = {name: values for part in parts for name, values in part.scores.items()}
    return Training(models, scores, max(scores, key=lambda name: scores[name]["test_r2"]))


def _scores(scored: DataFrame) -> dict[str, float]:
    sides = regression.regression_metrics(scored, by=["is_train"], weight=F.col(WEIGHT))
    by_side = {row["is_train"]: row for row in sides.collect()}
    missing = {True, False} - by_side.keys()
    if missing:
        raise ValueError("training and test rows are both needed; one side of the split is empty")
    train, test = by_side[True], by_side[False]
    return {"train_r2": train["r2"], "test_r2": test["r2"], "test_rmse": test["rmse"], "test_mae": test["mae"]}


def save(spark: SparkSession, cfg: LakeConfig, training: Training) -> None:
    """Best model, sorted leaderboard, and what was trained on what."""
    path = f"{cfg.table('model')}/{uuid.uuid4().hex}"
    save_pipeline(spark, training.best, path)
    board = training.leaderboard(spark)
    board.coalesce(1).write.mode("overwrite").option("header", True).csv(cfg.table("leaderboard"))
    metadata = Row(
        target_column=TARGET,
        feature_columns=list(FEATURES),
        best_model_name=training.best_name,
        model_path=path,
    )
    spark.createDataFrame([metadata]).coalesce(1).write.mode("overwrite").json(cfg.table("training_metadata"))


def load_model(spark: SparkSession, cfg: LakeConfig) -> PipelineModel:
    """The model that the metadata of the last training names; older ones stay for jobs that are loading them."""
    if not path_exists(spark, cfg.table("training_metadata")):
        raise FileNotFoundError(f"no model under {cfg.root}; run the training job first")
    path = spark.read.schema("model_path string").json(cfg.table("training_metadata")).first()["model_path"]
    return load_pipeline(path)


def read_leaderboard(spark: SparkSession, cfg: LakeConfig) -> DataFrame:
    board = spark.read.schema(LEADERBOARD).option("header", True).csv(cfg.table("leaderboard"))
    return board.orderBy(F.desc("test_r2"), "model_name")


def log_runs(spark: SparkSession, cfg: LakeConfig, training: Training) -> None:
    """One row per fitted model, appended to the run log; the models go next to it."""
    rows = []
    for name, model in training.models.items():
        run_id = uuid.uuid4().hex
        path = f"{cfg.table('model_artifacts')}/{run_id}"
        save_pipeline(spark, model, path)
        rows.append((run_id, name, TARGET, list(FEATURES), {m: training.scores[name][m] for m in METRICS}, path))
    schema = ("run_id string, model_name string, target string, features array<string>, "
              "metrics map<string, double>, model_path string")
    logged = spark.createDataFrame(rows, schema).withColumn("logged_at", F.current_timestamp())
    logged.coalesce(1).write.format(cfg.table_format).mode("append").save(cfg.table("model_runs"))


def run(spark: SparkSession, cfg: LakeConfig, models: Mapping[str, Estimator] | None = None) -> Training:
    use_checkpoints(spark)
    fact = read_table(spark, cfg.table("fact"), cfg.table_format, FACT)
    training = fit_all(fact, models)
    save(spark, cfg, training)
    log_runs(spark, cfg, training)
    return training
