"""Speed regression on Spark: training rows, features, models, metrics, scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pavelake.config import EVENT_KEY, QualityLimits
from pavelake.functions.keys import event_bucket
from pavelake.functions.numeric import round_half_even
from pavelake.operators.ensembles import ROW_ID, BootstrapForest, MeanBoosting, applied
from pavelake.schemas import PREDICTIONS

# What is learned, from which columns, and how rows are split.
TARGET = "speed_int"
NUMERIC = ("hour", "peak_flag", "traffic_volume_int", "congestion_level_int", "incident_flag_int")
CATEGORICAL = ("road_id", "city_zone", "weather", "traffic_band")
FEATURES = NUMERIC + CATEGORICAL
SPLIT_BUCKETS = 10
TRAIN_BUCKETS = 8
SEED = 42

WEIGHT = "row_weight"
LABEL = "label"


def training_rows(fact: DataFrame) -> DataFrame:
    """Complete rows: event key, features, target."""
    columns = [*FEATURES, TARGET]
    return fact.select(*EVENT_KEY, *columns).dropna(subset=columns)


def with_split(rows: DataFrame) -> DataFrame:
    """80/20 by a hash of the event key: the same rows on every run and under any partitioning."""
    bucket = event_bucket(SPLIT_BUCKETS)
    return rows.withColumn("bucket", bucket).withColumn("is_train", F.col("bucket") < TRAIN_BUCKETS)


def collapse(rows: DataFrame, *also: str) -> DataFrame:
    """Equal (features, target, side of the split) become one row with a weight.

    All features are small integers or categories, so the result stops growing with the input
    long before the input does. A fit that honours weights gives the same model on it.
    """
    columns = [*FEATURES, TARGET, *also, *(["is_train"] if "is_train" in rows.columns else [])]
    collapsed = rows.groupBy(*columns).agg(F.count(F.lit(1)).cast("double").alias(WEIGHT))
    return collapsed.withColumn(ROW_ID, F.xxhash64(*FEATURES, TARGET))


def feature_pipeline() -> Pipeline:
    """One-hot blocks, then the numbers. A category not seen in training, or NULL, is an all-zero block."""
    index = [f"{name}_index" for name in CATEGORICAL]
    one_hot = [f"{name}_one_hot" for name in CATEGORICAL]
    return Pipeline(stages=[
        StringIndexer(
            inputCols=list(CATEGORICAL), outputCols=index, handleInvalid="keep", stringOrderType="alphabetAsc"
        ),
        OneHotEncoder(inputCols=index, outputCols=one_hot),
        VectorAssembler(inputCols=[*one_hot, *NUMERIC], outputCol="features"),
    ])


def bins_for(limits: QualityLimits = QualityLimits()) -> int:
    """More bins than any feature has valid values, so that trees try every threshold and none is sampled."""
    ranges = (limits.traffic_volume, limits.congestion, (0, 23))
    return 1 << max(high - low + 2 for low, high in ranges).bit_length()


def regressors(
    forest_trees: int = 200,
    boosting_rounds: int = 200,
    max_bins: int | None = None,
) -> dict[str, Estimator]:
    """The four contenders, in the order in which ties are decided."""
    max_bins = max_bins or bins_for()
    return {
        "Linear Regression": LinearRegression(labelCol=LABEL, tol=1e-12, maxIter=1000),
        "Decision Tree": DecisionTreeRegressor(labelCol=LABEL, maxDepth=8, maxBins=max_bins, seed=SEED),
        "Random Forest": BootstrapForest(
            DecisionTreeRegressor(labelCol=LABEL, maxDepth=12, maxBins=max_bins, seed=SEED), trees=forest_trees
        ),
        "Gradient Boosting": MeanBoosting(
            DecisionTreeRegressor(labelCol=LABEL, maxDepth=3, maxBins=max_bins, seed=SEED), rounds=boosting_rounds, step=0.05
        ),
    }


def labelled(rows: DataFrame) -> DataFrame:
    return rows.withColumn(LABEL, F.col(TARGET).cast("double"))


def regression_metrics(
    scored: DataFrame,
    by: Sequence[str] = (),
    label: str = LABEL,
    prediction: str = "prediction",
    weight: Column | None = None,
) -> DataFrame:
    """r2, rmse and mae per group of ``by`` in one aggregation."""
    w = F.lit(1.0) if weight is None else weight
    y = F.col(label).cast("double")
    miss = y - F.col(prediction)
    n, sum_y, sum_yy, sum_sq, sum_abs = (F.sum(w * x) for x in (F.lit(1.0), y, y * y, miss * miss, F.abs(miss)))
    spread = sum_yy - sum_y * sum_y / n
    # With a constant label r2 is 1 for a perfect prediction and 0 for any other.
    r2 = F.when(spread > 0, 1 - F.try_divide(sum_sq, spread)).when(sum_sq == 0, 1.0).otherwise(0.0)
    return scored.groupBy(*by).agg(
        n.alias("row_weight"),
        r2.alias("r2"),
        F.sqrt(sum_sq / n).alias("rmse"),
        (sum_abs / n).alias("mae"),
    )


def with_prediction_error(scored: DataFrame, prediction: str = "prediction", actual: str = TARGET) -> DataFrame:
    """Prediction and error to two digits; the error is taken from the rounded prediction."""
    rounded = scored.withColumn("predicted_speed", round_half_even(F.col(prediction)))
    return rounded.withColumn("prediction_error", round_half_even(F.col(actual) - F.col("predicted_speed")))


def score(fact: DataFrame, model: Transformer | PipelineModel) -> DataFrame:
    """Predictions with their error and the time of this (micro-)batch."""
    scored = with_prediction_error(applied(model, fact)).withColumn("prediction_ts", F.current_timestamp())
    return scored.select(*PREDICTIONS.fieldNames())


def unscored(fact: DataFrame, scored: DataFrame, keys: Sequence[str] = EVENT_KEY) -> DataFrame:
    """Fact rows whose event is not among the scored ones. Copies within ``fact`` all stay."""
    return fact.join(scored.select(*keys), list(keys), "left_anti").select(*fact.columns)
