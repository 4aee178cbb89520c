"""Registered queries: every operator run over the whole ``events`` table of a data folder.

The ``*_stream`` queries run real streaming queries to the end of their input and return the table
they wrote. Event times leave as TIMESTAMP_NTZ so that other engines read the same clock.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pavelake.config import LakeConfig
from pavelake.functions.casting import lenient_timestamp
from pavelake.functions.keys import event_bucket, with_record_key
from pavelake.functions.numeric import round_half_even
from pavelake.operators import regression, reports
from pavelake.operators.ensembles import MeanBoosting, applied, load_pipeline
from pavelake.operators.dedup import copy_slices, dedup_batch, dedup_stream
from pavelake.operators.features import with_features
from pavelake.operators.hourly import road_hourly, zone_hourly
from pavelake.operators.quality import (
    clean_rows,
    passing_rows,
    quality_rules,
    reason_list,
    rejected_rows,
    validate,
    with_clean_verdict,
    with_types,
)
from pavelake.operators.recovery import drift, rejudged
from pavelake.operators.star import dimension, fact_rows
from pavelake.plans import announce, publish, refine, score, train
from pavelake.schemas import BRONZE, FACT, MESSAGE, SILVER, VALIDATED
from pavelake.session import shared_folder, use_checkpoints
from pavelake.sources import bindings
from pavelake.sources.messages import decode_messages
from pavelake.sources.tables import ensure_folder, read_rejected, read_table, read_validated, stream_table
from pavelake.plans.refine import start_validated
from pavelake.streaming.audit import LATE_EVENT, as_rejected, late_rows
from pavelake.streaming.dimensions import dimension_sink, read_dimension
from pavelake.streaming.sinks import append_sink
from pavelake.streaming.supervise import run_to_end

Query = Callable[[SparkSession, str], DataFrame]
ALL_AVAILABLE = {"availableNow": True}

# The clock of the batch queries. Streams use the real one; the feed has no time between the two.
NOW = datetime(2030, 1, 1, tzinfo=timezone.utc)


GAPPY = ("congestion_level", "traffic_volume", "incident_flag", "congestion_level_int", "traffic_volume_int",
         "incident_flag_int", "speed_int")

# Fits of a session by data folder and model, so that each model is fitted once for all queries that look at it.
_FITS: dict[tuple[str, str, str], train.Training] = {}


def _wall_clock(df: DataFrame) -> DataFrame:
    return df.select(*[
        F.col(name).cast("timestamp_ntz").alias(name) if dtype in ("timestamp", "date") else F.col(name)
        for name, dtype in df.dtypes
    ])


def _with_gaps(query: Query) -> Query:
    """Integer columns that hold NULLs leave as DOUBLE, as data frames on either side store them anyway."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = query(spark, sf_dir)
        gaps = {*GAPPY} & set(df.columns)
        return df.withColumns({name: F.col(name).cast("double") for name in gaps})

    return run


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events, dealt out: a file is read by a task per row group, however large that is, and writing and parsing
    a message costs far more than moving its row."""
    return bindings.events_batch(spark, sf_dir).hint("rebalance", "event_id", "ts")


def _bronze(spark: SparkSession, sf_dir: str, redeliver: bool = False) -> DataFrame:
    return decode_messages(bindings.messages(_events(spark, sf_dir), redeliver))


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_features(clean_rows(_bronze(spark, sf_dir), now=NOW))


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_rows(_silver(spark, sf_dir)).drop("ingested_at")


def _fact_table(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    """The fact rows, stored once for queries that read them more than once: the feed is parsed a single time."""
    path = _stored(_fact(spark, sf_dir), f"{shared_folder(spark, label)}/fact")
    return read_table(spark, path)


def _training(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regression.training_rows(_fact(spark, sf_dir))


def _stored(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)
    return path


def _bronze_table(spark: SparkSession, sf_dir: str, root: str, redeliver: bool = False) -> DataFrame:
    path = _stored(_bronze(spark, sf_dir, redeliver), f"{root}/bronze")
    return stream_table(spark, path, BRONZE)


def _silver_table(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    path = _stored(_silver(spark, sf_dir).select(*SILVER.fieldNames()), f"{root}/silver")
    return stream_table(spark, path, SILVER)


def _appended(df: DataFrame, root: str, name: str, **options) -> DataFrame:
    """Run ``df`` into an append table to the end of its input and read the table."""
    path = f"{root}/{name}"
    run_to_end([lambda: append_sink(df, path, f"{root}/chk/{name}", trigger=ALL_AVAILABLE, **options)])
    return read_table(df.sparkSession, path, schema=df.schema).select(*df.columns)


# -- raw table ------------------------------------------------------------------------------------


def bronze_parse(spark, sf_dir):
    return _bronze(spark, sf_dir)


def bronze_stream(spark, sf_dir):
    feed = bindings.messages(bindings.events_stream(spark, sf_dir))
    return _appended(decode_messages(feed), shared_folder(spark, "bronze_stream"), "bronze")


def encode_roundtrip(spark, sf_dir):
    return decode_messages(bindings.payload_messages(_events(spark, sf_dir))).drop("raw_json")


def publish_stream(spark, sf_dir):
    """The fact table published as messages by the job and read back."""
    root = shared_folder(spark, "publish_stream")
    cfg = LakeConfig(root, message_source="parquet", message_options={"path": f"{root}/messages"})
    fact_rows(_silver(spark, sf_dir)).write.partitionBy("event_date").parquet(cfg.table("fact"))
    announce.run(spark, cfg, ALL_AVAILABLE, "fact")
    fields = "vehicle_id string, road_id string, city_zone string, weather string, event_ts timestamp, speed_int int"
    text = read_table(spark, f"{root}/messages", schema=MESSAGE).select(F.col("value").cast("string").alias("v"))
    return text.select(F.inline(F.array(F.from_json("v", fields))))


# -- clean and rejected ---------------------------------------------------------------------------


def silver_typed(spark, sf_dir):
    return with_types(_bronze(spark, sf_dir))


def dq_flags(spark, sf_dir):
    typed = with_types(_bronze(spark, sf_dir))
    return typed.withColumns({r.flag: F.when(r.check, 1).otherwise(0) for r in quality_rules(now=NOW)})


def dq_reasons(spark, sf_dir):
    judged = validate(_bronze(spark, sf_dir), now=NOW)
    return judged.select(
        "raw_json", "kafka_timestamp", "invalid_reason", "dq_flag",
        F.size(reason_list(F.col("invalid_reason"))).alias("reason_count"),
    )


def silver_clean(spark, sf_dir):
    return clean_rows(_bronze(spark, sf_dir), now=NOW)


def silver_rejected(spark, sf_dir):
    return rejected_rows(_bronze(spark, sf_dir), now=NOW)


def rejected_stream(spark, sf_dir):
    root = shared_folder(spark, "rejected_stream")
    return _appended(rejected_rows(_bronze_table(spark, sf_dir, root)), root, "silver_rejected")


def silver_rejected_split(spark, sf_dir):
    cfg = LakeConfig(shared_folder(spark, "silver_split"))
    _stored(_bronze(spark, sf_dir), cfg.table("bronze"))
    run_to_end([lambda: start_validated(spark, cfg, ALL_AVAILABLE)])
    both = read_validated(spark, cfg, "OK").unionByName(read_rejected(spark, cfg))
    return both.select("raw_json", "kafka_timestamp", "vehicle_id", "event_ts", "invalid_reason", "dq_flag")


def _drifting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_messages(bindings.drifting_messages(_events(spark, sf_dir)))


def rejected_recovered(spark, sf_dir):
    again = rejudged(rejected_rows(_drifting(spark, sf_dir), now=NOW), now=NOW)
    return again.select("raw_json", "kafka_timestamp", "former_reason", F.array_join("recovered", ",").alias("recovered"),
                        "congestion_level", "traffic_volume", "invalid_reason", "passes")


def bronze_drift(spark, sf_dir):
    return drift(_drifting(spark, sf_dir))


def silver_dedup(spark, sf_dir):
    return with_clean_verdict(dedup_batch(passing_rows(_bronze(spark, sf_dir, redeliver=True), now=NOW)))


def silver_features(spark, sf_dir):
    return _silver(spark, sf_dir)


def silver_stream(spark, sf_dir):
    """Which copy of a message arrives first is up to the cluster, so arrival time is left out."""
    root = shared_folder(spark, "silver_stream")
    passing = passing_rows(_bronze_table(spark, sf_dir, root, redeliver=True))
    unique = dedup_stream(passing, slices=copy_slices(spark))
    return _appended(with_features(with_clean_verdict(unique)), root, "silver").drop("kafka_timestamp")


def late_drop_audit(spark, sf_dir):
    """Every seventh microsecond arrives in a second delivery, mostly too late for the watermark."""
    root = shared_folder(spark, "late_drop_audit")
    clean = clean_rows(_bronze(spark, sf_dir), now=NOW)
    second = F.unix_micros("event_ts") % 7 == 0
    passed = f"{root}/passed"
    unique = dedup_stream(stream_table(spark, ensure_folder(spark, passed), VALIDATED), slices=copy_slices(spark))
    for part in (clean.filter(~second), clean.filter(second)):
        part.write.mode("append").parquet(passed)
        silver = _appended(unique, root, "silver")
    late = as_rejected(late_rows(read_table(spark, passed, schema=VALIDATED), silver))
    return late.select("vehicle_id", "event_ts", "city_zone", "weather", "speed_int", "invalid_reason")


def late_rows_routed(spark, sf_dir):
    """Three deliveries through the jobs with routing on: what is rejected as late.

    Every seventh microsecond comes last and is judged by the latest event of the first delivery."""
    cfg = LakeConfig(shared_folder(spark, "late_rows_routed"), route_late=True)
    turn = F.coalesce(F.unix_micros(lenient_timestamp(F.col("event_time"))) % 7, F.lit(1))
    feed = read_table(spark, _stored(_bronze(spark, sf_dir).withColumn("turn", turn), f"{cfg.root}/feed"))
    for part in (feed.filter("turn between 1 and 5"), feed.filter("turn = 6"), feed.filter("turn = 0")):
        part.drop("turn").write.mode("append").parquet(cfg.table("bronze"))
        refine.run(spark, cfg, ALL_AVAILABLE)
    late = read_rejected(spark, cfg).filter(F.col("invalid_reason") == LATE_EVENT)
    return late.select("vehicle_id", "event_ts", "city_zone", "weather", "speed_int", "invalid_reason")


# -- fact, dimensions, hourly metrics ---------------------------------------------------------------


def gold_fact(spark, sf_dir):
    return _fact(spark, sf_dir)


def fact_batch(spark, sf_dir):
    path = f"{shared_folder(spark, 'fact_batch')}/fact"
    fact_rows(_silver(spark, sf_dir)).write.partitionBy("event_date").parquet(path)
    fact = read_table(spark, path, schema=FACT)
    return fact.groupBy("event_date", "city_zone").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("speed_int").alias("speed_sum")
    )


def gold_fact_stream(spark, sf_dir):
    root = shared_folder(spark, "gold_fact_stream")
    fact = fact_rows(_silver_table(spark, sf_dir, root))
    return _appended(fact, root, "fact", partition_by=["event_date"]).drop("ingested_at")


def _dimension(name: str) -> Query:
    return lambda spark, sf_dir: dimension(_silver(spark, sf_dir), name)


def _dimension_stream(name: str) -> Query:
    def run(spark, sf_dir):
        root = shared_folder(spark, f"{name}_stream")
        silver = _silver_table(spark, sf_dir, root)
        path = f"{root}/{name}"
        run_to_end([lambda: dimension_sink(silver, {name: path}, f"{root}/chk/{name}", trigger=ALL_AVAILABLE)])
        return read_dimension(spark, name, path)

    return run


def _hourly_stream(name: str, mode: str = "dates") -> Query:
    def run(spark, sf_dir):
        cfg = LakeConfig(shared_folder(spark, f"{name}_stream"), hourly_mode=mode)
        silver = _silver(spark, sf_dir)
        if mode == "dates":
            fact_rows(silver).write.partitionBy("event_date").parquet(cfg.table("fact"))
        else:
            _stored(silver.select(*SILVER.fieldNames()), cfg.table("silver"))
        run_to_end([lambda: publish.start_hourly(spark, cfg, name, ALL_AVAILABLE)])
        return publish.read_hourly(spark, cfg, name)

    return run


def zone_hourly_final(spark, sf_dir):
    root = shared_folder(spark, "zone_hourly_final")
    return _appended(zone_hourly(_silver_table(spark, sf_dir, root)), root, "zone_hourly")


def dedup_window_chain(spark, sf_dir):
    root = shared_folder(spark, "dedup_window_chain")
    unique = dedup_stream(passing_rows(_bronze_table(spark, sf_dir, root, redeliver=True)), slices=copy_slices(spark))
    return _appended(zone_hourly(with_features(unique), watermark=None), root, "zone_hourly")


# -- reports --------------------------------------------------------------------------------------


def profile_tables(spark, sf_dir):
    fact = fact_rows(_silver(spark, sf_dir))
    fact = read_table(spark, _stored(fact, f"{shared_folder(spark, 'profile_tables')}/fact"), schema=fact.schema)
    tables = {"fact": fact} | {n: dimension(fact, n) for n in ("dim_zone", "dim_road", "dim_weather")}
    profiles = [reports.table_profile(df, name) for name, df in tables.items()]
    together = profiles[0]
    for profile in profiles[1:]:
        together = together.unionByName(profile)
    return together.drop("column_type")


def _of_fact(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(_fact(spark, sf_dir))


def _with_dimension(report: Callable[[DataFrame, DataFrame], DataFrame], name: str) -> Query:
    def run(spark, sf_dir):
        fact = _fact_table(spark, sf_dir, name)
        return report(fact, dimension(fact, name))

    return run


# -- regression -----------------------------------------------------------------------------------


def ml_features(spark, sf_dir):
    rows = regression.labelled(_training(spark, sf_dir))
    vectors = regression.feature_pipeline().fit(rows).transform(rows)
    numbers = F.transform(vector_to_array("features"), lambda x: x.cast("int").cast("string"))
    return vectors.select("vehicle_id", "event_ts", F.array_join(numbers, ",").alias("features"), "label")


def _guess():
    """A stand-in for a model: steps of an eighth make every rounding tie appear."""
    return 70 - 10 * F.col("congestion_level_int") + F.col("traffic_volume_int") / 8.0


def prediction_error(spark, sf_dir):
    scored = regression.with_prediction_error(_fact(spark, sf_dir).withColumn("prediction", _guess()))
    return scored.select("vehicle_id", "event_ts", "speed_int", "predicted_speed", "prediction_error")


def regression_metrics(spark, sf_dir):
    rows = regression.labelled(regression.with_split(_training(spark, sf_dir))).withColumn("prediction", _guess())
    metrics = regression.regression_metrics(rows, by=["is_train"])
    return metrics.select("is_train", "row_weight", *[
        (F.rint(F.col(name) * 1e6) / 1e6).alias(name) for name in ("r2", "rmse", "mae")
    ])


def unscored_rows(spark, sf_dir):
    fact = _fact(spark, sf_dir)
    return regression.unscored(fact, fact.filter(event_bucket() < 8))


def ml_split(spark, sf_dir):
    return regression.with_split(_training(spark, sf_dir)).select("vehicle_id", "event_ts", "bucket", "is_train")


def _fit(spark, sf_dir, only: list[str] | None = None, fact: DataFrame | None = None) -> train.Training:
    """The contenders at their full size, or some of them; those not fitted yet are fitted on one reading of the facts."""
    use_checkpoints(spark)
    models = regression.regressors()
    keys = {name: (spark.sparkContext.applicationId, sf_dir, name) for name in only or models}
    missing = {name: models[name] for name, key in keys.items() if key not in _FITS}
    if missing:
        fitted = train.fit_all(_fact(spark, sf_dir) if fact is None else fact, missing)
        _FITS.update({keys[name]: train.Training({name: fitted.models[name]}, {name: fitted.scores[name]}, name) for name in missing})
    return train.together([_FITS[key] for key in keys.values()])


def _model_scores(name: str) -> Query:
    def run(spark, sf_dir):
        fact = _fact_table(spark, sf_dir, "model_scores")
        return regression.score(fact, _fit(spark, sf_dir, [name], fact).best).drop("prediction_ts")

    return run


def ml_linear_fit(spark, sf_dir):
    """A fit is a least-squares fit exactly if its training errors cancel out within every category and are
    uncorrelated with every number."""
    named = lambda c, level, x: F.struct(F.lit(c).alias("feature"), level.alias("level"), x.cast("double").alias("x"))
    terms = F.explode(F.array(
        *[named(c, F.col(c), F.lit(1.0)) for c in regression.CATEGORICAL],
        *[named(c, F.lit("number"), F.col(c)) for c in regression.NUMERIC])).alias("l")
    errors = _training_errors(spark, sf_dir, "Linear Regression").select(terms, "error")
    mean = F.round(F.sum(F.col("error") * F.col("l.x")) / F.greatest(F.sum(F.abs("l.x")), F.lit(1.0)), 4)
    return errors.groupBy("l.feature", "l.level").agg(
        F.count(F.lit(1)).alias("row_count"), F.when(mean == 0, 0.0).otherwise(mean).alias("mean_error")
    )


def _training_errors(spark, sf_dir, name: str) -> DataFrame:
    """Errors on the training rows, stored: those who ask read them several times."""
    fact = _fact_table(spark, sf_dir, "training_errors")
    rows = regression.with_split(regression.training_rows(fact)).filter("is_train")
    scored = applied(_fit(spark, sf_dir, [name], fact).best, rows)
    errors = scored.select(*regression.FEATURES, regression.TARGET, "prediction", (F.col("speed_int") - F.col("prediction")).alias("error"))
    return read_table(spark, _stored(errors, f"{shared_folder(spark, 'training_errors')}/errors"))


def _beats_one_split(errors: DataFrame) -> DataFrame:
    """Squared training error of a model beside the least that any single split of a number can reach.

    A model that learned nothing is at or above the error of the mean, which is no less than that of the best split.
    """
    values = F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x")) for c in regression.NUMERIC
    ])).alias("v")
    y = F.col("speed_int").cast("double")
    sums = errors.select(values, y.alias("y")).groupBy("v.feature", "v.x").agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("s"))
    up_to = Window.partitionBy("feature").orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    left = sums.select("feature", F.sum("n").over(up_to).alias("n"), F.sum("s").over(up_to).alias("s"))
    whole = errors.agg(F.count(F.lit(1)).alias("row_count"), F.sum(y).alias("all_s"), F.sum(y * y).alias("all_ss"),
                       F.sum(F.col("error") * F.col("error")).alias("model_sse"))
    rest, rest_s = F.col("row_count") - F.col("n"), F.col("all_s") - F.col("s")
    reached = F.col("all_ss") - F.col("s") * F.col("s") / F.col("n") - F.when(rest > 0, rest_s * rest_s / rest).otherwise(0.0)
    return left.join(F.broadcast(whole)).groupBy("row_count", "model_sse").agg(  # whole is one row
        F.round(F.min(reached), 3).alias("one_split_sse")).select(
        "row_count", "one_split_sse", (F.col("model_sse") < F.col("one_split_sse")).alias("beats_one_split"))


def ml_decision_tree_fit(spark, sf_dir):
    """A leaf predicts the mean of its training rows, so errors cancel out within every leaf."""
    errors = _training_errors(spark, sf_dir, "Decision Tree")
    leaves = errors.groupBy("prediction").agg(F.avg("error").alias("leaf_error"))
    worst = leaves.agg(F.round(F.max(F.abs("leaf_error")), 6).alias("worst_leaf_error"))
    return _beats_one_split(errors).join(F.broadcast(worst))  # one row each


def ml_random_forest_fit(spark, sf_dir):
    return _beats_one_split(_training_errors(spark, sf_dir, "Random Forest"))


def ml_gbt_fit(spark, sf_dir):
    """Each round fits what the rounds before it missed, so errors cancel out over the training rows."""
    errors = _training_errors(spark, sf_dir, "Gradient Boosting")
    mean = errors.agg(F.round(F.abs(F.avg("error")), 6).alias("mean_error"))
    return _beats_one_split(errors).join(F.broadcast(mean))  # one row each


def ml_boosting_step(spark, sf_dir):
    """One round of stumps: the mean, moved a twentieth of the way to the means of the two sides of the best split."""
    use_checkpoints(spark)
    fact = _fact_table(spark, sf_dir, "ml_boosting_step")
    stump = DecisionTreeRegressor(labelCol=regression.LABEL, maxDepth=1, maxBins=regression.bins_for(), seed=regression.SEED)
    name = "one round"
    fitted = train.fit_all(fact, {name: MeanBoosting(stump, rounds=1, step=0.05)}).best
    rows = regression.with_split(regression.training_rows(fact)).filter("is_train")
    sides = fitted.transform(rows).groupBy("prediction").agg(F.count(F.lit(1)).alias("row_count"))
    return sides.select(F.round("prediction", 6).alias("prediction"), "row_count")


def ml_runs_verified(spark, sf_dir):
    """The run log against its artifacts: each logged model is loaded and its metrics taken anew from single rows."""
    cfg = LakeConfig(shared_folder(spark, "ml_runs_verified"))
    fact = _fact_table(spark, sf_dir, "ml_runs_verified")
    train.log_runs(spark, cfg, _fit(spark, sf_dir, fact=fact))
    test = regression.with_split(regression.training_rows(fact)).filter("NOT is_train")
    y, p = F.col(regression.TARGET), F.col("prediction")
    found = []
    for run in read_table(spark, cfg.table("model_runs")).orderBy("model_name").collect():  # a row a model
        scored = applied(load_pipeline(run["model_path"]), test)
        again = scored.agg(
            F.count(F.lit(1)).alias("test_rows"), F.sum(y).alias("label_sum"), (1 - F.sum((y - p) ** 2) / (F.count(y) * F.var_pop(y))).alias("test_r2"),
            F.sqrt(F.avg((y - p) ** 2)).alias("test_rmse"), F.avg(F.abs(y - p)).alias("test_mae"))
        fits = [F.abs(F.col(m) - run["metrics"][m]) < 1e-6 for m in ("test_r2", "test_rmse", "test_mae")]
        found.append(again.select(F.lit(run["model_name"]).alias("model_name"), "test_rows", "label_sum",
                                  (fits[0] & fits[1] & fits[2]).alias("metrics_fit")))
    return reduce(DataFrame.unionByName, found)


def ml_leaderboard(spark, sf_dir):
    cfg = LakeConfig(shared_folder(spark, "ml_leaderboard"))
    train.save(spark, cfg, _fit(spark, sf_dir))
    train.load_model(spark, cfg)
    return train.read_leaderboard(spark, cfg)


def ml_runs(spark, sf_dir):
    cfg = LakeConfig(shared_folder(spark, "ml_runs"))
    train.log_runs(spark, cfg, _fit(spark, sf_dir))
    runs = read_table(spark, cfg.table("model_runs"))
    return runs.select("model_name", "target", F.array_join("features", ",").alias("features"),
                       F.map_entries("metrics").alias("metrics"))


def score_new_rows(spark, sf_dir):
    """Rows there at the start are passed over; those of the second half arrive later and are scored."""
    cfg = LakeConfig(shared_folder(spark, "score_new_rows"))
    dealt = fact_rows(_silver(spark, sf_dir)).withColumn("half", event_bucket(2))
    rows = read_table(spark, _stored(dealt, f"{cfg.root}/rows"))  # the feed is parsed once, a row's half told once
    # a date is written by few tasks, not by each, so that the scorer has few files to list and open
    halves = [rows.filter(F.col("half") == i).drop("half").hint("rebalance", "event_date") for i in (0, 1)]
    train.save(spark, cfg, _fit(spark, sf_dir, ["Linear Regression"], rows.drop("ingested_at", "half")))
    halves[0].write.partitionBy("event_date").parquet(cfg.table("fact"))
    score.skip_existing(spark, cfg)
    halves[1].write.mode("append").partitionBy("event_date").parquet(cfg.table("fact"))
    run_to_end([lambda: score.start_scoring(spark, cfg, ALL_AVAILABLE)])
    predictions = score.read_predictions(spark, cfg)
    error = round_half_even(F.col("speed_int") - F.col("predicted_speed"))
    return predictions.select(
        "vehicle_id", "road_id", "city_zone", "weather", "event_ts", "traffic_volume_int", "congestion_level_int",
        "speed_int", (F.col("prediction_error") == error).alias("error_fits"),
    )


def registered() -> dict[str, Query]:
    of_fact = {
        "speed_by_congestion": reports.speed_by_congestion,
        "speed_by_zone": reports.speed_by_zone,
        "incidents_by_zone": reports.incidents_by_zone,
        "dash_speed_drop": reports.speed_drop,
        "dash_slow_zones": reports.slow_zones,
        "record_key": lambda fact: with_record_key(fact).select("vehicle_id", "event_ts", "record_key"),
    }
    found: dict[str, Query] = {
        "bronze_parse": _with_gaps(bronze_parse),
        "bronze_stream": _with_gaps(bronze_stream),
        "encode_roundtrip": encode_roundtrip,
        "publish_stream": publish_stream,
        "silver_typed": _with_gaps(silver_typed),
        "dq_flags": _with_gaps(dq_flags),
        "dq_reasons": dq_reasons,
        "silver_clean": silver_clean,
        "silver_rejected": _with_gaps(silver_rejected),
        "rejected_stream": _with_gaps(rejected_stream),
        "silver_rejected_split": silver_rejected_split,
        "rejected_recovered": _with_gaps(rejected_recovered),
        "bronze_drift": bronze_drift,
        "silver_dedup": silver_dedup,
        "silver_features": silver_features,
        "silver_stream": silver_stream,
        "late_drop_audit": late_drop_audit,
        "late_rows_routed": late_rows_routed,
        "gold_fact": gold_fact,
        "fact_batch": fact_batch,
        "gold_fact_stream": gold_fact_stream,
        **{name: _dimension(name) for name in ("dim_zone", "dim_road", "dim_weather")},
        **{f"{name}_stream": _dimension_stream(name) for name in ("dim_zone", "dim_road", "dim_weather")},
        "zone_hourly": lambda spark, sf_dir: zone_hourly(_silver(spark, sf_dir)),
        "road_hourly": lambda spark, sf_dir: road_hourly(_silver(spark, sf_dir)),
        "zone_hourly_stream": _hourly_stream("zone_hourly"),
        "road_hourly_stream": _hourly_stream("road_hourly"),
        "zone_hourly_complete": _hourly_stream("zone_hourly", "complete"),
        "zone_hourly_final": zone_hourly_final,
        "dedup_window_chain": dedup_window_chain,
        "rejected_summary": lambda spark, sf_dir: reports.rejected_summary(silver_rejected(spark, sf_dir)),
        "profile_tables": profile_tables,
        **{name: _of_fact(report) for name, report in of_fact.items()},
        "top_zone_windows": lambda spark, sf_dir: reports.top_zone_windows(zone_hourly(_silver(spark, sf_dir))),
        "top_road_windows": lambda spark, sf_dir: reports.top_road_windows(road_hourly(_silver(spark, sf_dir))),
        "dash_zone_risk": _with_dimension(reports.zone_risk, "dim_zone"),
        "dash_weather_impact": _with_dimension(reports.weather_impact, "dim_weather"),
        "ml_training_set": _training,
        "ml_split": ml_split,
        "ml_features": ml_features,
        "prediction_error": prediction_error,
        "regression_metrics": regression_metrics,
        "unscored_rows": unscored_rows,
        "ml_linear": _model_scores("Linear Regression"),
        "ml_linear_fit": ml_linear_fit,
        "ml_decision_tree_fit": ml_decision_tree_fit,
        "ml_random_forest_fit": ml_random_forest_fit,
        "ml_gbt_fit": ml_gbt_fit,
        "ml_decision_tree": _model_scores("Decision Tree"),
        "ml_random_forest": _model_scores("Random Forest"),
        "ml_gbt": _model_scores("Gradient Boosting"),
        "ml_boosting_step": ml_boosting_step,
        "ml_leaderboard": ml_leaderboard,
        "ml_runs_verified": ml_runs_verified,
        "ml_runs": ml_runs,
        "score_new_rows": score_new_rows,
    }
    return {name: _in_utc(query) for name, query in found.items()}


def _in_utc(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return _wall_clock(query(spark, sf_dir))

    return run
