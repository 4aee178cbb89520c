"""Models, metrics and their weighted shortcuts."""

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressionModel, RandomForestRegressionModel
from pyspark.sql import functions as F

from pavelake.checks.queries import _fact
from pavelake.operators import regression
from pavelake.operators.ensembles import poisson
from pavelake.plans import train
from pavelake.session import use_checkpoints

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    use_checkpoints(spark)
    return regression.labelled(regression.with_split(regression.training_rows(_fact(spark, SF_DIR)))).cache()


@pytest.fixture(scope="module")
def framed(rows):
    features = regression.feature_pipeline().fit(rows)
    return features.transform(rows).cache()


@pytest.fixture(scope="module")
def collapsed(spark, rows):
    # Coarser volumes, so that equal rows exist even in a small table.
    coarse = rows.withColumn("traffic_volume_int", F.lit(100)).withColumn("hour", F.lit(8))
    features = regression.feature_pipeline().fit(coarse)
    small = features.transform(regression.labelled(regression.collapse(coarse)))
    return features.transform(coarse).cache(), small.cache()


def test_split_does_not_depend_on_partitioning(rows):
    def train_keys(df):
        return {(r.vehicle_id, r.event_ts) for r in df.filter("is_train").collect()}

    again = regression.with_split(rows.drop("bucket", "is_train").repartition(7))
    assert train_keys(rows) == train_keys(again)
    assert 0.7 < rows.filter("is_train").count() / rows.count() < 0.9


def test_unseen_category_is_a_zero_block(rows):
    model = regression.feature_pipeline().fit(rows)
    odd = rows.limit(1).withColumn("road_id", F.lit("R999")).withColumn("weather", F.lit(None).cast("string"))
    vector = model.transform(odd).select(vector_to_array("features")).first()[0]
    sizes = [rows.select(c).distinct().count() for c in regression.CATEGORICAL]
    ends = np.cumsum(sizes)
    blocks = [vector[end - size:end] for size, end in zip(sizes, ends)]
    assert sum(blocks[0]) == 0 and sum(blocks[2]) == 0 and sum(blocks[1]) == 1 and sum(blocks[3]) == 1
    assert len(vector) == ends[-1] + len(regression.NUMERIC)


def test_linear_regression_is_least_squares(framed):
    model = regression.regressors()["Linear Regression"].fit(framed)
    pdf = model.transform(framed).select(
        vector_to_array("features").alias("x"), "label", "prediction").toPandas()
    x = np.column_stack([np.stack(pdf.x), np.ones(len(pdf))])
    best = x @ np.linalg.lstsq(x, pdf.label.to_numpy(), rcond=None)[0]
    assert np.abs(best - pdf.prediction).max() < 0.05


@pytest.mark.parametrize("name", ["Linear Regression", "Decision Tree", "Gradient Boosting"])
def test_weighted_fit_equals_fit_on_all_rows(collapsed, name):
    every, small = collapsed
    assert small.count() < every.count()
    assert small.agg(F.sum(regression.WEIGHT)).first()[0] == every.count()
    model = regression.regressors(boosting_rounds=5)[name]
    by_weight = model.copy({model.weightCol: regression.WEIGHT}).fit(small)
    by_row = model.fit(every)
    a = by_row.transform(every).withColumnRenamed("prediction", "p1")
    both = by_weight.transform(a)
    assert both.agg(F.max(F.abs(F.col("p1") - F.col("prediction")))).first()[0] < 1e-2


def test_metrics_equal_the_evaluator(framed):
    scored = framed.withColumn("prediction", 70 - 10 * F.col("congestion_level_int") + F.lit(0.25))
    ours = regression.regression_metrics(scored).first()
    for metric in ("r2", "rmse", "mae"):
        assert ours[metric] == pytest.approx(RegressionEvaluator(metricName=metric).evaluate(scored), abs=1e-9)


def test_weighted_metrics_equal_metrics_on_all_rows(collapsed):
    every, small = (df.withColumn("prediction", F.col("congestion_level_int") * 8.0) for df in collapsed)
    a = regression.regression_metrics(every, ["is_train"]).orderBy("is_train").collect()
    b = regression.regression_metrics(small, ["is_train"], weight=F.col(regression.WEIGHT)).orderBy("is_train")
    assert [pytest.approx(tuple(r)) for r in a] == [tuple(r) for r in b.collect()]


def test_metrics_of_a_constant_label(spark):
    df = spark.createDataFrame([(5.0, 5.0), (5.0, 5.0)], "label double, prediction double")
    assert regression.regression_metrics(df).first().r2 == 1.0
    assert regression.regression_metrics(df.withColumn("prediction", F.lit(1.0))).first().r2 == 0.0


def test_first_of_equal_models_wins(rows):
    linear = regression.regressors()["Linear Regression"]
    training = train.fit_all(rows.drop("bucket", "is_train", "label"), {"first": linear, "second": linear})
    assert training.best_name == "first"


def test_unscored_keeps_copies(spark):
    fact = spark.createDataFrame([("a", 1), ("b", 1), ("b", 1)], "vehicle_id string, event_ts int")
    done = spark.createDataFrame([("a", 1), ("a", 1)], "vehicle_id string, event_ts int")
    assert [r.vehicle_id for r in regression.unscored(fact, done).collect()] == ["b", "b"]


def test_models_carry_the_published_parameters():
    models = regression.regressors()
    assert list(models) == ["Linear Regression", "Decision Tree", "Random Forest", "Gradient Boosting"]
    assert models["Linear Regression"].getRegParam() == 0.0
    assert models["Decision Tree"].getMaxDepth() == 8
    assert (models["Random Forest"].trees, models["Random Forest"].tree.getMaxDepth()) == (200, 12)
    boosted = models["Gradient Boosting"]
    assert (boosted.getMaxIter(), boosted.getStepSize(), boosted.tree.getMaxDepth()) == (200, 0.05, 3)


def test_bins_cover_every_valid_value():
    assert regression.bins_for() > 1001


def test_multiplicities_are_poisson_numbers(spark):
    """Mean, variance, share of zeros and tail of the numbers drawn, for small and for large counts; the same each time."""
    for mean in (1.0, 3.0, 49.0, 51.0, 5_000.0):
        draws = spark.range(40_000).select(poisson(F.lit(mean), F.col("id"), F.lit(7)).alias("k"))
        got = draws.agg(F.avg("k").alias("m"), F.var_samp("k").alias("v"), F.avg((F.col("k") == 0).cast("double")).alias("zero"),
                        F.skewness("k").alias("skew"), F.min("k").alias("low")).first()
        assert abs(got.m - mean) < 5 * (mean / 40_000) ** 0.5 and abs(got.v / mean - 1) < 0.05
        assert abs(got.zero - np.exp(-mean)) < 0.012 and abs(got.skew - mean ** -0.5) < 0.08 and got.low >= 0
        assert draws.exceptAll(spark.range(40_000).select(poisson(F.lit(mean), F.col("id"), F.lit(7)).alias("k"))).isEmpty()
    two = spark.range(20_000).select(poisson(F.lit(1.0), F.col("id"), F.lit(1)).alias("a"), poisson(F.lit(1.0), F.col("id"), F.lit(2)).alias("b"))
    assert abs(two.corr("a", "b")) < 0.03  # trees draw their own


def test_forest_is_the_mean_of_trees_and_is_saved_as_any_model(spark, framed, tmp_path):
    rows = framed.withColumn("row_id", F.xxhash64(*regression.FEATURES, "label", "vehicle_id"))
    model = regression.regressors(forest_trees=7)["Random Forest"].fit(rows)
    assert model.getNumTrees == 7 and len({t.toDebugString for t in model.trees}) == 7
    mean = sum(t.transform(rows).agg(F.avg("prediction")).first()[0] for t in model.trees) / 7
    assert model.transform(rows).agg(F.avg("prediction")).first()[0] == pytest.approx(mean)
    model.save(str(tmp_path / "forest"))
    again = RandomForestRegressionModel.load(str(tmp_path / "forest"))
    a, b = (m.transform(rows).select("vehicle_id", "event_ts", "prediction") for m in (model, again))
    assert a.exceptAll(b).isEmpty()


def test_a_row_with_a_large_count_weighs_as_many_rows(spark):
    """A leaf is drawn to the label that is there 10,000 times, whichever tree."""
    rows = spark.createDataFrame([(Vectors.dense(0.0), 10.0, 10_000.0, 1), (Vectors.dense(0.0), 20.0, 1.0, 2), (Vectors.dense(1.0), 5.0, 3.0, 3)],
                                 ["features", "label", "row_weight", "row_id"])
    forest = regression.regressors(forest_trees=5)["Random Forest"]
    model = forest.copy({forest.weightCol: "row_weight"}).fit(rows)
    assert model.predict(Vectors.dense(0.0)) == pytest.approx(10.0, abs=0.02)


def by_force(x, y, w, rounds, step, depth):
    """Boosting from the mean with exact splits, plainly."""
    def grow(rows, left, level):
        mean = np.average(left[rows], weights=w[rows])
        best = None
        for f in range(x.shape[1]) if level else ():
            for t in np.unique(x[rows, f])[:-1]:
                low = rows[x[rows, f] <= t]
                high = rows[x[rows, f] > t]
                gain = sum(np.average(left[s], weights=w[s]) ** 2 * w[s].sum() for s in (low, high)) - mean ** 2 * w[rows].sum()
                if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                    best = (gain, low, high)
        if best is None:
            return [(rows, mean)]
        return grow(best[1], left, level - 1) + grow(best[2], left, level - 1)

    told = np.full(len(y), np.average(y, weights=w))
    for _ in range(rounds):
        for rows, value in grow(np.arange(len(y)), y - told, depth):
            told[rows] += step * value
    return told


def test_boosting_starts_from_the_mean_and_shrinks_every_tree(spark, tmp_path):
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.integers(0, 9, 60), rng.integers(0, 5, 60), rng.integers(0, 2, 60)]).astype(float)
    y, w = rng.normal(50, 20, 60).round(3), rng.integers(1, 6, 60).astype(float)
    rows = spark.createDataFrame([(i, Vectors.dense(x[i]), float(y[i]), float(w[i])) for i in range(60)], ["id", "features", "label", "row_weight"])
    for rounds in (0, 1, 3, 12):
        model = regression.regressors(boosting_rounds=rounds)["Gradient Boosting"]
        fitted = model.copy({model.weightCol: "row_weight"}).fit(rows)
        got = {r.id: r.prediction for r in fitted.transform(rows).collect()}
        want = by_force(x, y, w, rounds, 0.05, 3)
        assert max(abs(got[i] - want[i]) for i in range(60)) < 1e-8
    fitted.save(str(tmp_path / "boosted"))
    again = GBTRegressionModel.load(str(tmp_path / "boosted"))
    assert again.treeWeights == [1.0] + [0.05] * 12 and {r.id: r.prediction for r in again.transform(rows).collect()} == got


def test_no_fit_holds_a_frame_that_grows_with_the_fact_table(spark, rows):
    """Ten copies of every row reach the trees as rows with ten times the weight."""
    from pavelake.operators import ensembles

    plain, seen = rows.drop("bucket", "is_train", "label"), []
    for copies in (1, 10):
        many = plain.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("k")
        small = regression.collapse(regression.labelled(regression.with_split(regression.training_rows(many))), "label")
        seen.append((small.count(), small.agg(F.sum(regression.WEIGHT)).first()[0] / copies, small.select(ensembles.ROW_ID).distinct().count()))
    assert seen[0] == seen[1] and seen[0][0] == seen[0][2]


def test_numbers_drawn_for_the_forest_are_those_of_the_column(spark):
    from pavelake.operators.ensembles import poisson_numbers, uniform

    for mean in (0.5, 1.0, 49.0, 51.0, 5_000.0):
        key = (F.col("id"), F.lit(7))
        got = spark.range(5_000).select(poisson(F.lit(mean), *key).alias("k"), *[uniform(*key, F.lit(x)).alias(x) for x in "uv"]).toPandas()
        numbers = poisson_numbers(np.full(5_000, mean), got.u.to_numpy()[:, None], got.v.to_numpy()[:, None])
        assert (numbers[:, 0] == got.k.to_numpy()).mean() > 0.999  # logarithms and cosines may differ in the last bit


def counted_jobs(spark, group, work):
    """Runs the work and counts its Spark jobs."""
    spark.sparkContext.setJobGroup(group, group)
    try:
        return work(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_forest_takes_no_job_for_every_tree(spark, framed):
    """All trees grow together: ten times the trees are as many jobs, and the first trees are the same ones."""
    rows = framed.withColumn("row_id", F.xxhash64(*regression.FEATURES, "label", "vehicle_id"))
    (few, jobs), (many, more) = (
        counted_jobs(spark, f"forest of {n}", lambda n=n: regression.regressors(forest_trees=n)["Random Forest"].fit(rows)) for n in (3, 30))
    assert 0 < more < jobs + 6
    assert [t.toDebugString.split("\n", 1)[1] for t in few.trees] == [t.toDebugString.split("\n", 1)[1] for t in many.trees[:3]]


def test_large_nodes_split_by_all_tasks_give_the_same_trees(spark, framed):
    rows = framed.withColumn("row_id", F.xxhash64(*regression.FEATURES, "label", "vehicle_id"))
    found = []
    for node_rows in (10_000, 20):
        forest = regression.regressors(forest_trees=4)["Random Forest"]
        forest.node_rows = node_rows
        found.append([t.toDebugString.split("\n", 1)[1] for t in forest.fit(rows).trees])
    assert found[0] == found[1]


def test_a_round_of_boosting_is_a_job_a_level(spark, framed):
    """Depth 3, so three jobs a round, and one now and then to store what is left."""
    (_, jobs), (_, more) = (
        counted_jobs(spark, f"{n} rounds", lambda n=n: regression.regressors(boosting_rounds=n)["Gradient Boosting"].fit(framed)) for n in (1, 21))
    assert 0 < more - jobs <= 3 * 20 + 2 + 4


def test_a_forest_is_applied_in_arrays_as_it_transforms(spark, framed, tmp_path):
    """Every prediction is that of Spark's own walk, to the last bit, of a fresh model and of one that was stored; Python, not Java, walks."""
    from pavelake.operators.ensembles import applied

    rows = framed.withColumn("row_id", F.xxhash64(*regression.FEATURES, "label", "vehicle_id"))
    model = regression.regressors(forest_trees=9)["Random Forest"].fit(rows)
    model.save(str(tmp_path / "forest"))
    edge = [t for tree in model.trees for t in [tree.toDebugString] if "<=" in t]  # values at a threshold go left
    cuts = sorted({float(line.split("<=")[1].rstrip(")").strip()) for text in edge for line in text.splitlines() if "<=" in line})
    odd = spark.createDataFrame([(Vectors.dense([x] * model.numFeatures),) for x in [*cuts, -1.0, 1e9, float("nan")]], ["features"])
    for found in (model, RandomForestRegressionModel.load(str(tmp_path / "forest"))):
        for some in (rows, odd, odd.limit(0)):
            mine, theirs = applied(found, some), found.transform(some)
            assert mine.columns == theirs.columns and mine.exceptAll(theirs).isEmpty() and theirs.exceptAll(mine).isEmpty()
        assert "ArrowEvalPython" in applied(found, rows)._jdf.queryExecution().executedPlan().toString()


def test_uniform_numbers_in_arrays_are_those_of_the_column(spark):
    from pavelake.operators.ensembles import uniform, uniform_numbers

    ids = spark.range(-2_000, 2_000).select((F.col("id") * 4_611_000_018_427_387).alias("row_id"))
    columns = [F.array(*[uniform(F.col("row_id"), F.lit(tree), F.lit(x)) for tree in range(5)]).alias(x) for x in "uv"]
    got = ids.select(F.xxhash64("row_id").alias("seed"), *columns).toPandas()
    for letter in "uv":
        assert (uniform_numbers(got.seed.to_numpy(), 5, letter) == np.stack(got[letter])).all()


def test_patterns_of_two_bins_count_as_each_feature_does():
    from pavelake.operators.ensembles import histogram, packed

    rng = np.random.default_rng(5)
    sizes = [1, 2, 3, 2, *[2] * 17, 40, 1]
    starts = np.concatenate([[0], np.cumsum(sizes)])
    codes = np.stack([rng.integers(0, n, 900) for n in sizes]).astype(np.uint8)
    node, weights = rng.integers(0, 6, 900), [rng.integers(1, 9, 900).astype(float), None]
    columns, read = packed(codes, starts)
    assert len(columns) == 1 + 2 + 3  # the first, two wide ones, 19 of two bins
    got = histogram(columns, read, node, 6, starts, weights)
    for f, n in enumerate(sizes[:-1]):
        for i, w in enumerate(weights):
            want = np.bincount(node * n + codes[f], w, 6 * n).reshape(6, n)
            assert (got[i, :, starts[f]:starts[f + 1]] == want).all()


def test_boosting_in_one_task_is_boosting_by_all(spark, framed, monkeypatch):
    """Few rows are taken by one task, ten rounds a job; more rows are counted by all. The trees are the same."""
    from pavelake.operators import ensembles

    found = []
    for most in (ensembles.ALONE_ROWS, 0):
        monkeypatch.setattr(ensembles, "ALONE_ROWS", most)
        model, jobs = counted_jobs(spark, f"alone up to {most}", lambda: regression.regressors(boosting_rounds=13)["Gradient Boosting"].fit(framed))
        found.append((jobs, model.transform(framed).select("vehicle_id", "event_ts", F.round("prediction", 6)).collect()))
    assert found[0][0] < found[1][0] - 25
    assert sorted(found[0][1]) == sorted(found[1][1])


def test_collapsed_rows_of_many_partitions_are_few_tasks(spark, rows):
    """A small table is not fitted by a task for every shuffle partition."""
    from pavelake.session import setting

    seen = []

    class Seen(type(regression.regressors()["Linear Regression"])):
        def fit(self, frame, params=None):
            seen.append(frame.rdd.getNumPartitions())
            return super().fit(frame, params)

    plain = rows.drop("bucket", "is_train", "label")
    with setting(spark, "spark.sql.shuffle.partitions", "64"):
        train.fit_all(plain, {"seen": Seen(labelCol="label", tol=1e-12, maxIter=1000)})
    assert seen and seen[0] <= max(1, spark.sparkContext.defaultParallelism)


def test_a_stored_pipeline_takes_its_nodes_from_the_table(spark, rows, tmp_path):
    """Tasks copy the nodes; what is stored is what Spark itself would have stored, parameters included."""
    from pyspark.ml import PipelineModel

    from pavelake.operators.ensembles import applied, load_pipeline, save_pipeline

    plain = rows.drop("bucket", "is_train", "label")
    for name, few in (("Random Forest", regression.regressors(forest_trees=5)), ("Gradient Boosting", regression.regressors(boosting_rounds=3))):
        model = train.fit_all(plain, {name: few[name]}).best
        model.stages[-1].setPredictionCol("told")
        save_pipeline(spark, model, str(tmp_path / f"mine {name}"))
        model.write().save(str(tmp_path / f"theirs {name}"))
        mine, theirs = (PipelineModel.load(str(tmp_path / f"{who} {name}")) for who in ("mine", "theirs"))
        assert mine.stages[-1].toDebugString == theirs.stages[-1].toDebugString
        assert mine.stages[-1].extractParamMap() == theirs.stages[-1].extractParamMap()
        want = theirs.transform(rows).select("vehicle_id", "event_ts", "told")
        got = applied(load_pipeline(str(tmp_path / f"mine {name}")), rows).select("vehicle_id", "event_ts", "told")
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
