"""Forest and boosting on collapsed rows: one row with a weight for all rows that are equal in features and label.

Both grow their trees from histograms: every partition counts weight and label by node, feature and bin, the counts are
added up, and the best threshold is read off them. A pass serves all trees that can grow side by side, so a forest takes
as many passes as a tree has levels of large nodes, and not a number of fits. Nothing is held that grows with the fact
table, and both give Spark's own model classes, which are saved, loaded and applied like any other.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasMaxIter, HasStepSize, HasWeightCol
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor, GBTRegressionModel, RandomForestRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pavelake.session import shared_folder

ROW_ID = "row_id"
LARGE = 50  # mean from which on a Poisson number is drawn from the normal curve, corrected for its skew
PARTITION_ROWS = 25_000  # most rows of a partition that histograms are taken of
TREES_ROWS = 2_000  # rows that are worth a partition of their own in a pass for all trees of a forest
ROUND_ROWS = 10_000  # the same in a pass for one tree, which takes little more than its start
NODE_ROWS = 100_000  # most rows of a node whose subtree is grown in one task; larger nodes are split by all tasks
ADDED_ROWS = 500_000  # rows of small nodes that one task gets at most, on average
ALONE_ROWS = 200_000  # most rows of boosting that one task grows its trees from, many in a job
DRAWN_ROWS = 1_000  # rows whose draws for all trees are made at once, to stay in the processor's cache
CUT_EVERY = 10  # rounds of boosting after which what is left is stored anew

NODES = ("treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, "
         "rawCount: bigint, gain: double, leftChild: int, rightChild: int, "
         "split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>")


def uniform(*key: Column) -> Column:
    """A number between 0 and 1, the same for the same key."""
    return (F.pmod(F.xxhash64(*key), F.lit(1 << 53)) + 0.5) / float(1 << 53)


def poisson(mean: Column, *key: Column) -> Column:
    """A Poisson number of that mean, the same for the same key.

    Small ones are found by summing the distribution up to a uniform number; of large ones the quantile is taken from
    the normal curve with the first correction for skewness, whose error is far below one.
    """
    u = uniform(*key, F.lit("u"))
    steps = F.sequence(F.lit(1), (mean + 8 * F.sqrt(mean) + 16).cast("int"))
    start = F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("sum"), F.lit(0).cast("long").alias("k"))

    def step(a: Column, i: Column) -> Column:
        p = a["p"] * mean / i
        return F.struct(p.alias("p"), (a["sum"] + p).alias("sum"), (a["k"] + (u > a["sum"]).cast("long")).alias("k"))

    z = F.sqrt(-2 * F.log(u)) * F.cos(2 * math.pi * uniform(*key, F.lit("v")))
    large = F.greatest(F.floor(mean + F.sqrt(mean) * z + (z * z - 1) / 6 + 0.5), F.lit(0).cast("long"))
    return F.when(mean > LARGE, large).otherwise(F.aggregate(F.when(mean <= LARGE, steps), start, step, lambda a: a["k"]))


def poisson_numbers(mean: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """What ``poisson`` gives, for rows of uniform numbers with the mean of each row; ``v`` is read for large means only."""
    k, large = np.zeros(u.shape, int), mean > LARGE
    for m in np.unique(mean[~large]):
        p, sums = np.exp(-m), [np.exp(-m)]
        for i in range(1, int(m + 8 * np.sqrt(m) + 16)):
            p = p * m / i
            sums.append(sums[-1] + p)
        rows = np.flatnonzero(mean == m)
        k[rows] = np.searchsorted(sums, u[rows])
    m = mean[large, None]
    z = np.sqrt(-2 * np.log(u[large])) * np.cos(2 * math.pi * v[large])
    k[large] = np.maximum(np.floor(m + np.sqrt(m) * z + (z * z - 1) / 6 + 0.5), 0)
    return k


def uniform_numbers(seed: np.ndarray, trees: int, letter: str) -> np.ndarray:
    """What ``uniform(row id, tree, letter)`` gives, by row and tree, from the XXH64 of the row id; the hash goes on from there."""
    p1, p2, p3, p5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))

    def rolled(h: np.ndarray, bits: int) -> np.ndarray:
        return (h << np.uint64(bits)) | (h >> np.uint64(64 - bits))

    def mixed(h: np.ndarray) -> np.ndarray:
        h = (h ^ (h >> np.uint64(33))) * p2
        h = (h ^ (h >> np.uint64(29))) * p3
        return h ^ (h >> np.uint64(32))

    h = (seed.view(np.uint64)[:, None] + (p5 + np.uint64(4))) ^ (np.arange(trees, dtype=np.uint64) * p1)
    h = mixed(rolled(h, 23) * p2 + p3)
    h = (h + (p5 + np.uint64(1))) ^ np.uint64(ord(letter) * int(p5) % 2**64)
    h = mixed(rolled(h, 11) * p1)
    return ((h & np.uint64((1 << 53) - 1)).astype(float) + 0.5) / float(1 << 53)


def drawn(batch: pa.RecordBatch, trees: int) -> np.ndarray:
    """How often each row is taken, by tree."""
    mean, seed = (batch[name].to_numpy(zero_copy_only=False) for name in ("count", "seed"))
    out = []
    for i in range(0, max(len(mean), 1), DRAWN_ROWS):
        m, s = mean[i:i + DRAWN_ROWS], seed[i:i + DRAWN_ROWS]
        u, v, large = uniform_numbers(s, trees, "u"), np.zeros((len(m), trees)), m > LARGE
        v[large] = uniform_numbers(s[large], trees, "v")
        k = poisson_numbers(m, u, v)
        out.append(k.astype(np.min_scalar_type(int(k.max(initial=0)))))
    return np.concatenate(out).T.astype(int)


def thresholds(rows: DataFrame, features: str, max_bins: int) -> list[np.ndarray]:
    """Per feature the numbers between its values; of a feature with more values than bins, quantiles."""
    def distinct_values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
            for f in range(x.shape[1]):
                values = np.unique(x[:, f])
                yield pa.record_batch({"feature": np.full(len(values), f, np.int32), "value": values})

    arrays = rows.select(vector_to_array(features).alias("x"))
    distinct = arrays.mapInArrow(distinct_values, "feature int, value double").distinct().persist()
    try:
        counts = dict(distinct.groupBy("feature").count().collect())
        wide = [f for f, n in counts.items() if n > max_bins]
        few = distinct.where(~F.col("feature").isin(wide)) if wide else distinct
        found = {r.feature: np.sort(r.values) for r in few.groupBy("feature").agg(F.collect_list("value").alias("values")).collect()}
    finally:
        distinct.unpersist()
    edges = {f: (v[1:] + v[:-1]) / 2 for f, v in found.items()}
    if wide:
        shares = [i / max_bins for i in range(1, max_bins)]
        values = arrays.select(F.posexplode("x").alias("feature", "value"))
        cut = values.where(F.col("feature").isin(wide)).groupBy("feature").agg(
            F.percentile_approx("value", shares, 10 * max_bins).alias("cuts"))
        edges |= {r.feature: np.unique(r.cuts) for r in cut.collect()}
    return [edges[f] for f in range(len(counts))]


class Binned:
    """Rows as one block of arrays per partition: bins by feature, label, and whatever else is named, kept in memory."""

    def __init__(self, rows: DataFrame, features: str, max_bins: int, label: Column, more: dict[str, Column],
                 read: Callable[[pa.RecordBatch], np.ndarray], worth: int):
        count, cores = rows.count(), rows.sparkSession.sparkContext.defaultParallelism
        if not count:
            raise ValueError("no rows to learn from")
        self.rows, self.partitions = count, max(1 + count // PARTITION_ROWS, min(cores, 1 + count // worth))
        self.edges = edges = thresholds(rows.coalesce(max(self.partitions, cores)), features, max_bins)
        self.starts = np.concatenate([[0], np.cumsum([len(e) + 1 for e in edges])])
        kind = np.min_scalar_type(max((len(e) for e in edges), default=0))

        def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
                codes = np.stack([np.searchsorted(e, x[:, f]).astype(kind) for f, e in enumerate(edges)]) if len(batch) else x.T.astype(kind)
                more = read(batch)
                more = more.astype(np.min_scalar_type(int(more.max(initial=0)))) if more.dtype.kind == "i" else more
                yield pa.record_batch({"codes": [codes.tobytes()], "more": [more.tobytes()], "kind": [more.dtype.str],
                                       "y": [batch["y"].to_numpy(zero_copy_only=False).tobytes()]})

        def joined(parts: Iterator) -> Iterator[tuple]:
            parts = [(np.frombuffer(r.codes, kind).reshape(len(edges), -1), np.frombuffer(r.y), np.frombuffer(r.more, r.kind)) for r in parts]
            parts = [(codes, y, more.reshape(-1, len(y))) for codes, y, more in parts if len(y)]
            if parts:
                codes, y, more = zip(*parts)
                yield np.concatenate(codes, 1), np.concatenate(y), np.concatenate(more, 1)

        dealt = rows.repartition(self.partitions)  # before anything is computed, so that all tasks take part in it
        columns = dealt.select(vector_to_array(features).alias("x"), label.cast("double").alias("y"), *[c.alias(name) for name, c in more.items()])
        binary = columns.mapInArrow(blocks, "codes binary, more binary, kind string, y binary")
        self.blocks = binary.rdd.mapPartitions(joined).persist(StorageLevel.MEMORY_AND_DISK)


def packed(codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, list[tuple]]:
    """Columns to count by: a feature each, but features of two bins eight to a column, as one number for each pattern of
    bins that occurs. With each column its features, its size and, of a column of patterns, the patterns."""
    sizes = np.diff(starts)
    pairs = np.flatnonzero(sizes == 2)
    columns, read = [], []
    for f in np.flatnonzero((sizes > 2) | ((sizes == 1) & (np.arange(len(sizes)) == 0))):  # the first is wanted for the sums by node
        columns.append(codes[f])
        read.append(([f], int(sizes[f]), None))
    for features in np.split(pairs, range(8, len(pairs), 8)) if len(pairs) else ():
        pattern = np.packbits(codes[features].astype(bool), axis=0, bitorder="little")[0]
        seen = np.flatnonzero(np.bincount(pattern, minlength=256))
        number = np.zeros(256, codes.dtype)
        number[seen] = np.arange(len(seen))
        columns.append(number[pattern])
        read.append((features, max(len(seen), 1), seen))
    return np.stack(columns), read


def histogram(columns: np.ndarray, read: list[tuple], node: np.ndarray, nodes: int, starts: np.ndarray, weights: list) -> np.ndarray:
    """Sums of each weight by node and bin; the bins of all features lie side by side."""
    out = np.zeros((len(weights), nodes, starts[-1]))
    for column, (features, size, seen) in zip(columns, read):
        key = node * size + column
        for i, w in enumerate(weights):
            sums = np.bincount(key, w, nodes * size).reshape(nodes, size)
            if seen is None:
                out[i, :, starts[features[0]]:starts[features[0]] + size] = sums
            elif len(seen):
                for bit, f in enumerate(features):
                    right = (seen >> bit & 1).astype(bool)
                    out[i, :, starts[f]], out[i, :, starts[f] + 1] = sums[:, ~right].sum(1), sums[:, right].sum(1)
    return out


def best_splits(weight: np.ndarray, total: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per node the feature (-1: none) and the last bin on the left that lower the squared error most; the first of equals."""
    w, t = (a[:, :starts[1]].sum(1, keepdims=True) for a in (weight, total))
    feature, bin_, best = np.full(len(w), -1), np.zeros(len(w), int), 1e-20 * (t * t)[:, 0] / w[:, 0]
    for f, (start, end) in enumerate(zip(starts, starts[1:])):
        if end - start < 2:
            continue
        left, left_t = (np.cumsum(a[:, start:end - 1], 1) for a in (weight, total))
        right = w - left
        apart = left_t * w - t * left
        both = (left > 0) & (right > 1e-12 * w)
        gain = np.where(both, apart * apart / np.where(both, left * right * w, 1), 0)
        at = gain.argmax(1)
        top = gain[np.arange(len(at)), at]
        better = top > best
        feature[better], bin_[better], best[better] = f, at[better], top[better]
    return feature, bin_


def subtree(codes: np.ndarray, y: np.ndarray, k: np.ndarray, starts: np.ndarray, depth: int, top: int) -> list[tuple]:
    """All levels below one node, from its rows. Nodes are numbered as in a heap; those of one level are one entry."""
    out, ids, node = [], np.array([top]), np.zeros(len(y), int)
    k = k.astype(float)
    columns, read = packed(codes, starts)
    for level in range(depth + 1):
        sums = np.stack([np.bincount(node, w, len(ids)) for w in (k, k * y, k * y * y, None)], 1)
        feature, bin_ = np.full(len(ids), -1), np.zeros(len(ids), int)
        if level < depth:
            feature, bin_ = best_splits(*histogram(columns, read, node, len(ids), starts, [k, k * y]), starts)
        out.append((ids, feature, bin_, sums))
        split = feature >= 0
        if not split.any():
            break
        rows = np.flatnonzero(split[node])
        if len(rows) < len(node):
            codes, columns, y, k, node = codes[:, rows], columns[:, rows], y[rows], k[rows], node[rows]
        right = codes[feature[node], np.arange(len(node))] > bin_[node]
        node = 2 * (np.cumsum(split) - 1)[node] + right
        ids = np.repeat(2 * ids[split], 2) + np.tile([0, 1], split.sum())
    return out


def descend(codes: np.ndarray, splits: dict[int, tuple[int, int]], depth: int) -> np.ndarray:
    """The node of each row under a tree that is given by its splits."""
    node = np.ones(codes.shape[1], int)
    if not splits:
        return node
    ids = np.array(sorted(splits))
    feature, bin_ = np.array([splits[i] for i in ids]).T
    for _ in range(depth):
        at = np.minimum(np.searchsorted(ids, node), len(ids) - 1)
        rows = np.flatnonzero(ids[at] == node)
        if not len(rows):
            break
        right = codes[feature[at[rows]], rows] > bin_[at[rows]]
        node[rows] = 2 * node[rows] + right
    return node


def node_rows(tree: int, levels: list[tuple], edges: list[np.ndarray]) -> pa.RecordBatch:
    """The nodes of a tree as rows of a stored model, numbered from the root down, left before right."""
    ids, feature, bin_, sums = (np.concatenate(a) for a in zip(*levels))
    order = np.argsort(ids)
    ids, feature, bin_, sums = ids[order], feature[order], bin_[order], sums[order]
    depth = np.frexp(ids)[1] - 1
    number = np.empty(len(ids), int)
    number[np.lexsort((depth, ids << (depth.max() - depth)))] = np.arange(len(ids))
    mean = sums[:, 1] / sums[:, 0]
    impurity = np.maximum(sums[:, 2] / sums[:, 0] - mean * mean, 0.0)
    inner = np.flatnonzero(feature >= 0)
    left, right = (np.searchsorted(ids, 2 * ids[inner] + side) for side in (0, 1))
    below, gain = np.full((2, len(ids)), -1), np.full(len(ids), -1.0)
    below[:, inner] = number[left], number[right]
    gain[inner] = impurity[inner] - (sums[left, 0] * impurity[left] + sums[right, 0] * impurity[right]) / sums[inner, 0]
    cuts = pa.array([edges[f][b] for f, b in zip(feature[inner], bin_[inner])], pa.float64())
    ends = np.concatenate([[0], np.cumsum(feature >= 0)])
    split = pa.StructArray.from_arrays(
        [pa.array(feature, pa.int32()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), cuts), pa.array(np.full(len(ids), -1), pa.int32())],
        ["featureIndex", "leftCategoriesOrThreshold", "numCategories"])
    stats = pa.ListArray.from_arrays(pa.array(np.arange(0, 3 * len(ids) + 1, 3), pa.int32()), pa.array(sums[:, :3].ravel()))
    fields = {
        "id": pa.array(number, pa.int32()), "prediction": pa.array(mean), "impurity": pa.array(impurity), "impurityStats": stats,
        "rawCount": pa.array(sums[:, 3].astype(int)), "gain": pa.array(gain), "leftChild": pa.array(below[0], pa.int32()),
        "rightChild": pa.array(below[1], pa.int32()), "split": split,
    }
    data = pa.StructArray.from_arrays(list(fields.values()), list(fields))
    return pa.record_batch({"treeID": pa.array(np.full(len(ids), tree), pa.int32()), "nodeData": data})


def node_table(spark: SparkSession, trees: RDD, edges: list[np.ndarray]) -> DataFrame:
    """The nodes of numbered trees, given by their levels, as Spark stores them."""
    packed = spark.createDataFrame(trees.map(lambda t: (t[0], pickle.dumps(t[1]))), "tree int, levels binary", verifySchema=False)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tree, levels in zip(batch["tree"].to_pylist(), batch["levels"].to_pylist()):
                yield node_rows(tree, pickle.loads(levels), edges)

    return packed.mapInArrow(rows, NODES)


def stored_model(spark: SparkSession, kind: type, uid: str, trees: list[float], features: int, nodes: DataFrame):
    """A model of trees with these weights, read from its nodes: Spark writes a model of as many leaves, whose nodes are
    replaced before it is read back."""
    row = spark.createDataFrame([(Vectors.sparse(features, []), 0.0)], ["features", "label"])
    leaf = DecisionTreeRegressor(maxDepth=0).fit(row)  # held: Java lets go of its tree with it
    gateway, classes = spark.sparkContext._gateway, spark._jvm.org.apache.spark.ml.regression
    leaves, weights = gateway.new_array(classes.DecisionTreeRegressionModel, len(trees)), gateway.new_array(spark._jvm.double, len(trees))
    for i, weight in enumerate(trees):
        leaves[i], weights[i] = leaf._java_obj, weight
    more = [weights] if kind is GBTRegressionModel else []
    model = getattr(classes, kind.__name__)(uid, leaves, *more, features)
    if kind is RandomForestRegressionModel:
        model.set(model.getParam("numTrees"), len(trees))
    path = shared_folder(spark, "trees")
    model.write().overwrite().save(path)
    nodes.write.mode("overwrite").parquet(f"{path}/data")
    leaves = kind(model)
    model = kind.load(path)
    model.stored_nodes, model.leaves = f"{path}/data", leaves
    return model


def nodes_folder(model: PipelineModel, path: str) -> str:
    """Where a stored pipeline has the nodes of its last stage."""
    stages = len(model.stages)
    return f"{path}/stages/{stages - 1:0{len(str(stages))}d}_{model.stages[-1].uid}/data"


def save_pipeline(spark: SparkSession, model: PipelineModel, path: str) -> None:
    """``model.write().save``, but nodes that lie in a table are copied by tasks: Java would write them from the driver."""
    last = model.stages[-1]
    if not hasattr(last, "leaves"):
        return model.write().save(path)
    last._transfer_params_to_java()  # some may have been set since
    leaves = type(last)(last.leaves._java_obj.copy(last._java_obj.extractParamMap()))
    leaves._transfer_params_from_java()
    PipelineModel(stages=[*model.stages[:-1], leaves]).write().save(path)
    spark.read.parquet(last.stored_nodes).write.mode("overwrite").parquet(nodes_folder(model, path))


def load_pipeline(path: str) -> PipelineModel:
    model = PipelineModel.load(path)
    if isinstance(model.stages[-1], RandomForestRegressionModel):
        model.stages[-1].stored_nodes = nodes_folder(model, path)
    return model


def applied(model: Transformer, rows: DataFrame) -> DataFrame:
    """What ``model.transform`` gives, for a model or a pipeline of stages. A forest is walked in arrays, all rows of a batch
    a level at a time: row by row, hundreds of large trees fit no cache."""
    for stage in model.stages if isinstance(model, PipelineModel) else [model]:
        told = forest_told(rows.sparkSession, stage) if isinstance(stage, RandomForestRegressionModel) else None
        rows = rows.withColumn(stage.getPredictionCol(), told(vector_to_array(stage.getFeaturesCol()))) if told else stage.transform(rows)
    return rows


def forest_told(spark: SparkSession, model: RandomForestRegressionModel) -> Callable[[Column], Column] | None:
    """A function from the features, as an array, to what the forest predicts; None if it has more than thresholds and means."""
    if model.getLeafCol():
        return None
    if not hasattr(model, "walked"):
        if not hasattr(model, "stored_nodes"):
            path = shared_folder(spark, "trees")
            model.write().overwrite().save(path)
            model.stored_nodes = f"{path}/data"
        walked = walkable(spark.read.parquet(model.stored_nodes), model.numFeatures)
        model.walked = spark.sparkContext.broadcast(walked) if walked else None
    shared = model.walked
    if shared is None:
        return None

    @F.arrow_udf("double")
    def told(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        cuts, trees = shared.value
        for x in batches:
            yield pa.array(walk(x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), len(cuts)), cuts, trees))

    return told


def walkable(nodes: DataFrame, features: int) -> tuple | None:
    """Per feature its thresholds in order, and per tree, from the root down: feature, number of the threshold, first child
    (the second follows it), mean, and the levels. A leaf is its own child."""
    node = F.col("nodeData")
    found = nodes.select(
        F.col("treeID").alias("tree"), node["id"].alias("id"), node["prediction"].alias("mean"), node["leftChild"].alias("left"),
        node["rightChild"].alias("right"), node["split"]["featureIndex"].alias("feature"), node["split"]["numCategories"].alias("categories"),
        F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("cut")).toArrow()
    tree, id_, mean, left, right, feature, categories, cut = (found[name].to_numpy() for name in found.column_names)
    if (categories >= 0).any():
        return None
    cuts = [np.unique(cut[(left >= 0) & (feature == f)]) for f in range(features)]
    most = max(map(len, cuts), default=0)
    order = np.lexsort((id_, tree))
    trees = []
    for at in np.split(order, np.flatnonzero(np.diff(tree[order])) + 1):
        levels = [np.array([0])]
        while len(levels[-1]):
            inner = levels[-1][left[at[levels[-1]]] >= 0]
            levels.append(np.stack([left[at[inner]], right[at[inner]]], 1).ravel())
        down = np.concatenate(levels)
        place = np.empty(len(at), int)
        place[down] = np.arange(len(at))
        at = at[down]
        inner = left[at] >= 0
        child = np.where(inner, place[np.where(inner, left[at], 0)], np.arange(len(at)))
        number = np.full(len(at), most)
        for f in range(features):
            of = np.flatnonzero(inner & (feature[at] == f))
            number[of] = np.searchsorted(cuts[f], cut[at[of]])
        trees.append((np.where(inner, feature[at], 0).astype(np.int32), number.astype(np.min_scalar_type(most)), child.astype(np.int32), mean[at], len(levels) - 2))
    return cuts, trees


def walk(x: np.ndarray, cuts: list[np.ndarray], trees: list[tuple]) -> np.ndarray:
    """The mean of what the trees tell of each row, added up in their order."""
    kind = trees[0][1].dtype
    codes = np.concatenate([np.searchsorted(c, x[:, f]).astype(kind) for f, c in enumerate(cuts)] or [np.zeros(len(x), kind)])
    row, total = np.arange(len(x)), np.zeros(len(x))
    for feature, number, child, mean, depth in trees:
        start, child, node = feature.astype(int) * len(x), child.astype(int), np.zeros(len(x), int)
        for _ in range(depth):
            at = start.take(node)
            at += row
            right = codes.take(at) > number.take(node)
            node = child.take(node)
            node += right
        total += mean.take(node)
    return total / len(trees)


class BootstrapForest(Estimator, HasLabelCol, HasFeaturesCol, HasWeightCol):
    """Mean of trees that are each fitted on a bootstrap of the single rows behind the collapsed ones.

    A bootstrap takes each single row about Poisson(1) times, so a collapsed row of n single rows is taken Poisson(n)
    times. Every tree draws its own numbers, by a hash of row and tree. All trees grow together: large nodes of all trees
    are split from histograms of one pass a level, the rows of a small node meet in one task, which grows what is below.
    Without a weight column each row counts once. Rows need a column ``row_id`` that tells them apart. Of ``tree``,
    depth and bins are taken.
    """

    def __init__(self, tree: DecisionTreeRegressor, trees: int, node_rows: int = NODE_ROWS):
        super().__init__()
        self.tree, self.trees, self.node_rows = tree, trees, node_rows
        self._set(labelCol=tree.getLabelCol())

    def _fit(self, rows: DataFrame) -> RandomForestRegressionModel:
        count = (F.col(self.getWeightCol()) if self.isSet(self.weightCol) else F.lit(1.0)).cast("double")
        more, trees = {"count": count, "seed": F.xxhash64(F.col(ROW_ID))}, self.trees
        binned = Binned(rows, self.getFeaturesCol(), self.tree.getMaxBins(), F.col(self.getLabelCol()), more, lambda batch: drawn(batch, trees), TREES_ROWS)
        try:
            nodes = node_table(rows.sparkSession, self._grown(binned), binned.edges)
            model = stored_model(rows.sparkSession, RandomForestRegressionModel, self.uid, [1.0] * self.trees, len(binned.edges), nodes)
        finally:
            binned.blocks.unpersist()
        return model.setFeaturesCol(self.getFeaturesCol())

    def _grown(self, binned: Binned) -> RDD:
        starts, depth = binned.starts, self.tree.getMaxDepth()
        splits: dict[int, dict[int, tuple[int, int]]] = {tree: {} for tree in range(self.trees)}
        upper: dict[int, list[tuple]] = {tree: [] for tree in range(self.trees)}
        small: dict[int, list[int]] = {tree: [] for tree in range(self.trees)}
        large = {tree: [1] for tree in range(self.trees)}
        tasks = max(binned.partitions, 1 + binned.rows * self.trees // ADDED_ROWS)

        def counted(blocks: Iterator[tuple]) -> Iterator[tuple]:
            for codes, y, taken in blocks:
                columns, read = packed(codes, starts)
                for tree, wanted in large.items():
                    node = descend(codes, splits[tree], level)
                    at = np.minimum(np.searchsorted(wanted, node), len(wanted) - 1)
                    here = np.flatnonzero((np.array(wanted)[at] == node) & (taken[tree] > 0))
                    k, v = taken[tree][here].astype(float), y[here]
                    sums = histogram(columns[:, here], read, at[here], len(wanted), starts, [k, k * v, k * v * v, None])
                    for i, n in enumerate(wanted):
                        if sums[3, i, :starts[1]].any():
                            yield (tree, n), sums[:, i]

        def judged(sums: np.ndarray) -> tuple:
            (feature,), (bin_,) = best_splits(sums[:1], sums[1:2], starts)
            start = starts[feature]
            left = sums[3, start:start + bin_ + 1].sum()
            return int(feature), int(bin_), sums[:, :starts[1]].sum(1), int(left)

        level = 0
        while large:
            best = binned.blocks.mapPartitions(counted).reduceByKey(np.add, tasks).mapValues(judged).collect()
            if len(best) < sum(map(len, large.values())):
                raise ValueError("too few rows: the bootstrap of a tree is empty")
            large = {}
            for (tree, node), (feature, bin_, sums, left) in sorted(best, key=lambda b: b[0]):
                upper[tree].append((np.array([node]), np.array([feature]), np.array([bin_]), sums[None]))
                if feature >= 0:
                    splits[tree][node] = feature, bin_
                    for child, size in ((2 * node, left), (2 * node + 1, int(sums[3]) - left)):
                        grows = size > self.node_rows and level + 1 < depth
                        (large.setdefault(tree, []) if grows else small[tree]).append(child)
            level += 1

        def dealt(blocks: Iterator[tuple]) -> Iterator[tuple]:
            for codes, y, taken in blocks:
                for tree, wanted in small.items():
                    node = np.where(taken[tree] > 0, descend(codes, splits[tree], level), 0)
                    order = np.argsort(node, kind="stable")
                    ends = np.searchsorted(node[order], [wanted, np.add(wanted, 1)]) if wanted else ((), ())
                    for n, a, b in zip(wanted, *ends):
                        if a < b:
                            here = order[a:b]
                            yield (tree, n), (codes[:, here], y[here], taken[tree][here])

        def grown(group: tuple) -> tuple:
            (tree, node), parts = group
            codes, y, k = zip(*parts)
            below = depth - (node.bit_length() - 1)
            return tree, subtree(np.concatenate(codes, 1), np.concatenate(y), np.concatenate(k), starts, below, node)

        def whole(group: tuple) -> tuple:
            tree, parts = group
            return tree, [*upper[tree], *(level for part in parts for level in part)]

        lower = binned.blocks.mapPartitions(dealt).groupByKey(tasks).map(grown)
        alone = lower.context.parallelize([(tree, []) for tree in upper], 1)  # trees without a small node
        return lower.union(alone).groupByKey(min(tasks, self.trees)).map(whole)


class MeanBoosting(Estimator, HasLabelCol, HasFeaturesCol, HasWeightCol, HasMaxIter, HasStepSize):
    """Least-squares boosting that starts from the mean and adds every tree shrunk by the step size.

    Each round fits one tree on what the rounds before it left, with one pass a level; few rows are taken by one task, which
    grows the trees of ten rounds in a job. Rows of equal features get equal
    predictions, so they are one row with the mean of their labels and the sum of their weights: the fit is that on the
    single rows. Of ``tree``, depth and bins are taken.
    """

    def __init__(self, tree: DecisionTreeRegressor, rounds: int, step: float):
        super().__init__()
        self.tree = tree
        self._set(labelCol=tree.getLabelCol(), maxIter=rounds, stepSize=step)

    def _fit(self, rows: DataFrame) -> GBTRegressionModel:
        features, y = self.getFeaturesCol(), F.col(self.getLabelCol())
        weight = F.col(self.getWeightCol()) if self.isSet(self.weightCol) else F.lit(1.0)
        spark, step, depth = rows.sparkSession, self.getStepSize(), self.tree.getMaxDepth()
        merged = rows.groupBy(features).agg(F.sum(weight).cast("double").alias("weight"), (F.sum(weight * y) / F.sum(weight)).alias("left")).persist()
        try:
            binned = Binned(merged, features, self.tree.getMaxBins(), F.col("left"), {"weight": F.col("weight")},
                            lambda batch: batch["weight"].to_numpy(zero_copy_only=False)[None], ROUND_ROWS)
            blocks, starts = binned.blocks, binned.starts
            blocks.count()
        finally:
            merged.unpersist()
        trees, recent, shares = [], [], [1.0] + [step] * self.getMaxIter()
        alone = binned.rows <= ALONE_ROWS
        try:
            while len(trees) < len(shares):
                if alone:
                    more = shares[len(trees):len(trees) + CUT_EVERY]
                    found = blocks.coalesce(1).mapPartitions(partial(grown_alone, before=recent, shares=more, first=not trees, starts=starts, depth=depth)).collect()
                else:
                    passes = partial(counted_by_all, blocks, recent, starts)
                    found = [boosted_tree(passes, starts, depth if trees else 0)]  # a tree without a split is the mean
                for levels, splits, values in found:
                    recent.append((splits, values, shares[len(trees)]))
                    trees.append(levels)
                if len(recent) >= CUT_EVERY and len(trees) < len(shares):
                    rest = blocks.map(lambda block, done=recent: less(block, done)).persist(StorageLevel.MEMORY_AND_DISK)
                    rest.count()
                    blocks.unpersist()
                    blocks, recent = rest, []
        finally:
            blocks.unpersist()
        nodes = node_table(spark, spark.sparkContext.parallelize(list(enumerate(trees)), 1), binned.edges)
        return stored_model(spark, GBTRegressionModel, self.uid, shares, len(binned.edges), nodes).setFeaturesCol(features)


def boosted_tree(counted: Callable[[dict, list[int], int], np.ndarray], starts: np.ndarray, depth: int) -> tuple:
    """One tree from the sums of a level's nodes: its levels, its splits and the values of its leaves."""
    levels, splits, values, wanted = [], {}, {}, [1]
    for level in range(max(depth, 1)):
        sums = counted(splits, wanted, level)
        whole = sums[:, :, :starts[1]].sum(2).T
        feature, bin_ = best_splits(sums[0], sums[1], starts) if depth else (np.array([-1]), np.array([0]))
        levels.append((np.array(wanted), feature, bin_, whole))
        following, last = [], ([], [])
        for i, node in enumerate(wanted):
            if feature[i] < 0:
                values[node] = whole[i, 1] / whole[i, 0]
                continue
            splits[node] = int(feature[i]), int(bin_[i])
            start = starts[feature[i]]
            left = sums[:, i, start:start + bin_[i] + 1].sum(1)
            for child, s in ((2 * node, left), (2 * node + 1, whole[i] - left)):
                following.append(child)
                if level + 1 == depth:
                    values[child] = s[1] / s[0]
                    last[0].append(child)
                    last[1].append(s)
        if last[0]:
            levels.append((np.array(last[0]), np.full(len(last[0]), -1), np.zeros(len(last[0]), int), np.array(last[1])))
        if not following:
            break
        wanted = following
    return levels, splits, values


def node_sums(block: tuple, columns: np.ndarray, read: list[tuple], starts: np.ndarray, splits: dict, wanted: list[int], level: int) -> np.ndarray:
    """Sums of weight, label, its square and rows by node and bin."""
    codes, left, (w,) = block
    node = descend(codes, splits, level)
    at = np.minimum(np.searchsorted(wanted, node), len(wanted) - 1)
    here = np.flatnonzero(np.array(wanted)[at] == node)
    if len(here) < len(node):
        at, columns, w, left = at[here], columns[:, here], w[here], left[here]
    return histogram(columns, read, at, len(wanted), starts, [w, w * left, w * left * left, None])


def counted_by_all(blocks: RDD, before: list[tuple], starts: np.ndarray, splits: dict, wanted: list[int], level: int) -> np.ndarray:
    """The sums over all blocks, on what the trees before left."""
    def counted(parts: Iterator[tuple]) -> Iterator[np.ndarray]:
        for block in parts:
            yield node_sums(less(block, before), *packed(block[0], starts), starts, splits, wanted, level)

    return sum(blocks.mapPartitions(counted).collect())


def grown_alone(parts: Iterator[tuple], before: list[tuple], shares: list[float], first: bool, starts: np.ndarray, depth: int) -> Iterator[tuple]:
    """The next trees, one after the other, from all rows in one task."""
    codes, left, more = zip(*(less(block, before) for block in parts))
    block = np.concatenate(codes, 1), np.concatenate(left), np.concatenate(more, 1)
    columns, read = packed(block[0], starts)
    for i, share in enumerate(shares):
        tree = boosted_tree(partial(node_sums, block, columns, read, starts), starts, 0 if first and not i else depth)
        yield tree
        block = less(block, [(*tree[1:], share)])


def less(block: tuple, trees: list[tuple]) -> tuple:
    """The block with what these trees tell taken off its labels."""
    codes, left, more = block
    left = left.copy()
    for splits, values, share in trees:
        ids = np.array(sorted(values))
        told = np.array([values[i] for i in ids])
        left -= share * told[np.searchsorted(ids, descend(codes, splits, 64))]
    return codes, left, more
