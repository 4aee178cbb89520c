"""A manifest of a dataset: a Merkle tree over its rows, and the proof of every row.

The rows of a source are the leaves of its tree, three nodes to a parent; the roots of the sources are the leaves of
one more tree. Trees grow by joining runs of 81 nodes, so one shuffle makes four levels, and a node of a run knows its
siblings on the way out of the run. Proofs come by pointer jumping: a node holds that segment of siblings and points to
the ancestor it leads to, which is a node of the next run; a self-join with the ancestors doubles the distance and
appends their segments, until every leaf points to the root.

Null values have an encoding of their own, so every row is a leaf: rows without a key come first in their source, rows
without a source form the first source. Repeated rows are equal leaves side by side; rows that share a key are ordered
by their digests. An empty table has no rows. Columns other than those of a leaf are not looked at.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from pavelake.llm.common import in_order, kept, ranked, together

ARITY = 3
LEVELS = 4  # levels that one shuffle makes, and that a segment covers at first
RUN = ARITY**LEVELS
TOP = -1  # number of the tree over the sources; the trees of the sources are numbered from 0
DEEPEST = 39  # 3**39 rows are the most that a long can count
BROADCAST_BYTES = 8 << 20  # ancestors are broadcast if their counted rows, times their width, take no more
STEP_BYTES = 96  # at most, one step of a proof in memory: a byte, two digests and the array's own fields
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def encoded(value: Column) -> Column:
    """How a value enters a digest: `-` for null, else its length in bytes, a colon and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: tuple[str, ...] = COLUMNS, **changed: Column) -> Column:
    """Digest of a row; a changed column replaces the one of that name."""
    return F.sha2(F.concat(*(encoded(changed.get(c, F.col(c))) for c in columns)), 256)


def _height(leaves: Column) -> Column:
    """Levels above the leaves until one node is left."""
    return reduce(lambda a, b: a + b, ((leaves > F.lit(ARITY**k)).cast("int") for k in range(DEEPEST + 1)))


def _parents(nodes: Column) -> Column:
    """Digests of the next level of nodes that start a run."""
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / ARITY).cast("int"))
    return F.transform(runs, lambda i: F.sha2(F.array_join(F.slice(nodes, i * ARITY + 1, ARITY), ""), 256))


def _siblings(nodes: Column, i: Column) -> Column:
    """One step of a proof: how many siblings stand to the left, as a byte, then the digests of all siblings."""
    mine = i % ARITY
    run = F.slice(nodes, i - mine + 1, F.lit(ARITY))
    others = F.concat(F.slice(run, F.lit(1), mine), F.slice(run, mine + 2, F.lit(ARITY)))
    return F.unhex(F.concat(F.lit("0"), mine.cast("string"), F.array_join(others, "")))


def _segments(level: int) -> Column:
    """(pos, path, load) of the nodes of a run: path has a step for each level up to the next run's, or the root."""
    def one(_: Column, i: Column) -> Column:
        steps = F.array(*(_siblings(F.col(f"d{k}"), F.floor(i / ARITY**k).cast("int")) for k in range(LEVELS)))
        path = F.slice(steps, F.lit(1), F.least(F.lit(LEVELS), F.col("h") - level))
        return F.struct((F.col("run") * RUN + i).alias("pos"), path.alias("path"), F.col("n")[i]["load"].alias("load"))

    return F.transform("d0", one)


def _grown(nodes: DataFrame, top: int) -> tuple[list[DataFrame], DataFrame]:
    """(nodes at the foot of each run, the roots) of every tree, from the nodes of level 0.

    nodes: (tree, h, pos, digest, load), with h the height of the tree, top the largest, and load what a leaf carries
    along. No group has over 81 nodes, whatever the size of a tree.
    """
    made, roots = [], [nodes.where("h = 0").select("tree", "digest")]
    none = F.lit(None).cast(nodes.schema["load"].dataType)
    nodes = nodes.where("h > 0")
    for level in range(0, top, LEVELS):
        groups = nodes.groupBy("tree", "h", F.floor(F.col("pos") / RUN).alias("run")).agg(
            F.sort_array(F.collect_list(F.struct("pos", "digest", "load"))).alias("n"))
        groups = groups.withColumn("d0", F.transform("n", lambda x: x.digest))
        for k in range(LEVELS):
            groups = groups.withColumn(f"d{k + 1}", F.when(F.col("h") > level + k, _parents(F.col(f"d{k}"))))
        groups = kept(groups)
        made.append(groups.select("tree", "h", F.lit(level).alias("level"), F.inline(_segments(level))))
        last = F.coalesce(*(F.when(F.col("h") == level + k, F.col(f"d{k}")[0]) for k in range(1, LEVELS + 1)))
        roots.append(groups.where(F.col("h") <= level + LEVELS).select("tree", last.alias("digest")))
        nodes = groups.where(F.col("h") > level + LEVELS).select(
            "tree", "h", F.col("run").alias("pos"), F.col(f"d{LEVELS}")[0].alias("digest"), none.alias("load"))
    return made, reduce(DataFrame.unionByName, roots)


def _placed(rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows with tree, pos and the height h of their tree; the sources with tree and h).

    Places come from one global sort: a source that fills many ranges is numbered range by range.
    """
    rows = in_order(rows, "source", key, "leaf")
    runs = rows.groupBy("source", "part").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
    sources = ranked(runs.groupBy("source").agg(F.sum("n").alias("leaves")), "source").select(
        F.col("source").alias("s"), F.col("pos").alias("tree"), _height(F.col("leaves")).alias("h"))
    sources = kept(sources)
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    runs = runs.join(sources, F.col("source").eqNullSafe(F.col("s"))).select(
        F.col("source").alias("s"), F.col("part").alias("p"), (F.col("before") - F.col("first")).alias("shift"), "tree", "h")
    placed = rows.join(runs, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")))
    return placed.withColumn("pos", F.col("row") + F.col("shift")).drop("part", "row", "s", "p", "shift"), sources


def _to_root(nodes: DataFrame, hops: int, root: Column) -> DataFrame:
    """Double the hops, of four levels each, that every node's path covers until all point to the root.

    A node is met as an ancestor so many levels up by 3**levels leaves at most, so the ancestors that are too many to be
    broadcast are met by equally many rows each.
    """
    nodes = kept(nodes)
    counts = nodes.groupBy((F.col("tree") == TOP).alias("top"), "level").count().collect()  # a row for each run's level
    far = 1
    while far < hops:
        nodes = kept(nodes) if far > 1 else nodes
        above = nodes.where((F.col("tree") == TOP) | (F.col("level") >= far * LEVELS)).select(
            F.struct("tree", "level", "pos").alias("up"), F.col("path").alias("further"), F.col("up").alias("next"))
        rows = sum(c["count"] for c in counts if c.top or c.level >= far * LEVELS)
        moved = {"path": F.concat("path", F.coalesce("further", F.array())), "up": F.coalesce("next", "up")}
        if rows * (STEP_BYTES * LEVELS * far + 100) <= BROADCAST_BYTES:
            nodes = nodes.join(F.broadcast(above), "up", "left").withColumns(moved).select(*nodes.columns)
        else:  # nodes that are there would all meet under the key of the root
            there = nodes.where(F.col("up") == root)
            moving = nodes.where(F.col("up") != root).join(above, "up").withColumns(moved).select(*nodes.columns)
            nodes = together([moving, there])
        far *= 2
    return nodes


def folded(start: Column, path: Column) -> Column:
    """The digest that a path leads to from a leaf."""
    def up(digest: Column, step: Column) -> Column:
        text = F.lower(F.hex(step))
        left = F.substr(text, F.lit(2), F.lit(1)).cast("int") * 64
        return F.sha2(F.concat(F.substr(text, F.lit(3), left), digest, F.substr(text, left + 3)), 256)

    return F.aggregate(path, start, up)


def manifest(docs: DataFrame, tampered: Column | None = None, text: Column | None = None, key: str = "doc_id") -> DataFrame:
    """(key, leaf, changed, path, height, root) of every row.

    path holds the steps from the leaf to the root, each a byte with the number of siblings to the left and then all
    siblings' digests; height is the number of steps in the tree of the row's source. changed is the leaf of the row as
    it is read now: where `tampered` holds, `text` stands for its text.
    """
    now = leaf() if tampered is None else F.when(F.coalesce(tampered, F.lit(False)), leaf(text=text)).otherwise(leaf())
    rows = docs.select(F.col(key).alias("key"), F.col("source").cast("string").alias("source"), leaf().alias("leaf"), now.alias("changed"))
    placed, sources = _placed(kept(rows), "key")
    raw = [F.unhex("leaf").alias("leaf"), F.when(F.col("changed") != F.col("leaf"), F.unhex("changed")).alias("changed")]
    placed = kept(placed.select("tree", "h", "pos", F.col("leaf").alias("digest"), F.struct("key", *raw, "h").alias("load")))
    size = sources.agg(F.count(F.lit(1)).alias("n"), F.max("h").alias("h")).first()
    tallest, top = size["h"] or 0, next(k for k in range(DEEPEST + 1) if ARITY**k >= size["n"])
    made, subroots = _grown(placed, tallest)
    none = F.lit(None).cast(placed.schema["load"].dataType)
    over, last = _grown(subroots.select(
        F.lit(TOP).cast("long").alias("tree"), F.lit(top).alias("h"), F.col("tree").alias("pos"), "digest", none.alias("load")), top)
    end = last.first()  # one row, none for an empty table

    def address(tree: Column, level: Column, pos: Column) -> Column:
        return F.struct(tree.cast("long").alias("tree"), level.cast("int").alias("level"), pos.cast("long").alias("pos"))

    subroot = address(F.lit(TOP), F.lit(0), F.col("tree"))
    next_run = address(F.col("tree"), F.col("level") + LEVELS, F.floor(F.col("pos") / RUN))
    root = address(F.lit(TOP), F.lit(top), F.lit(0))
    leaves_run = F.col("level") + LEVELS >= F.col("h")
    columns = ["tree", "level", "pos", "load", "path", "up"]
    lone = placed.where("h = 0").withColumns({"level": F.lit(0), "path": F.array().cast("array<binary>"), "up": subroot})
    nodes = [lone, *(m.withColumn("up", F.when(leaves_run, subroot).otherwise(next_run)) for m in made),
             *(m.withColumn("up", F.when(leaves_run, root).otherwise(next_run)) for m in over)]
    nodes = reduce(DataFrame.unionByName, [n.select(*columns) for n in nodes]).repartition("tree", "level", "pos")
    hops = max(1, -(-tallest // LEVELS)) + -(-top // LEVELS)
    paths = _to_root(nodes, hops, root).where("load IS NOT NULL")
    digest = F.lower(F.hex("load.leaf"))
    return paths.select(
        F.col("load.key").alias(key), digest.alias("leaf"), F.coalesce(F.lower(F.hex("load.changed")), digest).alias("changed"),
        "path", F.col("load.h").alias("height"), F.lit(end["digest"] if end else None).cast("string").alias("root"))


def verified(proofs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Digest columns of a manifest: the subroot, the digest of all siblings, the root that the row leads to as it is
    read now, and whether that is the root of the manifest."""
    siblings = F.transform("path", lambda step: F.substr(F.lower(F.hex(step)), F.lit(3)))
    rows = proofs.select(
        key, "leaf", folded(F.col("leaf"), F.slice("path", F.lit(1), F.col("height"))).alias("subroot"), "root",
        F.sha2(F.array_join(siblings, ""), 256).alias("proof_sha256"), folded(F.col("changed"), F.col("path")).alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))
