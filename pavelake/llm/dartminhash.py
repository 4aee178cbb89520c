"""Near-duplicates by DartMinHash: weighted minwise signatures from darts thrown at weighted elements.

The elements of a text are its distinct runs of five words, weighted by how often they occur. Every element has the
same random darts in every text: points in the plane of weight and rank, one on average in each unit of area. A dart
counts for a text if it lies below the element's weight there. Each dart belongs to one of the signature's
coordinates, which keeps the dart of least rank, so two texts agree in a coordinate with a chance equal to their
weighted Jaccard similarity. Only darts of small rank are thrown: about k ln k + 2k for a text of any size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pavelake.llm.arrays import U, as_bytes, batches_of, mix, only, rolled, span_hashes, word_spans
from pavelake.llm.common import kept, narrow_batches, small, text_or_empty
from pavelake.llm.components import components

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 20, 4  # a pair at the threshold shares no band once in 38,000 times
BLOCK = 512  # texts of a bucket that are compared with as many others by one step
COLUMNS = 4_096  # elements that are compared at a time
AT_ONCE = 50_000  # elements whose darts are thrown together
SURE = 0.55  # pairs whose signatures agree in fewer coordinates are not verified: five deviations below the threshold

_POISSON = np.cumsum([np.exp(-1.0) / np.prod(np.arange(1, k + 1)) for k in range(20)])


def _uniform(x: np.ndarray) -> np.ndarray:
    return (x >> U(11)).astype(np.float64) * 2.0**-53


def elements(text: str | None) -> tuple[np.ndarray, np.ndarray, str]:
    """Distinct runs of five words as hashes, their numbers of occurrences, and a digest of the words in order."""
    codes = as_bytes((text or "").lower())
    words = span_hashes(codes, *word_spans(codes))
    digest = hashlib.md5(words.tobytes()).hexdigest()
    return *np.unique(rolled(words, WORDS), return_counts=True), digest


def signatures(texts: list[tuple[np.ndarray, np.ndarray]], size: int) -> np.ndarray:
    """[text, coordinate] as 64-bit values, for texts as (hashes, positive weights) with one element at least."""
    out = np.zeros((len(texts), size), U)
    total = np.array([float(w.sum()) for _, w in texts])
    top = (size * np.log(size) + 2 * size) / total  # darts of greater rank are not thrown at first
    left = np.arange(len(texts))
    while len(left):
        hashes = np.concatenate([texts[i][0] for i in left])
        weights = np.concatenate([texts[i][1] for i in left]).astype(np.float64)
        owner = np.repeat(np.arange(len(left)), [len(texts[i][0]) for i in left])
        ids, ranks, owner = _darts(hashes, weights, owner, top[left])
        cell = owner * size + (mix(ids ^ U(0x5851F42D4C957F2D)) % U(size)).astype(np.int64)
        order = np.lexsort((ranks, cell))
        found, at = np.unique(cell[order], return_index=True)
        full = np.bincount(found // size, minlength=len(left)) == size
        good = full[found // size]
        out[left[found[good] // size], found[good] % size] = mix(ids[order[at[good]]])
        left = left[~full]  # a coordinate got no dart
        top[left] *= 2
    return out


def _darts(hashes: np.ndarray, weights: np.ndarray, owner: np.ndarray, top: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, ranks and owners of the darts below the elements' weights with ranks below their owner's top.

    The plane is cut into regions that double in both directions: level v spans weights from 2**v - 1 and level r
    ranks from 2**r - 1. A region is cut into 2**r by 2**v cells of area one, each with a Poisson number of darts.
    """
    ids, ranks, owners = [], [], []
    limit = top[owner]
    for r in range(int(np.log2(1 + top.max())) + 1):
        for v in range(int(np.log2(1 + weights.max())) + 1):
            low, base = 2.0**v - 1, 2.0**r - 1
            tall, wide = 2.0 ** (v - r), 2.0 ** (r - v)  # of a cell
            inside = np.flatnonzero((weights > low) & (limit > base))
            if not len(inside):
                continue
            down = np.minimum(np.ceil((weights[inside] - low) / tall), 2**r).astype(np.int64)
            across = np.minimum(np.ceil((limit[inside] - base) / wide), 2**v).astype(np.int64)
            n = down * across
            element = np.repeat(inside, n)
            place = np.arange(len(element)) - np.repeat(np.cumsum(n) - n, n)
            across = np.repeat(across, n)
            i, j = place // across, place % across
            cell = mix(hashes[element] + mix(np.uint64([(r << 48) | (v << 40)]) + (i.astype(U) << U(20)) + j.astype(U) + U(1)))
            count = np.searchsorted(_POISSON, _uniform(mix(cell ^ U(0x2545F4914F6CDD1D))), side="right")
            element, i, j, cell = (np.repeat(x, count) for x in (element, i, j, cell))
            dart = mix(cell + (np.arange(len(cell)) - np.repeat(np.cumsum(count) - count, count)).astype(U) * U(0x9E3779B97F4A7C15))
            rank = base + (j + _uniform(mix(dart ^ U(0xE7037ED1A0B428DB)))) * wide
            good = np.flatnonzero(rank < limit[element])
            weight = low + (i[good] + _uniform(mix(dart[good] ^ U(0xA0761D6478BD642F)))) * tall
            good = good[weight < weights[element[good]]]
            ids.append(dart[good])
            ranks.append(rank[good])
            owners.append(owner[element[good]])
    return np.concatenate([*ids, np.zeros(0, U)]), np.concatenate([*ranks, np.zeros(0)]), np.concatenate([*owners, np.zeros(0, np.int64)])


def similarity(a: str | None, b: str | None) -> float:
    """Weighted Jaccard similarity of two texts: sum of lesser over sum of greater weights."""
    (x, m, _), (y, n, _) = elements(a), elements(b)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    both = int(np.minimum(m[i], n[j]).sum())
    either = int(m.sum() + n.sum()) - both
    return both / either if either else 0.0


def _sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    only("dartminhash")
    size = BANDS * ROWS
    for batch in batches:
        found = [elements(t) for t in batch["text"]]
        signed: list[np.ndarray] = [np.zeros(0, np.int32)] * len(found)
        for run in batches_of([len(f[0]) for f in found], AT_ONCE):
            real = [i for i in run if len(found[i][0])]
            if real:
                for i, row in zip(real, (signatures([found[i][:2] for i in real], size) >> U(32)).astype(np.uint32).view(np.int32)):
                    signed[i] = row
        yield pd.DataFrame({"id": batch["id"], "digest": [f[2] for f in found], "signature": signed})


def _verify(least: float):
    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            good = [similarity(a, b) >= least for a, b in zip(batch["text_a"], batch["text_b"])]
            yield batch.loc[good, ["a", "b"]]

    return verify


def _linked(pairs: DataFrame, signed: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Those of the (a, b) pairs that reach the similarity, checked on whole texts."""
    left = signed.select(F.col("id").alias("a"), F.col("signature").alias("sa"))
    right = signed.select(F.col("id").alias("b"), F.col("signature").alias("sb"))
    agree = F.size(F.filter(F.zip_with("sa", "sb", lambda x, y: x == y), lambda z: z))
    likely = kept(pairs.join(left, "a").join(right, "b").where(agree >= SURE * BANDS * ROWS).select("a", "b"))
    wanted = kept(likely.select(F.col("a").alias("id")).unionByName(likely.select(F.col("b").alias("id"))).distinct())
    used = texts.join(small(wanted, wanted.count()), "id", "left_semi").dropDuplicates(["id"])
    both = likely.join(used.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a").join(
        used.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    with narrow_batches(texts.sparkSession):
        return kept(both.select("a", "b", "text_a", "text_b").mapInPandas(_verify(least), "a long, b long"))


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Elements as a set: the second occurrence of a run is another element, so that set sizes are sums of weights."""
    for batch in batches:
        out = []
        for text in batch["text"]:
            hashes, n, _ = elements(text)
            turn = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            out.append(mix(np.repeat(hashes, n) + turn.astype(U) * U(0x9E3779B97F4A7C15)).view(np.int64))
        yield pd.DataFrame({"id": batch["id"], "elements": out})


def _compare(least: float):
    """(a, b) for members of each run of equal keys: a reaches the similarity with members of other parts, of which
    b is the smallest that can be reached within the run."""

    def links_of(run: pd.DataFrame) -> pd.DataFrame:
        sizes = run["elements"].map(len).to_numpy()
        owner = np.repeat(np.arange(len(run)), sizes)
        _, column, n = np.unique(np.concatenate(run["elements"].to_numpy()), return_inverse=True, return_counts=True)
        shared = n > 1
        column, owner = (np.cumsum(shared) - 1)[column[shared[column]]], owner[shared[column]]
        both = np.zeros((len(run), len(run)), np.float32)
        order = np.argsort(column, kind="stable")
        column, owner = column[order], owner[order]
        for at in range(0, int(shared.sum()), COLUMNS):
            x, y = np.searchsorted(column, [at, at + COLUMNS])
            present = np.zeros((len(run), COLUMNS), np.float32)
            present[owner[x:y], column[x:y] - at] = 1
            both += present @ present.T
        part, side, ids = (run[c].to_numpy(np.int64) for c in ("part", "side", "id"))
        near = both >= least * (sizes[:, None] + sizes[None, :] - both) - 1e-3  # whole numbers, so this decides exactly
        near &= (part[:, None] != part[None, :]) & ((run["i"].iloc[0] == run["j"].iloc[0]) | (side[:, None] != side[None, :]))
        x, y = np.nonzero(near)
        root = ids.copy()
        while len(x):
            before = root.copy()
            np.minimum.at(root, x, root[y])
            if (root == before).all():
                break
        told = np.unique(x)
        return pd.DataFrame({"a": ids[told], "b": root[told]})

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None  # a run has two blocks at most
        for batch in batches:
            batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            keys = batch["key"].to_numpy()
            cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            for a, b in zip([0, *cuts], cuts):
                yield links_of(batch.iloc[a:b])
            rest = batch.iloc[cuts[-1] if len(cuts) else 0:]
        if rest is not None and len(rest):
            yield links_of(rest)

    return compare


def _across_parts(members: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Links between the parts of each bucket: all pairs of texts but those within one part.

    A bucket is cut into blocks, and each pair of blocks is compared by one step, so a bucket of any size is compared
    whole. Texts of the largest part meet only those of the others. Links leave as (text, smallest text it leads to).
    """
    counts = members.groupBy("bucket").agg(F.count("*").alias("n"), F.sum((F.col("part") != F.col("largest")).cast("int")).alias("others"))
    single = F.col("n") <= BLOCK
    cut = counts.select("bucket", F.when(single, 1).otherwise(F.ceil(F.col("others") / BLOCK)).cast("int").alias("first"),
                        F.when(single, 0).otherwise(F.ceil((F.col("n") - F.col("others")) / BLOCK)).cast("int").alias("second"))
    wanted = kept(members.select("id").distinct())
    with narrow_batches(texts.sparkSession):
        sets = kept(texts.join(small(wanted, wanted.count()), "id").dropDuplicates(["id"]).select("id", "text").mapInPandas(
            _counted, "id long, elements array<long>"))
        meets = (F.col("part") != F.col("largest")) | (F.col("second") == 0)
        number = F.xxhash64("id", "bucket")
        placed = members.join(cut, "bucket").select(
            "bucket", "id", "part", F.when(meets, F.pmod(number, "first")).otherwise(
                F.col("first") + F.pmod(number, F.greatest("second", F.lit(1)))).cast("int").alias("side"),
            F.explode(F.sequence(F.lit(0), F.when(meets, F.col("first") + F.col("second")).otherwise(F.col("first")) - 1)).alias("other"))
        dealt = placed.select("id", "part", "side", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "bucket")
        dealt = dealt.withColumn("key", F.xxhash64("bucket", "i", "j")).drop("bucket").join(sets, "id")
        found = dealt.repartition("key").sortWithinPartitions("key").mapInPandas(_compare(least), "a long, b long")
        return kept(found.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """(key, class_id, group_id, kept) for every row.

    class_id is the smallest key of the texts with the same words, group_id the smallest key reachable by links of at
    least the similarity, kept tells the row that stays of its group. Words are lower-cased runs without white space;
    a text of fewer than five words is one run. Null and empty texts link with nothing. Keys should be unique: rows with
    equal keys stay or go together, by one of their texts. Rows with a null key are not compared and stay.

    Texts with the same words are one class, so copies are never compared. In a bucket each text is compared with one
    leader. Texts of a bucket that are still in different components after that are all compared with each other, but
    for those within the largest component, so no pair that shares a bucket is passed over.
    """
    kind = docs.schema[key].dataType.simpleString()
    if kind not in ("bigint", "int", "smallint", "tinyint"):
        raise TypeError("keys are whole numbers")
    rows = docs.select(F.col(key).cast("long").alias("id"), text_or_empty(text).alias("text"))
    with narrow_batches(docs.sparkSession):
        signed = kept(rows.where("id IS NOT NULL").mapInPandas(_sign, "id long, digest string, signature array<int>"))
    real = F.size("signature") > 0
    classes = signed.where(real).groupBy("digest").agg(F.min("id").alias("class_id"))
    first = signed.where(real).join(classes, (F.col("id") == F.col("class_id")) & (signed["digest"] == classes["digest"]), "left_semi")
    first = kept(first.select("id", "signature").dropDuplicates(["id"]))
    band = lambda k: F.xxhash64(F.lit(k), F.slice("signature", k * ROWS + 1, ROWS))
    placed = first.select("id", F.explode(F.array(*[band(k) for k in range(BANDS)])).alias("bucket"))
    # the leader of a bucket differs from band to band, so that a large group is tried against several of its texts
    leaders = placed.groupBy("bucket").agg(F.min_by("id", F.xxhash64("bucket", "id")).alias("leader"), F.count("*").alias("n"))
    shared = kept(placed.join(leaders.where("n > 1"), "bucket").select("bucket", "id", "leader"))
    star = shared.where("id <> leader").select(F.least("id", "leader").alias("a"), F.greatest("id", "leader").alias("b")).distinct()
    links = _linked(star, first, rows, least)
    parts = components(links, "a", "b").withColumnRenamed("node", "id")
    members = shared.join(parts, "id", "left").select("bucket", "id", F.coalesce("component", "id").alias("part"))
    sizes = members.groupBy("bucket", "part").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("bucket").agg(F.max_by("part", F.struct("n", "part")).alias("largest"), F.count("*").alias("parts"))
    open_ = kept(members.join(largest.where("parts > 1").drop("parts"), "bucket"))
    links = links.unionByName(_across_parts(open_, rows, least))
    groups = components(links, "a", "b").withColumnRenamed("node", "class_id")
    known = signed.where(real).join(classes, "digest").select("id", "class_id").unionByName(
        signed.where(~real).select("id", F.col("id").alias("class_id")))
    found = known.join(groups, "class_id", "left").withColumn("group_id", F.coalesce("component", "class_id"))
    nobody = rows.where("id IS NULL").select("id", F.col("id").alias("class_id"), F.col("id").alias("group_id"))
    out = found.select("id", "class_id", "group_id").unionByName(nobody)
    return out.select(F.col("id").cast(kind).alias(key), "class_id", "group_id",
                      F.coalesce(F.col("id") == F.col("group_id"), F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without their near-duplicates: of each group the one with the smallest key, all columns."""
    drop = near_duplicates(docs, key, text).where("NOT kept").select(F.col(key).alias("__key"))
    return docs.join(drop, docs[key] == F.col("__key"), "left_anti")
