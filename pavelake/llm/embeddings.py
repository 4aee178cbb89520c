"""Embedding near-duplicates: sign hashing by random hyperplanes, exact cosines, connected components.

Equal vectors of a label are one class with a count, so copies are never compared with each other. A vector is
put into one bucket per table by the signs of its products with random hyperplanes; large buckets are cut into
blocks and every pair of blocks is compared, so a bucket of any size is compared whole, by many tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pavelake.llm.common import kept
from pavelake.llm.components import components

COSINE = 0.98
BITS = 14  # hyperplanes per table: about log2 of the vectors of a label over the wanted bucket size
MISS = 1e-4  # largest chance that a pair exactly at the threshold shares no bucket
BLOCK = 256  # vectors compared with as many others by one step


def tables_needed(cosine: float = COSINE, bits: int = BITS, miss: float = MISS) -> int:
    """Tables that bring the chance of missing a pair at the threshold below `miss`."""
    same = (1 - math.acos(cosine) / math.pi) ** bits
    return math.ceil(math.log(miss) / math.log(1 - same))


def _signer(bits: int, tables: int, seed: int):
    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        planes: dict[int, np.ndarray] = {}
        powers = 1 << np.arange(bits, dtype=np.int64)
        for batch in batches:
            signs = np.zeros((len(batch), tables), np.int64)
            dims = batch["vector"].map(len).to_numpy()
            for dim in np.unique(dims):
                if dim not in planes:
                    planes[dim] = np.random.default_rng([seed, int(dim)]).standard_normal((int(dim), tables * bits))
                rows = np.flatnonzero(dims == dim)
                above = np.stack(batch["vector"].to_numpy()[rows]) @ planes[dim] > 0
                signs[rows] = above.reshape(len(rows), tables, bits) @ powers
            batch["signs"] = list(signs.astype(np.int32))
            yield batch[["rep", "label", "n", "vector", "signs"]]

    return sign


def _pairs_within(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All index pairs a < b inside consecutive runs of the given sizes."""
    ends = np.cumsum(sizes)
    later = np.repeat(ends, sizes) - np.arange(int(ends[-1])) - 1
    a = np.repeat(np.arange(len(later)), later)
    return a, a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(later) - later, later)


def _compare(cosine: float):
    """Compare the vectors of each run of equal keys; (rep, links, root) for those that have a link there."""

    def links_of(batch: pd.DataFrame) -> pd.DataFrame:
        runs = (batch["key"] != batch["key"].shift()).cumsum().to_numpy()
        sizes = np.unique(runs, return_counts=True)[1]
        signs = np.stack(batch["signs"].to_numpy())
        rep, n = batch["rep"].to_numpy(np.int64), batch["n"].to_numpy(np.int64)
        side, table = batch["side"].to_numpy(), batch["table"].to_numpy(np.int64)
        own = (batch["i"] == batch["j"]).to_numpy()
        a, b = _pairs_within(sizes)
        good = own[a] | (side[a] != side[b])  # two blocks are compared across, one block within
        a, b = a[good], b[good]
        left, right, new = [], [], []
        vectors = batch["vector"].to_numpy()
        lengths = batch["vector"].map(len).to_numpy()
        unit = np.zeros((len(batch), int(lengths.max())))
        for dim in np.unique(lengths):
            rows = np.flatnonzero(lengths == dim)
            block = np.stack(vectors[rows]).astype(np.float64)
            block /= np.abs(block).max(axis=1)[:, None]  # no overflow in the squares
            unit[rows, :dim] = block / np.sqrt((block * block).sum(axis=1))[:, None]
        for at in range(0, len(a), 100_000):
            x, y = a[at: at + 100_000], b[at: at + 100_000]
            near = (np.einsum("ij,ij->i", unit[x], unit[y]) >= cosine) & (lengths[x] == lengths[y])
            x, y = x[near], y[near]
            left.append(x), right.append(y)
            new.append((signs[x] == signs[y]).argmax(axis=1) == table[x])  # counted in the first table they share
        x, y, first = (np.concatenate(z) if z else np.zeros(0, int) for z in (left, right, new))
        links = np.zeros(len(batch), np.int64)
        np.add.at(links, x, n[y] * first)
        np.add.at(links, y, n[x] * first)
        root = rep.copy()
        while len(x):  # least member of each connected part of this run
            before = root.copy()
            np.minimum.at(root, x, root[y])
            np.minimum.at(root, y, root[x])
            if (root == before).all():
                break
        told = np.zeros(len(batch), bool)
        told[x] = told[y] = True
        return pd.DataFrame({"rep": rep[told], "links": links[told], "root": root[told]})

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None  # the run that may go on in the next batch; a run has two blocks at most
        for batch in batches:
            batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            last = batch["key"].iloc[-1] if len(batch) else None
            done = batch[batch["key"] != last]
            rest = batch[batch["key"] == last].reset_index(drop=True)
            if len(done):
                yield links_of(done.reset_index(drop=True))
        if rest is not None and len(rest):
            yield links_of(rest)

    return compare


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                    cosine: float = COSINE, bits: int = BITS, tables: int | None = None, seed: int = 7) -> DataFrame:
    """(key, n_links, component_id, kept) for every row.

    Rows are linked when labels and dimensions are equal and the cosine in double precision reaches `cosine`.
    Null, zero, empty and non-finite vectors, and rows without a label or key, have no link and form their own
    component. Repeated rows count as further vectors of the same id.
    """
    tables = tables or tables_needed(cosine, bits)
    rows = vectors.select(F.col(key).alias("id"), F.col(label).alias("label"),
                          F.col(vector).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("label").isNotNull() & F.col("id").isNotNull() & finite & F.exists("vector", lambda x: x != 0)
    classes = rows.where(usable).groupBy("label", "vector").agg(F.min("id").alias("rep"), F.count("*").alias("n"))
    signed = kept(classes.select("rep", "label", "n", "vector").mapInPandas(
        _signer(bits, tables, seed), classes.select("rep", "label", "n", "vector").withColumn(
            "signs", F.array().cast("array<int>")).schema))
    placed = signed.select("rep", "label", "n", "vector", "signs", F.posexplode("signs").alias("table", "bucket"))
    sizes = placed.groupBy("label", "table", "bucket").agg(F.count("*").alias("size")).where("size > 1")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    shared = placed.join(sizes, ["label", "table", "bucket"]).withColumn("blocks", blocks).withColumn(
        "own", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
    dealt = shared.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "rep", "n", "vector", "signs", "table", F.col("own").alias("side"),
        F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "label", "bucket")
    dealt = dealt.withColumn("key", F.xxhash64("label", "table", "bucket", "i", "j")).drop("label", "bucket")
    links = kept(dealt.repartition("key").sortWithinPartitions("key").mapInPandas(
        _compare(cosine), "rep long, links long, root long"))
    counts = links.groupBy("rep").agg(F.sum("links").alias("links"))
    parts = components(links, "rep", "root").select(F.col("node").alias("rep"), "component")
    found = classes.join(counts, "rep", "left").join(parts, "rep", "left").select(
        "label", "vector", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"),
        F.coalesce("component", "rep").alias("component"))
    good, bad = rows.where(usable).join(found, ["label", "vector"], "left"), rows.where(~F.coalesce(usable, F.lit(False)))
    out = good.select("id", "links", "component").unionByName(
        bad.select("id", F.lit(0).cast("long").alias("links"), F.col("id").alias("component")))
    return out.select(F.col("id").alias(key), F.col("links").alias("n_links"), F.col("component").alias("component_id"),
                      F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"))
