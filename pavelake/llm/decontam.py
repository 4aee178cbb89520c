"""Benchmark decontamination: which documents contain a test item, by MinHash sketches of the items.

A short item inside a long document has a tiny Jaccard similarity, so sketches of both cannot be compared. Here the
items are sketched, each size class keeping the least hashes of its five-word runs, and the runs of every document,
all of them, are looked up in the sketches. The share of a sketch that is found estimates the containment; what comes
near the threshold is verified by the exact runs. All of it is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pavelake.llm.common import kept, small, text_or_empty

WORDS = 5
CONTAINED = 0.8
SKETCH = 64  # least hashes kept of an item; an item with no more runs is kept whole
SLACK = 0.25  # an estimate this far below the threshold, five deviations, still makes a candidate


def words(text: Column) -> Column:
    """Lower-cased runs without white space (space, tab, line breaks)."""
    return F.filter(F.split(F.lower(text), r"[\x09-\x0D\x20]+"), lambda w: w != "")


def _runs(column: str, make) -> Column:
    """make(first place) of each run of five words; of all words together where there are fewer; none without words."""
    size = F.size(column)
    none = F.array().cast("array<int>")
    starts = F.when(size == 0, none).when(size < WORDS, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), size - WORDS))
    return F.transform(starts, make)


def run_hashes(column: str) -> Column:
    return _runs(column, lambda i: F.xxhash64(*[F.get(F.col(column), i + k) for k in range(WORDS)]))


def run_texts(column: str) -> Column:
    return _runs(column, lambda i: F.array_join(F.slice(F.col(column), i + 1, WORDS), " "))


def _sketches(items: DataFrame) -> DataFrame:
    """(item, size, kept, hash): the sketch of every item, one row per hash."""
    each = items.select("item", F.array_sort(F.array_distinct(run_hashes("words"))).alias("runs")).where(F.size("runs") > 0)
    sized = each.select("item", F.size("runs").alias("size"), F.slice("runs", 1, SKETCH).alias("sketch"))
    return sized.select("item", "size", F.size("sketch").alias("kept"), F.explode("sketch").alias("hash"))


def _least(size: str, kept_: str) -> Column:
    """Hashes of a sketch that a candidate must hold: the exact number where the sketch is the whole item."""
    whole = F.ceil(F.col(size) * CONTAINED - 1e-9)
    return F.when(F.col(size) <= SKETCH, whole).otherwise(F.ceil(F.col(kept_) * (CONTAINED - SLACK)))


def contained(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
              item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """(key, item_key, n_shared, n_item, containment) of all pairs in which at least 0.8 of the item's distinct
    five-word runs are in the document.

    An item of fewer than five words is one run, found in documents of just these words. Empty and null texts and
    rows with a null key are in no pair. Rows with equal keys are one document for the search; the pair is reported
    once, with the largest containment of a row. Size classes prune: a document with fewer runs than the item needs
    is never a candidate.
    """
    source = docs.select(F.col(key).alias("doc"), text_or_empty(text).alias("text")).where("doc IS NOT NULL")
    # words leave through a generator: else they would be made anew for every run that is built from them
    listed = items.where(F.col(item_key).isNotNull()).select(
        F.col(item_key).alias("item"), F.explode(F.array(words(text_or_empty(item_text)))).alias("words"))
    sketch = kept(_sketches(listed))
    probes = source.select("doc", F.explode(F.array(words(F.col("text")))).alias("words"))
    probes = probes.select("doc", F.size("words").alias("length"), F.explode(run_hashes("words")).alias("hash"))
    hits = probes.join(small(sketch, sketch.count()), "hash").where(
        F.greatest(F.col("length") - (WORDS - 1), F.lit(1)) >= F.ceil(F.col("size") * CONTAINED - 1e-9))
    # one row per document, item and hash, then per document and item: no group holds more than a sketch
    found = hits.groupBy("doc", "item", "size", "kept", "hash").agg(F.lit(1).alias("one"))
    counted = found.groupBy("doc", "item", "size", "kept").agg(F.count("*").alias("n"))
    candidates = kept(counted.where(F.col("n") >= _least("size", "kept")).select("doc", "item"))
    wanted = small(candidates.select("doc").distinct(), candidates.count())
    texts = source.join(wanted, "doc", "left_semi").select("doc", F.explode(F.array(words(F.col("text")))).alias("words"))
    runs = F.array_distinct(run_texts("words"))
    both = candidates.join(texts.select("doc", runs.alias("doc_runs")), "doc").join(
        listed.select("item", runs.alias("item_runs")), "item")
    sized = both.select("doc", "item", F.size(F.array_intersect("item_runs", "doc_runs")).cast("long").alias("n_shared"),
                        F.size("item_runs").cast("long").alias("n_item"))
    exact = sized.groupBy("doc", "item").agg(F.max("n_shared").alias("n_shared"), F.max("n_item").alias("n_item"))
    share = F.col("n_shared") / F.col("n_item")
    return exact.where(share >= CONTAINED).select(
        F.col("doc").alias(key), F.col("item").alias(item_key), "n_shared", "n_item", share.alias("containment"))


def clean(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
          item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents that contain no item, all columns; rows with a null key stay."""
    spoilt = contained(docs, items, key, text, item_key, item_text).select(F.col(key).alias("__key")).distinct()
    return docs.join(spoilt, docs[key] == F.col("__key"), "left_anti")
