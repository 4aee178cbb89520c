"""Passages that documents share, by sparse suffixes and windows of 50 words.

Of all suffixes only those are kept that begin at a minimiser: the least hash of eight words in a window of such
hashes. Every passage of 50 words holds a minimiser that is followed by 31 words of it, in each of its copies, and
begins at most 19 words before it. So only suffixes whose 31 words stand in two documents are looked at further:

- where another document has the same 69 words around the minimiser, all of them are shared;
- else the passages of 50 words in them are looked up one by one among those of the suffixes with the same 31 words.

Nothing is compared in pairs: what stands in two documents is told by the least and the greatest key of its hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pavelake.llm.arrays import mix, span_hashes, word_hashes
from pavelake.llm.common import kept, text_or_empty

LEAST = 50  # words of a passage
GRAM = 8  # words whose hash is compared to choose a position
SPAN = 20  # hashes of a window
AHEAD = LEAST - SPAN + 1  # words that are sure to follow the first minimiser of a passage

SUFFIX = "key long, around long, id long, at long"  # at: a and the number of words to b, in one number as there are very many rows
BITS = 7  # for that number
STRETCH = f"at >> {BITS} AS a", f"(at >> {BITS}) + (at & {(1 << BITS) - 1}) AS b"


def anchors(words: np.ndarray) -> tuple[np.ndarray, ...]:
    """Kept suffixes of a text: hash of the words that follow, hash of all words a passage around may have, their [a, b)."""
    n = len(words)
    if n < LEAST:
        return (np.zeros(0, np.int64),) * 4
    grams = span_hashes(words, np.arange(n - GRAM + 1), np.arange(GRAM, n + 1))
    windows = np.lib.stride_tricks.sliding_window_view(grams, SPAN)
    place = np.unique(windows.argmin(axis=1) + np.arange(len(windows)))
    place = place[place + AHEAD <= n]
    a, b = np.maximum(place - SPAN + 1, 0), np.minimum(place + LEAST, n)
    place, a, b = (x[b - a >= LEAST] for x in (place, a, b))
    # where the minimiser stands among them is part of what must be equal
    around = mix(span_hashes(words, a, b) + (place - a).astype(np.uint64))
    return span_hashes(words, place, place + AHEAD).view(np.int64), around.view(np.int64), a, b


def _suffixes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        each = [anchors(word_hashes(t)) for t in batch["text"]]
        ids = np.repeat(batch["id"].to_numpy(np.int64), [len(x[0]) for x in each])
        if len(ids):
            key, around, a, b = (np.concatenate([x[k] for x in each]) for k in range(4))
            yield pd.DataFrame({"key": key, "around": around, "id": ids, "at": (a << BITS) + b - a})


def _windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(passage, id, a, low, high): hash of each passage of 50 words in the wanted stretches, and keys that have it.

    Passages that are only there to be found by others have no place a.
    """
    for batch in batches:
        out = []
        for id_, text, wanted in zip(batch["id"], batch["text"], batch["wanted"]):
            words = word_hashes(text)
            last = len(words) - LEAST
            asks = np.zeros(last + 2 if last >= 0 else 1, np.int64)
            for w in wanted:
                if w["asks"] and w["a"] <= last:
                    asks[w["a"]] += 1
                    asks[min(w["b"] - LEAST, last) + 1] -= 1
                elif w["a"] <= last:
                    a = np.arange(w["a"], min(w["b"] - LEAST, last) + 1)
                    out.append((a, np.full(len(a), -1), id_, w["low"], w["high"], words))
            a = np.flatnonzero(np.cumsum(asks)[:-1] > 0)
            out.append((a, a, id_, id_, id_, words))
        out = [o for o in out if len(o[0])]
        if out:
            sizes = [len(o[0]) for o in out]
            yield pd.DataFrame({
                "passage": np.concatenate([span_hashes(o[5], o[0], o[0] + LEAST) for o in out]).view(np.int64),
                "a": np.concatenate([o[1] for o in out])} | {c: np.repeat([o[k] for o in out], sizes) for c, k in (("id", 2), ("low", 3), ("high", 4))})


def _merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for spans in batch["spans"]:
            whole: list[list[int]] = []
            for s in spans:  # in order of their starts
                if whole and s["a"] <= whole[-1][1]:
                    whole[-1][1] = max(whole[-1][1], s["b"])
                else:
                    whole.append([s["a"], s["b"]])
            out.append([{"start": a, "end": b} for a, b in whole])
        yield pd.DataFrame({"x": batch["x"], "spans": out})


def repeated(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, spans) for each document that shares a passage of 50 words or more with another one.

    spans are [start, end) in words of the whole text, lower-cased runs without white space; overlapping and touching
    ones are joined. Every occurrence of a shared passage is told. Null, empty and shorter texts share nothing, nor does a passage
    that one document repeats by itself. Rows with a null key are not compared, and rows with equal keys, which should
    have equal texts, never count as different documents. Words and passages are compared by hashes of 64 bits.
    """
    kind = docs.schema[key].dataType.simpleString()
    if kind not in ("bigint", "int", "smallint", "tinyint"):
        raise TypeError("keys are whole numbers")
    rows = docs.select(F.col(key).cast("long").alias("id"), text_or_empty(text).alias("text")).where("id IS NOT NULL")
    suffixes = rows.mapInPandas(_suffixes, SUFFIX)  # made twice, which takes less than to keep them
    # the least of a grouped column is dealt out anew for the join, which Spark then splits where a key has very many rows
    keys = suffixes.groupBy("key").agg(F.min("key").alias("shared"), F.min("id").alias("low"), F.max("id").alias("high"))
    met = kept(suffixes.join(keys.where("low < high").select("shared"), F.col("key") == F.col("shared")).drop("shared"))
    groups = kept(met.groupBy("around").agg(
        F.min("around").alias("same"), F.min("key").alias("group_key"), F.min(F.struct("id", "at")).alias("first"),
        F.max("id").alias("high")).select("same", "group_key", "first", "high", (F.col("first.id") < F.col("high")).alias("whole")))
    told = met.join(groups.select("same", "whole"), F.col("around") == F.col("same"))
    told = kept(told.select("id", "at", "whole"))
    # stretches that have no equal ask; one of each group of equal stretches with the same 31 words answers
    asking = groups.where("NOT whole").groupBy("group_key").agg(F.min("group_key").alias("asked"))
    answers = groups.where("whole").join(asking.select("asked"), F.col("group_key") == F.col("asked")).select(
        "first.id", "first.at", F.col("first.id").alias("low"), "high", F.lit(False).alias("asks"))
    asks = told.where("NOT whole").select("id", "at", F.col("id").alias("low"), F.col("id").alias("high"), F.lit(True).alias("asks"))
    wanted = asks.unionByName(answers).selectExpr("id", *STRETCH, "low", "high", "asks").groupBy("id").agg(F.collect_list(F.struct("a", "b", "low", "high", "asks")).alias("wanted"))
    passages = kept(rows.join(wanted, "id").mapInPandas(_windows, "passage long, id long, a int, low long, high long"))
    common = passages.groupBy("passage").agg(F.min("passage").alias("found"), F.min("low").alias("low"), F.max("high").alias("high"))
    single = passages.where("a >= 0").select("passage", "id", "a").join(
        common.where("low < high").select("found"), F.col("passage") == F.col("found")).select("id", "a", F.expr(f"a + {LEAST}").alias("b"))
    spans = told.where("whole").selectExpr("id", *STRETCH).unionByName(single)
    merged = spans.groupBy(F.col("id").alias("x")).agg(F.array_sort(F.collect_list(F.struct("a", "b"))).alias("spans")).mapInPandas(
        _merged, "x long, spans array<struct<start:long,end:long>>")
    return merged.select(F.col("x").cast(kind).alias(key), "spans")


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    return found.select(
        key, F.size("spans").cast("long").alias("n_spans"),
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("n_words"),
        F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",").alias("spans"))
