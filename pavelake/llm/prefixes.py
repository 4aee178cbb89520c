"""The trie of conversation prefixes, told from sorted conversations instead of built node by node.

Each distinct conversation is the row of its turns' digests. Sorted, the conversations that start alike stand together,
and the turns that two neighbours share (their LCP) say where one prefix ends and the next begins. Each neighbourhood is
a candidate prefix: the turns that conversation i shares with i-1. How far its members reach is told by two independent
binary searches over range minima of the LCPs, one to the left and one to the right, on a sparse table; there is no
stack and no scan over all conversations.

The sparse table is kept by blocks of BLOCK conversations. A search that leaves its block goes on among the blocks'
minima, which are sorted into blocks again, and comes back into the block where it ends; so a task holds one block,
whatever the number of conversations, and the number of steps up grows with its logarithm. Counts and sums over the
members come along as prefix sums, the smallest id as one more range minimum.

Rows without a conversation id belong to no conversation. Equal turn numbers are ordered by the digests of their turns;
a null role or text is empty. An empty table has no nodes, not even a root. A conversation is one row of 16 bytes a
turn in this operator; its texts are read once, where they lie. Columns other than the four named are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pavelake.llm.common import in_order, kept, ranked

BLOCK = 1024  # conversations, or blocks, whose range minima one task holds
IDS = 512  # ids of members that are joined into one text at a time
WIDTH = 16  # bytes of a turn's digest
SUMS = ("n", "gross", "fresh", "leaves")  # what is summed over the members of a prefix
FAR = f"e long, d long, right boolean, stop long, stop_low long, first long, {', '.join(f'{s} long' for s in SUMS)}"
NOTHING = np.iinfo(np.int64).max  # smallest id among no conversations


# -- conversations as rows of digests ---------------------------------------------------------------


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): the digest and the number of words of each turn, in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.substring(F.unhex(digest), 1, WIDTH).alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).alias("words"))
    ordered = F.sort_array(F.collect_list(F.struct("turn", "digest", "words")))
    return turns.groupBy("conv_id").agg(
        F.transform(ordered, lambda t: F.struct(t.digest.alias("digest"), t.words.cast("long").alias("words"))).alias("turns"))


def rebuilt(told: DataFrame, every: int = 20, heads: int = 4) -> DataFrame:
    """Each conversation c after its first h turns, preceded by the first h turns of conversation c - c % every.

    h is the unsigned crc32 of c in decimals modulo `heads`. One head meets `every` conversations at most.
    """
    lead = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    head = told.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", F.lit(1), F.lit(heads - 1)).alias("head"))
    own = told.withColumns({"base": F.col("conv_id") - F.col("conv_id") % every, "h": lead})
    turns = F.concat(F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("turns", F.lit(1), F.lit(0))),
                     F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1))))
    return own.join(head, "base", "left").select("conv_id", turns.alias("turns"))


def _classes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row for each run of rows with equal turns; the digest goes on from row to row and from batch to batch."""
    names = ["seq", "words", "first", "n", "ends_sha256"]
    current, state = None, None
    for batch in batches:
        done = []
        for seq, words, first, n, ids in zip(*(batch[c] for c in ("seq", "words", "first", "n", "ids"))):
            if current is None or seq != current[0]:
                if current is not None:
                    done.append((*current, state.hexdigest()))
                current, state = [seq, words, first, n], hashlib.sha256(ids.encode())
            else:
                current[3] += n
                state.update(f",{ids}".encode())
        yield pd.DataFrame(done, columns=names)
    if current is not None:
        yield pd.DataFrame([(*current, state.hexdigest())], columns=names)


def classes(told: DataFrame) -> DataFrame:
    """(seq, words, first, n, ends_sha256): each distinct conversation, its smallest id, its copies, and the SHA-256 over
    the ids of all of them, ascending, with commas between.

    Such a digest is sequential, and copies may be many: conversations are sorted with their ids, so a class may fill
    many ranges, its ids are joined by runs of IDS where they lie, and one task reads the finished runs in order.
    """
    flat = told.select(
        "conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t.digest)), "")).alias("seq"),
        F.transform("turns", lambda t: t.words).alias("words"))
    runs = in_order(flat, "seq", "conv_id").groupBy("seq", "part", F.floor(F.col("row") / IDS).alias("run")).agg(
        F.min("words").alias("words"), F.min("conv_id").alias("first"), F.count(F.lit(1)).alias("n"),
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))
    by_class = runs.repartition("seq").sortWithinPartitions("seq", "first").select("seq", "words", "first", "n", "ids")
    return by_class.mapInPandas(_classes, "seq binary, words array<long>, first long, n long, ends_sha256 string")


# -- neighbours -------------------------------------------------------------------------------------


def _shared(a: bytes, b: bytes) -> int:
    """Turns that two rows of digests share at their start."""
    n = min(len(a), len(b))
    unequal = np.flatnonzero(np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n))
    return (int(unequal[0]) if len(unequal) else n) // WIDTH


def _neighbours(block: pd.DataFrame) -> pd.DataFrame:
    """LCPs with the conversation before and after, -1 where there is none, and what is summed over members: all words
    of the copies, words of the turns not shared with the one before, and whether the last turn has no child. Rows of
    other blocks only lend their turns."""
    block = block.sort_values("pos", ignore_index=True)
    seq = block["seq"].tolist()
    low = np.array([-1, *map(_shared, seq, seq[1:]), -1], np.int64)
    block = block.assign(low=low[:-1], after=low[1:])[block["own"].to_numpy()]
    run = [np.concatenate([[0], np.cumsum(np.asarray(w, np.int64))]) for w in block["words"]]
    total = np.array([r[-1] for r in run], np.int64)
    return block.drop(columns=["seq", "own", "words"]).assign(
        run=pd.Series(run, index=block.index, dtype=object), gross=block["n"].to_numpy() * total,
        fresh=total - np.array([r[max(k, 0)] for r, k in zip(run, block["low"])], np.int64),
        leaves=(block["after"].to_numpy() < np.array([len(r) - 1 for r in run])).astype(np.int64))


def neighbours(ordered: DataFrame) -> DataFrame:
    """The classes by pos, without their turns, with the LCPs `low` and `after`, running words and sums."""
    block, inside = F.floor(F.col("pos") / BLOCK), F.col("pos") % BLOCK

    def lent(where: Column, to: Column) -> Column:
        return F.when(where, F.struct(to.alias("block"), F.lit(False).alias("own")))

    homes = F.array_compact(F.array(
        F.struct(block.alias("block"), F.lit(True).alias("own")),
        lent((inside == 0) & (F.col("pos") > 0), block - 1), lent(inside == BLOCK - 1, block + 1)))
    # the row lent to a block beyond the last one is alone there and gives nothing
    return ordered.select("pos", "seq", "words", "first", "n", "ends_sha256", F.inline(homes)).groupBy("block").applyInPandas(
        _neighbours, "pos long, first long, n long, ends_sha256 string, block long, low long, after long, run array<long>, "
                     "gross long, fresh long, leaves long")


# -- range minima by blocks -------------------------------------------------------------------------


def sparse_table(values: np.ndarray) -> list[np.ndarray]:
    """Level k holds the minima of all runs of 2**k values."""
    table = [values]
    while 1 << len(table) <= len(values):
        step = 1 << (len(table) - 1)
        table.append(np.minimum(table[-1][:-step], table[-1][step:]))
    return table


def range_minima(table: list[np.ndarray], begins: np.ndarray, ends: np.ndarray, none: int) -> np.ndarray:
    """Minimum of values[begin:end] for each pair; `none` for empty ones."""
    out = np.full(len(begins), none, np.int64)
    size = ends - begins
    level = np.frexp(np.maximum(size, 1))[1] - 1
    for k in range(len(table)):
        at = (level == k) & (size > 0)
        out[at] = np.minimum(table[k][begins[at]], table[k][ends[at] - (1 << k)])
    return out


def first_below(table: list[np.ndarray], begins: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Binary search: the first place at or after each begin whose value is under the bound, or the number of values."""
    at, n = begins.copy(), len(table[0])
    for k in reversed(range(len(table))):
        fits = at + (1 << k) <= n
        passed = fits & (table[k][np.where(fits, at, 0)] >= least)
        at[passed] += 1 << k
    return at


def _search(whole: bool):
    """Answers the questions put to one block; `stop` is null where no value of the block is under the bound.

    The sums and the smallest id are those of the elements passed. Where elements are whole conversations, a search to
    the left takes in the one where it stops, as that is the first member of the prefix.
    """
    def search(block: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        if not len(block) or not len(asks):
            return pd.DataFrame(columns=["e", "d", "right", "stop", "stop_low", "first", *SUMS])
        block = block.sort_values("e", ignore_index=True)
        n, base = len(block), int(block["e"].iloc[0])
        low = block["low"].to_numpy(np.int64)
        sums = {s: np.concatenate([[0], np.cumsum(block[s].to_numpy(np.int64))]) for s in SUMS}
        smallest, parts = sparse_table(block["first"].to_numpy(np.int64)), []
        for right, some in asks.groupby("right"):
            d, e = some["d"].to_numpy(np.int64), some["e"].to_numpy(np.int64) - base
            if right:
                begin, end = e, first_below(sparse_table(low), e, d)
                found = end
            else:  # the same search on the block read from its end
                begin, end = n - first_below(sparse_table(low[::-1].copy()), n - 1 - e, d), e + 1
                found = begin - 1
                begin = np.maximum(found, 0) if whole else begin
            inside = (found >= 0) & (found < n)
            parts.append(pd.DataFrame({
                "e": e + base, "d": d, "right": right,
                "stop": pd.Series(found + base, dtype="Int64").where(inside),
                "stop_low": pd.Series(low[np.where(inside, found, 0)], dtype="Int64").where(inside),
                "first": range_minima(smallest, begin, end, NOTHING), **{s: sums[s][end] - sums[s][begin] for s in SUMS}}))
        return pd.concat(parts)

    return search


def _within_blocks(elements: DataFrame, asks: DataFrame, whole: bool) -> DataFrame:
    block = F.floor(F.col("e") / BLOCK).alias("block")
    return elements.groupBy(block).cogroup(asks.groupBy(block)).applyInPandas(_search(whole), FAR)


def reach(elements: DataFrame, count: int, asks: DataFrame, whole: bool = True) -> DataFrame:
    """For each question (e, d, right): the first element from e on, to the right or to the left, whose `low` is under d.

    elements: (e, low, first, sums), e from 0 without gaps. The answer has `stop` (null beyond the last element), the
    low there, and the smallest id and the sums of the elements on the way.
    """
    near = _within_blocks(elements, asks, whole)
    if count <= BLOCK:
        return near
    near, blocks = kept(near), -(-count // BLOCK)
    outer = (F.floor(F.col("e") / BLOCK) + F.when(F.col("right"), 1).otherwise(-1)).alias("outer")
    open_ = F.col("stop").isNull() & outer.between(0, blocks - 1)
    minima = elements.groupBy(F.floor(F.col("e") / BLOCK).alias("e")).agg(
        F.min("low").alias("low"), F.min("first").alias("first"), *(F.sum(s).alias(s) for s in SUMS))
    up = kept(reach(kept(minima), blocks, near.where(open_).select(outer.alias("e"), "d", "right").distinct(), whole=False))
    edge = F.when(F.col("right"), F.col("stop") * BLOCK).otherwise(F.col("stop") * BLOCK + (BLOCK - 1))
    down = _within_blocks(elements, up.where("stop IS NOT NULL").select(edge.alias("e"), "d", "right").distinct(), whole)
    below = down.select(F.floor(F.col("e") / BLOCK).alias("in"), "d", "right", *(F.col(c).alias(f"b_{c}") for c in ("stop", "stop_low", "first", *SUMS)))
    far = up.withColumnRenamed("stop", "in").join(below, ["in", "d", "right"], "left").select(
        F.col("e").alias("outer"), "d", "right", F.col("b_stop").alias("far_stop"), F.col("b_stop_low").alias("far_low"),
        F.least("first", "b_first").alias("far_first"), *((F.col(s) + F.coalesce(f"b_{s}", F.lit(0))).alias(f"far_{s}") for s in SUMS))
    gone = near.where(open_).withColumn("outer", outer).join(far, ["outer", "d", "right"]).select(
        "e", "d", "right", F.col("far_stop").alias("stop"), F.col("far_low").alias("stop_low"),
        F.least("first", "far_first").alias("first"), *((F.col(s) + F.col(f"far_{s}")).alias(s) for s in SUMS))
    return near.where(~open_).unionByName(gone)


# -- the trie ---------------------------------------------------------------------------------------


def _prefixes(rows: DataFrame, count: int) -> DataFrame:
    """(pos, l, r, d, low_l, low_r, sums, first) of each candidate: the longest prefix that pos shares with pos - 1, the
    first and last class that start with it, and the LCPs just before and after them."""
    candidates = rows.where("pos > 0")
    asks = candidates.where(F.col("pos") + 1 < count).select((F.col("pos") + 1).alias("e"), F.col("low").alias("d"), F.lit(True).alias("right"))
    asks = asks.unionByName(candidates.select((F.col("pos") - 1).alias("e"), F.col("low").alias("d"), F.lit(False).alias("right")))
    elements = rows.select(F.col("pos").alias("e"), "low", "first", *SUMS)
    answers = kept(reach(elements, count, asks))

    def side(right: bool, name: str) -> DataFrame:
        found = answers.where(F.col("right") == right)
        return found.select((F.col("e") + (-1 if right else 1)).alias("pos"), *(F.col(c).alias(f"{name}_{c}") for c in ("stop", "stop_low", "first", *SUMS)))

    both = candidates.join(side(False, "l"), "pos").join(side(True, "r"), "pos", "left")
    return both.select(
        "pos", F.col("l_stop").alias("l"), F.coalesce(F.col("r_stop"), F.lit(count)).alias("next"), F.col("low").alias("d"),
        F.col("l_stop_low").alias("low_l"), F.coalesce("r_stop_low", F.lit(-1)).alias("low_r"), F.least("first", "l_first", "r_first").alias("first"),
        *((F.col(s) + F.col(f"l_{s}") + F.coalesce(f"r_{s}", F.lit(0))).alias(s) for s in SUMS))


def trie(told: DataFrame) -> DataFrame:
    """The nodes of the prefixes of conversations (conv_id, turns), turns being (digest, words) in order.

    Per node: conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and
    ends_sha256. Prefixes with the same members differ in depth alone and are one row until the end.
    """
    ordered = ranked(classes(told), "seq")
    rows = kept(neighbours(ordered))
    count = rows.count()
    found = kept(_prefixes(rows, count))
    # a prefix is found once by every neighbourhood within it; each but the first child starts at one of them
    same = [c for c in found.columns if c not in ("pos", "l", "d")]
    shared = found.groupBy("l", "d").agg(F.count(F.lit(1)).alias("starts"), *(F.min(c).alias(c) for c in same))
    at = rows.select(F.col("pos").alias("l"), "run", "ends_sha256", (F.size("run") - 1).cast("long").alias("length"))
    shared = shared.join(at, "l").withColumn("children", F.col("starts") + (F.col("length") > F.col("d")).cast("long")).drop("starts")
    single = rows.select(
        F.col("pos").alias("l"), (F.size("run") - 1).cast("long").alias("d"), (F.col("pos") + 1).alias("next"), F.col("low").alias("low_l"),
        F.col("after").alias("low_r"), "first", *SUMS, "run", "ends_sha256", (F.size("run") - 1).cast("long").alias("length"),
        F.lit(0).cast("long").alias("children"))
    spans = shared.unionByName(single.where("d > greatest(low_l, low_r)"))
    # the parent is the prefix of the neighbourhood that shares more, before or after the members
    spans = spans.withColumn("pos", F.when(F.col("low_l") >= F.col("low_r"), F.col("l")).otherwise(F.col("next")))
    spans = spans.join(found.select("pos", F.col("first").alias("parent")), "pos", "left")
    top = F.greatest("low_l", "low_r") + 1
    nodes = spans.withColumn("top", top).withColumn("depth", F.explode(F.sequence("top", "d")))
    before = F.when(F.col("depth") > 0, F.element_at("run", F.greatest(F.col("depth"), F.lit(1)).cast("int"))).otherwise(0)
    known = F.element_at("run", (F.greatest(F.col("low_l"), F.lit(0)) + 1).cast("int"))
    nothing = hashlib.sha256(b"").hexdigest()
    return nodes.select(
        F.col("first").alias("conv_id"), "depth", F.when(F.col("depth") > F.col("top"), F.col("first")).otherwise(F.col("parent")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.when(F.col("depth") < F.col("d"), F.lit(1).cast("long")).otherwise(F.col("children")).alias("n_children"),
        F.col("leaves").alias("n_leaves"), (F.col("gross") - F.col("fresh") - known - (F.col("n") - 1) * before).alias("saved_tokens"),
        F.when(F.col("depth") == F.col("length"), F.col("ends_sha256")).otherwise(nothing).alias("ends_sha256"))
