"""Language-model scoring with a probabilistic suffix tree over words, beside a unigram count.

Contexts are the one or two words before a token. One is kept if it occurs at least SEEN times in training and what
follows it diverges from what follows any word; the tree of kept contexts grows with the corpus and is nowhere
gathered: blocks of documents list their words and word runs, the lists are summed and judged by Spark, and each block
gets back the counts of what it holds. A token is scored by the longest kept context before it, smoothed with the
distribution of the next shorter one.

The root has no context: the shares of words in training, mixed with a suffix tree over bytes, which is all that is
known of a word never seen. Of that tree's contexts of up to DEPTH bytes those are kept that are frequent and whose
next-byte distribution diverges from that of the context one byte shorter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pavelake.llm.arrays import as_bytes, batches_of, is_space, mix, side_by_side, span_hashes, word_spans
from pavelake.llm.common import kept, outside, pieces, text_or_empty

DEPTH = 4  # bytes of the longest context
LEAST = 5e-5  # least share of all positions for a context to be kept; so at most 1 / LEAST of each length are
DIVERGENCE = 0.02  # least relative entropy, in nats, to the parent's distribution
NEW = 0.1  # weight of the byte tree in the mixture with the counts of whole words
PRIOR = 4.0  # weight of the parent's distribution, in observations
SEEN = 2  # least count in training of a context of words
GAIN = 0.25  # least divergence of a context of words, in nats a token, after what its description costs
BUCKETS = 16  # in which the words that follow a context are counted, by hash, to measure its divergence
JOIN = np.uint64(0x9E3779B97F4A7C15)
END, BLANK = 10, 32  # symbols of the end of a text (and of what stands before it) and of the gap between words
BLOCK_BYTES = 16 << 20  # text of one block; a task holds a few times as much
AT_ONCE = 1 << 20
PIECE = 1_024
FLUSH = 2_000_000  # distinct grams that a task holds before it hands them on


def _words(text: str) -> np.ndarray:
    """Bytes of the text, A-Z in lower case."""
    codes = as_bytes(text)
    return np.where((codes >= 65) & (codes <= 90), codes + 32, codes).astype(np.uint8)


def sequence(text: str) -> np.ndarray:
    """The symbols scored for a text: its words, each with one blank after it, then the end."""
    codes = _words(text)
    space = is_space(codes)
    inner = codes[~(space & np.concatenate([[True], space[:-1]]))]  # first of each gap, none at the start
    inner = np.where(is_space(inner), BLANK, inner)
    tail = [END] if not len(inner) or inner[-1] == BLANK else [BLANK, END]
    return np.append(inner, tail).astype(np.uint8)


def _grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of each byte with the DEPTH bytes before it, as a number whose lowest byte is the last."""
    codes, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        texts = batch["text"].tolist()
        for run in batches_of([len(t) for t in texts], AT_ONCE):
            parts = [np.concatenate([np.full(DEPTH, END, np.uint8), sequence(texts[i])]) for i in run]
            flat = np.concatenate(parts).astype(np.int64)
            real = np.concatenate([np.arange(len(p)) >= DEPTH for p in parts])
            code = np.zeros(len(flat) - DEPTH, np.int64)
            for k in range(DEPTH + 1):
                code = (code << 8) | flat[k: len(flat) - DEPTH + k]
            new, n = np.unique(code[real[DEPTH:]], return_counts=True)
            codes, where = np.unique(np.concatenate([codes, new]), return_inverse=True)
            counts = np.bincount(where, weights=np.concatenate([counts, n]), minlength=len(codes)).astype(np.int64)
            if len(codes) > FLUSH:
                yield pd.DataFrame({"code": codes, "n": counts})
                codes, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(codes):
        yield pd.DataFrame({"code": codes, "n": counts})


def grow(training: DataFrame, text: str = "text") -> pd.DataFrame:
    """(length, context, symbol, n) of all contexts that are frequent enough: at most 1 / LEAST for each length.

    Counts cover all training texts, whole; every shorter context is summed from the longest ones.
    """
    grams = training.select(text_or_empty(text).alias("text")).mapInPandas(_grams, "code long, n long")
    grams = grams.groupBy("code").agg(F.sum("n").alias("n"))
    lengths = F.explode(F.array(*[F.struct(F.lit(k).alias("length"), F.lit((1 << 8 * k) - 1).cast("long").alias("mask"))
                                  for k in range(DEPTH + 1)])).alias("x")
    rows = grams.select("code", "n", lengths).select(
        "x.length", F.expr("shiftright(code, 8) & x.mask").alias("context"), F.expr("code & 255").alias("symbol"), "n")
    rows = kept(rows.groupBy("length", "context", "symbol").agg(F.sum("n").alias("n")))
    total = rows.where("length = 0").agg(F.sum("n").alias("n")).first()["n"] or 0
    common = rows.groupBy("length", "context").agg(F.sum("n").alias("all")).where(F.col("all") >= LEAST * total)
    return rows.join(common.select("length", "context"), ["length", "context"]).toPandas()


class Tree:
    """Kept contexts as an automaton: next state and log10 probability by state and symbol.

    Bytes never seen in training are one symbol: all have the same probability after any context.
    """

    def __init__(self, counts: pd.DataFrame):
        counts = counts.sort_values(["length", "context", "symbol"])
        seen = np.unique(counts["symbol"].to_numpy(np.int64)) if len(counts) else np.zeros(0, np.int64)
        self.symbol = np.full(256, len(seen), np.uint8 if len(seen) < 256 else np.uint16)
        self.symbol[seen] = np.arange(len(seen))
        self.width = len(seen) + 1
        length, context = counts["length"].to_numpy(np.int64), counts["context"].to_numpy(np.int64)
        symbol, n = self.symbol[counts["symbol"].to_numpy(np.int64)], counts["n"].to_numpy(np.float64)
        cuts = np.flatnonzero((np.diff(length) != 0) | (np.diff(context) != 0)) + 1
        smooth: dict[tuple[int, int], np.ndarray] = {(0, 0): np.full(self.width, 1 / 256)}
        wanted = []
        for rows in np.split(np.arange(len(n)), cuts) if len(n) else []:
            node = int(length[rows[0]]), int(context[rows[0]])
            own = np.zeros(self.width)
            own[symbol[rows]] = n[rows]
            if not node[0]:
                # half a count for each byte, so that bytes never seen have a chance
                smooth[node] = (own + 0.5) / (own.sum() + 128)
                continue
            parent = smooth[self._end(node[1], node[0] - 1)]  # as frequent at least, so it is there
            smooth[node] = own = (own + PRIOR * parent) / (own.sum() + PRIOR)
            if (own[:len(seen)] * np.log(own[:len(seen)] / parent[:len(seen)])).sum() >= DIVERGENCE:
                wanted.append(node)
        # a kept context keeps its endings; states are the kept contexts and their beginnings
        self.nodes = {(0, 0)} | {self._end(c, k) for m, c in wanted for k in range(1, m + 1)}
        states = sorted(self.nodes | {(k, c >> 8 * (m - k)) for m, c in self.nodes for k in range(1, m)})
        number = {state: i for i, state in enumerate(states)}
        below: list[list[int]] = [[] for _ in states]
        for (m, c), i in number.items():
            if m:
                below[number[m - 1, c >> 8]].append(i)
        moves = np.zeros((len(states), self.width), np.int32)
        logs = np.zeros((len(states), self.width))
        for i, (m, c) in enumerate(states):  # shorter states come first
            if m:
                shorter = next(number[e] for k in range(m - 1, -1, -1) if (e := self._end(c, k)) in number)
                moves[i], logs[i] = moves[shorter], logs[shorter]
            for j in below[i]:
                moves[i, self.symbol[states[j][1] & 255]] = j
            if (m, c) in self.nodes:
                logs[i] = np.log10(smooth[m, c])
        self.moves, self.logs = (moves * self.width).ravel(), logs.ravel()

    @staticmethod
    def _end(context: int, length: int) -> tuple[int, int]:
        return length, context & ((1 << 8 * length) - 1)

    def word_logs(self, texts: list[str]) -> np.ndarray:
        """log10 probability of each word with its blank, and of each text's end, given all before; in order.

        Long texts are stepped in pieces, each led in by DEPTH symbols, which settle the state.
        """
        whole = [sequence(t) for t in texts]
        lead = np.full(DEPTH, END, np.uint8)
        parts = []
        for symbols in whole:
            symbols = self.symbol[np.concatenate([lead, symbols])]
            parts += [symbols[at: at + PIECE + DEPTH] for at in range(0, len(symbols) - DEPTH, PIECE)]
        order, flat, begins = side_by_side(parts)
        state, found = np.zeros(len(parts), np.int64), np.empty(len(flat))
        for k in range(len(begins) - 1):
            part = slice(begins[k], begins[k + 1])
            used = state[: part.stop - part.start] + flat[part]
            found[part] = self.logs[used]
            state[: len(used)] = self.moves[used]
        sizes = np.array([len(p) - DEPTH for p in parts])
        row = np.repeat(np.argsort(order), sizes)  # place of each piece among those stepped
        step = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + DEPTH
        logs, symbols = found[begins[step] + row], np.concatenate(whole)
        closed = (symbols == BLANK) | (symbols == END)
        return np.add.reduceat(logs, np.concatenate([[0], np.flatnonzero(closed)[:-1] + 1]))


def _hashed(texts: list[str]) -> Iterator[tuple[range, np.ndarray, np.ndarray]]:
    """Runs of texts: (rows, text number of each word within the run, word hashes)."""
    for run in batches_of([len(t) for t in texts], AT_ONCE):
        each = [_words(texts[i]) for i in run]
        gap = np.full(1, END, np.uint8)
        codes = np.concatenate([x for e in each for x in (e, gap)])
        starts, ends = word_spans(codes)
        edges = np.cumsum([len(e) + 1 for e in each])
        yield run, np.searchsorted(edges, starts, side="right"), span_hashes(codes, starts, ends)


LAST = np.uint64(0x5851F42D4C957F2D)  # stands for the hash of a text's end, which is a token
FOUR = np.uint64(4)  # bits of a bucket; the other 60 bits of a word's hash tell the word


def _tokens(texts: list[str]) -> Iterator[tuple[range, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of texts: (rows, symbol and bucket of each token, text number of each, whether it is its text's first)."""
    for run, text, hashes in _hashed(texts):
        each = np.bincount(text, minlength=len(run)) if len(text) else np.zeros(len(run), np.int64)
        full = np.full(len(text) + len(run), LAST)
        full[np.arange(len(text)) + text] = hashes
        owner = np.repeat(np.arange(len(run)), each + 1)
        first = np.concatenate([[True], owner[1:] != owner[:-1]])
        yield run, full >> FOUR, full & np.uint64(BUCKETS - 1), owner, first


def _longer(symbols: np.ndarray, first: np.ndarray, at: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Contexts that end at the places `at`, made longer by the next token: (its places, the longer runs' symbols)."""
    inside = at + 1 < len(symbols)
    inside[inside] = ~first[at[inside] + 1]
    place = at[inside] + 1
    return place, mix(context[inside] * JOIN + symbols[place]) >> FOUR


def _follow(buckets: np.ndarray, first: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Bucket of the token after each place; 0 after a text's last."""
    follow = np.append(np.where(first, np.uint64(0), buckets)[1:], np.uint64(0))
    return follow[at]


class _Sums:
    """Counts by run of words and bucket of what follows, as one number whose lowest four bits are the bucket."""

    def __init__(self):
        self.codes, self.n = np.zeros(0, np.uint64), np.zeros(0)

    def add(self, symbols: np.ndarray, buckets: np.ndarray, learn: np.ndarray) -> None:
        codes = np.concatenate([self.codes, (symbols << FOUR) | buckets])
        self.codes, where = np.unique(codes, return_inverse=True)
        self.n = np.bincount(where, weights=np.concatenate([self.n, learn]), minlength=len(self.codes))

    def rows(self, block: int) -> pd.DataFrame:
        """(gram, at): one row of each run is marked `once`; of a run not learned from it is the only one."""
        symbols = self.codes >> FOUR
        once = np.concatenate([np.ones(min(1, len(symbols)), bool), symbols[1:] != symbols[:-1]])
        total = np.bincount(np.cumsum(once) - 1, weights=self.n)[np.cumsum(once) - 1] if len(symbols) else self.n
        wanted = (self.n > 0) | (once & (total == 0))
        symbols, n, follow = symbols[wanted], self.n[wanted].astype(np.int64), (self.codes & np.uint64(BUCKETS - 1))[wanted]
        once = np.concatenate([np.ones(min(1, len(symbols)), bool), symbols[1:] != symbols[:-1]])
        at = (np.int64(block) << 35) | (n << 5) | (follow.astype(np.int64) << 1) | once
        return pd.DataFrame({"gram": symbols.view(np.int64), "at": at})


LISTED = "gram long, at long"  # at: 28 bits for the block, 30 for the count, 4 for the bucket, 1 for once
BLOCK, COUNT, FOLLOW, ONCE = "at >> 35", f"(at >> 5) & {(1 << 30) - 1}", "(at >> 1) & 15", "at & 1"


def _list_words(block: pd.DataFrame) -> pd.DataFrame:
    """Words of a block, with how often what follows them in its training texts falls into each bucket."""
    sums, learn = _Sums(), block["learn"].to_numpy(bool)
    for run, symbols, buckets, owner, first in _tokens(block["text"].tolist()):
        at = np.flatnonzero(symbols != LAST >> FOUR)
        sums.add(symbols[at], _follow(buckets, first, at), learn[run.start: run.stop][owner[at]])
    return sums.rows(int(block["block"].iloc[0]))


def _list_longer(block: pd.DataFrame, counted: pd.DataFrame) -> pd.DataFrame:
    """Runs of two words that begin with a kept context, and of three that go on from those."""
    if not len(block) or not len(counted):
        return _Sums().rows(0)
    sums, learn, table = _Sums(), block["learn"].to_numpy(bool), _Counted(counted)
    for run, symbols, buckets, owner, first in _tokens(block["text"].tolist()):
        at = np.flatnonzero(table.of(symbols)[1])
        two, pairs = _longer(symbols, first, at, symbols[at])
        three, triples = _longer(symbols, first, two, pairs)
        learned = learn[run.start: run.stop]
        sums.add(np.concatenate([pairs, triples]), np.concatenate([_follow(buckets, first, two), np.zeros(len(three), np.uint64)]),
                 learned[owner[np.concatenate([two, three])]])
    return sums.rows(int(block["block"].iloc[0]))


class _Counted:
    """Counts in training of the words and runs that a block holds, and which of them are kept contexts."""

    def __init__(self, counted: pd.DataFrame):
        grams = counted["gram"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(grams)
        # a last entry that no symbol of 60 bits equals
        self.grams = np.append(grams[order], np.uint64(2**64 - 1))
        self.c = np.append(counted["c"].to_numpy(np.float64)[order], 0.0)
        self.keep = np.append(counted["keep"].to_numpy(bool)[order], False)

    def of(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.grams, symbols)
        found = self.grams[at] == symbols
        return np.where(found, self.c[at], 0.0), found & self.keep[at]


def _score_block(tree, tokens: int, texts_learned: int):
    def score(block: pd.DataFrame, counted: pd.DataFrame) -> pd.DataFrame:
        texts, table = block["text"].tolist(), _Counted(counted)
        n_words, n_known, logs, scores = (np.zeros(len(texts)) for _ in range(4))
        for run, symbols, _, owner, first in _tokens(texts):
            rows = slice(run.start, run.stop)
            word = symbols != LAST >> FOUR
            count, keep = table.of(symbols)
            n_words[rows] = np.bincount(owner, weights=word, minlength=len(run))
            n_known[rows] = np.bincount(owner, weights=word & (count > 0), minlength=len(run))
            logs[rows] = np.bincount(owner, weights=np.where(word, np.log10(count + 0.5), 0), minlength=len(run))
            # root: the words of each text, then its end
            share = np.where(word, count, texts_learned) / max(1, tokens)
            p = (1 - NEW) * share + NEW * 10.0 ** tree.value.word_logs([texts[i] for i in run])
            # then by the longest kept context, each smoothed with the one shorter
            at = np.flatnonzero(keep)
            two, pairs = _longer(symbols, first, at, symbols[at])
            seen, kept_pair = table.of(pairs)
            p[two] = (seen + PRIOR * p[two]) / (count[two - 1] + PRIOR)
            three, triples = _longer(symbols, first, two[kept_pair], pairs[kept_pair])
            of_pair = np.zeros(len(symbols))
            of_pair[two] = seen
            p[three] = (table.of(triples)[0] + PRIOR * p[three]) / (of_pair[three - 1] + PRIOR)
            scores[rows] = np.bincount(owner, weights=np.log10(p), minlength=len(run))
        own = counted["own"].to_numpy(bool)
        docs = pd.DataFrame({"total": False, "key": block["key"], "held": block["held"], "n_words": n_words.astype(np.int64),
                             "n_known": n_known.astype(np.int64), "logs": logs, "score": scores,
                             "tokens": int(block["learn"].sum()), "distinct": 0})
        c = counted["c"].to_numpy(np.int64)
        whole = docs.iloc[:1].assign(total=True, tokens=int(c[own].sum()), distinct=int((c[own] > 0).sum()),
                                     n_words=int(block["learn"].sum()))
        return pd.concat([docs, whole], ignore_index=True)

    return score


def _judged(listed: DataFrame, shares: DataFrame) -> DataFrame:
    """(block, gram, c, keep, own) for each block and run it lists: its count in training, and whether it is kept.

    The divergence is the relative entropy of the buckets that follow to those that follow any word, after the cost of
    naming the buckets in use. All rows of a run are in one partition of `listed`, one row a block and bucket; they are
    summed as they stream by and met again by a merge, so no group is held.
    """
    by_bucket = listed.groupBy("gram", F.expr(FOLLOW).alias("follow")).agg(
        F.sum(F.expr(COUNT)).alias("n"), F.min(F.expr(BLOCK)).alias("block"))
    gain = F.when(F.col("n") > 0, F.col("n") * F.log(F.col("n") / F.coalesce("share", F.lit(1.0))))
    summed = by_bucket.join(F.broadcast(shares), "follow", "left").groupBy("gram").agg(
        F.sum("n").alias("c"), F.sum(gain).alias("gain"), F.count_if(F.col("n") > 0).alias("used"), F.min("block").alias("least"))
    excess = F.col("gain") - F.col("c") * F.log("c") - F.col("used") * float(np.log(BUCKETS))
    keep = (F.col("c") >= SEEN) & (excess >= GAIN * F.col("c"))
    judged = summed.select("gram", "c", F.coalesce(keep, F.lit(False)).alias("keep"), "least")
    met = listed.join(judged.hint("merge"), "gram").withColumn("block", F.expr(BLOCK))
    # no block is before the least; said of both sides, this is not pushed below the one shuffle that all readers share
    met = met.where(F.expr(ONCE) * (F.col("block") - F.col("least") + 1) > 0)
    return met.select(F.col("block").cast("int").alias("block"), "gram", "c", "keep", (F.col("block") == F.col("least")).alias("own"))


def _by_gram(listed: DataFrame) -> DataFrame:
    """Dealt out by run. Readers take both columns and neither can be null, so no filter is put below the shuffle and
    they all share it."""
    return listed.select(*[F.coalesce(c, F.lit(0)).alias(c) for c in ("gram", "at")]).repartition("gram")


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", parts: int = 5, part: int = 1) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row.

    Trees and counts are learned from all rows outside the named part of the key's hash; rows with a null key are
    scored but not learned from. Tokens are the words in lower case and one end per text. A null text is empty: one
    end. Equal rows are scored each, and learned from each. Words and runs of words are told apart by 60-bit hashes.

    Each block of documents lists its distinct words once; counts are summed by word over the blocks and go back to
    them, then the same for the runs that follow kept contexts. The byte tree has at most DEPTH / LEAST kept contexts
    whatever the corpus, so it is broadcast; the contexts of words have no bound and stay dealt out.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), text_or_empty(text).alias("text"), outside(key, parts, part).alias("learn"))
    rows = rows.withColumn("held", F.col("key").isNotNull() & ~F.col("learn"))
    counts = grow(rows.where("learn"))
    ends = {s: int(counts[(counts["length"] == 0) & (counts["symbol"] == s)]["n"].sum()) for s in (BLANK, END)}
    tree = docs.sparkSession.sparkContext.broadcast(Tree(counts))
    blocks = pieces(rows, "text", BLOCK_BYTES)
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("key", "text"), F.lit(blocks)).cast("int"))
    listed = _by_gram(dealt.groupBy("block").applyInPandas(_list_words, LISTED))
    # sixteen rows; one more of each, so that no share is nothing
    shares = listed.groupBy(F.expr(FOLLOW).alias("follow")).agg(F.sum(F.expr(COUNT)).alias("n"))
    shares = shares.select("follow", ((F.col("n") + 1) / F.lit(ends[BLANK] + BUCKETS)).alias("share"))
    words = _judged(listed, shares)
    longer = dealt.groupBy("block").cogroup(words.where("keep").groupBy("block")).applyInPandas(_list_longer, LISTED)
    runs = _judged(_by_gram(longer), shares).where("c > 0").withColumn("own", F.lit(False))
    counted = words.unionByName(runs)
    scored = kept(dealt.groupBy("block").cogroup(counted.groupBy("block")).applyInPandas(
        _score_block(tree, sum(ends.values()), ends[END]), f"total boolean, key {kind}, held boolean, n_words long, n_known long, logs double, "
                            "score double, tokens long, distinct long"))
    sums = scored.where("total").agg(F.sum("tokens").alias("n"), F.sum("distinct").alias("v"), F.sum("n_words").alias("texts")).first()
    texts = sums["texts"] or 0
    n, v = (sums["n"] or 0) + texts, (sums["v"] or 0) + (1 if texts else 0)
    return scored.where("not total").select(
        F.col("key").alias(key), F.col("held").alias("held_out"), (F.col("n_words") + 1).alias("n_tokens"),
        (F.col("n_known") + (1 if texts else 0)).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("logs") + F.log10(F.lit(texts + 0.5)) - (F.col("n_words") + 1) * F.log10(F.lit(n + 0.5 * (v + 1)))).alias("base_score"),
        "score")
