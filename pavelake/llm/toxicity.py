"""Toxicity: a learned lexicon, Levenshtein automata over its trie, and scores of the window around each hit.

The lexicon is learned from labelled texts: whole words, and word beginnings (stems) for languages that inflect. The
trie of the words is intersected with the automaton of all strings within one edit, which gives one deterministic
automaton; it is run over the distinct words of many texts side by side. A hit between quotation marks or in a quoted
line counts as quotation; hits close together count as abuse. A logistic model joins these counts to a score.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pavelake.llm.arrays import batches_of, rolled, side_by_side, span_hashes, word_hashes
from pavelake.llm.common import kept, outside, text_or_empty

SAMPLE = 6_000  # labelled texts of each class that are learned from, at most
TERMS = 400  # entries of the lexicon, at most
SHORTEST, LONGEST = 3, 9  # characters of a stem
RATIO = 5.0  # an entry is so many times as frequent in toxic texts, at least
SUPPORT = 0.03  # and in this share of the toxic texts
FUZZY = 5  # words of so many letters are also found with one edit
NEAR = 0.7  # what a hit with an edit counts for
RARE = 100  # forms with an edit must be so many times rarer in other texts than the word is in toxic ones
WINDOW = 12  # words to each side of a hit
AT_ONCE = 1 << 19
WORD_BREAK, QUOTE, LINE, MORE = 0, 1, 2, 3  # classes of other characters


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.array([unicodedata.category(chr(c))[0] in "LN" for c in range(0x110000)])


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def _dense(moves: list[dict[str, int]], dead: int, letters: dict[str, int]) -> np.ndarray:
    width = len(letters) + 1
    table = np.full((len(moves), width), dead * width, np.int64)
    for state, to in enumerate(moves):
        other = to.get("", dead)
        table[state] = other * width
        for letter, target in to.items():
            if letter:
                table[state, letters[letter]] = target * width
    return table.ravel()


class Lexicon:
    """Terms as automata. words: whole words; stems: beginnings of words."""

    def __init__(self, words: list[str], stems: list[str], edited: set[str] | None = None):
        self.edited = {w for w in words if len(w) >= FUZZY} if edited is None else edited
        self.words, self.stems = sorted(set(words)), sorted(set(stems))
        alphabet = sorted({c for t in (*self.words, *self.stems) for c in t})
        self.letters = {c: i + 1 for i, c in enumerate(alphabet)}  # 0: any other character
        self.symbol = np.zeros(0x110000, np.uint8 if len(alphabet) < 256 else np.uint16)
        self.symbol[[ord(c) for c in alphabet]] = np.arange(1, len(alphabet) + 1)
        self.width = len(alphabet) + 1
        self.longest = max([len(w) + 1 for w in self.words] + [len(s) for s in self.stems] + [1])
        self.word_table, self.exact, self.near = self._within_one_edit()
        self.stem_table, self.stem = self._beginnings()

    @staticmethod
    def _trie(terms: list[str]) -> tuple[list[dict[str, int]], dict[int, str]]:
        below: list[dict[str, int]] = [{}]
        ends = {}
        for term in terms:
            node = 0
            for c in term:
                if c not in below[node]:
                    below[node][c] = len(below)
                    below.append({})
                node = below[node][c]
            ends[node] = term
        return below, ends

    def _within_one_edit(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The trie of the words intersected with the automaton of one edit, made deterministic."""
        below, ends = self._trie(self.words)
        # edits are allowed where such a word still lies below
        deep = [False] * len(below)
        for term in self.words:
            if term in self.edited:
                node = 0
                deep[0] = True
                for c in term:
                    node = below[node][c]
                    deep[node] = True

        def closed(items) -> frozenset:
            out = set(items)
            for node, edits in list(out):
                if not edits and deep[node]:
                    out |= {(child, 1) for child in below[node].values() if deep[child]}  # a letter left out
            return frozenset(out)

        def step(items: frozenset, c: str) -> frozenset:
            out = set()
            for node, edits in items:
                if c in below[node]:
                    out.add((below[node][c], edits))
                if not edits and deep[node]:
                    out.add((node, 1))  # a letter too many
                    out |= {(child, 1) for child in below[node].values() if deep[child]}  # another letter
            return closed(out)

        start = closed({(0, 0)})
        number, queue, moves = {frozenset(): 0, start: 1}, [frozenset(), start], []
        for items in queue:
            wanted = {c for node, _ in items for c in below[node]}
            to = {}
            for c in ("", *sorted(wanted)):
                after = step(items, c)
                if after not in number:
                    number[after] = len(queue)
                    queue.append(after)
                to[c] = number[after]
            moves.append(to)
        exact = np.array([any(n in ends and e == 0 for n, e in items) for items in queue])
        near = np.array([any(n in ends and ends[n] in self.edited for n, _ in items) for items in queue])
        return _dense(moves, 0, self.letters), exact, near & ~exact

    def _beginnings(self) -> tuple[np.ndarray, np.ndarray]:
        """Automaton that stays in the state of a stem once a word has begun with it; and the stem of each state."""
        below, ends = self._trie(self.stems)
        moves: list[dict[str, int]] = [{}, *({c: n + 1 for c, n in to.items()} for to in below)]  # state 0 is dead
        for node in ends:
            moves[node + 1] = {"": node + 1} | {c: node + 1 for c in self.letters}
        found = np.full(len(moves), -1)
        found[[n + 1 for n in ends]] = [self.stems.index(t) for t in ends.values()]
        return _dense(moves, 0, self.letters), found

    def look_up(self, words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For words as code points: is a term, is one edit from one, number of its stem or -1."""
        # what lies beyond the longest term and an edit can only matter as being too long
        order, flat, begins = side_by_side([self.symbol[w[: self.longest + 1]] for w in words])
        out = []
        for table in (self.word_table, self.stem_table):
            state = np.full(len(words), self.width, np.int64)
            for k in range(len(begins) - 1):
                symbols = flat[begins[k]: begins[k + 1]]
                state[: len(symbols)] = table[state[: len(symbols)] + symbols]
            last = np.empty(len(words), np.int64)
            last[order] = state // self.width
            out.append(last)
        return self.exact[out[0]], self.near[out[0]], self.stem[out[1]]


FEATURES = 7


def features(lexicon: Lexicon, weights: np.ndarray, expected: float, texts: list[str]) -> np.ndarray:
    """[text, feature]. weights: log ratio of each stem; expected: what its hits per word add up to by chance."""
    out = np.zeros((len(texts), FEATURES))
    for run in batches_of([len(t) for t in texts], AT_ONCE):
        each = [_codes(texts[i] + "\n") for i in run]
        codes = np.concatenate(each)
        letter = _letters()[codes]
        edge = np.flatnonzero(np.diff(np.concatenate([[False], letter, [False]]).astype(np.int8)))
        starts, ends = edge[::2], edge[1::2]
        doc = np.searchsorted(np.cumsum([len(e) for e in each]), starts, side="right")
        n = np.bincount(doc, minlength=len(run)).astype(float)
        if not len(starts):
            continue
        _, at, back = np.unique(span_hashes(codes, starts, ends), return_index=True, return_inverse=True)
        found = lexicon.look_up([codes[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())])
        exact, near, stem = (x[back] for x in found)
        hit = exact | near | (stem >= 0)
        place = np.flatnonzero(hit)
        # inside an odd number of quotation marks of its line, or in a line that begins with the sign of a quoted one
        marks = np.cumsum(np.isin(codes, [0x22, 0xAB, 0xBB, 0x201C, 0x201D, 0x201E]))
        line = np.concatenate([[0], np.flatnonzero(codes == 10) + 1])
        begin = line[np.searchsorted(line, starts[place], side="right") - 1]
        before = np.where(begin > 0, marks[begin - 1], 0)
        quoted = ((marks[starts[place]] - before) % 2 == 1) | (codes[begin] == 0x3E)
        # hits in the window, of the same text
        low, high = np.searchsorted(place, place - WINDOW), np.searchsorted(place, place + WINDOW, side="right")
        first = np.searchsorted(doc[place], doc[place])
        last = np.searchsorted(doc[place], doc[place], side="right")
        close = np.minimum(high, last) - np.maximum(low, first) - 1
        said = ~quoted
        add = lambda mask, w=1.0: np.bincount(doc[place], weights=mask * w, minlength=len(run))
        stems = add(np.where(stem[place] >= 0, weights[np.maximum(stem[place], 0)] if len(weights) else 0.0, 0.0) * said)
        crowd = np.zeros(len(run))
        np.maximum.at(crowd, doc[place], close * said)
        rows = slice(run.start, run.stop)
        out[rows, 0] = np.log1p(add(exact[place] & said) + NEAR * add(near[place] & said))
        out[rows, 2] = np.log1p(add((stem[place] >= 0) & said))
        out[rows, 3] = np.clip((stems - expected * n) / 10, -2, 4)
        out[rows, 4] = np.log1p(add(quoted))
        out[rows, 5] = np.log1p(crowd)
        out[rows, 6] = np.minimum(add(said) / np.maximum(n, 20) * 10, 3)
        out[rows, 1] = np.log1p(n) / 5
    return out


def _fit(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weighted logistic regression by Newton steps; the last coefficient is the constant."""
    x = np.column_stack([x, np.ones(len(x))])
    beta = np.zeros(x.shape[1])
    penalty = np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gain = x.T @ (w * (y - p)) - penalty @ beta
        move = np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x + penalty, gain)
        beta += move
        if np.abs(move).max() < 1e-8:
            break
    return beta


class Model:
    def __init__(self, lexicon: Lexicon, weights: np.ndarray, expected: float, beta: np.ndarray):
        self.lexicon, self.weights, self.expected, self.beta = lexicon, weights, expected, beta

    def score(self, texts: list[str]) -> np.ndarray:
        x = features(self.lexicon, self.weights, self.expected, texts)
        return 1 / (1 + np.exp(-np.clip(np.column_stack([x, np.ones(len(x))]) @ self.beta, -30, 30)))


def _least_run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        runs = [rolled(word_hashes(t), 5) for t in batch["text"]]
        batch["least"] = [int(r.min().view(np.int64)) if len(r) else 0 for r in runs]
        yield batch


def training_sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, parts: int, part: int) -> DataFrame:
    """(text, toxic): at most SAMPLE labelled texts of each class, those with the smallest key hashes, outside the
    held-out fold. Of texts with the same least five-word run, copies mostly, one is taken."""
    known = labels.where(outside(key, parts, part) & F.col(label).isin(0, 1)).select(
        F.col(key).alias("id"), F.col(label).cast("int").alias("toxic")).distinct()
    by_hash = Window.partitionBy("toxic").orderBy(F.xxhash64("id"), "id")
    chosen = known.withColumn("n", F.row_number().over(by_hash)).where(F.col("n") <= SAMPLE).drop("n")
    found = docs.select(F.col(key).alias("id"), text_or_empty(text).alias("text")).join(F.broadcast(chosen), "id")  # 2 * SAMPLE rows
    least = found.select("toxic", "text").mapInPandas(_least_run, "toxic int, text string, least long")
    return least.groupBy("toxic", "least").agg(F.min("text").alias("text")).select("text", "toxic")


def _candidates(sample: DataFrame) -> pd.DataFrame:
    """(term, whole, toxic and other occurrences, toxic texts) of words and beginnings frequent enough in toxic texts."""
    words = sample.withColumn("id", F.monotonically_increasing_id()).select(
        "id", "toxic", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}]+"), 0)).alias("word"))
    counted = words.groupBy("id", "toxic", "word").agg(F.count("*").alias("n"))
    sizes = F.sequence(F.lit(SHORTEST), F.least(F.length("word"), F.lit(LONGEST)))
    terms = F.concat(F.array(F.struct(F.col("word").alias("term"), F.lit(True).alias("whole"))), F.when(
        F.length("word") >= SHORTEST, F.transform(sizes, lambda k: F.struct(F.substring("word", 1, k).alias("term"), F.lit(False).alias("whole"))))
        .otherwise(F.array().cast("array<struct<term:string,whole:boolean>>")))
    each = counted.select("id", "toxic", "n", F.explode(terms).alias("t")).groupBy("id", "toxic", "t.term", "t.whole").agg(F.sum("n").alias("n"))
    sums = each.groupBy("term", "whole").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("n1"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("n0"), F.sum("toxic").alias("d1"))
    total = {r["toxic"]: (r["words"], r["texts"]) for r in counted.groupBy("toxic").agg(
        F.sum("n").alias("words"), F.count_distinct("id").alias("texts")).collect()}
    (w1, t1), (w0, _) = total.get(1, (1, 1)), total.get(0, (1, 1))
    rate1, rate0 = (F.col("n1") + 0.5) / w1, (F.col("n0") + 0.5) / w0
    good = sums.where((F.col("d1") >= max(4, SUPPORT * t1)) & (rate1 / rate0 >= RATIO))
    gain = F.col("n1") * F.log(rate1 / rate0)
    return good.select("term", "whole", "d1", rate1.alias("rate1"), rate0.alias("rate0"), gain.alias("gain")).orderBy(
        F.desc("gain"), "term", "whole").limit(20 * TERMS).toPandas()  # feature: the candidates that gain most


def _editable(words: list[str], rate: dict[str, float], texts: pd.Series) -> set[str]:
    """The longer words whose forms with one edit are rare in texts that are not toxic, so that edits tell something."""
    counts = Counter(w for t in texts for w in re.findall(r"[^\W_]+", t.lower()))
    total, known = max(1, sum(counts.values())), np.array(list(counts.values()))
    codes = [np.frombuffer(w.encode("utf-32-le", "surrogatepass"), np.uint32) for w in counts]
    out = set()
    for word in words:
        if len(word) >= FUZZY:
            near = Lexicon([word], []).look_up(codes)[1] if codes else np.zeros(0, bool)
            if known[near].sum() / total * RARE <= rate[word]:
                out.add(word)
    return out


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
          parts: int = 4, part: int = 2) -> Model:
    """Lexicon and weights from a bounded sample of labelled texts; without labels of both classes all scores are low."""
    sample = kept(training_sample(docs, labels, key, text, label, parts, part))
    words, stems, weights = [], [], {}
    expected = 0.0
    found = _candidates(sample)
    # a beginning that owes its gain to one word gives way to the word
    whole = found[found["whole"]]
    gain = dict(zip(found.loc[~found["whole"], "term"], found.loc[~found["whole"], "gain"]))
    given = {w[:k] for w, g in zip(whole["term"], whole["gain"]) for k in range(1, len(w) + 1) if g >= 0.8 * gain.get(w[:k], np.inf)}
    for row in found.itertuples():
        if not row.whole and row.term in given:
            continue
        # one entry along each line of the trie, the one that gains most
        if any(s.startswith(row.term) or row.term.startswith(s) for s in (*stems, *words)):
            continue
        if len(words) + len(stems) == TERMS:
            break
        if row.whole:
            words.append(row.term)
        else:
            stems.append(row.term)
            weights[row.term] = float(np.log(row.rate1 / row.rate0))
            expected += (row.rate1 + row.rate0) / 2 * weights[row.term]
    rows = sample.toPandas()  # at most 2 * SAMPLE texts
    rate = dict(zip(whole["term"], whole["rate1"]))
    lexicon = Lexicon(words, stems, _editable(words, rate, rows.loc[rows["toxic"] == 0, "text"]))
    ordered = np.array([weights[s] for s in lexicon.stems])
    x, y = features(lexicon, ordered, expected, rows["text"].tolist()), rows["toxic"].to_numpy(float)
    if not len(y) or y.min() == y.max():
        return Model(lexicon, ordered, expected, np.append(np.zeros(FEATURES), -4.0))
    share = {r["toxic"]: r["n"] for r in labels.where(
        outside(key, parts, part) & F.col(label).isin(0, 1)).groupBy(F.col(label).cast("int").alias("toxic")).agg(F.count("*").alias("n")).collect()}
    # classes weigh as they do among all labels that may be learned from
    weight = np.where(y == 1, share[1] / y.sum(), share[0] / (1 - y).sum())
    return Model(lexicon, ordered, expected, _fit(x, y, weight * len(y) / weight.sum()))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score, predicted) for every row, from the whole text alone; null texts score as empty ones."""
    kind = docs.schema[key].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by TERMS

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"key": batch["key"], "score": shared.value.score(batch["text"].tolist())})

    found = docs.select(F.col(key).alias("key"), text_or_empty(text).alias("text")).mapInPandas(judge, f"key {kind}, score double")
    return found.select(F.col("key").alias(key), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
