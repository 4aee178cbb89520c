"""Language identification by cross-parsing.

A suffix automaton of each language's labelled text knows all its substrings. A text is cut greedily into the
longest phrases that the automaton knows; the language that needs the fewest phrases, each weighed by the bits
that a place in its text costs, is taken.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pavelake.llm.arrays import batches_of, only, side_by_side, table_of
from pavelake.llm.common import kept, outside, small

ROWS = 400  # labelled rows per language that the automata are made of, at most
SYMBOLS = 40_000  # symbols per language, at most
DENSE = 40  # the most frequent letters, whose transitions are looked up in a table; those of all others are searched for
KINDS = 1 << 21  # more than there are code points
PIECE = 1_024  # symbols parsed in one go; a phrase ends at the end of a piece
AT_ONCE = 1 << 20  # symbols stepped through together
TOO_MANY = 0.5  # phrases after the first, per symbol, from which on a text is in none of the languages
UNKNOWN = "und"


@table_of("langid")
def _is_letter() -> np.ndarray:
    return np.array([unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)])


def _letters(text: str | None) -> np.ndarray:
    """Code points of the lower-cased text with each run of other characters as one blank."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(_is_letter()[codes], codes, 32)
    return codes[~((codes == 32) & (np.concatenate([[32], codes[:-1]]) == 32))] if len(codes) else codes


def automaton(symbols: list[int], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Transitions of the suffix automaton, (table, keys, entries): those of symbols below width as a dense table
    [state * width + symbol], those of the others as sorted keys [state * width * KINDS + symbol] and their entries.

    An entry is 2 * width * next state; where the automaton has no transition the table has the one from the start
    state, plus 1 to tell that a phrase ended, so that following the entries is the greedy parse.
    """
    nexts: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for symbol in symbols:
        current = len(nexts)
        nexts.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and symbol not in nexts[p]:
            nexts[p][symbol] = current
            p = link[p]
        if p >= 0:
            q = nexts[p][symbol]
            if length[p] + 1 == length[q]:
                link[current] = q
            else:
                clone = len(nexts)
                nexts.append(dict(nexts[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nexts[p].get(symbol) == q:
                    nexts[p][symbol] = clone
                    p = link[p]
                link[q] = link[current] = clone
        last = current
    first = np.ones(width, np.int32)
    for symbol, state in nexts[0].items():
        if symbol < width:
            first[symbol] = state * width * 2 + 1
    table, rare = np.tile(first, len(nexts)), {}
    for state, moves in enumerate(nexts):
        for symbol, target in moves.items():
            if symbol < width:
                table[state * width + symbol] = target * width * 2
            else:
                rare[state * width * KINDS + symbol] = target * width * 2
    keys = np.array(sorted(rare), np.int64)
    return table, keys, np.array([rare[k] for k in keys.tolist()], np.int64)


def _searched(keys: np.ndarray, entries: np.ndarray, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """Entries of symbols that the table does not hold; a symbol that the automaton has nowhere is a phrase by itself."""
    def look_up(wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return keys[at] == wanted, entries[at]

    if not len(keys):
        return np.ones(len(states), np.int64)
    known, entry = look_up(states * KINDS + symbols)
    starts, anew = look_up(symbols)
    return np.where(known, entry, np.where(starts, anew + 1, 1))


class Parser:
    """Automata of all languages. Small enough to be rebuilt from the sample by each worker."""

    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(samples)
        parts = {lang: _letters(samples[lang])[:SYMBOLS] for lang in self.languages}
        seen, counts = np.unique(np.concatenate([*parts.values(), np.zeros(0, np.uint32)]), return_counts=True)
        ranked = seen[np.argsort(-counts, kind="stable")]
        ranked = ranked[ranked != 32]  # the blank is symbol 0, the letters follow by frequency
        self.width = min(DENSE, len(ranked)) + 1
        self.symbol = np.full(0x110000, KINDS - 1, np.int32)  # letters of no sample: a symbol that no automaton has
        self.symbol[ranked] = np.arange(1, len(ranked) + 1)
        self.symbol[32] = 0
        self.tables = [automaton(self.symbol[parts[lang]].tolist(), self.width) for lang in self.languages]
        self.bits = np.array([math.log2(max(2, len(parts[lang]))) for lang in self.languages])

    def phrases(self, sequences: list[np.ndarray]) -> np.ndarray:
        """[language, sequence]: number of phrases."""
        order, flat, begins = side_by_side(sequences)
        rare = np.flatnonzero(flat >= self.width)
        steps = np.searchsorted(rare, begins)
        rare_from, dense = steps.tolist(), np.where(flat >= self.width, 0, flat)
        out = np.zeros((len(self.tables), len(sequences)), np.int64)
        for g, (table, keys, entries) in enumerate(self.tables):
            state = np.zeros(len(sequences), np.int64)
            count = np.ones(len(sequences), np.int64)
            for k in range(len(begins) - 1):
                symbols = dense[begins[k]: begins[k + 1]]
                n = len(symbols)
                entry = table[state[:n] + symbols]
                if rare_from[k] < rare_from[k + 1]:
                    at = rare[rare_from[k]: rare_from[k + 1]]
                    entry = entry.astype(np.int64)
                    entry[at - begins[k]] = _searched(keys, entries, state[at - begins[k]], flat[at])
                count[:n] += entry & 1
                state[:n] = entry >> 1
            out[g, order] = count
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and phrases after the first, per symbol, of each text."""
        langs, scores, rates = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts))
        for run in batches_of([len(t or "") for t in texts], AT_ONCE):
            cut, owner, size = [], [], np.zeros(len(run), np.int64)
            for i, row in enumerate(run):
                symbols = self.symbol[_letters(texts[row])]
                size[i] = len(symbols) if (symbols > 0).any() else 0
                for at in range(0, int(size[i]), PIECE):
                    cut.append(symbols[at: at + PIECE])
                    owner.append(i)
            if not cut or not self.tables:
                continue
            each = self.phrases(cut)
            total = np.stack([np.bincount(owner, weights=row, minlength=len(run)) for row in each])
            cost = total * self.bits[:, None] / np.maximum(size, 1)
            best = cost.argmin(axis=0)
            least = np.sort(cost, axis=0)
            second = least[1] if len(least) > 1 else np.full(len(run), self.bits[0])
            for i, row in enumerate(run):
                if size[i]:
                    langs[row] = self.languages[best[i]]
                    scores[row] = min(1.0, max(0.0, 1 - least[0, i] / second[i]))
                    rates[row] = (total[best[i], i] - -(-size[i] // PIECE)) / size[i]
        return langs, scores, rates


@table_of("langid")
def _parser(samples: tuple[tuple[str, str], ...]) -> Parser:
    return Parser(dict(samples))


def samples(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
            parts: int = 4, part: int = 2) -> tuple[tuple[str, str], ...]:
    """Labelled text per language, a bounded sample: the ROWS different texts with the smallest hashes, SYMBOLS characters of them.

    Rows of the held-out fold, without key or label, or without a letter are not learned from. Only the sample
    (languages times SYMBOLS) comes to the driver.
    """
    known = docs.where(outside(key, parts, part)).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    known = known.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    known = known.withColumn("hash", F.xxhash64("text"))
    by_hash = Window.partitionBy("lang").orderBy("hash")
    chosen = known.select("lang", "hash").distinct().withColumn("n", F.row_number().over(by_hash)).where(F.col("n") <= ROWS)
    chosen = kept(chosen)
    taken = known.join(small(chosen, chosen.count()), ["lang", "hash"]).groupBy("lang", "n").agg(F.min("text").alias("text"))
    room = Window.partitionBy("lang").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    taken = taken.withColumn("before", F.coalesce(F.sum(F.length("text")).over(room), F.lit(0)))
    taken = taken.where(F.col("before") < SYMBOLS).select(
        "lang", "n", F.substring("text", 1, SYMBOLS).alias("text"))  # more of one text would not fit anyway
    gathered: dict[str, list[str]] = {}
    for row in taken.orderBy("lang", "n").collect():
        gathered.setdefault(row["lang"], []).append(row["text"])
    return tuple((name, " ".join(texts)) for name, texts in sorted(gathered.items()))


def identify(docs: DataFrame, learned: tuple[tuple[str, str], ...], text: str = "text", into: str = "language") -> DataFrame:
    """All columns of docs and the verdict, a struct of lang_pred, score and phrase_rate under the name given.

    Whole texts are read. Null texts and texts without a letter, and all texts if nothing was learned, are `und`
    with score 0 and rate 1; ties go to the first language by name.
    """
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        only("langid")
        parser = _parser(learned)
        for batch in batches:
            langs, scores, rates = parser.predict([t if isinstance(t, str) else None for t in batch.tolist()])
            yield pd.DataFrame({"lang_pred": langs, "score": scores, "phrase_rate": rates})

    # only the text goes through Python, and only the verdict comes back
    # (nondeterministic only in name: the verdict is then made once, whatever filters follow)
    judge = F.pandas_udf(predict, "lang_pred string, score double, phrase_rate double").asNondeterministic()
    return docs.withColumn(into, judge(F.col(text).cast("string")))


def accepted(verdict: str = "language") -> "F.Column":
    """Is the text, judged by identify(), in one of the languages?"""
    return (F.col(f"{verdict}.lang_pred") != UNKNOWN) & (F.col(f"{verdict}.phrase_rate") < TOO_MANY)
