"""Packing of documents into training sequences of several lengths, none of them with room to spare.

A document is cut into whole windows and a rest. Windows are sequences as they are. A rest is routed to the shortest
context size that holds it; sizes are powers of two. Each size is packed from the longest down: a rest opens a sequence,
the gap it leaves is filled with the longest whole rests of shorter sizes that fit, and what then remains is filled by
cutting one more. So a document is cut only to close a gap, and every sequence is as long as its size. The few tokens
that are left in a block at its end fill sequences of ever smaller powers of two. Sequences of one size form step groups
of equally many tokens, so that the steps of a training run cost alike.

Documents are dealt into blocks by hash, so blocks hold all sources and sizes alike; a block is packed by one task, and
the number of blocks follows the bytes of all texts. What moves is a rest's tokens, never a text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pavelake.llm.arrays import batches_of
from pavelake.llm.bpe import VOCABULARY, encoder
from pavelake.llm.common import pieces, text_or_empty

WINDOW = 2048
SMALLEST = 256  # the shortest size that rests are routed to
END = 1  # id put after each document
BLOCK_BYTES = 16 << 20  # texts of one block; a token has a byte at least, a block's rests are a part of it
STEP_TOKENS = 8 * WINDOW  # tokens of a step group
BATCH = 4 << 20  # characters that are encoded at a time


def sizes(window: int = WINDOW, smallest: int = SMALLEST) -> list[int]:
    """Context sizes from the longest down."""
    if window & (window - 1) or smallest & (smallest - 1) or not 0 < smallest <= window:
        raise ValueError("context sizes are powers of two")
    return [window >> k for k in range((window // smallest).bit_length())]


class Stock:
    """Rests by length, to take the longest under a bound. A bit tells which lengths there are."""

    def __init__(self, longest: int):
        self.by_length: list[list[tuple[int, int]]] = [[] for _ in range(longest + 1)]
        self.there = 0

    def put(self, length: int, doc: int, start: int) -> None:
        if length:
            self.by_length[length].append((doc, start))
            self.there |= 1 << length

    def longest(self, bound: int) -> int:
        """Length of the longest rest of at most that length; 0 where there is none."""
        return max((self.there & ((2 << bound) - 1)).bit_length() - 1, 0)

    def take(self, length: int) -> tuple[int, int]:
        found = self.by_length[length].pop()
        if not self.by_length[length]:
            self.there &= ~(1 << length)
        return found


def packed(lengths: list[int], contexts: list[int]) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (document, first token, tokens) of rests that are shorter than the longest context.

    All sequences are as long as one of the contexts, but for the last few, which are smaller powers of two.
    """
    stock, made = Stock(contexts[0]), []
    for doc, length in enumerate(lengths):
        stock.put(length, doc, 0)
    for size, shorter in zip(contexts, [*contexts[1:], 0]):
        while (opening := stock.longest(size)) > shorter:
            sequence, room = [], size
            length = opening
            while room and length:
                doc, start = stock.take(length)
                used = min(length, room)
                sequence.append((doc, start, used))
                stock.put(length - used, doc, start + used)
                room -= used
                # a whole rest that fits, else the longest of the shorter sizes, else any of this size, to be cut
                length = stock.longest(room) or stock.longest(shorter) or stock.longest(size)
            made += [sequence] if not room else _powers(sequence, size - room)
    return made


def _powers(pieces_: list[tuple[int, int, int]], total: int) -> list[list[tuple[int, int, int]]]:
    """The pieces, in order, dealt out to sequences of the powers of two that sum to the total."""
    made, left = [], list(reversed(pieces_))
    while total:
        room = size = 1 << (total.bit_length() - 1)
        sequence = []
        while room:
            doc, start, length = left.pop()
            used = min(length, room)
            sequence.append((doc, start, used))
            if used < length:
                left.append((doc, start + used, length - used))
            room -= used
        made.append(sequence)
        total -= size
    return made


def _tokens(path: str, window: int, end: int, ids: bool):
    """Per document: its tokens, the checksums of its windows, the tokens of its rest and, if wanted, of its windows."""
    def tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(path)
        for batch in batches:
            for run in batches_of(batch["text"].str.len().tolist(), BATCH):
                part, out = batch.iloc[run.start: run.stop], []
                for text in part["text"]:
                    found = np.append(encode(text), end).astype("<u4")
                    cut = len(found) // window * window
                    windows = found[:cut].reshape(-1, window)
                    out.append((len(found), [zlib.crc32(w) for w in windows], found[cut:].tobytes(), windows.tobytes() if ids else b""))
                yield pd.DataFrame(out, columns=["tokens", "sums", "rest", "windows"]).assign(
                    key=part["key"].to_numpy(), block=part["block"].to_numpy())

    return tokens


def _step_groups(contexts: np.ndarray, smallest: int, step_tokens: int) -> np.ndarray:
    """Consecutive sequences of one size make a group until it has its tokens; the smallest ones share the last."""
    group, out, held, size = 0, [], 0, None
    for context in contexts.tolist():
        kind = max(context, smallest // 2)
        if out and (kind != size or held + context > step_tokens):
            group, held = group + 1, 0
        size, held = kind, held + context
        out.append(group)
    return np.array(out, np.int64)


def _pack(contexts: list[int], step_tokens: int, ids: bool):
    window = contexts[0]

    def pack(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["key", "rest"], ignore_index=True)
        base = int(block["block"].iloc[0]) << 32
        tokens = block["tokens"].to_numpy(np.int64)
        rests = [np.frombuffer(r, "<u4") for r in block["rest"]]
        made = [[(doc, k * window, window)] for doc, n in enumerate(tokens.tolist()) for k in range(n // window)]
        full = len(made)
        made += packed([len(r) for r in rests], contexts)
        rows = []
        for number, sequence in enumerate(made):
            at = 0
            for doc, start, length in sequence:
                if number < full:
                    found = np.frombuffer(block["windows"].iloc[doc], "<u4")[start: start + length] if ids else None
                    rows.append((doc, start, length, block["sums"].iloc[doc][start // window], number, at, found))
                else:
                    found = rests[doc][start: start + length]
                    rows.append((doc, start + tokens[doc] // window * window, length, zlib.crc32(found), number, at, found if ids else None))
                at += length
        out = pd.DataFrame(rows, columns=["doc", "start", "length", "ids_crc32", "number", "offset", "ids"])
        context = out.groupby("number")["length"].sum().to_numpy()
        group = _step_groups(context, contexts[-1], step_tokens)
        doc, number = out["doc"].to_numpy(), out["number"].to_numpy()
        return out.drop(columns=["doc", "number"]).assign(
            key=block["key"].to_numpy()[doc], doc_tokens=tokens[doc], sequence_id=base + number, context=context[number],
            step_group=base + group[number])

    return pack


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = VOCABULARY, window: int = WINDOW,
         smallest: int = SMALLEST, end: int = END, step_tokens: int = STEP_TOKENS, ids: bool = False) -> DataFrame:
    """(key, start, length, ids_crc32, doc_tokens, sequence_id, offset, context, step_group[, ids]): one row a piece.

    A document is the ids of its text, then `end`; a null or empty text is `end` alone. start counts the document's ids
    before the piece, offset the sequence's; ids_crc32 is over the ids as unsigned 32-bit numbers, low byte first.
    context is the size of the sequence, which is full. Rows with equal or null keys are documents of their own.
    Columns other than key and text are not looked at. An empty table has no pieces.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), text_or_empty(text).alias("text"))
    # equal rows of different input partitions are dealt apart
    block = F.pmod(F.xxhash64("key", "text", F.spark_partition_id()), F.lit(pieces(rows, "text", BLOCK_BYTES)))
    found = rows.withColumn("block", block).mapInPandas(
        _tokens(path, window, end, ids), f"tokens long, sums array<long>, rest binary, windows binary, key {kind}, block long")
    made = found.groupBy("block").applyInPandas(
        _pack(sizes(window, smallest), step_tokens, ids),
        f"key {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, context long, "
        "step_group long, ids array<long>")
    return made.select(F.col("key").alias(key), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "context",
                       "step_group", *["ids"] * ids)
