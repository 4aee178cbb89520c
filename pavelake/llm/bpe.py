"""Byte-level BPE by a table of distinct words.

Documents are dealt into blocks. Each block lists its distinct words once; the lists meet by word bucket, where
each distinct word is encoded once, and the ids go back to the blocks, which join them to the words by position.
Text moves once, compressed, and what moves for words is a block's vocabulary, not its tokens.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pavelake.llm.arrays import only, span_hashes, table_of
from pavelake.llm.common import pieces, text_or_empty

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
BLOCK_BYTES = 8 << 20  # text of one block; a task holds a few times as much
STRIDE = 1 << 18  # characters that are split at a time
IDS_AT_ONCE = 1 << 18  # ids that are handed on at a time, in whole texts
WORDS_KEPT = 50_000  # words a task remembers the ids of before it starts afresh
LONG_GAP = re.compile(r"\s{10000}")
OTHER, LETTER, NUMBER, SPACE, UNKNOWN = range(5)


@table_of("bpe")
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.no_truncation(), made.no_padding()
    return made


@table_of("bpe")
def _classes() -> np.ndarray:
    """Class of each code point. Those that this Python's tables do not know are left to the tokenizer."""
    out = np.zeros(0x110000, np.uint8)
    for code in range(0x110000):
        kind = unicodedata.category(chr(code))
        out[code] = LETTER if kind[0] == "L" else NUMBER if kind[0] == "N" else UNKNOWN if kind == "Cn" else OTHER
    # The characters of the Unicode property White_Space.
    out[[9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = SPACE
    return out


def split(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Starts of the words of the byte-level pattern in code points; first marks where texts start.

    The pattern is 's|'t|'re|'ve|'m|'ll|'d| ?L+| ?N+| ?other+|space+(?!non-space)|space+. It is told by runs of one
    class: a blank before a run belongs to it, and a lone apostrophe not after a blank may take letters that follow.
    """
    kind = _classes()[codes]
    n = len(codes)
    edge = first.copy()
    edge[1:] |= kind[1:] != kind[:-1]
    starts = np.flatnonzero(edge)
    ends = np.append(starts[1:], n)
    run = kind[starts]
    last = np.append(first[starts[1:]], True)  # no run follows in this text
    word = edge
    gap = (run == SPACE) & ~last
    word[ends[gap] - 1] = True
    blank = gap & (codes[ends - 1] == 32)
    word[ends[blank]] = False
    alone = (run[:-1] == OTHER) & (codes[starts[:-1]] == 39) & (ends[:-1] - starts[:-1] == 1) & ~last[:-1] & (run[1:] == LETTER)
    alone[1:] &= ~blank[:-2]
    at = starts[1:][alone]
    size = ends[1:][alone] - at
    one = codes[at]
    two = np.where(size > 1, codes[np.minimum(at + 1, n - 1)], 0)
    taken = np.where(np.isin(one, [ord(c) for c in "stmd"]), 1, 0)
    for pair in ("re", "ve", "ll"):
        taken = np.where((one == ord(pair[0])) & (two == ord(pair[1])), 2, taken)
    word[at[taken > 0]] = False
    rest = taken < size
    word[(at + taken)[(taken > 0) & rest]] = True
    return np.flatnonzero(word)


def _strides(texts: list[str], marker: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list, str]]:
    """Runs of texts of about STRIDE characters: (codes, word starts, word ends, segments, joined text).

    A segment is (row, first character, end); between two segments of one row stands the marker token.
    """
    rows: list[tuple[int, int, int]] = []
    parts: list[str] = []
    at = 0
    for row, text in enumerate(texts):
        for part in text.split(marker):
            rows.append((row, at, at + len(part)))
            parts.append(part)
            at += len(part)
        if at >= STRIDE or row == len(texts) - 1:
            joined = "".join(parts)
            codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
            first = np.zeros(len(codes) + 1, bool)
            first[[a for _, a, _ in rows]] = True
            starts = split(codes, first[:-1]) if len(codes) else np.zeros(0, np.int64)
            yield codes, starts, np.append(starts[1:], len(codes))[: len(starts)], rows, joined
            rows, parts, at = [], [], 0


def _packed(values: np.ndarray | bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(values if isinstance(values, bytes) else values.tobytes())


def _unpacked(value: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(value)


def _pack_texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row for the texts of a batch that go to one block, compressed together."""
    only("bpe")
    for batch in batches:
        out = []
        for block, rows in batch.groupby("block", sort=False):
            texts = [t.encode("utf-8", "surrogatepass") for t in rows["text"]]
            out.append((block, rows["key"].tolist(), _packed(np.array([len(t) for t in texts], np.int64)), _packed(b"".join(texts))))
        yield pd.DataFrame(out, columns=["block", "keys", "sizes", "texts"])


def _texts(block: pd.DataFrame | dict[str, list[bytes]]) -> Iterator[list[str]]:
    """The texts of each row of a block."""
    for sizes, texts in zip(block["sizes"], block["texts"]):
        ends, whole = np.cumsum(np.frombuffer(_unpacked(sizes), np.int64)).tolist(), _unpacked(texts)
        yield [whole[a:b].decode("utf-8", "surrogatepass") for a, b in zip([0, *ends], ends)]


def _marker(path: str) -> tuple[str, int]:
    """The special token whose string is an id of its own wherever it stands in a text."""
    added = _tokenizer(path).get_added_tokens_decoder()
    if len(added) != 1:
        raise ValueError("a vocabulary with one added token is expected")
    return next((token.content, number) for number, token in added.items())


def _distinct(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in the order in which a block lists its words: by bucket, then by hash; and the buckets."""
    found = np.unique(hashes)
    bucket = (found % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return found[order], bucket[order]


def _list_words(path: str, buckets: int):
    def words(block: pd.DataFrame) -> pd.DataFrame:
        only("bpe")
        known: dict[int, str] = {}
        marker = _marker(path)[0]
        for codes, starts, ends, _, joined in (s for texts in _texts(block) for s in _strides(texts, marker)):
            hashes, at = np.unique(span_hashes(codes, starts, ends), return_index=True)
            for h, a, b in zip(hashes.tolist(), starts[at].tolist(), ends[at].tolist()):
                if h not in known:
                    known[h] = joined[a:b]
        listed, bucket = _distinct(np.array(list(known), np.uint64), buckets)
        cuts = np.flatnonzero(np.diff(bucket)) + 1
        groups = np.split(listed, cuts) if len(listed) else []
        lists = [[known[h].encode("utf-8", "surrogatepass") for h in g.tolist()] for g in groups]
        return pd.DataFrame({
            "block": block["block"].iloc[0], "bucket": [int(g[0] % np.uint64(buckets)) for g in groups],
            "sizes": [_packed(np.array([len(w) for w in words], np.int32)) for words in lists],
            "words": [_packed(b"".join(words)) for words in lists]})

    return words


def _encode_words(path: str):
    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fast, known = encoder(path), {}
        for batch in batches:
            only("bpe ranks", "bpe")
            sizes, ids = [], []
            for lengths, joined in zip(batch["sizes"], batch["words"]):
                ends, joined = np.cumsum(np.frombuffer(_unpacked(lengths), np.int32)).tolist(), _unpacked(joined)
                words = [joined[a:b] for a, b in zip([0, *ends], ends)]
                if len(known) > WORDS_KEPT:
                    known = {}
                for w in words:
                    if w not in known:
                        known[w] = fast(w.decode("utf-8", "surrogatepass")).tobytes()
                found = [known[w] for w in words]
                sizes.append(_packed(np.array([len(x) // 4 for x in found], np.int32)))
                ids.append(_packed(b"".join(found)))
            yield pd.DataFrame({"block": batch["block"], "bucket": batch["bucket"], "sizes": sizes, "ids": ids})

    return encode


@table_of("bpe")
def pieces_of(path: str) -> tuple[np.ndarray, np.ndarray]:
    """The id-to-piece table of the vocabulary, by id: bytes of all pieces and where each starts."""
    made = _tokenizer(path)
    # the printable stand-ins of the 256 bytes, made by the usual rule
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    stand_in = {chr(b): b for b in plain}
    stand_in |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
    added = {number: token.content for number, token in made.get_added_tokens_decoder().items()}
    out = [added[i].encode() if i in added else bytes(stand_in[c] for c in made.id_to_token(i)) for i in range(made.get_vocab_size())]
    return np.frombuffer(b"".join(out), np.uint8), np.cumsum([0, *map(len, out)])


def _gather(values: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The slices values[begin: begin + length], one after the other."""
    ends = np.cumsum(lengths)
    return values[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(begins - (ends - lengths), lengths)]


def _joined(ids: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> bytes:
    values, begins = table
    return _gather(values, begins[ids], begins[ids + 1] - begins[ids]).tobytes()


@table_of("bpe ranks")
def _by_rank(path: str):
    """The vocabulary of the file as byte pairs by rank, which another library encodes whole texts by several times faster.

    Ids must follow the merges, so that a pair's id is its rank; a file where they don't raises.
    """
    import tiktoken

    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    merges = [m if isinstance(m, str) else " ".join(m) for m in model["merges"]]
    if any(model["vocab"][m.replace(" ", "")] != 256 + i for i, m in enumerate(merges)):
        raise ValueError("a vocabulary whose ids follow its merges is expected")
    values, begins = pieces_of(path)
    raw = values.tobytes()
    added = _tokenizer(path).get_added_tokens_decoder()
    ranks = {raw[begins[i]: begins[i + 1]]: i for i in range(len(begins) - 1) if i not in added}
    return tiktoken.Encoding("by rank", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoder(path: str = VOCABULARY):
    """A function from a text to its ids for use inside a task: those of the tokenizer without special tokens around it.

    Runs of blanks that are too long for the fast way are left to the tokenizer itself.
    """
    made, fast = _tokenizer(path), _by_rank(path)
    marker, marker_id = _marker(path)

    def encode(text: str) -> np.ndarray:
        if LONG_GAP.search(text):
            return np.array(made.encode(text, add_special_tokens=False).ids, np.int32)
        first, *rest = text.split(marker)
        ids = fast.encode_ordinary(first)
        for part in rest:
            ids.append(marker_id)
            ids += fast.encode_ordinary(part)
        return np.array(ids, np.int32)

    return encode


@table_of("bpe")
def _strings_of(path: str) -> tuple[list[bytes], list[str]]:
    """The piece and the decimals of each id."""
    values, begins = pieces_of(path)
    raw, ends = values.tobytes(), begins.tolist()
    return [raw[a:b] for a, b in zip(ends, ends[1:])], [str(i) for i in range(len(ends) - 1)]


def _batch(done: list[tuple], wanted: tuple[str, ...], keys: pa.Array) -> pa.RecordBatch:
    """What was made of a few texts, as Arrow columns."""
    def column(name: str, values: tuple) -> pa.Array:
        if name != "ids":
            return pa.array(values, pa.int64() if KINDS[name] == "long" else pa.string())
        ends = np.cumsum([0, *map(len, values)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(values).astype(np.int32, copy=False)))

    return pa.RecordBatch.from_arrays([keys, *map(column, wanted, zip(*done))], ["key", *wanted])


def _place_ids(path: str, buckets: int, wanted: tuple[str, ...]):
    """Ids, decoded texts or their digests, of the texts of a block. Words are told twice, stride by stride: first for
    the order in which the block listed them, then to place their ids; so no more than a stride's words are held. Results
    become Arrow batches of a few texts, so that neither this worker nor Spark holds those of a block twice."""
    def finish(text: str, row: np.ndarray, sure: bool) -> tuple:
        pieces_by_id, decimals = _strings_of(path)
        ids, whole = row.tolist(), text.encode("utf-8", "surrogatepass")
        # the tokenizer takes texts with unknown characters, and any that a clash of word hashes would spoil
        if not sure or b"".join([pieces_by_id[i] for i in ids]) != whole:
            row = np.array(_tokenizer(path).encode(text, add_special_tokens=False).ids, np.int32)
            ids = row.tolist()
            whole = b"".join([pieces_by_id[i] for i in ids])
        decoded = whole.decode("utf-8", "replace")
        given = {"ids": lambda: row, "decoded": lambda: decoded, "n_tokens": lambda: len(ids),
                 "ids_sha256": lambda: hashlib.sha256(",".join([decimals[i] for i in ids]).encode()).hexdigest(),
                 "decoded_sha256": lambda: hashlib.sha256(decoded.encode()).hexdigest()}
        return tuple(given[w]() for w in wanted)

    def place(dealt: pa.Table, encoded: pa.Table) -> pa.Table:
        only("bpe")
        marker, marker_id = _marker(path)
        keys = pc.list_flatten(dealt["keys"]).combine_chunks()
        if pa.types.is_timestamp(keys.type) and keys.type.tz:
            keys = keys.cast(pa.timestamp("us", "UTC"))
        block = {name: dealt[name].to_pylist() for name in ("sizes", "texts")}
        encoded = encoded.sort_by("bucket")
        sizes = np.frombuffer(b"".join(map(_unpacked, encoded["sizes"].to_pylist())), np.int32).astype(np.int64)
        ids = np.frombuffer(b"".join(map(_unpacked, encoded["ids"].to_pylist())), np.int32)
        begins = np.cumsum(sizes) - sizes
        found = [np.unique(span_hashes(codes, starts, ends)) for texts in _texts(block) for codes, starts, ends, _, _ in _strides(texts, marker)]
        listed, _ = _distinct(np.concatenate(found) if found else np.zeros(0, np.uint64), buckets)
        order = np.argsort(listed)
        listed, done, held, given, batches = listed[order], [], 0, 0, []
        for texts in _texts(block):
            out: list[list[np.ndarray]] = [[] for _ in texts]
            first = 0
            for codes, starts, ends, rows, _ in _strides(texts, marker):
                word = order[np.searchsorted(listed, span_hashes(codes, starts, ends))] if len(listed) else np.zeros(0, np.int64)
                size = sizes[word]
                flat = _gather(ids, begins[word], size)
                passed = np.concatenate([[0], np.cumsum(size)])
                for row, a, b in rows:
                    i, j = np.searchsorted(starts, [a, b])
                    if out[row]:
                        out[row].append(np.array([marker_id], ids.dtype))
                    out[row].append(flat[passed[i]: passed[j]])
                unknown = np.flatnonzero(_classes()[codes] == UNKNOWN)
                strange = {rows[i][0] for i in np.searchsorted([b for _, _, b in rows], unknown, side="right").tolist()}
                for row in range(first, rows[-1][0] + 1):  # a stride ends with a whole text
                    row_ids = np.concatenate(out[row])
                    done.append(finish(texts[row], row_ids, row not in strange))
                    held += len(row_ids)
                    out[row] = []
                    if held >= IDS_AT_ONCE or given + len(done) == len(keys):
                        batches.append(_batch(done, wanted, keys[given: given + len(done)]))
                        done, held, given = [], 0, given + len(done)
                first = rows[-1][0] + 1
        return pa.Table.from_batches(batches)

    return place


KINDS = {"ids": "array<int>", "decoded": "string", "n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}


def _encoded(docs: DataFrame, key: str, text: str, path: str, wanted: tuple[str, ...]) -> DataFrame:
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), text_or_empty(text).alias("text"))
    blocks = pieces(rows, "text", BLOCK_BYTES)
    buckets = max(16, min(1024, blocks))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("key", "text"), F.lit(blocks)).cast("int"))
    dealt = dealt.mapInPandas(_pack_texts, f"block int, keys array<{kind}>, sizes binary, texts binary")
    words = dealt.groupBy("block").applyInPandas(_list_words(path, buckets), "block int, bucket int, sizes binary, words binary")
    encoded = words.repartition("bucket").mapInPandas(_encode_words(path), "block int, bucket int, sizes binary, ids binary")
    placed = dealt.groupBy("block").cogroup(encoded.groupBy("block")).applyInArrow(
        _place_ids(path, buckets, wanted), ", ".join([f"key {kind}", *(f"{w} {KINDS[w]}" for w in wanted)]))
    return placed.select(F.col("key").alias(key), *wanted)


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = VOCABULARY, decoded: bool = False) -> DataFrame:
    """(key, ids) for every row: the ids that the tokenizer gives without special tokens around the text.

    With decoded, the text that the ids decode to is a further column; the round trip then needs no second pass.

    A null or empty text has no ids. The string of the added token is that token, as the tokenizer reads it.
    Equal and null keys stay separate rows. Other columns are not looked at.
    """
    return _encoded(docs, key, text, path, ("ids", "decoded") if decoded else ("ids",))


def decode(encoded: DataFrame, key: str = "doc_id", ids: str = "ids", path: str = VOCABULARY) -> DataFrame:
    """(key, text): each id joined with its piece, the pieces of a row put together in order.

    The id-to-piece table has the fixed size of the vocabulary, so every task holds it and ids need not move.
    Bytes that are not UTF-8 become replacement characters. Null ids give an empty text; unknown ids raise.
    """
    kind = encoded.schema[key].dataType.simpleString()

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = pieces_of(path)
        for batch in batches:
            yield pd.DataFrame({"key": batch["key"], "text": [
                "" if x is None else _joined(np.asarray(x, np.int64), table).decode("utf-8", "replace") for x in batch["ids"]]})

    return encoded.select(F.col(key).alias("key"), F.col(ids).alias("ids")).mapInPandas(
        join, f"key {kind}, text string").select(F.col("key").alias(key), "text")


def digest(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = VOCABULARY, ids: bool = False) -> DataFrame:
    """Counts and digests of ids and decoded texts, with the ids if they are wanted."""
    return _encoded(docs, key, text, path, ("n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * ids))
