"""Vectorised text helpers used inside Arrow batches."""

from __future__ import annotations

import ctypes
import time
from functools import lru_cache

import numpy as np
import pyarrow as pa

U = np.uint64
TRIM_AFTER = 1.0  # seconds between two times that a worker gives back memory it has no use for
_tables: dict[str, list] = {}
_trimmed = [0.0]


def table_of(operator: str):
    """Keep the last value of a function that makes a large table, until a task of another operator runs in the worker."""
    def cached(make):
        keeps = lru_cache(1)(make)
        _tables.setdefault(operator, []).append(keeps)
        return keeps

    return cached


def only(*operators: str) -> None:
    """Let go of the tables that other operators have left in this worker, which is used again from stage to stage.

    What they and earlier batches have freed goes back to the system, or else a worker stays as large as it ever was.
    """
    left = False
    for other, caches in _tables.items():
        if other not in operators:
            for cache in caches:
                left = left or cache.cache_info().currsize > 0
                cache.cache_clear()
    if left or time.monotonic() - _trimmed[0] > TRIM_AFTER:
        give_back()


@lru_cache(1)
def _trim():
    """The C library's call to return freed pages; None where it has none."""
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return the pages that Arrow and the C library hold free."""
    pa.default_memory_pool().release_unused()
    if trim := _trim():
        trim(0)
    _trimmed[0] = time.monotonic()


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all 64 bits (the finaliser of SplitMix64)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


BASE = U(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
INVERSE = U(pow(int(BASE), -1, 1 << 64))


@lru_cache(1)
def _values() -> np.ndarray:
    return mix((np.arange(0x110000, dtype=U) + U(1)) * U(0xD1B54A32D192ED03))


@lru_cache(2)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, 2**bits of them."""
    return tuple(np.concatenate([np.ones(1, U), np.cumprod(np.full((1 << bits) - 1, x, U))]) for x in (BASE, INVERSE))


def span_hashes(units: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each slice units[start:end]: a polynomial told by two prefix sums, then spread.

    Units are code points or bytes, or hashes of 64 bits, which are taken as they are.
    """
    if not len(starts):
        return np.zeros(0, U)
    power, inverse = _powers(max(16, int(len(units)).bit_length()))
    sums = np.concatenate([np.zeros(1, U), np.cumsum((units if units.dtype == U else _values()[units]) * power[: len(units)])])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(U))


def is_space(codes: np.ndarray) -> np.ndarray:
    return (codes == 32) | ((codes >= 9) & (codes <= 13))


def word_spans(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs without white space (space, tab, line breaks)."""
    inside = np.concatenate([[False], ~is_space(codes), [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def as_bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "replace"), dtype=np.uint8)


def word_hashes(text: str | None) -> np.ndarray:
    """One hash per word of the lower-cased text."""
    codes = as_bytes((text or "").lower())
    return span_hashes(codes, *word_spans(codes))


def rolled(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n words; a text of fewer words is one run, no words give none."""
    if not len(words):
        return words
    n = min(n, len(words))
    out = np.zeros(len(words) - n + 1, U)
    for k in range(n):
        out = mix(out * U(0x9E3779B97F4A7C15) + words[k: len(words) - n + 1 + k])
    return out


def side_by_side(symbols: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lay sequences out for stepping through all of them together, longest first.

    Returns (order, flat, begins): step k reads flat[begins[k]: begins[k + 1]], one symbol of each sequence that is
    longer than k, in the given order.
    """
    lengths = np.array([len(s) for s in symbols], np.int64)
    order = np.argsort(-lengths, kind="stable")
    lengths = lengths[order]
    steps = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(steps), side="left")
    begins = np.concatenate([[0], np.cumsum(active)]).astype(np.int64)
    flat = np.empty(int(begins[-1]), np.int64)
    if steps:
        joined = np.concatenate([symbols[i] for i in order])
        row = np.repeat(np.arange(len(lengths)), lengths)
        step = np.arange(len(joined)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        flat[begins[step] + row] = joined
    return order, flat, begins


def batches_of(sizes: list[int], limit: int) -> list[range]:
    """Consecutive runs of rows whose sizes sum to about the limit; a larger row is a run of its own."""
    runs, first, total = [], 0, 0
    for i, size in enumerate(sizes):
        total += size
        if total >= limit:
            runs.append(range(first, i + 1))
            first, total = i + 1, 0
    if first < len(sizes):
        runs.append(range(first, len(sizes)))
    return runs
