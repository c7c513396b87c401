"""Whole-batch word and shingle arithmetic on the UTF-8 buffers of Arrow string columns.

The operators that look at every word of every text (shingle joins, benchmark windows,
quality statistics, language models) share these numpy helpers.  They work inside
``mapInArrow`` tasks on slices of a few megabytes, so a task's memory does not depend on
how many rows Spark puts into a batch.  Only one text has to fit at a time.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that one step works on; a longer text is one step of its own.
STEP_BYTES = 1 << 20

_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))
_Q = np.uint64(0xC2B2AE3D27D4EB4F)
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


#: What this worker process keeps between tasks, one object at a time.
_resident: dict = {}


def resident(key: tuple, make: Callable):
    """One object for each worker process, kept for later tasks that ask for the same one."""
    if key not in _resident:
        _resident.clear()
        _resident[key] = make()
    return _resident[key]


def trimmed(task: Callable) -> Callable:
    """A batch function that gives freed memory back at its end.

    Workers stay alive beside the stages that follow, in the same memory limit as their executor."""

    def run(batches):
        yield from task(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc keeps freed blocks of many sizes otherwise
        if trim is not None:
            trim(0)

    return run


def settled(task: Callable) -> Callable:
    """A batch function that also starts without what other operators left in its worker."""

    def run(batches):
        _resident.clear()
        yield from trimmed(task)(batches)

    return run


def byte_table(members: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


#: Bytes of words that end at blanks and the controls from tab to carriage return.
BLANK_WORDS = ~byte_table(b" \t\n\v\f\r")
#: Bytes of words made of digits, letters and everything beyond ASCII.
ALNUM_WORDS = byte_table(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ" + bytes(range(128, 256)))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def steps(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) for slices of a string column; null reads as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    n = len(texts)
    if not n:
        return
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offs, data = texts.buffers()
    offsets = np.frombuffer(offs, np.int64 if wide else np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + STEP_BYTES, side="right")) - 1
        end = min(n, max(end, first + 1))
        yield first, end, raw[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        tables = []
        for base in (_P, _P_INV):
            t = np.full(n, base, np.uint64)
            t[0] = 1
            tables.append(np.multiply.accumulate(t))
        _powers = (tables[0], tables[1])
    return _powers


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that every bit depends on every input bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def lower(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def spans(data: np.ndarray, offsets: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words, and each text's first word (n + 1 entries)."""
    inside = members[data]
    if not len(inside):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    filled = offsets[:-1] < offsets[1:]
    heads, tails = offsets[:-1][filled], offsets[1:][filled] - 1
    first[heads] = inside[heads]
    last[tails] = inside[tails]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans; equal bytes give equal hashes in every task and text."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    power, inverse = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * _Q)


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each position on; len(words) - k + 1 of them, across texts too."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, k, np.uint64)
    for j in range(k):
        total = total * _P + words[j : j + n]
    return mix(total)


def gram_offsets(word_offsets: np.ndarray, k: int) -> np.ndarray:
    """How many k-grams each text has."""
    return np.maximum(np.diff(word_offsets) - k + 1, 0)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All of start, start + 1, ... of each range, in order."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(starts - (np.cumsum(counts) - counts), counts)
    return np.arange(total) + shift
