"""Words of whole Arrow text columns as numpy arrays: boundaries, 64-bit hashes and hashes of word windows.

A word is a run of bytes other than 0x20 and 0x09-0x0D, which in UTF-8 equals `[^\\x20\\x09-\\x0D]+` on characters. A word's hash mixes
eight bytes at a time. Windows have Rabin-Karp hashes: polynomials of their words' hashes modulo the prime 2**61 - 1, from running sums,
so a window costs the same at any length.
"""

from __future__ import annotations

import contextlib
import ctypes
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19
#: Name of the module that once_per_worker() fills.
WORKER = "loadshift_worker"
Batches = Iterator[pa.RecordBatch]
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD6E8FEB86659FD93


def tidy(run: Callable[[Batches], Batches], keeps: tuple[str, ...] = ()) -> Callable[[Batches], Batches]:
    """A function on Arrow batches that drops what earlier kinds of tasks keep in the worker, but for `keeps`, and hands freed memory
    back to the system when a task is over. Workers wait for further tasks, and would hold it beside the memory that Spark itself
    needs then."""

    def task(batches: Batches) -> Batches:
        kept = vars(sys.modules[WORKER]) if WORKER in sys.modules else {}
        for key in [k for k in kept if not k.startswith("__") and k not in keeps]:
            del kept[key]
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # only the GNU library has it
        ctypes.CDLL(None).malloc_trim(0)


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every input bit over the result (one to one)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base), np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows; null counts as empty."""
    column = pc.fill_null(column, "") if column.null_count else column
    _, offsets, data = column.buffers()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if not len(at):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body[at[0] : at[-1]], at - at[0]


def slices(batch: pa.RecordBatch, text: int, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row ranges of a batch with about `size` bytes of text each; a longer text is a range of its own."""
    _, at = text_bytes(batch.column(text))
    first = 0
    while first < batch.num_rows:
        last = max(first + 1, int(np.searchsorted(at, at[first] + size, "right")) - 1)
        yield batch.slice(first, last - first)
        first = last


@dataclass
class Words:
    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    bounds: np.ndarray  # of each document, in words

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)


def find_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(data, none, none, np.zeros(len(offsets), np.int64))
    inside = (data != 0x20) & ((data < 0x09) | (data > 0x0D))
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    start = np.flatnonzero(inside & (~before | edge[:n]))
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, inside[1:]
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return Words(data, start, end, np.searchsorted(start, offsets))


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)


#: Spans of more bytes are hashed one by one.
LONG_SPAN = 256
PRIME = np.uint64((1 << 61) - 1)
#: Two numbers drawn at random once.
BASES = (0x0E4F9C1D7A35B862, 0x13A87D5E20C94F1B)


def reduced(x: np.ndarray) -> np.ndarray:
    """Modulo PRIME."""
    x = (x >> np.uint64(61)) + (x & PRIME)
    return np.where(x >= PRIME, x - PRIME, x)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo PRIME of numbers below it, by halves of 32 bits: 2**64 is 8, and 2**61 is 1."""
    low = np.uint64(0xFFFFFFFF)
    a1, a0, b1, b0 = a >> np.uint64(32), a & low, b >> np.uint64(32), b & low
    middle, last = a1 * b0 + a0 * b1, a0 * b0
    out = (a1 * b1) << np.uint64(3)
    out += middle >> np.uint64(29)
    out += (middle & np.uint64((1 << 29) - 1)) << np.uint64(32)
    out += (last >> np.uint64(61)) + (last & PRIME)
    return reduced(out)


def running(values: np.ndarray) -> np.ndarray:
    """Sums modulo PRIME of the first 0, 1, 2, ... values."""
    high, low = (np.zeros(len(values) + 1, np.uint64) for _ in range(2))
    np.cumsum(values >> np.uint64(32), out=high[1:])
    np.cumsum(values & np.uint64(0xFFFFFFFF), out=low[1:])
    high = reduced((high >> np.uint64(29)) + ((high & np.uint64((1 << 29) - 1)) << np.uint64(32)))
    return reduced(high + reduced(low))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range. No two ranges of one size up to eight bytes have the same one."""
    import xxhash

    size = end - start
    out = mix(size.astype(np.uint64) * np.uint64(WORD_BASE) + np.uint64(BYTE_BASE))
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    eights = np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))
    live = np.flatnonzero((size > 0) & (size <= LONG_SPAN))
    for done in range(0, LONG_SPAN, 8):
        if done:
            live = live[size[live] > done]
        if not len(live):
            break
        left = size[live] - done
        part = eights[start[live] + done]
        short = left < 8
        part[short] &= (np.uint64(1) << (np.uint64(8) * left[short].astype(np.uint64))) - np.uint64(1)
        out[live] = mix(out[live] ^ part) + np.uint64(BYTE_BASE)
    for i in np.flatnonzero(size > LONG_SPAN):
        out[i] = xxhash.xxh3_64_intdigest(data[start[i] : end[i]].tobytes(), BYTE_BASE)
    return out


def same_bytes(data: np.ndarray, start: np.ndarray, end: np.ndarray, other: np.ndarray, at: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Whether each range of `data` holds the same bytes as the range of `other` beside it, which has the same hash. Up to eight bytes, size
    and hash tell."""
    size = end - start
    equal = size == to - at
    for first in range(0, len(start), 1 << 14):
        here = np.flatnonzero(equal[first : first + (1 << 14)] & (size[first : first + (1 << 14)] > 8)) + first
        if not len(here):
            continue
        n = size[here]
        stop = np.cumsum(n)
        step = np.arange(int(stop[-1])) - np.repeat(stop - n, n)
        differs = data[np.repeat(start[here], n) + step] != other[np.repeat(at[here], n) + step]
        equal[here] = np.add.reduceat(differs, stop - n, dtype=np.int64) == 0
    return equal


def distinct_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct byte range, and for each range the number of its own among them. Ranges are distinct by their bytes."""
    _, at, which = np.unique(span_hashes(data, start, end), return_index=True, return_inverse=True)
    odd = np.flatnonzero(~same_bytes(data, start, end, data, start[at][which], end[at][which]))
    known: dict[bytes, int] = {}
    for i in odd:  # unlike ranges with one hash
        which[i] = known.setdefault(data[start[i] : end[i]].tobytes(), len(at))
        if which[i] == len(at):
            at = np.append(at, i)
    return at, which


class Hasher:
    """Keeps tables of powers, which grow to the longest slice seen."""

    def __init__(self):
        self.tables: dict[int, np.ndarray] = {}

    def table(self, base: int, n: int) -> np.ndarray:
        """Powers of a base modulo PRIME."""
        have = self.tables.get(base)
        have = np.ones(1, np.uint64) if have is None else have
        while len(have) < n:
            step = np.array([pow(base, len(have), int(PRIME))], np.uint64)
            have = np.concatenate([have, times(have, np.broadcast_to(step, have.shape))])
        self.tables[base] = have
        return have

    def spans(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A hash of each byte range."""
        return span_hashes(data, start, end)

    def rolling(self, words: Words, hashes: np.ndarray, length: int, base: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """First words and Rabin-Karp hashes, by one of BASES, of all windows of `length` words that lie in one document."""
        last = np.repeat(words.bounds[1:], words.counts)
        at = np.flatnonzero(np.arange(len(hashes)) + length <= last)
        n = len(hashes)
        inverse = pow(BASES[base], -1, int(PRIME))
        sums = running(times(reduced(hashes), self.table(BASES[base], n + 1)[:n]))
        gap = reduced(sums[at + length] + (PRIME - sums[at]))
        return at, mix(times(gap, self.table(inverse, n + 1)[at]))

    def windows(self, words: Words, hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """First words and hashes of all windows of a few words that lie in one document."""
        last = np.repeat(words.bounds[1:], words.counts)
        at = np.flatnonzero(np.arange(len(hashes)) + length <= last)
        out = np.full(len(at), np.uint64(BYTE_BASE))
        for k in range(length):
            out = mix(out ^ hashes[at + k]) + np.uint64(WORD_BASE)
        return at, out

    def sequences(self, hashes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of word sequences of any length, apart from those of windows."""
        size = end - start
        out = mix(size.astype(np.uint64) + np.uint64(WORD_BASE))
        for k in range(int(size.max(initial=0))):
            live = np.flatnonzero(size > k)
            out[live] = mix(out[live] ^ hashes[start[live] + k]) + np.uint64(WORD_BASE)
        return out
