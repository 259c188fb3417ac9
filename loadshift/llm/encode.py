"""Token ids of whole text columns by a public tokenizer, encoding each distinct unit of text once per task.

A unit ends where a blank or line feed follows a character that is surely no white space, or an ASCII non-letter follows a letter.
The pattern of the tokenizer never matches across such a place (a blank stands only at the front of a match, and a letter is
never followed by a non-letter in one), so the ids of a text are those of its units in order.
"""

from __future__ import annotations

import os
from pathlib import Path

import numpy as np

from loadshift.llm.words import distinct_spans, same_bytes, span_hashes

#: Units kept at once; beyond it the cache starts anew, which costs time only.
CACHE_UNITS = 400_000
CACHE_BYTES = 1 << 28
JOINED_BYTES = 1 << 16


def tokenizer_json(path: str) -> str:
    """Read on the driver and sent with the job, so executors need no such file."""
    return Path(path).read_text(encoding="utf-8")


def unit_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n = len(data)
    cut = np.zeros(n + 1, bool)
    if n > 1:
        here, after = data[:-1], data[1:]
        blank = (after == 0x20) | (after == 0x0A)
        solid = (here >= 0x21) & (here <= 0x7E)
        letter = ((here | 0x20) >= 0x61) & ((here | 0x20) <= 0x7A)
        # U+00C0 to U+00FF are bytes C3 80 to C3 BF; all but two are letters.
        latin = np.zeros(n - 1, bool)
        latin[1:] = (data[:-2] == 0xC3) & (data[1:-1] >= 0x80) & (data[1:-1] <= 0xBF) & ((data[1:-1] & 0xDF) != 0x97)
        other = (after < 0x80) & (((after | 0x20) < 0x61) | ((after | 0x20) > 0x7A))
        cut[1:n] = (blank & solid) | ((letter | latin) & other)
    cut[offsets] = True
    cut[n] = False
    return np.flatnonzero(cut)


class Encoder:
    """ids(data, offsets) returns all ids and the offsets of the rows among them. Known units are found by a hash of their bytes, which are kept and
    compared before ids are used again; a unit whose hash another one has is encoded each time it comes."""

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        # A token is written with one character for each of its bytes.
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.width = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.width[i] = len(token)
        self._clear()

    def _within_added(self, data: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Which places lie within the string of an added token, which the library takes out of a text before all else."""
        inside = np.zeros(len(places), bool)
        raw = data.tobytes() if self.added else b""
        for token in self.added:
            at = raw.find(token)
            while at >= 0:
                inside |= (places > at) & (places < at + len(token))
                at = raw.find(token, at + 1)
        return inside

    def _clear(self) -> None:
        self.known = np.zeros(0, np.uint64)
        # Places and sizes stay far below 2^31.
        self.entry = np.zeros(0, np.int32)
        self.first = np.zeros(0, np.int32)
        self.size = np.zeros(0, np.int32)
        self.flat = np.zeros(0, np.uint32)
        # Bytes of the known units, and where each begins and ends.
        self.held = np.zeros(0, np.uint8)
        self.begin = np.zeros(0, np.int32)
        self.stop = np.zeros(0, np.int32)

    def _encode(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The units' order here, the number of ids of each and all ids. Units that begin with a blank and end solidly are encoded joined, about 64 KB at
        once, and told apart by the byte lengths of their ids; the others one by one."""
        lead, tail = data[start], data[end - 1]
        second = data[np.minimum(start + 1, len(data) - 1)]
        joined = ((lead == 0x20) | (lead == 0x0A)) & (end - start > 1) & (second >= 0x21) & (second <= 0x7E) & (tail >= 0x21) & (tail <= 0x7E)
        order = np.concatenate([np.flatnonzero(joined), np.flatnonzero(~joined)])
        n, ids = int(joined.sum()), []
        length = (end - start)[order]
        stop = np.cumsum(length)
        raw = data[np.repeat(start[order] - stop + length, length) + np.arange(int(stop[-1]) if len(stop) else 0)].tobytes()
        group = (stop[:n] - 1) // JOINED_BYTES
        last = np.append(np.flatnonzero(np.diff(group)) + 1, n) if n else np.zeros(0, np.int64)
        cuts = [0, *stop[last - 1].tolist()] if n else [0]
        texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:])]
        for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False):
            ids.append(np.array(e.ids, np.uint32))
        flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
        ends = np.cumsum(self.width[flat])
        place = np.searchsorted(ends, stop[:n])
        if n and (place[-1] != len(ends) - 1 or (ends[place] != stop[:n]).any()):
            raise AssertionError("an id spans two units")
        size = [np.diff(np.concatenate([[-1], place])).astype(np.int64)]
        alone = [e.ids for e in self.tokenizer.encode_batch_fast([raw[b - c : b].decode("utf-8", "replace") for b, c in zip(stop[n:].tolist(), length[n:].tolist())], add_special_tokens=False)]
        size.append(np.fromiter(map(len, alone), np.int64, len(alone)))
        flat = np.concatenate([flat, np.fromiter((i for x in alone for i in x), np.uint32, int(size[1].sum()))])
        return order, np.concatenate(size), flat

    def _learn(self, hashes: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Encodes units and keeps them; the entries of the units. Of several with one hash the first one kept is found again."""
        order, size, flat = self._encode(data, start, end)
        entry = np.empty(len(order), np.int64)
        entry[order] = len(self.first) + np.arange(len(order))
        length = (end - start)[order]
        stop = np.cumsum(length)
        take = np.repeat(start[order] - stop + length, length) + np.arange(int(stop[-1]) if len(stop) else 0)
        self.begin = np.concatenate([self.begin, (len(self.held) + stop - length).astype(np.int32)])
        self.stop = np.concatenate([self.stop, (len(self.held) + stop).astype(np.int32)])
        self.held = np.concatenate([self.held, data[take]])
        self.first = np.concatenate([self.first, (len(self.flat) + np.cumsum(size) - size).astype(np.int32)])
        self.size = np.concatenate([self.size, size.astype(np.int32)])
        self.flat = np.concatenate([self.flat, flat])
        known, entries = np.concatenate([self.known, hashes]), np.concatenate([self.entry, entry.astype(np.int32)])
        order = np.argsort(known, kind="stable")
        self.known, self.entry = known[order], entries[order]
        return entry

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        start = unit_starts(data, offsets)
        start = start[~self._within_added(data, start)]
        if not len(start):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        end = np.append(start[1:], len(data))
        at, which = distinct_spans(data, start, end)
        begin, stop = start[at], end[at]
        hashes = span_hashes(data, begin, stop)
        if len(self.known) > CACHE_UNITS or len(self.held) > CACHE_BYTES:
            self._clear()
        entry = np.full(len(at), -1)
        if len(self.known):
            place = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
            hit = np.flatnonzero(self.known[place] == hashes)
            of = self.entry[place[hit]]
            same = same_bytes(data, begin[hit], stop[hit], self.held, self.begin[of].astype(np.int64), self.stop[of].astype(np.int64))
            entry[hit[same]] = of[same]
        new = np.flatnonzero(entry < 0)
        if len(new):
            entry[new] = self._learn(hashes[new], data, begin[new], stop[new])
        unit = entry[which]
        size = self.size[unit].astype(np.int64)
        stop = np.cumsum(size)
        # Ragged copy: each id's place in the cache is its unit's first place plus its number within the unit.
        take = np.repeat(self.first[unit] - stop + size, size) + np.arange(int(stop[-1]) if len(stop) else 0)
        bounds = np.concatenate([[0], stop])[np.searchsorted(start, offsets)]
        return self.flat[take], bounds
