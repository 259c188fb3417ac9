"""Token counts of texts under a unigram model, by dynamic programming on a trie of their distinct words.

The pieces and their scores come from a public vocabulary: a piece's score is the logarithm of a Zipf law of its rank. Distinct words
of a stretch of text, each with a blank before it, are put into a trie. The best score of a prefix depends on the prefix alone, so it
is found once for each node, from the nodes of its ancestors and the pieces that end there; all nodes of a depth are worked on
together. Nodes where words end store their number of tokens and score, and texts add up those of their words.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadshift.llm.words import BYTE_BASE, distinct_spans, find_words, powers, slices, text_bytes, tidy

RESULT = "doc_id bigint, n_words bigint, n_tokens bigint, score double"
#: Trie nodes whose suffixes are looked up together.
LONG = 64


def read_pieces(path: str) -> dict[bytes, float]:
    """Pieces of a rank file (base64 and rank on each line) with their scores. Every single byte must be among them."""
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in Path(path).read_bytes().splitlines() if line)}
    total = sum(1 / (r + 1) for r in ranks.values())
    missing = [b for b in range(256) if bytes([b]) not in ranks]
    if missing:
        raise ValueError(f"single bytes without a piece: {missing}")
    return {p: float(-np.log((r + 1) * total)) for p, r in ranks.items()}


@dataclass
class Pieces:
    """For each length the sorted hashes of its pieces and their scores. A hash is the polynomial of the bytes, each plus one."""

    by_length: dict[int, tuple[np.ndarray, np.ndarray]]
    known: dict[bytes, float]

    @staticmethod
    def of(known: dict[bytes, float]) -> Pieces:
        lengths: dict[int, list[bytes]] = {}
        for p in known:
            # Words hold no white space but the blank in front.
            if not any(c in b" \t\n\v\f\r" for c in p[1:]):
                lengths.setdefault(len(p), []).append(p)
        out = {}
        for n, pieces in sorted(lengths.items()):
            data = np.frombuffer(b"".join(pieces), np.uint8).reshape(-1, n).astype(np.uint64) + np.uint64(1)
            hashes = (data * powers(BYTE_BASE, n)).sum(axis=1, dtype=np.uint64)
            order = np.argsort(hashes)
            out[n] = (hashes[order], np.array([known[p] for p in pieces])[order])
        return Pieces(out, known)


def best_split(word: bytes, pieces: Pieces) -> tuple[int, float]:
    """Tokens and score of one word; ties: the shorter last piece."""
    best = [(0.0, 0)] + [(-np.inf, 0)] * len(word)
    for end in range(1, len(word) + 1):
        for n in pieces.by_length:
            if n > end:
                break
            score = pieces.known.get(word[end - n : end])
            if score is not None and best[end - n][0] + score > best[end][0]:
                best[end] = (best[end - n][0] + score, best[end - n][1] + 1)
    return best[-1][1], best[-1][0]


def trie_counts(words: list[bytes], pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and score of each word (distinct, at most LONG bytes)."""
    order = sorted(range(len(words)), key=words.__getitem__)
    size = np.array([len(words[i]) for i in order], np.int64)
    depth = int(size.max()) if len(size) else 0
    letters = np.zeros((len(order), depth), np.uint64)
    letters[np.arange(depth) < size[:, None]] = np.frombuffer(b"".join(words[i] for i in order), np.uint8).astype(np.uint64) + np.uint64(1)
    power = powers(BYTE_BASE, depth + 1)
    inverse = powers(pow(BYTE_BASE, -1, 1 << 64), depth + 1)
    prefix = np.zeros((len(order), depth + 1), np.uint64)
    np.cumsum(letters * power[:depth], axis=1, out=prefix[:, 1:])
    # node[d][i]: number of word i's prefix of d bytes among the distinct ones; sorted words have equal prefixes side by side.
    node = np.zeros((depth + 1, len(order)), np.int32)
    score, count, first = [np.zeros(1)], [np.zeros(1, np.int32)], [np.zeros(1, np.int64)]
    tokens, total = np.zeros(len(order), np.int64), np.zeros(len(order))
    for d in range(1, depth + 1):
        live = np.flatnonzero(size >= d)
        own = prefix[live, d]
        new = np.append(True, own[1:] != own[:-1])
        node[d, live] = np.cumsum(new) - 1
        at = live[new]
        best, n = np.full(len(at), -np.inf), np.zeros(len(at), np.int32)
        for length, (hashes, scores) in pieces.by_length.items():
            if length > d:
                break
            suffix = (prefix[at, d] - prefix[at, d - length]) * inverse[d - length]
            place = np.minimum(np.searchsorted(hashes, suffix), len(hashes) - 1)
            found = np.flatnonzero(hashes[place] == suffix)
            above = node[d - length, at[found]]
            value = score[d - length][above] + scores[place[found]]
            better = value > best[found]
            best[found[better]] = value[better]
            n[found[better]] = count[d - length][above[better]] + 1
        score.append(best)
        count.append(n)
        first.append(at)
        end = live[size[live] == d]
        tokens[end], total[end] = n[node[d, end]], best[node[d, end]]
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    return tokens[back], total[back]


def _counter(known: dict[bytes, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces.of(known)
        for batch in batches:
            for rows in slices(batch, 1, 4 << 20):
                words = find_words(*text_bytes(rows.column(1)))
                at, which = distinct_spans(words.data, words.start, words.end)
                raw = words.data.tobytes()
                distinct = [b" " + raw[a:b] for a, b in zip(words.start[at].tolist(), words.end[at].tolist())]
                tokens, score = np.zeros(len(distinct), np.int64), np.zeros(len(distinct))
                short = np.array([len(w) <= LONG for w in distinct], bool)
                if short.any():
                    tokens[short], score[short] = trie_counts([w for w, s in zip(distinct, short) if s], pieces)
                for i in np.flatnonzero(~short):
                    tokens[i], score[i] = best_split(distinct[i], pieces)
                sums = [np.concatenate([[0], np.cumsum(x[which])]) for x in (tokens, score)]
                each = [s[words.bounds[1:]] - s[words.bounds[:-1]] for s in sums]
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(words.counts), pa.array(each[0].astype(np.int64)), pa.array(each[1].astype(np.float64))], ["doc_id", "n_words", "n_tokens", "score"])

    return run


def count_tokens(docs: DataFrame, pieces: str) -> DataFrame:
    """doc_id, n_words, n_tokens and score (log-probability of the best split) of each text.

    `pieces` is a rank file, read on the driver. Words are runs without white space. Null or empty text: no words, no tokens, score 0.
    Ties between splits: the shorter last piece. Rows with equal or null doc_id are counted each for itself. Extra columns are not
    read; an empty table gives an empty table.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(tidy(_counter(read_pieces(pieces))), RESULT)
