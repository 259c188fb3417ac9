"""Removal of word windows that also start in an earlier document.

Rabin-Karp hashes of every window of fixed length are counted over the whole corpus: each block of documents sends the distinct
hashes of its windows, sorted and packed, to the task of their hash range; that task returns to each block the hashes that an
earlier block holds too. Documents meet their block's answer, mark all covered words and keep the rest. Windows shared by any
number of copies cross the network once per block, text once, and no group is larger than a block or a hash range.

A window is known by 93 bits: its hash modulo 2**61 - 1 and 32 bits of another one, so among the 10^13 windows of 100 TB unlike ones
are not expected to meet (0.005 pairs).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadshift.llm.shared import partitions
from loadshift.llm.words import Hasher, Words, find_words, give_back, slices, text_bytes, tidy

WINDOW = 50
#: Windows that a task gathers before it sends them.
FLUSH = 1_000_000
LAST_ID = np.iinfo(np.int64).max
RESULT = "doc_id bigint, n_words bigint, n_removed bigint, kept_text string, removed array<struct<first:bigint,end:bigint>>"
PACKED = "bucket int, block int, first binary, width int, steps binary, rest binary"


def pack(hashes: np.ndarray) -> tuple[bytes, int, bytes]:
    """Sorted distinct 64-bit numbers as the first one and their steps in as few bytes as the largest step needs."""
    steps = np.diff(hashes)
    width = max(1, (int(steps.max()).bit_length() + 7) // 8) if len(steps) else 1
    body = np.ascontiguousarray(steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width])
    return hashes[:1].astype("<u8").tobytes(), width, body.tobytes()


def unpack(first: bytes, width: int, steps: bytes) -> np.ndarray:
    raw = np.frombuffer(steps, np.uint8).reshape(-1, width)
    wide = np.zeros((len(raw) + 1, 8), np.uint8)
    wide[0] = np.frombuffer(first, np.uint8)
    wide[1:, :width] = raw
    return np.cumsum(wide.view("<u8").ravel(), dtype=np.uint64)


def _ids(column: pa.Array) -> np.ndarray:
    """Document ids; null counts as the last one."""
    return column.fill_null(int(LAST_ID)).to_numpy(zero_copy_only=False).astype(np.int64)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[] for _ in schema], schema)], schema=schema)


PACKED_ARROW = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("first", pa.binary()), ("width", pa.int32()), ("steps", pa.binary()), ("rest", pa.binary())])


def window_hashes(hasher: Hasher, words: Words, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First words, 64-bit hashes and 32 further bits of all windows."""
    hashes = hasher.spans(words.data, words.start, words.end)
    at, found = hasher.rolling(words, hashes, length)
    return at, found, (hasher.rolling(words, hashes, length, 1)[1] >> np.uint64(32)).astype(np.uint32)


def in_order(hashes: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """A stable order by hash and further bits."""
    order = np.argsort(hashes, kind="stable")
    h, r = hashes[order], rest[order]
    # Equal hashes nearly always have equal further bits.
    return order if not ((h[1:] == h[:-1]) & (r[1:] != r[:-1])).any() else np.lexsort((rest, hashes))


def new_in(hashes: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Where sorted pairs differ from the one before."""
    return np.append(np.ones(min(len(hashes), 1), bool), (hashes[1:] != hashes[:-1]) | (rest[1:] != rest[:-1]))


def distinct(hashes: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = in_order(hashes, rest)
    hashes, rest = hashes[order], rest[order]
    new = new_in(hashes, rest)
    return hashes[new], rest[new]


def among(known: np.ndarray, known_rest: np.ndarray, hashes: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Which pairs are among the known ones, which are sorted."""
    found = np.zeros(len(hashes), bool)
    place = np.searchsorted(known, hashes)
    while True:
        live = np.flatnonzero((place < len(known)) & ~found)
        live = live[known[place[live]] == hashes[live]]
        if not len(live):
            return found
        found[live] = known_rest[place[live]] == rest[live]
        place[live] += 1


def send_windows(length: int, limits: list[int], buckets: int):
    limits_ = np.array(limits, np.int64)

    def flush(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        hashes, rest, blocks = (np.concatenate(x) for x in zip(*parts))
        for block in np.unique(blocks):
            own, more = distinct(hashes[blocks == block], rest[blocks == block])
            # Buckets are equal ranges of the upper half of the hash, so each is one slice of the sorted hashes.
            bucket = ((own >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
            at = np.flatnonzero(np.diff(bucket, prepend=np.uint64(buckets)))
            rows = [(int(bucket[a]), int(block), *pack(own[a:b]), more[a:b].tobytes()) for a, b in zip(at, [*at[1:], len(own)])]
            yield _table(rows, PACKED_ARROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, parts, held = Hasher(), [], 0
        for batch in batches:
            for rows in slices(batch, 1):
                words = find_words(*text_bytes(rows.column(1)))
                at, found, rest = window_hashes(hasher, words, length)
                block = np.searchsorted(limits_, _ids(rows.column(0)), "right").astype(np.int32)
                parts.append((found, rest, block[words.doc[at]]))
                held += len(at)
                if held >= FLUSH:
                    yield from flush(parts)
                    parts, held = [], 0
        if held:
            yield from flush(parts)

    return run


def find_repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One task's hash ranges: for each block the hashes that an earlier block holds."""
    held: dict[int, list[tuple]] = {}
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(6))):
            held.setdefault(row[0], []).append(row[1:])
    for bucket, rows in held.items():
        rows.sort(key=lambda r: r[0])
        hashes = [unpack(*r[1:4]) for r in rows]
        blocks = np.repeat(np.array([r[0] for r in rows], np.int32), [len(h) for h in hashes])
        hashes, rest = np.concatenate(hashes), np.frombuffer(b"".join(r[4] for r in rows), np.uint32)
        order = in_order(hashes, rest)
        hashes, rest, blocks = hashes[order], rest[order], blocks[order]
        earliest = blocks[np.maximum.accumulate(np.where(new_in(hashes, rest), np.arange(len(hashes)), 0))]
        later = blocks > earliest
        hashes, rest, blocks = hashes[later], rest[later], blocks[later]
        out = []
        for b in np.unique(blocks):
            own, more = distinct(hashes[blocks == b], rest[blocks == b])
            out.append((bucket, int(b), *pack(own), more.tobytes()))
        yield _table(out, PACKED_ARROW)


def covered(words: Words, at: np.ndarray, repeated: np.ndarray, length: int) -> np.ndarray:
    """Which words lie in a repeated window."""
    change = np.zeros(len(words.start) + 1, np.int64)
    np.add.at(change, at[repeated], 1)
    np.add.at(change, at[repeated] + length, -1)
    return np.cumsum(change[:-1]) > 0


def join_words(words: Words, keep: np.ndarray) -> pa.Array:
    """The kept words of each document, joined by one blank."""
    start, end, doc = words.start[keep], words.end[keep], words.doc[keep]
    n = len(words.bounds) - 1
    blank = np.append(doc[1:] == doc[:-1], False) if len(doc) else np.zeros(0, bool)
    size = end - start + blank
    stop = np.cumsum(size)
    place = np.repeat(start - stop + size, size) + np.arange(int(stop[-1]) if len(stop) else 0)
    out = words.data[np.minimum(place, len(words.data) - 1)] if len(place) else np.zeros(0, np.uint8)
    out[(stop - 1)[blank]] = 0x20
    bounds = np.concatenate([[0], stop])[np.searchsorted(doc, np.arange(n + 1))]
    return pa.LargeStringArray.from_buffers(n, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(out))


def _intervals(words: Words, gone: np.ndarray) -> pa.Array:
    """Maximal runs of removed words in each document."""
    doc, number = words.doc, np.arange(len(gone)) - np.repeat(words.bounds[:-1], words.counts)
    new = np.append(True, doc[1:] != doc[:-1]) if len(doc) else np.zeros(0, bool)
    first = np.flatnonzero(gone & (new | ~np.append(False, gone[:-1])))
    last = np.flatnonzero(gone & (np.append(new[1:], True) | ~np.append(gone[1:], False)))
    spans = pa.StructArray.from_arrays([pa.array(number[first], pa.int64()), pa.array(number[last] + 1, pa.int64())], ["first", "end"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(doc[first], np.arange(len(words.bounds))), pa.int32()), spans)


def remove_in_block(length: int):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        hasher, out = Hasher(), []
        docs = docs.sort_by("doc_id").combine_chunks()
        known = [unpack(f.as_py(), w.as_py(), s.as_py()) for f, w, s in zip(answers["first"], answers["width"], answers["steps"])]
        known = np.concatenate(known) if known else np.zeros(0, np.uint64)
        known, known_rest = distinct(known, np.frombuffer(b"".join(answers["rest"].to_pylist()), np.uint32))
        # First the earliest document of each window in this block, then the words.
        parts = []
        for batch in docs.to_batches():
            for rows in slices(batch, 1):
                words = find_words(*text_bytes(rows.column(1)))
                at, found, rest = window_hashes(hasher, words, length)
                parts.append((rows, words, at, found, rest, _ids(rows.column(0))[words.doc[at]]))
        if not parts:
            return pa.table({n: [] for n in ARROW_RESULT.names}, schema=ARROW_RESULT)
        every, rest, ids = (np.concatenate([p[i] for p in parts]) for i in (3, 4, 5))
        # Documents are in the order of their ids, so a window's first place has its smallest id.
        order = in_order(every, rest)
        new = new_in(every[order], rest[order])
        first = order[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
        repeated = np.zeros(len(every), bool)
        repeated[order] = ids[first] < ids[order]
        repeated |= among(known, known_rest, every, rest)
        done = 0
        for rows, words, at, found, *_ in parts:
            gone = covered(words, at, repeated[done : done + len(found)], length)
            done += len(found)
            n_words = words.counts
            total = np.concatenate([[0], np.cumsum(gone)])
            removed = total[words.bounds[1:]] - total[words.bounds[:-1]]
            columns = [rows.column(0), pa.array(n_words), pa.array(removed), join_words(words, ~gone).cast(pa.string()), _intervals(words, gone)]
            out.append(pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, ARROW_RESULT)], schema=ARROW_RESULT))
        return pa.Table.from_batches(out, ARROW_RESULT)

    return run


ARROW_RESULT = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string()), ("removed", pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())])))]
)


def block_limits(docs: DataFrame, blocks: int) -> list[int]:
    """Upper ids of all blocks but the last; about as many documents in each. One number for each shuffle partition."""
    row = docs.agg(F.percentile_approx("doc_id", [i / blocks for i in range(1, blocks)], 20 * blocks)).first() if blocks > 1 else [None]
    return sorted(set(row[0] or []))


def remove_repeats(docs: DataFrame, window: int = WINDOW, blocks: int | None = None) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text (kept words joined by a blank) and the maximal removed intervals in words.

    A word goes if a window of `window` words that covers it equals one that starts in a document with a smaller doc_id; windows are
    those of the input. Null or empty text: no words, empty kept text. Fewer words than a window: all stay. A null doc_id comes after
    all others and is no smaller than another null; rows with the same doc_id do not count against each other. Extra columns are
    not read. An empty table gives an empty table.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    n = blocks or partitions(docs.sparkSession)
    limits = block_limits(docs, n)
    sent = docs.mapInArrow(tidy(send_windows(window, limits, n)), PACKED).repartition(n, "bucket")
    answers = sent.mapInArrow(tidy(find_repeats), PACKED).select("block", "first", "width", "steps", "rest")
    # A row is in the block whose number is that of the limits up to its id.
    edges = F.array(*[F.lit(x) for x in limits]) if limits else F.array().cast("array<bigint>")
    block = F.size(F.filter(edges, lambda x: x <= F.coalesce(F.col("doc_id"), F.lit(int(LAST_ID))))).cast("int")
    return docs.select("doc_id", "text", block.alias("block")).groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_cogrouped(window), RESULT)


def _cogrouped(window: int):
    run = remove_in_block(window)

    def block(docs: pa.Table, answers: pa.Table) -> pa.Table:
        out = run(docs.select(["doc_id", "text"]), answers)
        give_back()
        return out

    return block
