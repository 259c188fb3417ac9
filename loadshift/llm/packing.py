"""Documents as token sequences of bounded length with little padding.

Texts become ids and an end id, cut into full sequences and one shorter piece. The histogram of piece lengths, in steps of `STEP`
tokens and so of bounded size, is the only thing the driver sees: column generation turns it into patterns of lengths and a number
of sequences for each. Pieces are ranked within their length step and take the places of that step in the patterns by rank: a task
numbers its own pieces as it cuts them, and each task's first rank is a sum over tasks.

Patterns alone leave room where lengths fit badly. So of each stretch of NEIGHBOURS sequences the emptiest ones are taken apart, and
their pieces fill the room of the others, cut where a sequence is full.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loadshift.llm.column_generation import whole_bins
from loadshift.llm.encode import Encoder, tokenizer_json
from loadshift.llm.shared import once_per_worker, stored
from loadshift.llm.words import slices, text_bytes, tidy

CAPACITY = 2048
STEP = 8
END_ID = 1
#: Sequences that are looked at together to fill room, and the least room worth a cut.
NEIGHBOURS = 512
LEAST_ROOM = 12
PIECES = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, ids binary, ids_crc32 bigint, task bigint, number bigint, own bigint"


def id_bytes(definition: str, end_id: int) -> int:
    """Bytes in which a tokenizer's ids are kept on the way: two if all fit."""
    from tokenizers import Tokenizer

    return 2 if max(end_id, *Tokenizer.from_str(definition).get_vocab(with_added_tokens=True).values()) < 1 << 16 else 4


def checksums(ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """CRC-32 of each slice of ids as little-endian unsigned 32-bit numbers."""
    raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
    return np.array([zlib.crc32(raw[a:b]) for a, b in zip((4 * bounds[:-1]).tolist(), (4 * bounds[1:]).tolist())], np.int64)


def _cutter(definition: str, end_id: int, capacity: int, step: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = once_per_worker("encoder", lambda: Encoder(definition))
        task = TaskContext.get().partitionId()
        seen, done = np.zeros(-(-capacity // step) + 1, np.int64), 0
        for batch in batches:
            for rows in slices(batch, 1):
                found, bounds = encoder.ids(*text_bytes(rows.column(1)))
                found = np.insert(found, bounds[1:], end_id).astype("<u4")
                tokens = np.diff(bounds) + 1
                pieces = -(-tokens // capacity)
                doc = np.repeat(np.arange(len(tokens)), pieces)
                start = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * capacity
                length = np.minimum(capacity, tokens[doc] - start)
                size = -(-length // step)
                order = np.argsort(size, kind="stable")
                count = np.bincount(size, minlength=len(seen))
                own = np.empty(len(size), np.int64)
                own[order] = np.arange(len(size)) - (np.cumsum(count) - count)[size[order]] + seen[size[order]]
                seen += count
                # Pieces follow each other without gaps, so their bounds are running sums.
                at = np.concatenate([[0], np.cumsum(length)])
                ids = pa.Array.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer((at * width).astype(np.int32)), pa.py_buffer(found.astype(f"<u{width}"))])
                columns = [rows.column(0).take(pa.array(doc)), pa.array(start), pa.array(length), pa.array(tokens[doc]), ids, pa.array(checksums(found, at))]
                columns += [pa.array(np.full(len(doc), task)), pa.array(done + np.arange(len(doc))), pa.array(own)]
                done += len(doc)
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in PIECES.split(", ")])

    return run


def cut(docs: DataFrame, tokenizer: str, end_id: int = END_ID, capacity: int = CAPACITY, step: int = STEP) -> DataFrame:
    """doc_id, start, length, doc_tokens, ids (little-endian, of `id_bytes` bytes) and their ids_crc32 of each piece; task and number name it, and
    `own` is its number among the pieces of its size in its task. To be stored before it is read twice."""
    definition = tokenizer_json(tokenizer)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(tidy(_cutter(definition, end_id, capacity, step, id_bytes(definition, end_id)), ("encoder",)), PIECES)


def _places(patterns: np.ndarray, bins: np.ndarray):
    """For each size, in the order of its ranks: the end of each pattern's ranks, its places in a sequence and first sequence."""
    first = np.concatenate([[0], np.cumsum(bins)])[:-1]
    out = []
    for column in patterns.T:
        use = np.flatnonzero((column > 0) & (bins > 0))
        out.append((np.cumsum(column[use] * bins[use]), column[use], first[use]))
    return out


def _assigner(sizes: np.ndarray, places: list):
    """Sequence and slot of pieces (task, number, length, size, rank)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            task, number, length, size, rank = (batch.column(i).to_numpy() for i in range(5))
            sequence, slot = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            kind = np.searchsorted(sizes, size)
            for k in np.unique(kind):
                ends, each, first = places[k]
                of = np.flatnonzero(kind == k)
                p = np.searchsorted(ends, rank[of], "right")
                within = rank[of] - np.concatenate([[0], ends])[p]
                sequence[of] = first[p] + within // each[p]
                slot[of] = k * CAPACITY + within % each[p]
            columns = (task, number, length, sequence // NEIGHBOURS, sequence, slot)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["task", "number", "length", "stretch", "sequence_id", "slot"])

    return run


PLACED = pa.schema([(c, pa.int64()) for c in ("task", "number", "part_start", "part_length", "sequence_id", "offset")])


def fill(sequence: np.ndarray, slot: np.ndarray, length: np.ndarray, capacity: int, least_room: int) -> tuple[np.ndarray, ...]:
    """Piece (its place), start and length of the part, sequence and offset of every part, once the emptiest sequences are taken apart and
    their pieces laid over the room of the others. No more are taken apart than that room holds."""
    order = np.lexsort((-slot, sequence))
    sequence, length = sequence[order], length[order]
    first = np.flatnonzero(np.append(True, sequence[1:] != sequence[:-1]))
    count = np.diff(np.append(first, len(sequence)))
    total = np.add.reduceat(length, first)
    offset = np.cumsum(length) - length
    offset -= np.repeat(offset[first], count)
    room = np.where(capacity - total >= least_room, capacity - total, 0)
    rising = np.argsort(total, kind="stable")
    spare = room.sum() - np.cumsum(room[rising])
    apart = int((np.cumsum(total[rising]) <= spare).sum())
    gone = np.zeros(len(first), bool)
    gone[rising[:apart]] = True
    moved = np.flatnonzero(np.repeat(gone, count))
    stays = np.flatnonzero(~np.repeat(gone, count))
    parts = [(order[stays], np.zeros(len(stays), np.int64), length[stays], sequence[stays], offset[stays])]
    if len(moved):
        roomy = rising[apart:][room[rising[apart:]] > 0]
        pieces, rooms = np.cumsum(length[moved]), np.cumsum(room[roomy])
        ends = np.unique(np.concatenate([pieces, rooms[rooms < pieces[-1]]]))
        begins = np.append(0, ends[:-1])
        piece, place = np.searchsorted(pieces, begins, "right"), np.searchsorted(rooms, begins, "right")
        into = roomy[place]
        part_start = begins - (pieces - length[moved])[piece]
        parts.append((order[moved[piece]], part_start, ends - begins, sequence[first[into]], total[into] + begins - (rooms - room[roomy])[place]))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _filler(capacity: int, least_room: int):
    def run(rows: pa.Table) -> pa.Table:
        task, number, length, sequence, slot = (rows.column(c).to_numpy() for c in ("task", "number", "length", "sequence_id", "slot"))
        piece, start, size, sequence, offset = fill(sequence, slot, length, capacity, least_room)
        return pa.table([pa.array(x) for x in (task[piece], number[piece], start, size, sequence, offset)], PLACED)

    return run


def place(pieces: DataFrame, capacity: int = CAPACITY, step: int = STEP, least_room: int = LEAST_ROOM) -> DataFrame:
    """task, number, part_start, part_length, sequence_id and offset of all parts of stored pieces (task, number, own, length). Lengths over
    the capacity are an error; no pieces give no parts. A stretch of sequences that is filled together has NEIGHBOURS times `capacity`
    pieces at most."""
    sized = pieces.select("task", "number", "own", "length", F.ceil(F.col("length") / step).cast("bigint").alias("size"))
    by_task = stored(sized.groupBy("task", "size").agg(F.count(F.lit(1)).alias("n")), "counts")
    counts = by_task.groupBy("size").agg(F.sum("n").alias("n")).orderBy("size").collect()  # capacity / step rows at most
    sizes, demand = np.array([r[0] for r in counts], np.int64), np.array([r[1] for r in counts], np.int64)
    patterns, bins = whole_bins(sizes, demand, -(-capacity // step))
    before = F.sum("n").over(Window.partitionBy("size").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    first = by_task.select("task", "size", F.coalesce(before, F.lit(0)).alias("before"))
    ranked = sized.join(first, ["task", "size"]).select("task", "number", "length", "size", (F.col("own") + F.col("before")).alias("rank"))
    schema = "task bigint, number bigint, length bigint, stretch bigint, sequence_id bigint, slot bigint"
    placed = ranked.mapInArrow(_assigner(sizes, _places(patterns, bins)), schema)
    return placed.groupBy("stretch").applyInArrow(_filler(capacity, least_room), ", ".join(f"{c} bigint" for c in PLACED.names))


PARTS = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, {}, sequence_id bigint, `offset` bigint"


def _parts_of(checked: bool):
    """Parts with their own ids in 32 bits, or with the checksum of these, from parts (piece start, part_start, part_length) with the ids of
    the whole piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = {n: batch.column(n) for n in batch.schema.names}
            first, length, pieces = column["part_start"].to_numpy(), column["part_length"].to_numpy(), column["ids"].to_pylist()
            width = [len(p) // n for p, n in zip(pieces, column["length"].to_pylist())]
            parts = [np.frombuffer(p, f"<u{w}")[a : a + n].astype("<u4") for p, w, a, n in zip(pieces, width, first.tolist(), length.tolist())]
            bounds = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
            ids = pa.array(checksums(np.concatenate(parts), bounds)) if checked and parts else pa.array([p.tobytes() for p in parts], pa.binary())
            ids = ids.cast(pa.int64()) if checked and not parts else ids
            columns = [column["doc_id"], pa.array(column["start"].to_numpy() + first), column["part_length"], column["doc_tokens"], ids, column["sequence_id"], column["offset"]]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "length", "doc_tokens", "ids_crc32" if checked else "ids", "sequence_id", "offset"])

    return run


def assign(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, start, length, doc_tokens, ids_crc32, sequence_id and offset of all parts of stored pieces. Ids are looked at only where a
    piece is cut."""
    parts = stored(place(pieces, capacity), "parts")
    key = ["task", "number"]
    known = parts.join(pieces.select(*key, "doc_id", "start", "length", "doc_tokens", "ids_crc32"), key)
    whole = known.filter("part_length = length").select("doc_id", "start", "length", "doc_tokens", "ids_crc32", "sequence_id", "offset")
    broken = known.filter("part_length < length").drop("ids_crc32").join(pieces.select(*key, "ids"), key)
    return whole.union(broken.mapInArrow(tidy(_parts_of(True)), PARTS.format("ids_crc32 bigint")))


def pack(docs: DataFrame, tokenizer: str, end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, start, length, doc_tokens, ids (little-endian unsigned 32-bit), sequence_id and offset of each piece.

    Each id of each document lies in exactly one piece; a sequence holds at most `capacity` ids, its pieces without gaps from offset 0.
    Null or empty text: the end id alone. Rows with equal or null doc_id are packed each for itself. Extra columns are not read. An
    empty table gives an empty table.
    """
    pieces = stored(cut(docs, tokenizer, end_id, capacity), "pieces")
    both = place(pieces, capacity).join(pieces.select("task", "number", "doc_id", "start", "length", "doc_tokens", "ids"), ["task", "number"])
    return both.mapInArrow(tidy(_parts_of(False)), PARTS.format("ids binary"))
