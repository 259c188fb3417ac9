"""Token ids of a corpus in files of fixed-width packed ids, and back.

Each id takes the fewest bits that hold the vocabulary. A file ("shard") is a range of doc_ids in ascending order:

    4 bytes  magic "TKB1"           8 bytes  documents        the blocks: BLOCK ids each (the last one fewer), packed
    4 bytes  bits of an id          8 bytes  ids              8 bytes a block and one more: their byte offsets
    4 bytes  ids of a block         8 bytes  place of offsets 9 bytes a document: doc_id, whether known; 8 bytes: its ids

All numbers are little-endian; ids fill their bytes from the lowest bit up. Any run of ids is read by unpacking its blocks alone.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loadshift.llm.encode import Encoder, tokenizer_json
from loadshift.llm.shared import once_per_worker, partitions
from loadshift.llm.words import slices, text_bytes, tidy
from loadshift.session import scratch_dir

MAGIC = b"TKB1"
HEAD = "<4sIIQQQ"
BLOCK = 4096
END_ID = 0
MANIFEST = "shard int, file string, n_docs bigint, n_ids bigint"
DOCUMENTS = "shard int, place bigint, doc_id bigint, first bigint, n_tokens bigint, ids binary"


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack_ids(ids: np.ndarray, bits: int) -> bytes:
    """Eight ids make `bits` bytes, so each of the eight places has the same shift in every group."""
    groups = -(-len(ids) // 8)
    padded = np.zeros(groups * 8, np.uint64)
    padded[: len(ids)] = ids
    out = np.zeros((groups, bits), np.uint8)
    for k, column in enumerate(padded.reshape(groups, 8).T):
        byte, shift = divmod(k * bits, 8)
        shifted = column << np.uint64(shift)
        for i in range(-(-(shift + bits) // 8)):
            out[:, byte + i] |= ((shifted >> np.uint64(8 * i)) & np.uint64(255)).astype(np.uint8)
    return out.tobytes()[: -(-len(ids) * bits // 8)]


def unpack_ids(data: bytes, n: int, bits: int) -> np.ndarray:
    groups = -(-n // 8)
    raw = np.zeros(groups * bits, np.uint8)
    raw[: len(data)] = np.frombuffer(data, np.uint8)
    raw = raw.reshape(groups, bits).astype(np.uint64)
    out = np.zeros((groups, 8), np.uint32)
    for k in range(8):
        byte, shift = divmod(k * bits, 8)
        value = np.zeros(groups, np.uint64)
        for i in range(-(-(shift + bits) // 8)):
            value |= raw[:, byte + i] << np.uint64(8 * i)
        out[:, k] = (value >> np.uint64(shift)) & np.uint64((1 << bits) - 1)
    return out.reshape(-1)[:n]


def shard_bytes(doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray, bits: int, block: int = BLOCK) -> bytes:
    packed = [pack_ids(ids[i : i + block], bits) for i in range(0, len(ids), block)]
    offsets = struct.calcsize(HEAD) + np.cumsum([0, *map(len, packed)])
    table = np.zeros(len(doc_ids), [("doc_id", "<i8"), ("known", "u1"), ("n", "<i8")])
    table["doc_id"] = [x or 0 for x in doc_ids]
    table["known"] = [x is not None for x in doc_ids]
    table["n"] = counts
    head = struct.pack(HEAD, MAGIC, bits, block, len(doc_ids), len(ids), int(offsets[-1]))
    return b"".join([head, *packed, offsets.astype("<u8").tobytes(), table.tobytes()])


class Shard:
    """Random access to the ids of one file's bytes."""

    def __init__(self, data: bytes):
        self.data = data
        magic, self.bits, self.block, self.n_docs, self.n_ids, at = struct.unpack_from(HEAD, data)
        if magic != MAGIC:
            raise ValueError("not a file of packed ids")
        n = -(-self.n_ids // self.block) + 1
        self.offsets = np.frombuffer(data, "<u8", n, at)
        table = np.frombuffer(data, [("doc_id", "<i8"), ("known", "u1"), ("n", "<i8")], self.n_docs, at + 8 * n)
        self.doc_ids, self.known, self.counts = table["doc_id"], table["known"].astype(bool), table["n"]
        self.bounds = np.concatenate([[0], np.cumsum(self.counts)])

    def ids(self, first: int, end: int) -> np.ndarray:
        if end <= first:
            return np.zeros(0, np.uint32)
        parts = []
        for b in range(first // self.block, -(-end // self.block)):
            n = min(self.block, self.n_ids - b * self.block)
            parts.append(unpack_ids(self.data[int(self.offsets[b]) : int(self.offsets[b + 1])], n, self.bits))
        skip = first % self.block
        return np.concatenate(parts)[skip : skip + end - first]


def _writer(folder: str, definition: str, end_id: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = once_per_worker("encoder", lambda: Encoder(definition))
        doc_ids, counts, ids = [], [], []
        for batch in batches:
            for rows in slices(batch, 1):
                found, bounds = encoder.ids(*text_bytes(rows.column(1)))
                doc_ids += rows.column(0).to_pylist()
                counts.append(np.diff(bounds) + 1)
                ids.append(np.insert(found, bounds[1:], end_id))
        if not doc_ids:
            return
        counts, ids = np.concatenate(counts), np.concatenate(ids)
        task = TaskContext.get()
        name = f"shard-{task.partitionId():06d}.ids"
        files, path = pafs.FileSystem.from_uri(folder)
        part = f"{path}/.{name}.{task.taskAttemptId()}"
        with files.open_output_stream(part) as out:
            out.write(shard_bytes(doc_ids, counts, ids, bits))
        # A second attempt at this task puts the same bytes in the same place.
        files.move(part, f"{path}/{name}")
        row = [[task.partitionId()], [name], [len(doc_ids)], [len(ids)]]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, (pa.int32(), pa.string(), pa.int64(), pa.int64()))], ["shard", "file", "n_docs", "n_ids"])

    return run


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, shards: int | None = None) -> DataFrame:
    """Writes every text's ids and `end_id` to files below `folder` (a URI that executors can write) and returns the stored manifest:
    shard, file, n_docs, n_ids.

    Null or empty text: the end id alone. Ascending doc_id, nulls first; rows with equal doc_id are ordered by text. An empty table
    writes no file. Extra columns are not read. `tokenizer` is a file of the tokenizers library; it is read on the driver.
    """
    definition = tokenizer_json(tokenizer)
    vocabulary = max(Encoder(definition).tokenizer.get_vocab(with_added_tokens=True).values()) + 1
    files, path = pafs.FileSystem.from_uri(folder)
    files.create_dir(path, recursive=True)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = docs.repartitionByRange(shards or partitions(docs.sparkSession), "doc_id").sortWithinPartitions("doc_id", "text")
    manifest = ordered.mapInArrow(tidy(_writer(folder, definition, end_id, bits_for(max(vocabulary, end_id + 1))), ("encoder",)), MANIFEST)
    manifest.write.parquet(f"{folder}/manifest.parquet")
    return docs.sparkSession.read.schema(MANIFEST).parquet(f"{folder}/manifest.parquet")


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["shard", "place", "doc_id", "first", "n_tokens", "ids"]
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    for batch in batches:
        for number, data in zip(batch.column(0), batch.column(1)):
            shard = Shard(data.as_py())
            step = max(1, 500_000 // max(1, int(shard.n_ids // max(1, shard.n_docs))))
            for a in range(0, shard.n_docs, step):
                b = min(a + step, shard.n_docs)
                first = int(shard.bounds[a])
                raw = shard.ids(first, int(shard.bounds[b])).astype("<u4")
                at = 4 * (shard.bounds[a : b + 1] - first)
                ids = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(raw)])
                columns = [np.full(b - a, number.as_py()), np.arange(a, b), pa.array(shard.doc_ids[a:b], pa.int64(), mask=~shard.known[a:b]), shard.bounds[a:b], shard.counts[a:b], ids]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types)], names)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids (little-endian unsigned 32-bit) of every document in the files."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest.parquet")
    # One row for each file, as many as write() had partitions.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = manifest.select("shard", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    content = spark.read.format("binaryFile").option("pathGlobFilter", "shard-*.ids").load(folder)
    number = F.regexp_extract("path", r"shard-(\d+)\.ids$", 1).cast("int").alias("shard")
    docs = content.select(number, "content").mapInArrow(tidy(_reader), DOCUMENTS)
    return docs.join(F.broadcast(base), "shard").select("doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids")


def token_files(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Writes the files to a new folder of the shared scratch and reads them back; see write() and read()."""
    spark = docs.sparkSession
    folder = f"{scratch_dir(spark)}/token-files"
    folder = folder if "://" in folder else f"file://{folder}"
    write(docs, folder, tokenizer, end_id)
    return read(spark, folder)
