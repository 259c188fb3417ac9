"""Hard negatives: for an anchor row and each of its positives, rows of other labels that score nearly as high as the positive.

A score is the inner product of two integer vectors. Each vector is cut into SEGMENTS segments, and each segment's mean and deviation
are stored with it. Over a segment of m components the inner product lies within m (mean x mean +- deviation x deviation), so sums
over segments bound a score from both sides. Bounds are refined hierarchically: first the whole vector as one segment, then two, four,
up to SEGMENTS (a coarse segment's summary follows from those of its halves); only pairs whose interval still reaches the wanted scores
go on, and what is left after the finest level is scored exactly. The wanted scores narrow while rows pass by: below an anchor's worst
kept row nothing is of interest. Vectors without structure give wide intervals; then more pairs are scored, never fewer found.

Rows are dealt into groups and anchors into blocks. Anchors are the stated query set: each block meets each group in a cell, where its
anchors are held and the group's rows stream past, so a task's memory depends on neither table. A cell sends its best few rows for each
anchor, and the best of those are the result. This is done twice, for positives and, with their scores known, for negatives.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loadshift.llm.shared import partitions, stored
from loadshift.llm.words import tidy

SEGMENTS = 16
#: Anchors that a task holds at once, rows of a group (more groups if the session has more partitions), pairs looked at in one go.
BLOCK = 4096
GROUP_ROWS = 1 << 18
PAIRS = 1 << 21
LOWEST, HIGHEST = np.iinfo(np.int64).min // 4, np.iinfo(np.int64).max // 4
Batches = Iterator[pa.RecordBatch]


def whole_vectors(df: DataFrame, vector: str) -> DataFrame:
    """Rows with a vector of present, finite components; an empty vector is one."""
    return df.filter(F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))))


def steps(vector: str, scale: int) -> Column:
    """Each component times `scale`, rounded down, in double precision."""
    return F.transform(vector, lambda x: F.floor(scale * x.cast("double")).cast("bigint"))


def summaries(vectors: np.ndarray) -> np.ndarray:
    """Means and then deviations of the SEGMENTS segments of each row."""
    parts = vectors.reshape(len(vectors), SEGMENTS, -1).astype(np.float64)
    return np.concatenate([parts.mean(axis=2), parts.std(axis=2)], axis=1)


def pack(rows: DataFrame) -> DataFrame:
    """id, label, vector and summary (doubles as bytes), from id, label and vector (array of bigint); short vectors are filled up with zeros."""
    most = rows.agg(F.max(F.size("vector")).alias("n")).first().n
    size = SEGMENTS * max(1, -(-(most or 0) // SEGMENTS))

    def task(batches: Batches) -> Batches:
        for batch in batches:
            lists = batch.column(2)
            count = lists.value_lengths().to_numpy()
            table = np.zeros((batch.num_rows, size))
            at = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
            table[np.repeat(np.arange(len(count)), count), at] = lists.flatten().to_numpy()
            columns = [pa.array([r.tobytes() for r in x], pa.binary()) for x in (table, summaries(table))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=["id", "label", "vector", "summary"])

    return rows.select("id", "label", "vector").mapInArrow(tidy(task), "id bigint, label bigint, vector binary, summary binary")


def matrix(column: pa.Array) -> np.ndarray:
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].reshape(len(column), -1).view(np.float64)


class Side:
    """Rows of one side of a cell: ids, labels, vectors and, from coarse to fine, means and deviations times the root of a segment's length."""

    def __init__(self, batch: pa.RecordBatch):
        self.id, self.label = (batch.column(c).to_numpy() for c in ("id", "label"))
        self.vector, summary = matrix(batch.column("vector")), matrix(batch.column("summary"))
        mean, deviation, length = summary[:, :SEGMENTS], summary[:, SEGMENTS:], self.vector.shape[1] // SEGMENTS
        self.levels = [(mean * np.sqrt(length), deviation * np.sqrt(length))]
        while mean.shape[1] > 1:
            square = (deviation**2 + mean**2).reshape(len(mean), -1, 2).mean(axis=2)
            mean = mean.reshape(len(mean), -1, 2).mean(axis=2)
            deviation, length = np.sqrt(np.maximum(square - mean**2, 0)), length * 2
            self.levels.insert(0, (mean * np.sqrt(length), deviation * np.sqrt(length)))
        self.norm = np.sqrt((self.vector**2).sum(axis=1))
        self.largest = float(np.abs(self.vector).max(initial=0))


def inner(a: Side, r: Side, i: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Exact scores of pairs of places, as long as they fit 64 bits."""
    exact = a.largest * r.largest * a.vector.shape[1] < 2**53
    out = np.empty(len(i), np.int64)
    for at in range(0, len(i), 1 << 16):
        x, y = a.vector[i[at : at + (1 << 16)]], r.vector[k[at : at + (1 << 16)]]
        out[at : at + (1 << 16)] = np.einsum("ij,ij->i", x, y) if exact else (x.astype(np.int64) * y.astype(np.int64)).sum(axis=1)
    return out


class Cell:
    """The best `top` rows so far for each slot of each anchor: a slot wants scores from low to high."""

    def __init__(self, anchors: Side, number: np.ndarray, low: np.ndarray, high: np.ndarray, same: bool, top: int):
        self.anchors, self.number, self.low, self.high, self.same, self.top = anchors, number, low, high, same, top
        self.least = low.copy()  # rises to the worst kept score once a slot is full
        self.kept = [(np.zeros(0, np.int64),) * 3 for _ in range(low.shape[1])]  # anchor's place, score, id

    def pairs(self, rows: Side) -> tuple[np.ndarray, np.ndarray]:
        """Places of anchors and rows whose labels fit and whose bounds reach the wanted scores, level by level."""
        equal = self.anchors.label[:, None] == rows.label[None, :]
        open_ = (equal & (self.anchors.id[:, None] != rows.id[None, :])) if self.same else ~equal
        wanted = self.least <= self.high
        lowest = np.where(wanted, self.least, HIGHEST).min(axis=1).astype(np.float64)
        highest = np.where(wanted, self.high, LOWEST).max(axis=1).astype(np.float64)
        slack = 1e-6 * (1 + self.anchors.norm.max(initial=0) * rows.norm.max(initial=0))
        a, r = np.arange(len(self.number)), np.arange(len(rows.id))
        for (mean_a, dev_a), (mean_r, dev_r) in zip(self.anchors.levels, rows.levels):
            some_a, some_r = open_.any(axis=1), open_.any(axis=0)
            if not some_a.any():
                break
            if not (some_a.all() and some_r.all()):
                a, r, open_ = a[some_a], r[some_r], open_[np.ix_(some_a, some_r)]
            middle, spread = mean_a[a] @ mean_r[r].T, dev_a[a] @ dev_r[r].T
            open_ &= (middle + spread + slack >= lowest[a, None]) & (middle - spread - slack <= highest[a, None])
        i, k = np.nonzero(open_)
        return a[i], r[k]

    def add(self, rows: Side) -> None:
        i, k = self.pairs(rows)
        if not len(i):
            return
        score, ids = inner(self.anchors, rows, i, k), rows.id[k]
        for j in range(self.low.shape[1]):
            fits = (score >= self.least[i, j]) & (score <= self.high[i, j])
            if not fits.any():
                continue
            place, s, x = (np.concatenate([old, new[fits]]) for old, new in zip(self.kept[j], (i, score, ids)))
            order = np.lexsort((x, -s, place))
            place, s, x = place[order], s[order], x[order]
            first = np.concatenate([[True], place[1:] != place[:-1]])
            rank = np.arange(len(place)) - np.maximum.accumulate(np.where(first, np.arange(len(place)), 0))
            full, best = rank == self.top - 1, rank < self.top
            self.least[place[full], j] = s[full]
            self.kept[j] = place[best], s[best], x[best]

    def result(self) -> Batches:
        for j, (place, score, ids) in enumerate(self.kept):
            if len(place):
                slot = pa.array(np.full(len(place), j, np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(self.number[place]), slot, pa.array(ids), pa.array(score)], names=["anchor", "slot", "id", "score"])


def searching(same: bool, top: int):
    """Over rows sorted by cell, anchors (number not null) first: the best rows of each cell for each slot of its anchors."""

    def slots(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """Slots that are missing want nothing."""
        wants = batch.column("wants").to_pylist()
        low = np.full((len(wants), max(map(len, wants))), HIGHEST)
        high = np.full(low.shape, LOWEST)
        for i, each in enumerate(wants):
            for j, w in enumerate(each):
                low[i, j], high[i, j] = w["low"], w["high"]
        return low, high

    def task(batches: Batches) -> Batches:
        at, held, cell = None, [], None
        for batch in batches:
            keys = batch.column("cell").to_numpy()
            cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            for first, last in zip([0, *cuts], [*cuts, len(keys)]):
                part = batch.slice(first, last - first)
                if first == last:
                    continue
                if keys[first] != at:
                    if cell is not None:
                        yield from cell.result()
                    at, held, cell = keys[first], [], None
                n = part.num_rows - part.column("number").null_count
                if n:
                    held.append(part.slice(0, n))
                if n == part.num_rows or not held:
                    continue
                if cell is None:
                    whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                    cell, held = Cell(Side(whole), whole.column("number").to_numpy(), *slots(whole), same, top), [None]
                step = max(1, PAIRS // len(cell.number))
                for start in range(n, part.num_rows, step):
                    cell.add(Side(part.slice(start, step)))
        if cell is not None:
            yield from cell.result()

    return tidy(task)


def best_in_cells(rows: DataFrame, anchors: DataFrame, wants: DataFrame, grid: tuple[int, int], same: bool, top: int) -> DataFrame:
    """anchor, slot, id, score: the best `top` rows for each slot, by score and then id. wants: number and an array of (low, high)."""
    blocks, groups = grid
    columns = ["cell", "number", "id", "label", "vector", "summary", "wants"]
    each_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    asked = anchors.join(wants, "number").withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    asked = asked.withColumn("cell", F.pmod(F.xxhash64("number"), F.lit(blocks)) * groups + F.col("group"))
    dealt = rows.withColumn("block", each_block).withColumn("cell", F.col("block").cast("bigint") * groups + F.pmod(F.xxhash64("id", "vector"), F.lit(groups)))
    dealt = dealt.withColumn("number", F.lit(None).cast("bigint")).withColumn("wants", F.lit(None).cast(wants.schema["wants"].dataType))
    both = asked.select(*columns).union(dealt.select(*columns))
    sorted_ = both.repartitionByRange(max(partitions(rows.sparkSession), blocks * groups), "cell").sortWithinPartitions("cell", F.col("number").isNull())
    found = sorted_.mapInArrow(searching(same, top), "anchor bigint, slot int, id bigint, score bigint")
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for rows of id, label (bigint) and vector (array of bigint).

    An anchor's positives are its first `positives` rows of the same label and another id; the negatives of a positive its first
    `negatives` rows of other labels with low * positive_score <= 100 * negative_score <= high * positive_score. First means by higher
    score, then smaller id; so a positive with a negative score has none if high is 100. Scores are exact while they fit 64 bits.
    Rows with a null id, label or vector, or with a null component, take no part. Equal rows count once; rows that share an id only
    are rows of their own, and as anchors give results of their own. Short vectors count as filled up with zeros. No anchors, no rows
    of the same or of other labels and empty tables give no result rows. Other columns of `rows` are not looked at.
    """
    usable = rows.filter("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL AND forall(vector, x -> x IS NOT NULL)")
    all_rows = stored(pack(usable.select("id", F.col("label").cast("bigint").alias("label"), "vector").distinct()), "vectors")
    anchors = stored(all_rows.filter(is_anchor).withColumn("number", F.monotonically_increasing_id()), "anchor-rows")
    blocks = -(-anchors.count() // BLOCK)
    if not blocks:
        blocks = 1
    groups = max(-(-partitions(rows.sparkSession) // blocks), -(-all_rows.count() // GROUP_ROWS), 1)
    grid = blocks, groups
    anything = F.array(F.struct(F.lit(int(LOWEST)).alias("low"), F.lit(int(HIGHEST)).alias("high")))
    first = best_in_cells(all_rows, anchors, anchors.select("number", anything.alias("wants")), grid, True, positives)
    chosen = stored(first.select(F.col("anchor").alias("number"), (F.col("rank") - 1).alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    lowest = F.ceil(F.lit(low) * F.col("positive_score").cast("decimal(20,0)") / 100).cast("bigint")
    highest = F.floor(F.lit(high) * F.col("positive_score").cast("decimal(20,0)") / 100).cast("bigint")
    wants = chosen.groupBy("number").agg(F.sort_array(F.collect_list(F.struct("slot", lowest.alias("low"), highest.alias("high")))).alias("wants"))
    wants = wants.select("number", F.transform("wants", lambda w: F.struct(w["low"].alias("low"), w["high"].alias("high"))).alias("wants"))
    second = best_in_cells(all_rows, anchors, wants, grid, False, negatives).withColumnRenamed("anchor", "number")
    named = second.join(chosen, ["number", "slot"]).join(anchors.select("number", F.col("id").alias("anchor_id")), "number")
    return named.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
