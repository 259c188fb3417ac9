"""How filters overlap: what each removes, at each place of every order in which they could be applied.

A document's failures are the bits of a mask, so a part of the table is no more than a count for each of 2^k masks (its cells),
which partial aggregates add up. All subsets of the k filters are visited in Gray-code order: a step switches one filter on or off,
raises or lowers the counter of active failures of the cells that fail it, and takes from or gives to the running survivors those
cells whose counter leaves or reaches zero. The 2^k survivor states are kept; every step of every order is the difference of two.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadshift.llm.native_words import words
from loadshift.llm.shared import stored

#: Parts worked on at once in a task; each gives k! * k rows.
PARTS_AT_ONCE = 64
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def text_filters(text: str = "text") -> dict[str, Column]:
    """Failure conditions on one text: A few words, B few distinct words, C many capitals, D symbols. Null counts as empty."""
    t, w = F.coalesce(F.col(text), F.lit("")), F.col("__words")
    distinct, capitals = F.size(F.array_distinct(w)).cast("bigint"), F.length(F.regexp_replace(t, "[^A-Z]+", "")).cast("bigint")
    return {
        "A": F.size(w) < 50,
        "B": 100 * distinct < 65 * F.size(w).cast("bigint"),
        "C": 100 * capitals > 5 * F.length(t),
        "D": t.rlike("[#$%&*|]"),
    }


def failure_masks(docs: DataFrame, part: str = "source") -> DataFrame:
    """doc_id, part and mask of each document: bits 0 to 3 are text_filters(), bit 4 (E) is set where a smaller doc_id has the same text.

    Texts are equal if their SHA-256 digests are. Null and empty texts are equal; a null part is the empty string. A null doc_id is
    neither smaller nor larger than another: its row fails no E and makes none fail it. Repeated rows (equal id and text) count as
    rows, and do not make each other fail. The smallest id of each text comes from partial minima, and meets the documents by
    (digest, id), so a text that a third of the documents share is no hot key.
    """
    t = F.coalesce(F.col("text"), F.lit(""))
    split = docs.select("doc_id", "text", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), words(t).alias("__words"))
    mask = sum((F.when(fails, 1 << i).otherwise(0) for i, fails in enumerate(text_filters().values())), F.lit(0))
    slim = stored(split.select("doc_id", "part", F.unhex(F.sha2(t, 256)).alias("digest"), mask.cast("int").alias("mask")), "failures")
    first = slim.filter("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    repeat = F.col("doc_id").isNotNull() & F.col("first").isNull()
    marked = slim.join(first, ["digest", "doc_id"], "left")
    return marked.select("doc_id", "part", F.when(repeat, F.col("mask") + 16).otherwise(F.col("mask")).alias("mask"))


def survivors(cells: np.ndarray) -> np.ndarray:
    """From counts (parts, 2^k masks, measures) the counts of what passes each subset of the filters, in the same layout."""
    masks = np.arange(cells.shape[1])
    out = np.empty_like(cells)
    alive = cells.sum(axis=1)
    out[:, 0] = alive
    failures, subset = np.zeros(len(masks), np.int64), 0
    for step in range(1, len(masks)):
        bit = step & -step
        failing = (masks & bit) > 0
        subset ^= bit
        if subset & bit:
            alive = alive - cells[:, failing & (failures == 0)].sum(axis=1)
            failures[failing] += 1
        else:
            failures[failing] -= 1
            alive = alive + cells[:, failing & (failures == 0)].sum(axis=1)
        out[:, subset] = alive
    return out


def steps(cells: np.ndarray, k: int) -> np.ndarray:
    """COUNTS (parts, orders, steps, 7) for all orders of k filters, in the order of itertools.permutations."""
    state = survivors(cells)
    order = np.array(list(permutations(range(k))))
    after = np.cumsum(1 << order, axis=1)
    lost = state[:, after - (1 << order)] - state[:, after]
    fails = np.stack([cells[:, (np.arange(1 << k) >> f) & 1 > 0, 0].sum(axis=1) for f in range(k)], axis=1)
    shapley = np.stack([lost[:, order == f, 0].sum(axis=1) for f in range(k)], axis=1)
    unique = cells[:, 1 << np.arange(k), 0]
    removed = lost[..., 0]
    return np.stack([state[:, after, 0], removed, fails[:, order] - removed, unique[:, order], lost[..., 1], lost[..., 2], shapley[:, order]], axis=-1)


def report(masks: DataFrame, letters: str = "ABCDE") -> DataFrame:
    """part, filter_order, step and COUNTS from rows of part, mask, good and toxic (booleans). No rows give no parts."""
    k = len(letters)
    flags = [F.sum(F.col(c).cast("bigint")).alias(c) for c in ("good", "toxic")]
    cells = masks.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), *flags)
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))  # at most 2^k entries
    names = ["".join(p) for p in permutations(letters)]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PARTS_AT_ONCE):
                rows = batch.slice(at, PARTS_AT_ONCE).to_pylist()
                table = np.zeros((len(rows), 1 << k, 3), np.int64)
                for i, row in enumerate(rows):
                    for c in row["cells"]:
                        table[i, c["mask"]] = c["n"], c["good"], c["toxic"]
                found = steps(table, k).reshape(-1, len(COUNTS))
                columns = [
                    pa.array(np.repeat(np.array([r["part"] for r in rows], object), len(names) * k), pa.string()),
                    pa.array(np.tile(np.repeat(np.array(names, object), k), len(rows)), pa.string()),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows) * len(names))),
                    *(pa.array(found[:, i]) for i in range(len(COUNTS))),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "filter_order", "step", *COUNTS])

    return parts.mapInArrow(walk, "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in COUNTS))


def audit(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """The report of the five filters over whole texts, for each value of `part`.

    A document counts as good (toxic) if any row of `labels` with its doc_id has quality (toxic) 1; null ids meet no label.
    """
    marks = labels.groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    known = [F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")]
    return report(failure_masks(docs, part).join(marks, "doc_id", "left").select("part", "mask", *known))
