"""SimHash fingerprints of word shingles and the groups that differences of at most three bits hold together.

Anchor points: two fingerprints that differ in three bits or fewer differ in at most one within the lower or within the upper 31 bits.
In each of these halves the anchors are the words of the perfect Hamming code of length 31, whose covering radius is 1: every half lies
within one bit of exactly one anchor, its home. A fingerprint goes to its homes, and as a visitor to all anchors within covering radius
plus threshold, 1 + 1 bits (16 at most for a half). Of two fingerprints near each other in a half one visits the home of the other, so
comparing an anchor's own fingerprints with its visitors finds every pair.

Equal fingerprints are one from the start. An anchor with few fingerprints gives its links; one with more gives, for each group that
links hold together, a star, so what is written grows with the fingerprints and not with their pairs. A crowded anchor is not compared
but dealt out further: bits outside its half, in which a pair differs three times at most, are cut into four blocks, of which one is
equal. That is repeated until no crowd is left; once fewer than four bits are free, an anchor holds under 4,000 fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadshift.llm.components import components
from loadshift.llm.shared import is_empty, partitions, stored
from loadshift.llm.words import find_words, lower_ascii, mix, slices, text_bytes, tidy

SEED = 42
WIDTH = 31
DISTANCE = 3
#: Hashes whose bits are spread out at once.
SPREAD = 1 << 17
#: Fingerprints of an anchor that are compared directly; more are dealt out further.
CROWD = 1024
#: Groups up to this size are compared many at once, and give links instead of stars.
FEW = 8
#: No anchor has more once fewer than four bits are free: 497 halves within two bits, times 2^3.
LAST = 497 * 8
Batches = Iterator[pa.RecordBatch]
MET = pa.schema([("crowd", pa.bool_()), ("key", pa.int64()), ("free", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])
SENT = pa.schema([("key", pa.int64()), ("free", pa.int64()), ("print", pa.int64()), ("home", pa.bool_())])


def ddl(schema: pa.Schema) -> str:
    kinds = {pa.bool_(): "boolean", pa.int64(): "bigint"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)


def shingle_bounds(counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First words, last words and documents of all runs of n words; a document with fewer words (but any) has one run, all of it."""
    size = np.minimum(counts, n)
    runs = np.where(counts > 0, counts - size + 1, 0)
    doc = np.repeat(np.arange(len(counts)), runs)
    first = np.arange(int(runs.sum())) - np.repeat(np.cumsum(runs) - runs, runs) + np.repeat(np.cumsum(counts) - counts, runs)
    return first, first + size[doc] - 1, doc


def text_prints(column: pa.Array, n: int) -> np.ndarray:
    """SimHash of each text: a bit is set if it is in over half the XXH64 hashes of the lower-cased, blank-joined shingles; 0 without words."""
    import xxhash

    data, offsets = text_bytes(column)
    words = find_words(lower_ascii(data), offsets)
    size = words.end - words.start + 1
    stop = np.cumsum(size)
    begin = stop - size
    joined = np.full(int(stop[-1]) if len(stop) else 0, 0x20, np.uint8)
    letters = np.arange(len(joined)) - np.repeat(begin, size)
    letter = letters < np.repeat(size - 1, size)
    joined[letter] = words.data[(letters + np.repeat(words.start, size))[letter]]
    raw, digest = joined.tobytes(), xxhash.xxh64_intdigest
    first, last, doc = shingle_bounds(words.counts, n)
    ones, total = np.zeros((len(column), 64), np.int64), np.bincount(doc, minlength=len(column))
    for at in range(0, len(first), SPREAD):
        here = slice(at, at + SPREAD)
        spans = zip(begin[first[here]].tolist(), (stop[last[here]] - 1).tolist())
        hashes = np.array([digest(raw[a:b], SEED) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        docs, edge = np.unique(doc[here], return_index=True)
        ones[docs] += np.add.reduceat(bits, edge, axis=0, dtype=np.int64)
    return np.packbits(2 * ones > total[:, None], axis=1, bitorder="little").view("<u8").reshape(-1).astype(np.int64)


def fingerprints(docs: DataFrame, n: int = 3) -> DataFrame:
    """doc_id and print (64 bits as a bigint) of each row; null and empty texts have print 0."""

    def task(batches: Batches) -> Batches:
        for batch in batches:
            for part in slices(batch, 1):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(text_prints(part.column(1), n))], names=["doc_id", "print"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(tidy(task), "doc_id bigint, print bigint")


def syndrome(half: np.ndarray) -> np.ndarray:
    """Exclusive or of the places (from 1) of all set bits: 0 for a word of the code, else the place of its one wrong bit."""
    out = np.zeros(len(half), np.int64)
    for k in range(5):
        places = sum(1 << (p - 1) for p in range(1, WIDTH + 1) if p >> k & 1)
        out |= (np.bitwise_count(half & places).astype(np.int64) & 1) << k
    return out


def anchors(half: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of the half, anchor and whether it is the home, for all anchors within two bits of each half."""
    wrong = syndrome(half)
    bit = np.where(wrong > 0, np.int64(1) << np.maximum(wrong - 1, 0), 0)
    number, anchor, home = [np.arange(len(half))], [half ^ bit], [np.ones(len(half), bool)]
    off = np.flatnonzero(wrong > 0)
    for place in range(1, WIDTH + 1):
        # Two flipped places lead to a word of the code if their exclusive or is the syndrome; each such pair is taken once.
        other = wrong[off] ^ place
        pick = other > place
        number.append(off[pick])
        anchor.append(half[off[pick]] ^ np.int64(1 << (place - 1)) ^ (np.int64(1) << (other[pick] - 1)))
        home.append(np.zeros(int(pick.sum()), bool))
    return np.concatenate(number), np.concatenate(anchor), np.concatenate(home)


def to_anchors(batches: Batches) -> Batches:
    """One row for each anchor that a fingerprint goes to; `free` has the bits outside the half."""
    for batch in batches:
        prints = batch.column(0).to_numpy()
        for h in range(2):
            inside = ((1 << WIDTH) - 1) << (h * WIDTH)
            number, anchor, home = anchors((prints >> (h * WIDTH)) & ((1 << WIDTH) - 1))
            free = np.full(len(number), np.array([~inside & (2**64 - 1)], np.uint64).view(np.int64)[0])
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (anchor | (h << WIDTH), free, prints[number], home)], schema=SENT)


def blocks(free: int) -> list[int]:
    """The set bits of a mask in four masks; the empty mask alone if there are fewer than four."""
    places = [p for p in range(64) if free >> p & 1]
    return [sum(1 << p for p in places[i::4]) for i in range(4)] if len(places) >= 4 else [0]


def deal_further(batches: Batches) -> Batches:
    """Rows of crowded anchors, once for each of four blocks of free bits, under a key that holds the block's value. Keys are hashes: two that
    meet by chance only let strangers be compared."""
    for batch in batches:
        key, free, prints, home = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        for mask in np.unique(free):
            rows = free == mask
            for block in blocks(int(mask) & (2**64 - 1)):
                chosen = np.uint64(block)
                value = mix(mix(prints[rows].view(np.uint64) & chosen) ^ key[rows].view(np.uint64)) ^ mix(np.array([chosen]))
                left = np.full(int(rows.sum()), np.int64(mask) & ~chosen.view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (mix(value).view(np.int64), left, prints[rows], home[rows])], schema=SENT)


def near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64)) <= DISTANCE


def star_edges(own: np.ndarray, all_here: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each group that links between own and other fingerprints hold together, one of its own with each other member."""
    linked = near(own[:, None], all_here[None, :])
    open_ = linked.sum(axis=1) > 1
    a, b = [], []
    for i in range(len(own)):
        if not open_[i]:
            continue
        members, reach = np.zeros(len(all_here), bool), np.zeros(len(own), bool)
        edge = np.array([i])
        while len(edge):
            reach[edge] = True
            members |= linked[edge].any(axis=0)
            edge = np.flatnonzero(linked[:, members].any(axis=1) & ~reach)
        open_ &= ~reach
        other = all_here[members & (all_here != own[i])]
        a.append(np.full(len(other), own[i]))
        b.append(other)
    none = np.zeros(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def compare_sorted(most: int):
    """Links within each key of rows that come sorted by key; keys with more than `most` rows are passed on as crowds, unless fewer than four bits
    are free."""

    def limit(free: np.ndarray) -> int:
        return most if int(np.bitwise_count(free[:1].view(np.uint64))[0]) >= 4 else LAST

    def crowd(key, free, prints, home) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (np.ones(len(key), bool), key, free, prints, home.astype(np.int64))], schema=MET)

    def links(a, b) -> pa.RecordBatch:
        zero = np.zeros(len(a), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (zero.astype(bool), zero, zero, a, b)], schema=MET)

    def whole(rows: list[np.ndarray]) -> Batches:
        """Complete keys only."""
        key, _, prints, home = rows
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(first, len(key)))
        group = np.repeat(np.arange(len(first)), size)
        few = (size[group] > 1) & (size[group] <= FEW)
        p, h, g = prints[few], home[few], group[few]
        for shift in range(1, min(FEW, len(p))):
            met = np.flatnonzero((g[shift:] == g[:-shift]) & (h[shift:] | h[:-shift]) & near(p[shift:], p[:-shift]))
            if len(met):
                yield links(p[met], p[met + shift])
        for i in np.flatnonzero(size > FEW):
            at = slice(first[i], first[i] + size[i])
            if size[i] > limit(rows[1][at]):
                yield crowd(*(x[at] for x in rows))
            elif home[at].any():
                yield links(*star_edges(prints[at][home[at]], prints[at]))

    def task(batches: Batches) -> Batches:
        kept: list[np.ndarray] | None = None
        crowded = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            if crowded is not None:
                end = int(np.searchsorted(rows[0] != crowded, True))
                yield crowd(*(x[:end] for x in rows))
                rows = [x[end:] for x in rows]
                if not len(rows[0]):
                    continue
                crowded = None
            if kept is not None:
                rows = [np.concatenate(x) for x in zip(kept, rows)]
            last = len(rows[0]) - int(np.searchsorted(rows[0][::-1] != rows[0][-1], True))
            if last:
                yield from whole([x[:last] for x in rows])
            kept = [x[last:] for x in rows]
            if len(kept[0]) > limit(kept[1]):
                crowded = kept[0][0]
                yield crowd(*kept)
                kept = None
        if kept is not None:
            yield from whole(kept)

    return task


def near_links(prints: DataFrame) -> DataFrame:
    """a, b: pairs of distinct fingerprints (column print) that hold the same groups together as all pairs of at most DISTANCE bits do."""
    n = partitions(prints.sparkSession)
    sent, found = prints.mapInArrow(tidy(to_anchors), ddl(SENT)), None
    while True:
        dealt = sent.repartition(n, "key").sortWithinPartitions("key")
        met = stored(dealt.mapInArrow(tidy(compare_sorted(CROWD)), ddl(MET)), "anchors")
        links = met.filter("NOT crowd").select("a", "b")
        found = links if found is None else found.union(links)
        crowds = met.filter("crowd").select("key", "free", F.col("a").alias("print"), (F.col("b") == 1).alias("home"))
        if is_empty(crowds):
            return found
        sent = crowds.mapInArrow(tidy(deal_further), ddl(SENT))


def link(docs: DataFrame, n: int = 3) -> DataFrame:
    """doc_id, print, component_id of every row: rows whose fingerprints differ in at most DISTANCE bits are linked, and component_id is the
    smallest doc_id that links lead to, the row's own included.

    Null, empty and white texts have fingerprint 0 and are linked like any other. Equal rows, and rows with equal ids, stay rows of
    their own. A null doc_id is no smallest id; a group without any other has component_id null. An empty table gives an empty one.
    """
    prints = stored(fingerprints(docs, n), "prints")
    classes = stored(prints.groupBy("print").agg(F.min("doc_id").alias("least")), "classes")
    roots = components(near_links(classes.select("print"))).select(F.col("node").alias("print"), "root")
    rooted = classes.join(roots, "print", "left").select("print", "least", F.coalesce("root", "print").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_print = rooted.join(least, "root").select("print", "component_id")
    return prints.join(of_print, "print").select("doc_id", "print", "component_id")
