"""Documents whose sets of word shingles have a Jaccard similarity of at least a threshold, and what they hang together to.

Equal sets are one class. Sets of a and b members whose similarity is t or more differ in at most d = (1 - t) / (1 + t) * (a + b) members.

* Parity sketch: every member flips one bit; the Hamming distance of two sketches is at most the number of members in which the sets
  differ. Sketches of a size band have a fixed width; a band's width is twice that of the band below, to which it folds.
* Pigeonhole: in each band members are dealt into m non-empty parts, and the parity bits of a part, drawn wide, make its signature.
  Two sets that differ in d members share at least m - d of their signatures.
* Verify: classes that share a signature are compared by their sketches, and if these are near enough, by their sets.

Signatures are sent packed and met in hash ranges. A signature that few classes share gives all their pairs. One that many share
gives none by itself: a class with fewer than m - d such signatures shares another one with each class it is linked to, so it is
done with. What remains are classes that consist of common passages, or have very many near copies. There some classes of a
signature, the pivots, are compared with all others, and once components are known only classes outside the signature's largest
component go on, until each signature's classes are one component or all its pairs across components have been compared. So no link
between components is lost, while a group of thousands of near copies needs few comparisons.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loadshift.llm.components import components
from loadshift.llm.shared import broadcast_if_small, is_empty, partitions, row_hash, stored
from loadshift.llm.substring_dedup import pack, unpack
from loadshift.llm.words import Hasher, find_words, lower_ascii, mix, slices, text_bytes, tidy

GRAM = 5
SIMILARITY = Fraction(4, 5)
#: Signatures that a task gathers before it sends them.
FLUSH = 500_000
#: Classes of a signature up to which all its pairs are compared at once.
FEW = 8
PIVOTS = 1
#: By which pivots grow from round to round, so that rounds grow with the logarithm of the classes that stay apart.
GROWTH = 64
#: Least bits of a sketch.
WIDTH = 256
#: Rows of candidates that are joined by broadcasting ids.
SMALL = 500_000
SEED = np.uint64(0xA0761D6478BD642F)


def band(n: np.ndarray) -> np.ndarray:
    """Number of the size band: sizes up to 2, 4, 8, ..."""
    return np.maximum(np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64), 1)


def parts_of(number: int) -> int:
    """Parts in a band. Sets of at least half the band's upper size fill more parts than they may differ in; small sets get so many
    that each member is a part of its own."""
    top = 1 << number
    return 1 << 20 if top <= 32 else top // 2 + 2


def sketch_bits(number: np.ndarray) -> np.ndarray:
    return np.maximum(np.int64(1) << (number + 1), WIDTH)


class Sets:
    """Distinct shingles of the documents of one slice: `member` sorted within each document, `bounds` of the documents."""

    def __init__(self, rows: pa.RecordBatch, text: int, hasher: Hasher, gram: int = GRAM):
        data, offsets = text_bytes(rows.column(text))
        words = find_words(lower_ascii(data), offsets)
        hashes = hasher.spans(words.data, words.start, words.end)
        at, found = hasher.windows(words, hashes, gram)
        doc = words.doc[at]
        short = np.flatnonzero((words.counts > 0) & (words.counts < gram))
        if len(short):
            whole = hasher.sequences(hashes, words.bounds[short], words.bounds[short + 1])
            found, doc = np.concatenate([found, whole]), np.concatenate([doc, short])
        order = np.lexsort((found, doc))
        found, doc = found[order], doc[order]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (found[1:] != found[:-1])
        self.member, self.doc = found[new], doc[new]
        self.bounds = np.searchsorted(self.doc, np.arange(rows.num_rows + 1))

    @property
    def size(self) -> np.ndarray:
        return np.diff(self.bounds)

    def _sums(self, seed: np.uint64) -> np.ndarray:
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(self.member ^ seed), dtype=np.uint64)])
        return sums[self.bounds[1:]] - sums[self.bounds[:-1]]

    def classes(self, bits: int = 63) -> np.ndarray:
        """An even number for each set, equal for equal sets."""
        found = mix(self._sums(SEED) ^ mix(self._sums(~SEED) + self.size.astype(np.uint64))).view(np.int64) & ~1
        return found & ((1 << bits) - 1) if bits < 63 else found

    def checks(self) -> np.ndarray:
        """Another 64 bits for each set, which tell unlike sets of one class apart."""
        return mix(self._sums(mix(np.array([SEED]))[0]) + mix(self.size.astype(np.uint64))).view(np.int64)


def parity_sketch(members: np.ndarray, bits: int) -> np.ndarray:
    """Bit i is the parity of the members that are i modulo the width, in 64-bit numbers."""
    places = (members % np.uint64(bits)).astype(np.int64)
    return np.packbits((np.bincount(places, minlength=bits) & 1).astype(np.uint8)).view(np.int64)


def hamming(a: np.ndarray, b: np.ndarray) -> int:
    """Of two sketches; the wider one is folded, which gives the sketch of half the width."""
    a, b = (a, b) if len(a) <= len(b) else (b, a)
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    # The count of a negative number would be that of its absolute value.
    return int(np.bitwise_count((a ^ b).view(np.uint64)).sum())


def distinct_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted by the first number, then the second."""
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[new], b[new]


# ---- documents and classes -------------------------------------------------------------------------------------------------

DESCRIBED = "doc_id bigint, row bigint, n_shingles bigint, class bigint, check bigint, sketch array<bigint>"


def _describer(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for rows in slices(batch, 2):
                sets = Sets(rows, 2, hasher)
                width = sketch_bits(band(sets.size))
                sketches = [parity_sketch(sets.member[a:b], int(w)) if b > a else None for a, b, w in zip(sets.bounds, sets.bounds[1:], width)]
                known = [pa.array(x, mask=sets.size == 0) for x in (sets.classes(bits), sets.checks())]
                columns = [rows.column(0), rows.column(1), pa.array(sets.size), *known, pa.array(sketches, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row", "n_shingles", "class", "check", "sketch"])

    return run


# ---- signatures ------------------------------------------------------------------------------------------------------------

#: Signatures with their classes, and of classes how many shared signatures a link leaves over.
PACKED = "bucket int, first binary, width int, steps binary, classes binary, owners binary, spare binary"


def signatures(sets: Sets, classes: np.ndarray, similarity: Fraction = SIMILARITY) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Signature and owner of every part, then the owners and how many signatures they share with any linked class at least, less one.

    A set sends the parts of its own band, as the smaller set of a pair, and those of the band below if a smaller set of a pair can
    be there; its owner numbers are its class and its class plus one."""
    t, size = similarity, sets.size
    own = band(size)
    below = band(-(-size * t.numerator // t.denominator))
    apart = t.denominator - t.numerator
    # The smaller set of a pair has a partner of at most n / t members; the larger one, sent to the band below, of at most n.
    most = {0: size * apart // t.numerator, 1: 2 * size * apart // (t.denominator + t.numerator)}
    out: list[list[np.ndarray]] = [[], [], [], []]
    for number in np.unique(np.concatenate([own, below])) if len(size) else []:
        number = int(number)
        docs = np.flatnonzero(((own == number) | (below == number)) & (size > 0))
        if not len(docs):
            continue
        taken = np.zeros(len(size), bool)
        taken[docs] = True
        take = taken[sets.doc]
        member, doc = sets.member[take], sets.doc[take]
        dealt = mix(member ^ np.uint64((number + 1) * int(SEED) % 2**64))
        part = ((dealt >> np.uint64(32)) * np.uint64(parts_of(number))) >> np.uint64(32)
        order = np.lexsort((part, doc))
        doc, part, member = doc[order], part[order], member[order]
        first = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (part[1:] != part[:-1])))
        parity = np.bitwise_xor.reduceat(mix(member + SEED), first)
        doc, part = doc[first], part[first]
        role = (own != number).astype(np.int64)
        owner = classes + role
        out[0].append(mix(parity ^ mix(part + np.uint64(number << 32))))
        out[1].append(owner[doc])
        out[2].append(owner[docs])
        out[3].append(np.bincount(doc, minlength=len(size))[docs] - np.where(role, most[1], most[0])[docs] - 1)
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in out)


def _dealt_out(keys: np.ndarray, buckets: int) -> dict[int, tuple[int, int]]:
    """For sorted 64-bit keys: the slice of each of `buckets` equal ranges of their upper half."""
    bucket = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    at = np.flatnonzero(np.diff(bucket, prepend=np.uint64(buckets)))
    return {int(bucket[a]): (int(a), int(b)) for a, b in zip(at, [*at[1:], len(keys)])}


def send_signatures(buckets: int, bits: int = 63, given: bool = False):
    """Of texts; a set's class is its number, or that given beside the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, parts, held = Hasher(), [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            s, c, o, n = (np.concatenate(x) for x in zip(*parts))
            s, c = distinct_pairs(s.view(np.uint64), c)
            o, n = distinct_pairs(o.view(np.uint64), n)
            sent, owned = _dealt_out(s, buckets), _dealt_out(o, buckets)
            numbers = sorted(sent.keys() | owned.keys())
            packed = [pack(s[slice(*sent[b])]) if b in sent else (None, None, None) for b in numbers]
            first, width, steps = zip(*packed)
            columns = [pa.array(numbers, pa.int32()), pa.array(first, pa.binary()), pa.array(width, pa.int32()), pa.array(steps, pa.binary())]
            for x, at in ((c, sent), (o, owned), (n.astype(np.int32), owned)):
                columns.append(pa.array([x[slice(*at.get(b, (0, 0)))].tobytes() for b in numbers], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "first", "width", "steps", "classes", "owners", "spare"])

        for batch in batches:
            for rows in slices(batch, 0):
                sets = Sets(rows, 0, hasher)
                parts.append(signatures(sets, rows.column(1).to_numpy() if given else sets.classes(bits)))
                held += len(parts[-1][0])
                if held >= FLUSH:
                    yield from flush()
                    parts, held = [], 0
        if held:
            yield from flush()

    return run


#: a and b: classes to compare. With a signature: owner a has it, and n share it. Without both: what a link leaves over to owner a, n.
MET = "signature bigint, a bigint, b bigint, n int"


def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One task's signatures: all pairs of classes of those that few share, the owners of the others."""
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    for batch in batches:
        for bucket, first, width, steps, c, o, n in zip(*(batch.column(i).to_pylist() for i in range(7))):
            if c:
                held.setdefault(bucket, []).append((unpack(first, width, steps), np.frombuffer(c, np.int64)))
            if o:
                o = np.frombuffer(o, np.int64)
                yield pa.RecordBatch.from_arrays([pa.nulls(len(o), pa.int64()), pa.array(o), pa.nulls(len(o), pa.int64()), pa.array(np.frombuffer(n, np.int32))], ["signature", "a", "b", "n"])
    while held:
        _, parts = held.popitem()
        s, c = distinct_pairs(*(np.concatenate(x) for x in zip(*parts)))
        first = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
        count = np.diff(np.append(first, len(s)))
        left, right = [], []
        for n in range(2, FEW + 1):
            at = first[count == n]
            left += [c[at + i] for i in range(n) for _ in range(i + 1, n)]
            right += [c[at + j] for i in range(n) for j in range(i + 1, n)]
        # Owners are classes, or one more.
        a, b = np.concatenate(left) & ~1, np.concatenate(right) & ~1
        a, b = distinct_pairs(np.minimum(a, b), np.maximum(a, b))
        sharers = np.repeat(count, count)
        many = sharers > FEW
        n, k = len(a), int(many.sum())
        columns = [
            pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(s[many].view(np.int64))]),
            pa.array(np.concatenate([a, c[many]])),
            pa.concat_arrays([pa.array(b), pa.nulls(k, pa.int64())]),
            pa.concat_arrays([pa.nulls(n, pa.int32()), pa.array(sharers[many].astype(np.int32))]),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["signature", "a", "b", "n"])


# ---- verification ----------------------------------------------------------------------------------------------------------


def fold(sketch: str) -> str:
    half = f"cast(size({sketch}) / 2 AS int)"
    return f"zip_with(slice({sketch}, 1, {half}), slice({sketch}, {half} + 1, {half}), (p, q) -> p ^ q)"


def near_enough(n: str, m: str, x: str, y: str, similarity: Fraction = SIMILARITY) -> Column:
    """Whether sizes n, m and sketches x, y of one width allow the similarity; a condition for Spark. hamming() says the same of two
    sketches at hand."""
    t, u = similarity.numerator, similarity.denominator
    distance = f"aggregate(zip_with({x}, {y}, (p, q) -> bit_count(p ^ q)), 0, (s, d) -> s + d)"
    return F.expr(f"{u} * least({n}, {m}) >= {t} * greatest({n}, {m}) AND {u + t} * {distance} <= {u - t} * ({n} + {m})")


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = Hasher()
    for batch in batches:
        for rows in slices(batch, 1):
            sets = Sets(rows, 1, hasher)
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.ListArray.from_arrays(pa.array(sets.bounds, pa.int32()), pa.array(sets.member.view(np.int64)))], ["class", "members"])


def verify(pairs: DataFrame, classes: DataFrame, keyed: DataFrame) -> DataFrame:
    """Those pairs (a, b) of classes whose sets are similar. classes: class, row, n_shingles, sketch; keyed: row, text."""
    side = classes.select("class", "row", "n_shingles", "sketch")
    both = pairs.join(side.toDF("a", "row_a", "n", "x"), "a").join(side.toDF("b", "row_b", "m", "y"), "b")
    # Classes that share a signature are of one band or of neighbours.
    even = {"u": F.expr(f"CASE WHEN size(x) > size(y) THEN {fold('x')} ELSE x END"), "v": F.expr(f"CASE WHEN size(y) > size(x) THEN {fold('y')} ELSE y END")}
    near = stored(both.withColumns(even).filter(near_enough("n", "m", "u", "v")).select("a", "b", "row_a", "row_b"), "near")
    sides = F.array(*[F.struct(F.col(c).alias("class"), F.col(r).alias("row")) for c, r in (("a", "row_a"), ("b", "row_b"))])
    wanted = near.select(F.inline(sides)).distinct()
    texts = keyed.join(broadcast_if_small(stored(wanted, "wanted"), SMALL), "row").dropDuplicates(["class"])
    sets = stored(texts.select("class", "text").mapInArrow(tidy(_members), "class bigint, members array<bigint>"), "sets")
    both = near.select("a", "b").join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b").select("a", "b", "x", "y")
    t, u = SIMILARITY.numerator, SIMILARITY.denominator
    shared = F.size(F.array_intersect("x", "y"))
    return both.filter(u * shared >= t * (F.size("x") + F.size("y") - shared)).select("a", "b")


def with_sketches(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Adds n and sketch of each class a, in the width of the band for which `folded` rows are one band too wide."""
    sketch = F.expr(f"CASE WHEN folded AND size(sketch) > {WIDTH // 64} THEN {fold('sketch')} ELSE sketch END")
    sides = classes.select(F.col("class").alias("a"), F.col("n_shingles").alias("n"), "sketch")
    return rows.join(sides, "a").withColumn("sketch", sketch)


def across(members: DataFrame, labels: DataFrame | None, pivots: int, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs to compare for signatures that many classes share, and the members of signatures that may need another round.

    members: signature, a (class), folded (whether in the band below its own), central (how much the class shares with others: among
    near copies of one text, those nearest to it share most and are linked to most). Of each signature, the classes outside its
    largest component are what is left; at most about `pivots` of them are compared with all classes of other components. Where no
    more than that are left, the signature is done with."""
    if labels is None:
        labelled = members.withColumn("root", F.col("a"))
    else:
        labelled = members.join(labels.select(F.col("node").alias("a"), "root"), "a", "left").withColumn("root", F.coalesce("root", "a"))
    sizes = labelled.groupBy("signature", "root").count()
    largest = sizes.groupBy("signature").agg(F.max(F.struct("count", "root")).alias("top"), F.sum("count").alias("n"))
    open_ = largest.select("signature", F.col("top.root").alias("top"), (F.col("n") - F.col("top.count")).alias("rest")).filter("rest > 0")
    labelled = stored(labelled.join(open_, "signature"), "labelled")
    rest = labelled.filter("root <> top")
    # Of each of `pivots` residues the most central class, the same one in all its signatures.
    slot = F.when(F.col("rest") > pivots, F.pmod(F.xxhash64("a", F.lit(pivots)), F.lit(pivots)).cast("bigint")).otherwise(F.col("a"))
    picked = rest.groupBy("signature", slot.alias("slot")).agg(F.max(F.struct("central", "a", "root", "folded")).alias("p"))
    picked = with_sketches(picked.select("signature", "p.a", "p.root", "p.folded"), classes)
    names = ["a", "root", "n", "sketch"]
    picked = picked.select("signature", *[F.col(c).alias(f"pivot_{c}") for c in names])
    each = with_sketches(labelled.select("signature", "a", "root", "folded"), classes).select("signature", *names)
    # Sizes and sketches are compared within the join, so that only pairs near enough come out of it.
    near = near_enough("n", "pivot_n", "sketch", "pivot_sketch")
    met = each.join(picked, (each["signature"] == picked["signature"]) & F.expr("root <> pivot_root") & near)
    pairs = met.select(F.least("a", "pivot_a").alias("a"), F.greatest("a", "pivot_a").alias("b")).distinct()
    return pairs, labelled.filter(F.col("rest") > pivots).select("signature", "a", "folded", "central")


def apart(rows: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Rows in which each class holds equal sets only: unlike sets of one class, told apart by their check, get classes of their own,
    but for the smallest check. Then the rows (row, class) that got one, if there are any."""
    checks = rows.filter(F.col("class").isNotNull()).groupBy("class").agg(F.min("check").alias("least"), F.max("check").alias("most"))
    mixed = stored(checks.filter("least <> most").select(F.col("class").alias("mixed"), "least"), "mixed")
    if is_empty(mixed):
        return rows, None
    own = F.when(F.col("check") != F.col("least"), F.xxhash64("class", "check").bitwiseAND(F.lit(-2)))
    told = stored(rows.join(mixed, F.col("class") == F.col("mixed"), "left").withColumn("own", own).drop("mixed", "least"), "told")
    return told.withColumn("class", F.coalesce("own", "class")), told.filter(F.col("own").isNotNull()).select("row", F.col("own").alias("class")).distinct()


def link_rows(docs: DataFrame, class_bits: int = 63) -> DataFrame:
    """doc_id, row (a hash of doc_id and text), n_shingles (size of the set), class_id (equal for equal sets), root (equal for what is
    linked) and component_id of each row of docs (doc_id, text).

    The set of a text: its distinct five-word shingles in lower case; with fewer words the whole sequence as one. Null or empty text,
    or one without words: an empty set, null class_id, linked with nothing. Two rows are linked if their sets' similarity is 0.8 or
    more; component_id is the smallest doc_id that links lead to, the row's own included. A null doc_id is smaller than none and is
    returned as null unless its component has another. Repeated rows are equal sets. Extra columns are not read; an empty table
    gives an empty table. Sets are equal if 127 bits of them are; narrower class numbers (`class_bits`) change no result.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    keyed = docs.withColumn("row", row_hash(F.col("doc_id"), F.col("text")))
    rows, again = apart(stored(keyed.select("doc_id", "row", "text").mapInArrow(tidy(_describer(class_bits)), DESCRIBED), "described"))
    # A class is represented by the text of one of its rows.
    sizes = rows.filter(F.col("class").isNotNull()).groupBy("class")
    classes = stored(sizes.agg(F.min("doc_id").alias("least"), F.min("row").alias("row"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch")), "classes")
    n = partitions(spark)
    sent = docs.select("text").mapInArrow(tidy(send_signatures(n, class_bits)), PACKED)
    if again is not None:
        sent = sent.union(keyed.join(again, "row").select("text", "class").mapInArrow(tidy(send_signatures(n, class_bits, True)), PACKED))
    met = stored(sent.repartition(n, "bucket").mapInArrow(tidy(meet), MET), "met")
    many = met.filter(F.col("signature").isNotNull()).select("signature", F.col("a").alias("owner"), F.col("n").alias("sharers"))
    spare = met.filter(F.col("signature").isNull() & F.col("b").isNull()).groupBy(F.col("a").alias("owner")).agg(F.min("n").alias("spare"))
    bound = many.groupBy("owner").agg(F.count(F.lit(1)).alias("shared"), F.sum("sharers").alias("central")).join(spare, "owner").filter("shared > spare")
    # A linked class shares over `spare` signatures with the owner, so one of the rarest that remain without `spare` is enough.
    place = F.row_number().over(Window.partitionBy("owner").orderBy("sharers", "signature"))
    few = many.join(bound, "owner").withColumn("place", place).filter("place <= shared - spare")
    few = few.select("signature", F.col("owner").bitwiseAND(F.lit(-2)).alias("a"), (F.col("owner") % 2 != 0).alias("folded"), "central")
    pairs, many = across(stored(few, "many"), None, PIVOTS, classes)
    many = stored(many, "many")
    pairs = met.filter(F.col("b").isNotNull()).select("a", "b").union(pairs).distinct()
    links, pivots = None, PIVOTS
    while True:
        # A round without pairs only says that its pivots have none; signatures with more classes than pivots go on.
        if links is None or not is_empty(pairs):
            found = stored(verify(pairs, classes, keyed), "links")
            links = found if links is None else links.union(found)
            labels = components(links)
        pivots *= GROWTH
        pairs, many = across(many, labels, pivots, classes)
        pairs, many = stored(pairs, "pairs"), stored(many, "many")
        if is_empty(pairs) and is_empty(many):
            break
    root = classes.select("class", "least").join(labels.select(F.col("node").alias("class"), "root"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    smallest = root.groupBy("root").agg(F.min("least").alias("component_id"))
    by_class = stored(root.join(smallest, "root").select("class", "root", "component_id"), "by_class")
    out = rows.drop("sketch", "check").join(by_class, "class", "left")
    return out.select("doc_id", "row", "n_shingles", F.col("class").alias("class_id"), "root", F.coalesce("component_id", "doc_id").alias("component_id"))


def link(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, class_id and component_id of each row of docs; see link_rows()."""
    return link_rows(docs).select("doc_id", "n_shingles", "class_id", "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text and any columns) with one row of each linked group, the one of the smallest doc_id, null after all others, and
    among those of the smallest hash of doc_id and text. Rows with an empty set stay, all of them."""
    rows = stored(link_rows(docs).filter(F.col("root").isNotNull()).select("doc_id", "row", "root"), "linked")
    last = F.lit(int(np.iinfo(np.int64).max))
    first = rows.groupBy("root").agg(F.min(F.struct(F.coalesce("doc_id", last), "row")).alias("first"))
    stays = first.select("root", F.col("first.row").alias("stays"))
    gone = rows.join(stays, "root").filter("row <> stays").select(F.col("row").alias("__llm_gone"), F.col("doc_id").alias("__llm_id")).distinct()
    doc_id = F.col("doc_id").cast("bigint")
    keyed = docs.withColumn("__llm_row", row_hash(doc_id, F.col("text").cast("string")))
    same = (F.col("__llm_row") == F.col("__llm_gone")) & doc_id.eqNullSafe(F.col("__llm_id"))
    left = keyed.join(broadcast_if_small(stored(gone, "gone"), SMALL), same, "left_anti")
    repeated = rows.groupBy("row", "doc_id").count().filter("count > 1")
    if not is_empty(repeated):
        # Rows equal in doc_id and text have one hash; those without words are not in `rows` and get a number of their own.
        again = stored(repeated.select(F.col("row").alias("__llm_again")).distinct(), "repeated")
        twice = left.join(broadcast_if_small(again, SMALL), F.col("__llm_row") == F.col("__llm_again"), "left")
        left = twice.filter(F.col("__llm_again").isNull()).unionByName(twice.filter(F.col("__llm_again").isNotNull()).dropDuplicates(["__llm_row", "doc_id"]))
    return left.select(*docs.columns)
