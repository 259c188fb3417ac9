"""Benchmark items inside documents.

A window has as many words as an item; its fingerprint is the SimHash of its five-word shingles. Only windows that hold a shingle of
the benchmark can resemble an item, so windows are laid where a document's shingle meets an item's, item start on item start.
Fingerprints are cut into eight blocks of eight bits: two that differ in at most 23 bits differ by at most two bits in some block, so
items are filed under every block value within two bits, by window length, and windows look up their own blocks. Candidates within
the radius are verified by the weighted Jaccard similarity of their shingles, which counts a repeated shingle as often as it occurs.
Only Spark functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadshift.llm.native_words import grams, word_hashes
from loadshift.llm.shared import broadcast_if_small, row_hash, stored

GRAM = 5
BITS, BLOCKS = 64, 8
RADIUS = 23
SIMILARITY = 0.8
#: Tables of more rows than this are joined by shuffling instead of broadcast; a row has a few numbers.
SMALL = 500_000


def simhash(shingles: str) -> Column:
    """Bit b is set if more than half of the shingles' hashes have it."""
    return F.expr(
        f"""aggregate(sequence(0, {BITS - 1}), 0L, (a, b) ->
              a | CASE WHEN 2 * size(filter({shingles}, g -> (shiftright(g, b) & 1L) = 1L)) > size({shingles})
                       THEN shiftleft(1L, b) ELSE 0L END)"""
    )


def occurrences(shingles: str) -> Column:
    """A set with one member for each occurrence: the k-th of a shingle is a member of its own. So the sizes of intersections and
    unions of such sets are the sums of smaller and larger counts."""
    return F.expr(
        f"""CASE WHEN size(array_distinct({shingles})) = size({shingles}) THEN transform({shingles}, g -> xxhash64(g, 1))
              ELSE transform({shingles}, (g, i) -> xxhash64(g, size(filter(slice({shingles}, 1, i + 1), x -> x = g)))) END"""
    )


def _blocks(fingerprint: str) -> Column:
    width = BITS // BLOCKS
    return F.expr(f"transform(sequence(0, {BLOCKS - 1}), b -> named_struct('block', b, 'value', cast(shiftright({fingerprint}, b * {width}) & {(1 << width) - 1} AS int)))")


def _masks() -> list[int]:
    """All changes of at most RADIUS // BLOCKS bits within a block."""
    width, most = BITS // BLOCKS, RADIUS // BLOCKS
    return [m for m in range(1 << width) if m.bit_count() <= most]


def _text(name: str = "text") -> Column:
    return F.lower(F.coalesce(F.col(name).cast("string"), F.lit("")))


def item_table(benchmark: DataFrame) -> DataFrame:
    """item_id, item_words, item_grams, item_print of items with five words at least."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), word_hashes(_text()).alias("h"))
    items = items.withColumn("item_words", F.size("h")).filter(F.col("item_words") >= GRAM).withColumn("item_grams", grams("h", GRAM))
    return items.withColumn("item_print", simhash("item_grams")).drop("h")


def find(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, row (a hash of doc_id and text), item_id, start and length (in words of the document) of the best window of each
    document and item whose similarity is at least the given one, with that similarity and the fingerprints' distance.

    Texts are compared in lower case. Null or empty texts and items of fewer than five words match nothing; a document shorter than
    an item is one window. Rows equal in doc_id and text count once; a null doc_id is returned as null. Ties: the first start. Extra
    columns are not read. Empty tables give an empty table.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    keyed = docs.withColumn("row", row_hash(F.col("doc_id"), F.col("text")))
    items = stored(item_table(benchmark), "items")
    laid = items.select("item_words", F.posexplode("item_grams").alias("item_place", "gram")).distinct()
    # Every shingle of every document against those of the benchmark.
    hashed = keyed.select("row", word_hashes(_text()).alias("h"))
    shingles = hashed.select("row", F.size("h").alias("n"), grams("h", GRAM).alias("g"))
    # The outer form of explode keeps Spark from testing the array's size before it has a column.
    shingles = shingles.select("row", "n", F.posexplode_outer("g").alias("place", "gram")).filter(F.col("gram").isNotNull())
    hits = shingles.join(broadcast_if_small(laid, SMALL), "gram")
    length = F.least("item_words", "n")
    first = F.greatest(F.lit(0), F.least(F.col("place") - F.col("item_place"), F.col("n") - length))
    windows = hits.select("row", first.alias("start"), length.alias("length"), "item_words").distinct()
    windows = stored(windows.groupBy("row").agg(F.collect_list(F.struct("start", "length", "item_words")).alias("windows")), "windows")
    met = keyed.join(broadcast_if_small(windows, SMALL // 10), "row").dropDuplicates(["row", "doc_id"])
    met = met.withColumn("h", word_hashes(_text())).withColumn("g", grams("h", GRAM))
    each = met.select("doc_id", "row", "g", F.explode_outer("windows").alias("w")).select("doc_id", "row", "w.*", F.expr(f"slice(g, w.start + 1, w.length - {GRAM - 1})").alias("window_grams"))
    each = each.withColumn("window_print", simhash("window_grams"))
    filed = items.select("item_id", "item_words", "item_print", "item_grams", F.explode_outer(_blocks("item_print")).alias("b"))
    filed = filed.select("*", "b.block", F.explode_outer(F.transform(F.array(*[F.lit(m) for m in _masks()]), lambda m: F.col("b.value").bitwiseXOR(m))).alias("value")).drop("b")
    probes = each.select("*", F.explode_outer(_blocks("window_print")).alias("b")).select("*", "b.block", "b.value").drop("b")
    distance = F.bit_count(F.col("item_print").bitwiseXOR(F.col("window_print")))
    met_items = probes.join(filed.drop("item_grams"), ["item_words", "block", "value"]).withColumn("distance", distance).filter(F.col("distance") <= RADIUS)
    pairs = met_items.dropDuplicates(["row", "doc_id", "start", "length", "item_id"]).drop("block", "value", "window_print", "item_print")
    both = pairs.join(items.select("item_id", "item_grams"), "item_id")
    both = both.withColumn("a", occurrences("window_grams")).withColumn("b", occurrences("item_grams")).withColumn("shared", F.size(F.array_intersect("a", "b")))
    both = both.withColumn("similarity", F.col("shared") / (F.size("a") + F.size("b") - F.col("shared"))).filter(F.col("similarity") >= similarity)
    best = F.max_by(F.struct("start", "length", "distance", "similarity"), F.struct("similarity", -F.col("start")))
    return both.groupBy("doc_id", "row", "item_id").agg(best.alias("best")).select("doc_id", "row", "item_id", "best.*")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """docs without the rows in which find() meets an item; repeated rows go together, rows without text stay, an empty table stays empty."""
    found = find(docs, benchmark, similarity).select(F.col("row").alias("__llm_row"), F.col("doc_id").alias("__llm_id")).distinct()
    doc_id = F.col("doc_id").cast("bigint")
    keyed = docs.withColumn("__llm_key", row_hash(doc_id, F.col("text").cast("string")))
    same = (F.col("__llm_key") == F.col("__llm_row")) & doc_id.eqNullSafe(F.col("__llm_id"))
    return keyed.join(broadcast_if_small(stored(found, "contaminated"), SMALL), same, "left_anti").drop("__llm_key")
