"""Quality rules with thresholds that follow each language and source.

Every text is measured once (word, symbol, line and repetition counts, all by Spark functions). Quantile sketches of the measures are
built for each (language, source); sketches merge, so a group of any size is summarised where its rows lie and only sketches move.
A fence around the middle half of a group replaces a fixed cutoff; thresholds are joined back and decide.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadshift.llm.native_words import SPACE, grams, word_hashes
from loadshift.llm.shared import stored

NOT_SYMBOL = r"[^#*$%&|<>]+"
GRAM = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20


@dataclass(frozen=True)
class Fence:
    """Values outside quartile +- `reach` times the spread of the middle half fail; the spread counts as `least` at least, so that a
    group whose values hardly differ does not lose its normal rows."""

    measure: str
    low: bool
    high: bool
    reach: float
    least: float


FENCES = (
    Fence("symbol_share", False, True, 3.0, 0.01),
    Fence("line_repeat_share", False, True, 3.0, 0.1),
    Fence("word_repeat_share", False, True, 3.0, 0.05),
    Fence("word_length", True, True, 3.0, 1.0),
)
SKETCH_K = 400


def _repeated_words() -> Column:
    """Words that lie in a window of GRAM words found twice or more in the text.

    Window hashes are sorted together with their places. Equal neighbours are repeats; their places, sorted again, cover up to GRAM
    words each.
    """
    # Each step is a column of its own, so that no array is computed twice.
    return F.expr(
        f"""aggregate(
              transform(_quality_places, (p, i) -> least({GRAM}, coalesce(get(_quality_places, i + 1) - p, {GRAM}))),
              0L, (a, x) -> a + x)"""
    )


def measure(docs: DataFrame) -> DataFrame:
    """docs plus n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words; null text: no words."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.filter(F.split("_quality_text", "\n"), lambda x: x.rlike(r"[^\x09-\x0D\x20]"))
    out = docs.withColumn("_quality_text", text).withColumn("_quality_lines", lines).withColumn("_quality_hashes", word_hashes(F.col("_quality_text")))
    out = out.withColumn("n_words", F.size("_quality_hashes").cast("bigint"))
    out = out.withColumn("_quality_grams", grams("_quality_hashes", GRAM))
    keys = F.expr(
        """CASE WHEN size(array_distinct(_quality_grams)) < size(_quality_grams) THEN
             sort_array(transform(_quality_grams, (g, i) -> named_struct('gram', g, 'place', i))) END"""
    )
    places = F.expr(
        """sort_array(transform(
             filter(_quality_keys, (k, i) -> coalesce(k.gram = get(_quality_keys, i - 1).gram, false) OR coalesce(k.gram = get(_quality_keys, i + 1).gram, false)),
             k -> k.place))"""
    )
    out = out.withColumn("_quality_keys", keys).withColumn("_quality_places", places)
    counts = {
        "word_chars": F.length(F.regexp_replace("_quality_text", SPACE, "")).cast("bigint"),
        "n_symbols": F.length(F.regexp_replace("_quality_text", NOT_SYMBOL, "")).cast("bigint"),
        "n_lines": F.size("_quality_lines").cast("bigint"),
        "n_dup_lines": (F.size("_quality_lines") - F.size(F.array_distinct("_quality_lines"))).cast("bigint"),
        "n_repeat_words": F.coalesce(_repeated_words(), F.lit(0)).cast("bigint"),
    }
    return out.select(*docs.columns, "n_words", *[c.alias(n) for n, c in counts.items()])


def shares(measured: DataFrame) -> DataFrame:
    def ratio(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)

    return measured.withColumns(
        {
            "symbol_share": ratio("n_symbols", "word_chars"),
            "line_repeat_share": ratio("n_dup_lines", "n_lines"),
            "word_repeat_share": ratio("n_repeat_words", "n_words"),
            "word_length": ratio("word_chars", "n_words"),
        }
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def thresholds(rows: DataFrame, groups: list[str], fences: tuple[Fence, ...] = FENCES, k: int = SKETCH_K) -> DataFrame:
    """One row for each group: low_<measure> and high_<measure>. Sketches are partial aggregates of fixed size."""
    sketches = rows.groupBy(*groups).agg(*[F.kll_sketch_agg_double(f.measure, F.lit(k)).alias(f.measure) for f in fences])
    out = sketches
    for f in fences:
        q1, q3 = (F.kll_sketch_get_quantile_double(f.measure, F.lit(q)) for q in (0.25, 0.75))
        spread = F.greatest(q3 - q1, F.lit(f.least))
        out = out.withColumns({f"low_{f.measure}": q1 - f.reach * spread, f"high_{f.measure}": q3 + f.reach * spread})
    return out.select(*groups, *[f"{side}_{f.measure}" for f in fences for side in ("low", "high")])


def judge(docs: DataFrame, groups: tuple[str, ...] = ("lang", "source"), fences: tuple[Fence, ...] = FENCES) -> DataFrame:
    """docs with their measures, base_failed and kept.

    base_failed: fewer than 10 words, or over 20 % of words in repeated five-word windows. kept: not base_failed, and every measure
    within the fence of the row's group. Thresholds are drawn from the rows that pass the base rules. Null text: no words, so
    base_failed. A null language or source is a group of its own. Rows with equal doc_id are judged each for itself. Columns named
    like a result are replaced; an empty table gives an empty table.
    """
    own = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    docs = docs.drop(*own, *[f.measure for f in fences])
    rows = stored(shares(measure(docs).drop("text")).withColumn("base_failed", base_failed()), "measured")
    limits = thresholds(rows.filter(~F.col("base_failed")), list(groups), fences)
    keys = [f"_{g}" for g in groups]
    for g, k in zip(groups, keys):
        limits = limits.withColumnRenamed(g, k)
    joined = rows.join(limits, [rows[g].eqNullSafe(limits[k]) for g, k in zip(groups, keys)], "left")
    inside = F.lit(True)
    for f in fences:
        if f.low:
            inside &= F.col(f.measure) >= F.col(f"low_{f.measure}")
        if f.high:
            inside &= F.col(f.measure) <= F.col(f"high_{f.measure}")
    kept = ~F.col("base_failed") & F.coalesce(inside, F.lit(False))
    return joined.withColumn("kept", kept).drop(*keys, *[f"{side}_{f.measure}" for f in fences for side in ("low", "high")])
