"""Secret scans with an incremental ledger of blobs.

Every text is addressed by its SHA-256, so any number of paths and historical versions of it are one blob. The ledger records which
(blob, rule, rule version) has been scanned and what was found; a run scans only the pairs that are missing, appends to the ledger
and joins the findings of all blobs back to all paths. Only Spark functions are used.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


@dataclass(frozen=True)
class Rule:
    """Leftmost matches of `pattern` that do not overlap; one whose `group` has fewer than `least` characters is dropped."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


#: Fixed patterns of the base kinds.
BASE = (
    Rule("assign", 1, r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20),
    # Greedy runs of fewer characters would be dropped whole, so the shortest length may stand in the pattern.
    Rule("hex", 1, r"[0-9a-f]{24,}"),
)
#: Further kinds.
RULES = (
    *BASE,
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*(?:-----END [A-Z ]*PRIVATE KEY-----)?"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("forge", 1, r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("login", 1, r"[a-z][a-z0-9+.-]{1,15}://[^\s/:@]{1,64}:[^\s/@]{1,64}@"),
)
FINDINGS = "blob binary, rule string, kind string, start int, end int"
SCANNED = "blob binary, rule string"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _matches(text: str, rule: Rule) -> Column:
    """What stands before each match, the match and its tested group, in lengths; NULL without a match.

    Splitting at the pattern gives the parts between the matches, so running sums of both give places."""
    pattern = _literal(rule.pattern)
    return F.expr(
        f"""CASE WHEN {text} RLIKE {pattern} THEN transform(
              arrays_zip(
                slice(split({text}, {pattern}, -1), 1, size(regexp_extract_all({text}, {pattern}, 0))),
                regexp_extract_all({text}, {pattern}, 0),
                regexp_extract_all({text}, {pattern}, {rule.group})),
              z -> named_struct('gap', length(z['0']), 'size', length(z['1']), 'tested', length(z['2']))) END"""
    )


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Findings of blobs (blob, text, wanted: rule keys to run)."""
    found = [
        F.struct(F.lit(r.key).alias("rule"), F.lit(r.kind).alias("kind"), F.lit(r.least).alias("least"), F.when(F.array_contains("wanted", r.key), _matches("text", r)).alias("matches"))
        for r in rules
    ]
    # The outer form of explode keeps Spark from scanning the texts once more for empty results.
    by_rule = blobs.select("blob", F.explode_outer(F.filter(F.array(*found), lambda x: x["matches"].isNotNull())).alias("f"))
    each = by_rule.select("blob", "f.rule", "f.kind", "f.least", F.posexplode_outer("f.matches").alias("number", "m")).filter(F.col("m").isNotNull())
    upto = Window.partitionBy("blob", "rule").orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    ends = each.withColumn("end", F.sum(F.col("m.gap") + F.col("m.size")).over(upto).cast("int"))
    return ends.filter(F.col("m.tested") >= F.col("least")).select("blob", "rule", "kind", (F.col("end") - F.col("m.size")).alias("start"), "end")


class Ledger:
    """Two append-only Parquet tables below a shared folder. A run's findings are written before its pairs count as scanned, and each
    run has its own folders, so a run that breaks off leaves nothing that counts."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _read(self, name: str, schema: str) -> DataFrame | None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return None
        return self.spark.read.schema(schema + ", run string").parquet(f"{self.folder}/{name}")

    def scanned(self) -> DataFrame | None:
        return self._read("scanned", SCANNED)

    def findings(self) -> DataFrame | None:
        """Only of runs whose pairs count as scanned."""
        found, done = self._read("findings", FINDINGS), self.scanned()
        if found is None or done is None:
            return None
        return found.join(done.select("run").distinct(), "run", "left_semi").drop("run")

    def append(self, findings: DataFrame, scanned: DataFrame) -> None:
        run = uuid.uuid4().hex
        findings.withColumn("run", F.lit(run)).write.mode("append").partitionBy("run").parquet(f"{self.folder}/findings")
        scanned.withColumn("run", F.lit(run)).write.mode("append").partitionBy("run").parquet(f"{self.folder}/scanned")


def scan(paths: DataFrame, folder: str, rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, DataFrame]:
    """Scans the texts of `paths` (any columns, one of them text) against the ledger in `folder`.

    Returns paths without text but with `blob`, and all findings of the given rules: blob, rule, kind, start, end (code points, end
    exclusive). Null text counts as empty. Equal texts are scanned once, however many rows hold them; a rule whose version has not
    changed never sees a blob again. An empty table scans nothing.
    """
    addressed = paths.withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit(""))).withColumn("blob", F.unhex(F.sha2("text", 256)))
    ledger = Ledger(paths.sparkSession, folder)
    keys = F.array(*[F.lit(r.key) for r in rules])
    # The copies of a text meet where they lie first, so a hot blob moves once for each task.
    blobs = addressed.groupBy("blob").agg(F.first("text").alias("text"))
    done = ledger.scanned()
    if done is None:
        blobs = blobs.withColumn("wanted", keys)
    else:
        seen = done.groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        blobs = blobs.join(seen, "blob", "left").withColumn("wanted", F.array_except(keys, F.coalesce("seen", F.array().cast("array<string>"))))
        blobs = blobs.drop("seen").filter(F.size("wanted") > 0)
    ledger.append(scan_blobs(blobs, rules), _pairs(addressed, done, rules))
    return addressed.drop("text"), ledger.findings().filter(F.col("rule").isin([r.key for r in rules]))


def _pairs(addressed: DataFrame, done: DataFrame | None, rules: tuple[Rule, ...]) -> DataFrame:
    """All pairs of a blob and a rule version that the ledger lacks."""
    pairs = addressed.select("blob").distinct().select("blob", F.explode(F.array(*[F.lit(r.key) for r in rules])).alias("rule"))
    return pairs if done is None else pairs.join(done.select("blob", "rule"), ["blob", "rule"], "left_anti")


def spans_by_blob(findings: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """blob, spans: all findings as array of (start, rank of the kind in `rules`, end, kind), in that order."""
    rank = F.array_position(F.array(*[F.lit(r.kind) for r in rules]), F.col("kind")).cast("int")
    return findings.groupBy("blob").agg(F.sort_array(F.collect_set(F.struct("start", rank.alias("rank"), "end", "kind"))).alias("spans"))


def with_spans(paths: DataFrame, folder: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """paths without text, plus `blob` and `spans` of each, which replace columns of these names; rows without a finding have an empty
    array."""
    addressed, findings = scan(paths.drop("blob", "spans"), folder, rules)
    empty = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")
    joined = addressed.join(spans_by_blob(findings, rules), "blob", "left")
    return joined.withColumn("spans", F.coalesce("spans", empty))


def redact(docs: DataFrame, folder: str, rules: tuple[Rule, ...] = RULES, mark: str = "[secret]") -> DataFrame:
    """docs with every found span replaced by `mark`; overlapping spans are replaced once. Texts without a finding and nulls stay as
    they are. The columns stay the same."""
    _, findings = scan(docs.select("text"), folder, rules)
    spans = spans_by_blob(findings, rules).select(F.col("blob").alias("__llm_blob"), "spans")
    # Spans ascend by start: one that begins before the end so far adds only what lies beyond.
    cut = F.expr(
        f"""aggregate(__llm_spans, named_struct('at', 0, 'out', cast('' AS string)),
              (a, s) -> named_struct(
                'at', greatest(a.at, s.end),
                'out', CASE WHEN s.start >= a.at THEN concat(a.out, substring(text, a.at + 1, s.start - a.at), {_literal(mark)}) ELSE a.out END),
              a -> concat(a.out, substring(text, a.at + 1)))"""
    )
    joined = docs.withColumn("__llm_address", F.unhex(F.sha2(F.col("text"), 256))).join(spans.withColumnRenamed("spans", "__llm_spans"), F.col("__llm_address") == F.col("__llm_blob"), "left")
    return joined.withColumn("text", F.when(F.col("__llm_spans").isNull(), F.col("text")).otherwise(cut)).select(*docs.columns)
