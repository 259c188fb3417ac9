"""URL filters whose patterns are found by their rarest literal token.

A rule is a regular expression over host and path together with the literal tokens that every URL it matches must hold. Tokens of all
URLs are counted; each rule is filed under the one of its tokens that fewest URLs hold. A URL's tokens fetch the rules filed under them,
and only those run their expression, so the work follows the matches and not rules times URLs.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadshift.llm.shared import stored

TOKEN = r"[^a-z0-9]+"
RULE = "name string, rule_verdict string, pattern string, literals array<string>, base boolean"


@dataclass(frozen=True)
class UrlRule:
    """A pattern runs over host and path put together; a host holds no slash, and a path is empty or begins with one. `name` is reported. The longest matching base rule decides; without one, any other rule that matches blocks."""

    name: str
    verdict: str
    pattern: str
    literals: tuple[str, ...]
    base: bool


def path_rule(verdict: str, name: str) -> UrlRule:
    """A rule "host/path": the host and its subdomains, paths that start like this."""
    host, path = name.split("/", 1)
    # Only whole labels of the host are sure to be tokens of the URL; a path may go on where the rule's ends.
    literals = tuple(t for t in re.split(TOKEN, host) if t) + tuple(t for t in re.split(TOKEN, path.rpartition("/")[0].lower()) if t)
    return UrlRule(name, verdict, rf"^(?:[^/]*\.)?{re.escape(host)}/{re.escape(path)}", literals, True)


def host_word_rule(word: str) -> UrlRule:
    """Blocks hosts with this word between dots and hyphens, like `pills` in www.cheap-pills.example.net."""
    return UrlRule(word, "block", rf"^(?:[^/]*[.-])?{re.escape(word)}(?:[.-][^/]*)?(?:/|$)", (word,), False)


#: The given host and path rules, fixed.
BASE_RULES = tuple(path_rule(v, n) for v, n in (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")))
#: Words of hosts that sell, bet or track, fixed.
HOST_WORDS = ("ads", "adult", "bets", "casino", "payday", "pills", "replica", "spam", "xxx")
RULES = BASE_RULES + tuple(host_word_rule(w) for w in HOST_WORDS)


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without `://`."""
    raw = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens(host: Column, path: Column) -> Column:
    lower = F.translate(F.concat(host, path), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_distinct(F.filter(F.split(lower, TOKEN), lambda t: t != ""))


def rule_table(spark: SparkSession, rules: tuple[UrlRule, ...]) -> DataFrame:
    return spark.createDataFrame([(r.name, r.verdict, r.pattern, list(r.literals), r.base) for r in rules], RULE)


def path_rule_table(rules: DataFrame) -> DataFrame:
    """A table (name "host/path", verdict) as base rules, for lists of any length. A name without a slash, or null, is no rule."""

    def made(names: pd.Series) -> pd.DataFrame:
        each = [path_rule("", n) for n in names]
        return pd.DataFrame({"pattern": [r.pattern for r in each], "literals": [list(r.literals) for r in each]})

    named = rules.filter(F.contains("name", F.lit("/"))).select("name", F.col("verdict").alias("rule_verdict"))
    parts = F.pandas_udf(made, "pattern string, literals array<string>")(F.col("name"))
    return named.withColumn("made", parts).select("name", "rule_verdict", "made.pattern", "made.literals", F.lit(True).alias("base"))


def pattern_table(rules: DataFrame) -> DataFrame:
    """A table (name, pattern) as rules that block what their pattern matches; their literals are derived from it. Rows with a null are
    no rules."""

    def derived(patterns: pd.Series) -> pd.Series:
        return pd.Series([required_tokens(p) for p in patterns])

    whole = rules.filter("name IS NOT NULL AND pattern IS NOT NULL")
    literals = F.pandas_udf(derived, "array<string>")(F.col("pattern")).alias("literals")
    return whole.select("name", F.lit("block").alias("rule_verdict"), "pattern", literals, F.lit(False).alias("base"))


#: Stands for text that a pattern does not fix, and for the ends of a URL.
OPEN, EDGE = "\uffff", "\n"


def required_tokens(pattern: str) -> list[str]:
    """Tokens that every text holds which a pattern matches: runs of letters and digits that the pattern spells out, with an end of the
    text or a spelt-out other character on both sides. Alternatives, repeats and sets count as unknown; so does the whole of a pattern that
    Python's parser does not know. No token is always a right answer, it only costs more."""
    try:
        spelt = "".join(_spelt(re._parser.parse(pattern)))  # type: ignore[attr-defined]
    except (re.error, OverflowError, RecursionError):
        return []
    lower = re.sub("[A-Z]+", lambda m: m[0].lower(), spelt)
    return sorted(set(re.findall(rf"(?<=[^a-z0-9{OPEN}])[a-z0-9]+(?=[^a-z0-9{OPEN}])", lower)))


def _spelt(parts: Iterable[tuple[Any, Any]]) -> Iterable[str]:
    for kind, value in parts:
        kind = str(kind)
        if kind == "LITERAL":
            # A bracket left over may close a nested set in Java's notation.
            yield OPEN if chr(value) == "]" else chr(value)
        elif kind == "AT" and str(value) in ("AT_BEGINNING", "AT_BEGINNING_STRING", "AT_END", "AT_END_STRING"):
            yield EDGE
        elif kind == "SUBPATTERN":
            yield from _spelt(value[3])
        elif kind == "IN" and all(str(k) == "LITERAL" and chr(c) != "[" and not chr(c).isalnum() for k, c in value):
            # One of a few characters that end a token.
            yield EDGE
        else:
            yield OPEN


def file_rules(rules: DataFrame, places: DataFrame) -> DataFrame:
    """Rules with `token`, the literal that fewest rows of `places` (host, path, tokens) hold; ties: the first by text. Rules without a
    literal get the token '' and meet every URL. Repeated rules are filed once."""
    of = ["name", "rule_verdict", "pattern", "base"]
    words = rules.select(*of, F.explode_outer(F.array_distinct("literals")).alias("token"))
    counts = places.select(F.explode("tokens").alias("token")).join(words.select("token").distinct(), "token", "left_semi").groupBy("token").count()
    rarest = F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), F.coalesce("token", F.lit("")).alias("token")))
    return words.join(counts, "token", "left").groupBy(*of).agg(rarest.alias("r")).select(*of, "r.token")


def fetch(places: DataFrame, filed: DataFrame) -> DataFrame:
    """host, path and each rule filed under one of their tokens. Spark broadcasts the rules while their bytes allow; otherwise frequent
    tokens are split by adaptive execution."""
    # '' stands for rules without a literal.
    return places.select("host", "path", F.explode(F.concat("tokens", F.array(F.lit("")))).alias("token")).join(filed, "token")


def judge(pages: DataFrame, rules: tuple[UrlRule, ...] | DataFrame = RULES) -> DataFrame:
    """pages plus host, path, rule (name of the longest matching base rule, else null), blocked_by (names of matching other rules,
    sorted) and verdict: the base rule's, else block if any other rule matches, else allow.

    `rules` is a tuple, or a table as `path_rule_table` and `pattern_table` give it, which never passes through the driver. No rules: all
    is allowed. Null URL or one without `://`: host and path empty, and no rule matches. Rows stay as they are, repeated ones too; columns named
    like a result are replaced. Equal host and path are judged once. An empty table gives an empty table.
    """
    spark = pages.sparkSession
    pages = pages.drop("host", "path", "rule", "blocked_by", "verdict")
    located = pages.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    places = stored(located.select("host", "path").distinct().withColumn("tokens", tokens(F.col("host"), F.col("path"))), "places")
    table = rules if isinstance(rules, DataFrame) else rule_table(spark, rules)
    matched = fetch(places, file_rules(table, places)).filter(F.rlike(F.concat("host", "path"), F.col("pattern")))
    longest = F.max(F.when(F.col("base"), F.struct(F.length("name").alias("size"), "name", "rule_verdict")))
    others = F.sort_array(F.collect_set(F.when(~F.col("base"), F.col("name"))))
    decided = matched.groupBy("host", "path").agg(longest.alias("best"), others.alias("blocked_by"))
    joined = located.join(decided, ["host", "path"], "left")
    blocked = F.coalesce("blocked_by", F.array().cast("array<string>"))
    verdict = F.coalesce("best.rule_verdict", F.when(F.size(blocked) > 0, "block").otherwise("allow"))
    return joined.select(*pages.columns, "host", "path", F.col("best.name").alias("rule"), blocked.alias("blocked_by"), verdict.alias("verdict"))
