"""Words and word shingles as arrays, by Spark functions alone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[\x09-\x0D\x20]+"


def words(text: Column) -> Column:
    """Runs of characters other than 0x20 and 0x09-0x0D."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def grams(hashes: str, n: int) -> Column:
    """Hashes of all runs of n words, from a column of word hashes; empty for fewer words."""
    parts = ", ".join(f"get({hashes}, i + {k})" for k in range(n))
    return F.expr(
        f"""CASE WHEN size({hashes}) >= {n} THEN transform(sequence(0, size({hashes}) - {n}), i -> xxhash64({parts}))
              ELSE cast(array() AS array<bigint>) END"""
    )
