"""Column builders shared by the operators; all stay inside the JVM.

Wide expressions are SQL text: one parsed string costs far less to set up than a tree of Python calls.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day names Monday..Sunday and month names, in calendar order.
DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
MONTH_NAMES = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]


def number(col: Column | str) -> Column:
    """Text to number; anything unparsable, NaN included, is NULL."""
    value = F.col(col) if isinstance(col, str) else col
    parsed = value.try_cast("double")
    return F.when(~F.isnan(parsed), parsed)


def safe_name(col: Column | str) -> Column:
    """Entity id as an identifier: dots to underscores, parentheses removed, lower case."""
    return F.lower(F.translate(col, ".()", "_"))


def safe_name_spaced(col: Column | str) -> Column:
    """The CSV households' variant, where blanks become underscores."""
    return F.lower(F.translate(col, " ()", "_"))


def time_features(ts: Column | str) -> dict[str, Column]:
    ts = F.col(ts) if isinstance(ts, str) else ts
    weekday = F.weekday(ts)
    return {
        "hour": F.hour(ts).cast("int"),
        "day_of_week": weekday.cast("int"),
        "day_name": F.date_format(ts, "EEEE"),
        "month": F.month(ts).cast("int"),
        "month_name": F.date_format(ts, "MMMM"),
        "weekend": (weekday >= 5).cast("int"),
    }


def dummies(col: Column, categories: list[str], prefix: str) -> list[Column]:
    """One 0/1 column per category but the alphabetically first one."""
    first = min(categories)
    return [(col == c).cast("int").alias(f"{prefix}_{c}") for c in categories if c != first]


def day_dummies(ts: str) -> list[Column]:
    return [
        F.expr(f"cast(weekday(`{ts}`) = {i} AS int) AS day_name_{name}")
        for i, name in enumerate(DAY_NAMES)
        if name != "Friday"
    ]


def dot(a: str, b: str) -> str:
    """Dot product of two array expressions; a missing element counts as zero."""
    return f"aggregate(zip_with({a}, {b}, (x, y) -> coalesce(x * y, 0D)), 0D, (acc, x) -> acc + x)"


def dot_strict(a: str, b: str) -> str:
    """Dot product that is NULL when any element is missing."""
    return f"aggregate(zip_with({a}, {b}, (x, y) -> x * y), 0D, (acc, x) -> acc + x)"


def sliding_costs(prices: str, load: str, hours: int = 24) -> Column:
    """cost(h) = sum over j of prices[h + j] * load[j], for h = 0..hours-1, in money per MWh times W."""
    cost = dot_strict(f"slice({prices}, h + 1, size({load}))", load)
    return F.expr(f"transform(sequence(0, {hours - 1}), h -> {cost} / 1e6D)")
