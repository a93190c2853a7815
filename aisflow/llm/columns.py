"""Small column helpers that several operators share."""

import json
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The separators of words, and a word.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A lambda that mentions an outer expression computes it anew for every
    element; bound as the element of a one-element array it is a variable.
    """
    return F.transform(F.array(value), body)[0]


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text, in order."""
    return F.array_remove(F.split(text, SPACE + "+"), "")


def position_in(value: Column, points: list) -> Column:
    """How many of the sorted ``points`` are at most ``value`` (a null counts as
    below all): binary search, so thousands of points cost a dozen steps a row."""
    if not points:
        return F.lit(0)
    table = F.array(*[F.lit(p) for p in points]) if len(points) < 100 else _literal_array(points)
    steps = max(1, len(points).bit_length())
    powers = F.array(*[F.lit(1 << k) for k in reversed(range(steps))])
    size = len(points)

    def step(at: Column, power: Column) -> Column:
        there = at + power
        return F.when((there <= size) & (F.get(table, there - 1) <= value), there).otherwise(at)

    return F.aggregate(powers, F.lit(0), step)


def _literal_array(points: list) -> Column:
    """One literal instead of thousands of expressions; texts or longs."""
    kind = "string" if isinstance(points[0], str) else "bigint"
    return F.from_json(F.lit(json.dumps(points)), f"array<{kind}>")
