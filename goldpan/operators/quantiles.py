"""Exact quantiles of many columns by aggregations alone.

A mergeable sketch brackets the value of every asked rank, a count says how many values lie below the bracket, and the next pass
looks only inside it.  Passes over the data are all that is needed: no row is shuffled, and only the last, small bracket is sorted.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACCURACY = 10_000  # of the sketch: a rank is off by at most a ten-thousandth of the rows
SORTED_AT_ONCE = 10_000  # values of a bracket that are sorted in one buffer


@dataclass
class _Bracket:
    """Values from ``low`` to ``high`` (both included) hold the asked rank; ``below`` values are smaller."""

    column: str
    rank: int
    low: float
    high: float
    below: int
    inside: int

    def held(self) -> Column:
        c = F.col(self.column)
        return F.when((c >= F.lit(self.low)) & (c <= F.lit(self.high)), c)

    @property
    def found(self) -> bool:
        return self.low == self.high


def _first(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[int, float, float]]:
    row = df.agg(*[e for c in columns for e in (F.count(c), F.min(c), F.max(c))]).first()
    return {c: tuple(row[3 * i:3 * i + 3]) for i, c in enumerate(columns)}


def _narrowed(df: DataFrame, brackets: Sequence[_Bracket], accuracy: int) -> None:
    """One sketch of every bracket, then one count of where its borders fall."""
    asked = []
    for b in brackets:
        place, slack = (b.rank - b.below + 1) / b.inside, 1.5 / accuracy
        shares = [max(0.0, place - slack), min(1.0, place + slack)]
        asked.append(F.percentile_approx(b.held(), shares, accuracy))
    borders = df.agg(*[a.alias(f"a{i}") for i, a in enumerate(asked)]).first()
    counts = []
    for b, (lo, hi) in zip(brackets, borders, strict=True):
        held = b.held()
        between = (held > lo) & (held < hi)
        counts += [F.count(F.when(held < lo, 1)), F.count(F.when(held == lo, 1)), F.count(F.when(between, 1)), F.count(F.when(held == hi, 1)),
                   F.max(F.when(held < lo, held)), F.min(F.when(between, held)), F.max(F.when(between, held)), F.min(F.when(held > hi, held))]
    row = df.agg(*[c.alias(f"c{i}") for i, c in enumerate(counts)]).first()
    for i, (b, (lo, hi)) in enumerate(zip(brackets, borders, strict=True)):
        under, at_low, between, at_high, last_under, first_between, last_between, first_over = row[8 * i:8 * i + 8]
        rank = b.rank - b.below
        if rank < under:  # the sketch was off: the rank lies below its bracket
            b.high, b.inside = last_under, under
        elif rank < under + at_low:
            b.low = b.high = lo
        elif rank < under + at_low + between:
            b.low, b.high, b.below, b.inside = first_between, last_between, b.below + under + at_low, between
        elif lo < hi and rank < under + at_low + between + at_high:
            b.low = b.high = hi
        else:
            upto = under + at_low + between + (at_high if lo < hi else 0)
            b.low, b.below, b.inside = first_over, b.below + upto, b.inside - upto


def exact_quantiles(df: DataFrame, columns: Sequence[str], fractions: Sequence[float], accuracy: int = ACCURACY,
                    sorted_at_once: int = SORTED_AT_ONCE) -> dict[str, dict[float, float]]:
    """Interpolated quantiles of every column, nulls left out; a column without values has NaN.

    Every pass makes the brackets smaller by a factor of some thousand, so a few passes do for any number of rows.
    """
    rows = df.select(*[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(columns)])
    names = {c: f"_{i}" for i, c in enumerate(columns)}
    facts = _first(rows, list(names.values()))
    brackets: dict[tuple[str, int], _Bracket] = {}
    for name, (n, low, high) in facts.items():
        for f in fractions if n else ():
            at = f * (n - 1)
            for rank in {math.floor(at), math.ceil(at)}:
                brackets[name, rank] = _Bracket(name, rank, low, high, 0, n)
    while wide := [b for b in brackets.values() if not b.found and b.inside > sorted_at_once]:
        _narrowed(rows, wide, accuracy)
    small = [b for b in brackets.values() if not b.found]
    if small:
        lists = rows.agg(*[F.get(F.sort_array(F.collect_list(b.held())), F.lit(b.rank - b.below)).alias(f"v{i}") for i, b in enumerate(small)]).first()
        for b, value in zip(small, lists, strict=True):
            b.low = b.high = value
    found: dict[str, dict[float, float]] = {}
    for c, name in names.items():
        n = facts[name][0]
        for f in fractions:
            at = f * (n - 1)
            if n:
                lower, upper = brackets[name, math.floor(at)].low, brackets[name, math.ceil(at)].low
                found.setdefault(c, {})[f] = lower + (upper - lower) * (at - math.floor(at))
            else:
                found.setdefault(c, {})[f] = math.nan
    return found
