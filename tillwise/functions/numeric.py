"""Ratios, order-independent sums, min-max terms and weighted scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# units per whole: a BIGINT holds 9 * 10**12 values' worth of fractions at the money scale
MONEY_SCALE = 10**6
RATIO_SCALE = 10**9
# values from here on are summed as doubles, as are NaN and infinity
_LARGEST = 9e18


def safe_ratio(num: Column, den: Column, default: float | None = 0.0) -> Column:
    """``num / den``, or ``default`` where the denominator is zero."""
    return F.when(den == 0, F.lit(default).cast("double")).otherwise(num / den)


def _countable(value: Column) -> Column:
    """Whether a value has a whole part that BIGINT can hold; false for NaN and infinity."""
    return F.abs(value) < F.lit(_LARGEST)


def whole_part(value: Column) -> Column:
    return F.when(_countable(value), F.floor(value)).cast("bigint")


def fraction_units(value: Column, scale: int) -> Column:
    """Fraction of ``value`` as a whole number of ``1 / scale`` units."""
    units = F.rint((value - F.floor(value).cast("double")) * F.lit(float(scale)))
    return F.when(_countable(value), units).cast("bigint")


def uncounted(value: Column) -> Column:
    """The values that the other two parts leave out."""
    return F.when(~_countable(value), value)


def from_parts(whole: Column, units: Column, odd: Column, scale: int) -> Column:
    """A sum from its parts; ``units`` may hold many wholes, which are carried over first."""
    left = F.pmod(units, F.lit(scale).cast("bigint"))
    carried = F.floor((units - left) / F.lit(float(scale)) + F.lit(0.5)).cast("bigint")
    total = (whole + carried).cast("double") + left.cast("double") / F.lit(float(scale))
    return F.when(odd.isNull(), total).otherwise(F.coalesce(total, F.lit(0.0)) + odd)


def stable_sum(value: Column, scale: int = MONEY_SCALE) -> Column:
    """Sum of doubles that does not depend on the order of the rows, at any row count.

    Adding doubles rounds differently for every shuffle order, so a retried task could
    change a total.  Each value is rounded to ``1 / scale``; its whole part and the units of
    its fraction are summed apart as BIGINT, which is exact and fails loudly on overflow.
    NaN and infinity pass through.
    """
    value = value.cast("double")
    return from_parts(
        F.sum(whole_part(value)), F.sum(fraction_units(value, scale)), F.sum(uncounted(value)), scale
    )


def minmax_term(value: Column, low: Column, high: Column, inverted: bool = False) -> Column:
    """Position of ``value`` between ``low`` and ``high``; 0 when the range is empty."""
    share = (value - low) / (high - low)
    if inverted:
        share = F.lit(1.0) - share
    return F.when((high - low) == 0, F.lit(0.0)).otherwise(share)


def weighted_score(terms: Sequence[tuple[float, Column]]) -> Column:
    """Sum of weight times term, left to right."""
    (first_weight, first_term), *rest = terms
    score = F.lit(first_weight) * first_term
    for weight, term in rest:
        score = score + F.lit(weight) * term
    return score


def growth(current: Column, previous: Column, default: float | None = 0.0) -> Column:
    """Relative change, or ``default`` where there is no usable base."""
    base = previous.cast("double")
    change = (current - previous) / base
    return F.when(previous.isNull() | (previous == 0), F.lit(default).cast("double")).otherwise(change)
