"""Numeric comparison rules as Column expressions."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the comparison rule.
TOLERANCE_PCT = 0.001
TINY = 1e-10
SMALL_DIFFERENCE = 0.01
BLANKS = ("null", "none", "")


def _number(text: Column) -> Column:
    text = F.trim(text.cast("string"))
    blank = text.isNull() | F.lower(text).isin(*BLANKS)
    return F.when(blank, F.lit("0")).otherwise(text).try_cast("double")


def difference_pct(source: Column, target: Column) -> Column:
    """Difference in percent of the larger magnitude; null when either is no number."""
    a, b = _number(source), _number(target)
    larger = F.greatest(F.abs(a), F.abs(b))
    return (F.when(source.eqNullSafe(target) | (a == b) | (larger < TINY), F.lit(0.0))
            .otherwise(F.try_divide(F.abs(a - b), larger) * 100.0))


def within_tolerance(source: Column, target: Column, pct: float = TOLERANCE_PCT) -> Column:
    """True when two statistics agree: as text, as numbers, or within ``pct`` percent."""
    a, b = _number(source), _number(target)
    gap = F.abs(a - b)
    larger = F.greatest(F.abs(a), F.abs(b))
    share = F.try_divide(gap, larger) * 100.0
    no_share = F.isnan(share) | (share == F.lit(float("inf")))
    return (F.when(source.eqNullSafe(target), F.lit(True))
            .when(a.isNull() | b.isNull() | F.isnan(a) | F.isnan(b), F.lit(False))
            .when(a == b, F.lit(True))
            .when(larger < TINY, F.lit(True))
            .when(no_share, ~F.isnan(gap) & (gap < SMALL_DIFFERENCE))
            .otherwise(share <= pct))


def variance_pct(source: Column, target: Column) -> Column:
    """Percent deviation from the source count, 0 for an empty source."""
    share = F.abs(source - target) / source.cast("double") * 100.0
    return F.when(source == 0, F.lit(0.0)).otherwise(F.round(share, 2))
