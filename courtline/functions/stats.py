"""Row-level box-score expressions: age, venue, milestone flags, unit conversions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: unit conversion constants ----------------------------------------
CM_PER_FOOT = Decimal("30.48")
CM_PER_INCH = Decimal("2.54")
KG_PER_POUND = Decimal("0.45359237")
# Categories counted for double- and triple-doubles, and the threshold.
MILESTONE_STATS = ["pts", "ast", "reb", "stl", "blk"]
MILESTONE_THRESHOLD = 10


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def full_years_between(later: Column | str, earlier: Column | str) -> Column:
    """Completed calendar years from ``earlier`` to ``later`` (age on a date).

    A year is complete once the (month, day) of ``later`` reaches that of ``earlier``;
    a 29 February birthday completes a year on 1 March in non-leap years.  This is
    not ``months_between``, which counts 2000-02-29 -> 2001-02-28 as a full year.
    """
    g, b = _c(later), _c(earlier)
    md = lambda d: F.month(d) * 100 + F.dayofmonth(d)
    return (F.year(g) - F.year(b) - F.when(md(g) < md(b), 1).otherwise(0)).cast("int")


def home_away(matchup: Column | str) -> Column:
    """'AAA vs. BBB' is a home game, 'AAA @ BBB' an away game, else NULL."""
    m = _c(matchup)
    return F.when(m.like("%vs%"), F.lit("Home")).when(m.like("%@%"), F.lit("Away"))


def milestone_count(prefix: str = "") -> Column:
    """How many milestone categories reached the threshold (NULL counts as not reached)."""
    total = None
    for s in MILESTONE_STATS:
        hit = F.when(F.col(prefix + s) >= MILESTONE_THRESHOLD, 1).otherwise(0)
        total = hit if total is None else total + hit
    return total


def double_double(prefix: str = "") -> Column:
    return F.when(milestone_count(prefix) >= 2, 1).otherwise(0)


def triple_double(prefix: str = "") -> Column:
    return F.when(milestone_count(prefix) >= 3, 1).otherwise(0)


def height_cm(height: Column | str) -> Column:
    """'6-10' (feet-inches) -> centimetres, rounded half away from zero.

    Exact decimal arithmetic keeps ties exact (6-3 is 190.50 -> 191); casting the
    decimal straight to INT would truncate.
    """
    h = _c(height)
    feet = F.split_part(h, F.lit("-"), F.lit(1)).cast("int")
    inches = F.split_part(h, F.lit("-"), F.lit(2)).cast("int")
    cm = feet * F.lit(CM_PER_FOOT) + inches * F.lit(CM_PER_INCH)
    return F.when(h.isNotNull(), F.round(cm, 0).cast("int"))


def weight_kg(weight: Column | str) -> Column:
    return F.round(_c(weight) * F.lit(KG_PER_POUND), 0).cast("int")


def ratio(num: Column, den: Column) -> Column:
    """``DIVIDE(a, b)`` / ``a / NULLIF(b, 0)``: NULL on a zero or NULL denominator."""
    return F.try_divide(num.cast("double"), F.nullif(den, F.lit(0)).cast("double"))
