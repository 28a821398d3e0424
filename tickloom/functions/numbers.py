"""Numbers: order-independent sums and null-safe ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NANO = 1_000_000_000
TERM_LIMIT = 9e18  # terms of a sum of longs
DIGITS = 15  # significant decimal digits that a double holds


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact_sum(x: Column | str) -> Column:
    """Sum of a double, as DECIMAL(38,18).

    Each row keeps the 15 significant digits that a double holds (18 decimals below 1), split
    into whole units, billionths and billionths of these. They are summed as longs, so the
    result does not depend on the order in which shuffled rows arrive (a retried task gives
    the same number), and the aggregation keeps plain long buffers instead of wide decimals.
    Null where a term or the total is not finite or beyond what a long holds.
    """
    x = _col(x)
    fits = F.abs(x) < TERM_LIMIT  # false of NaN
    too_much = F.max(~fits)
    x = F.when(fits, x)
    size = F.abs(x)
    # Of a number from 1 on: its digits as a whole number, and the power of ten they are scaled by.
    power = F.pow(F.lit(10.0), F.greatest(DIGITS - 1 - F.floor(F.log10(size)), F.lit(0))).cast("long")
    scaled = F.rint(size * power).cast("long")
    large = size >= 1
    whole = F.when(large, _div(scaled, power)).when(x.isNotNull(), F.lit(0))
    small = F.rint(size * F.lit(1e18)).cast("long")
    rest = F.when(large, scaled % power * _div(F.lit(NANO * NANO), power)).otherwise(small)
    sign = F.signum(x).cast("long")
    units, nanos, attos = (
        F.try_sum(sign * part) for part in (whole, _div(rest, F.lit(NANO)), rest % NANO)
    )
    nanos, attos = _carry(nanos, attos)
    units, nanos = _carry(units, nanos)
    total = units.try_cast("decimal(18,0)")
    for part, unit, scale in ((nanos, "1e-9", 9), (attos, "1e-18", 18)):
        total = total + part.cast("decimal(9,0)") * F.lit(unit).cast(f"decimal({scale},{scale})")
    # Beyond 18 digits a double has no decimals.
    huge = F.abs(units) >= NANO * NANO
    return F.when(~too_much, F.when(huge, units.cast("decimal(38,18)")).otherwise(total.cast("decimal(38,18)")))


def _div(a: Column, b: Column) -> Column:
    """Whole division of longs."""
    return F.call_function("div", a, b)


def _carry(high: Column, low: Column) -> tuple[Column, Column]:
    """The same sum with ``low`` in ``[0, 1e9)``."""
    rest = F.pmod(low, F.lit(NANO))
    return high + _div(low - rest, F.lit(NANO)), rest


def exact_avg(x: Column | str) -> Column:
    """Order-independent mean of a double, as double."""
    return F.try_divide(exact_sum(x).cast("double"), F.count(_col(x)))


def decimal_avg(total: Column, n: Column) -> Column:
    """Mean from an exact DECIMAL total, as double."""
    return F.try_divide(total.cast("double"), n)


def safe_div(a: Column, b: Column, default: Column | float | None = None) -> Column:
    """``a / b``; ``default`` where ``b`` is 0."""
    fallback = default if isinstance(default, Column) else F.lit(default)
    return F.when(b != 0, a / b).otherwise(fallback)


def pct_change(new: Column | str, old: Column | str) -> Column:
    """Change in percent of ``old``; 0 where ``old`` is 0."""
    new, old = _col(new), _col(old)
    return F.when(old != 0, (new - old) / old * 100).otherwise(F.lit(0.0))


def round_numeric(x: Column, digits: int) -> Column:
    """Half-up rounding of a double by its 12-decimal value.

    A mean such as 0.12155 is often stored a hair below the tie; rounding the binary value
    would send it down.
    """
    return F.round(x.cast("decimal(38,12)"), digits).cast("double")
