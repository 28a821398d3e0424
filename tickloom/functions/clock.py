"""Calendar expressions on epoch milliseconds.

All of them are integer arithmetic on UTC days, so none depends on the session time zone
and all stay inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND, MINUTE, HOUR, DAY = 1_000, 60_000, 3_600_000, 86_400_000


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def floor_div(ms: Column | str, unit: int) -> Column:
    """Whole units since the epoch, rounding down before 1970 too.

    Exact for epoch milliseconds (below 2**53), and much less generated code than the
    overflow-checked integer division.
    """
    return F.floor(_col(ms) / F.lit(float(unit)))


def now_ms() -> Column:
    return F.unix_millis(F.current_timestamp())


def as_of_or_now(as_of_ms: int | Column | None) -> Column:
    if as_of_ms is None:
        return now_ms()
    return as_of_ms if isinstance(as_of_ms, Column) else F.lit(as_of_ms).cast("long")


def event_time(ms: Column | str) -> Column:
    return F.timestamp_millis(_col(ms))


def whole_seconds(ms: Column | str) -> Column:
    """Timestamp cut to the second."""
    return F.timestamp_seconds(floor_div(ms, SECOND))


def day(ms: Column | str) -> Column:
    return F.date_from_unix_date(floor_div(ms, DAY).cast("int"))


def _within(ms: Column | str, unit: int, of: int) -> Column:
    """Whole units since the start of the enclosing larger unit."""
    return (floor_div(ms, unit) - floor_div(ms, of) * (of // unit)).cast("int")


def hour(ms: Column | str) -> Column:
    return _within(ms, HOUR, DAY)


def minute(ms: Column | str) -> Column:
    return _within(ms, MINUTE, HOUR)


def day_of_week(ms: Column | str) -> Column:
    """0 = Monday."""
    return F.weekday(day(ms))


def is_weekend(ms: Column | str) -> Column:
    return day_of_week(ms) >= 5


def week_of_year(ms: Column | str) -> Column:
    """Weeks counted from the year's first Monday; earlier days are week 0."""
    return F.floor((F.dayofyear(day(ms)) + 6 - day_of_week(ms)) / 7).cast("int")


def datetime_key(ms: Column | str) -> Column:
    """Epoch ms as the number ``YYYYMMDDHHmm``."""
    d = day(ms)
    ymd = F.year(d) * 10_000 + F.month(d) * 100 + F.dayofmonth(d)
    return ymd.cast("long") * 10_000 + hour(ms) * 100 + minute(ms)


def trading_session(ms: Column | str) -> Column:
    h = hour(ms)
    return (
        F.when(is_weekend(ms), "Off")
        .when(h < 8, "Asia")
        .when(h < 16, "Europe")
        .otherwise("US")
    )


def alert_session(ms: Column | str) -> Column:
    """The alert feed's own session rule: other bounds, no weekend."""
    h = hour(ms)
    return (
        F.when(h.between(1, 8), "Asia").when(h.between(9, 16), "Europe").otherwise("US")
    )


def age_ms(ms: Column | str, as_of_ms: int | Column | None) -> Column:
    return as_of_or_now(as_of_ms) - _col(ms)


def within(ms: Column | str, span_ms: int, as_of_ms: int | Column | None) -> Column:
    """Rows no older than ``span_ms`` (bound included)."""
    return _col(ms) >= as_of_or_now(as_of_ms) - span_ms
