"""Why a message is not used: one reason a row, decided before any sum or stored type can fail.

A row without a reason is exactly one that the filters (``valid_trades`` and so on) keep. Prices must fit
DECIMAL(18,8), amounts DECIMAL(24,8), and price times quantity a sum of longs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: From here on a value does not fit its stored type (or, for a notional, one term of an exact sum).
PRICE_LIMIT, AMOUNT_LIMIT, NOTIONAL_LIMIT = 1e10, 1e16, 9e18
INFINITE = float("inf")


def within(column: str, limit: float) -> Column:
    """Positive, finite and below ``limit``; NaN is greater than any limit."""
    return (F.col(column) > 0) & (F.col(column) < limit)


def absent_or_within(df: DataFrame, columns: list[str], limit: float) -> Column:
    """Each of the columns is not there, null, or finite and of a size below ``limit``."""
    sizes = [F.coalesce(F.abs(F.col(c)) < limit, F.lit(True)) for c in columns if c in df.columns]
    return reduce(Column.__and__, sizes, F.lit(True))


def _number(column: str, limit: float, name: str, least: str = "positive", optional: bool = False) -> Column:
    """The reason against one number, else null."""
    c = F.col(column)
    low = c <= 0 if least == "positive" else c < 0 if least == "negative" else F.lit(False)
    return (
        F.when(c.isNull(), None if optional else f"no {name}")
        .when(F.isnan(c) | (F.abs(c) == INFINITE), f"{name} not finite")
        .when(low, f"{name} not positive" if least == "positive" else f"{name} negative")
        .when(F.abs(c) >= limit, f"{name} out of range")
    )


def _symbol() -> Column:
    return F.when(F.col("symbol").isNull(), "no symbol")


def trade_reason() -> Column:
    product = F.col("price") * F.col("quantity")
    return F.coalesce(
        _symbol(), _number("price", PRICE_LIMIT, "price"), _number("quantity", AMOUNT_LIMIT, "quantity"),
        F.when(product >= NOTIONAL_LIMIT, "notional out of range"))


def quote_reason() -> Column:
    return F.coalesce(
        _symbol(), _number("bid_price", PRICE_LIMIT, "bid"), _number("ask_price", PRICE_LIMIT, "ask"),
        *(_number(c, AMOUNT_LIMIT, c.replace("_qty", " size"), "any", optional=True) for c in ("bid_qty", "ask_qty")))


def kline_reason() -> Column:
    return F.coalesce(
        F.when(~F.coalesce("is_closed", F.lit(False)), "not closed"), _symbol(),
        _number("close", PRICE_LIMIT, "close"), _number("volume", AMOUNT_LIMIT, "volume", "negative"),
        *(_number(c, PRICE_LIMIT, c, "any", optional=True) for c in ("open", "high", "low")))


REASONS = {"trades": trade_reason, "quotes": quote_reason, "klines": kline_reason}


def rejected(df: DataFrame, kind: str) -> DataFrame:
    """The rows that are not used, with ``reason``; for one pass over both, add the reason and filter."""
    return df.withColumn("reason", REASONS[kind]()).filter("reason IS NOT NULL")
