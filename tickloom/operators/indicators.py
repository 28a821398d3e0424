"""Technical indicators over bounded look-back frames.

Each candle gets one array of itself and the candles before it (``frame``); every indicator
is a fold over that array, so all of them share one shuffle and one sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.clock import DAY
from tickloom.operators.blocks import over_last_rows
from tickloom.schemas import conform

LOOKBACK = 27  # candles in the RSI, ATR and OBV frames
MACD_FRAME = 34  # slow period + signal period - 1
BLOCK_MS = 7 * DAY  # 10,080 one-minute candles


def last(array: Column, n: int) -> Column:
    return F.slice(array, F.greatest(F.size(array) - (n - 1), F.lit(1)), n)


def _pairs(array: Column, f) -> Column:
    """``f(current, previous)`` for each element after the first."""
    n = F.size(array) - 1
    return F.zip_with(F.slice(array, F.lit(2), n), F.slice(array, F.lit(1), n), f)


def _total(array: Column, f=lambda x: x) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda acc, x: acc + f(x))


def _mean(array: Column, n: int, f=lambda x: x) -> Column:
    return _total(array, f) / n


def _rest(array: Column, used: int) -> Column:
    return F.slice(array, F.lit(used + 1), F.greatest(F.size(array) - used, F.lit(0)))


def _wilder(values: Column, period: int, f=lambda x: x) -> Column:
    """Mean of the first ``period`` values, then smoothed over the rest."""
    return F.aggregate(
        _rest(values, period),
        _mean(F.slice(values, 1, period), period, f),
        lambda acc, x: (acc * (period - 1) + f(x)) / period,
    )


def _none_below(frame: Column, n: int, value: Column) -> Column:
    return F.when(F.size(frame) >= n, value)


def with_frame(
    df: DataFrame, keys: list[str], depth: int, block_ms: int = BLOCK_MS,
    order: str = "open_time",
) -> DataFrame:
    """Adds ``frame``: this candle and up to ``depth - 1`` before it, oldest first."""
    candle = F.struct(
        *[F.col(c).cast("double").alias(c) for c in ("high", "low", "close", "volume")]
    )
    return over_last_rows(
        df, keys, order, depth - 1, block_ms, {"frame": F.collect_list(candle)}
    )


def ema(values: Column, period: int) -> Column:
    """Exponential mean of a whole array: simple mean of the first ``period``, then 2/(p+1)."""
    k = 2 / (period + 1)
    return F.aggregate(
        _rest(values, period),
        _mean(F.slice(values, 1, period), period),
        lambda acc, x: x * k + acc * (1 - k),
    )


def rsi_columns(frame: Column, period: int, lookback: int) -> dict[str, Column]:
    moves = _pairs(last(frame, lookback)["close"], lambda cur, prev: cur - prev)
    return {
        "_gain": _wilder(moves, period, lambda x: F.greatest(x, F.lit(0.0))),
        "_loss": _wilder(moves, period, lambda x: F.greatest(-x, F.lit(0.0))),
    }


def rsi_value(frame: Column, period: int) -> Column:
    gain, loss = F.col("_gain"), F.col("_loss")
    value = F.when(loss == 0, F.lit(100.0)).otherwise(100 - 100 / (1 + gain / loss))
    return _none_below(frame, period + 1, F.round(value, 4))


def with_rsi(df: DataFrame, period: int = 14, lookback: int = LOOKBACK) -> DataFrame:
    frame = F.col("frame")
    return (
        df.withColumns(rsi_columns(frame, period, lookback))
        .withColumn("rsi_14", rsi_value(frame, period)).drop("_gain", "_loss")
    )


def with_macd(df: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9) -> DataFrame:
    """MACD line, signal and histogram; null below ``slow + signal - 1`` candles.

    The frame has exactly one signal period of line values, so the signal is their mean.
    """
    frame, n = F.col("frame"), slow + signal - 1
    closes = last(frame, n)["close"]
    kf, ks = 2 / (fast + 1), 2 / (slow + 1)
    first = F.slice(closes, 1, slow)
    fast0, slow0 = ema(first, fast), ema(first, slow)
    start = F.struct(
        fast0.alias("fast"), slow0.alias("slow"), (fast0 - slow0).alias("sum")
    )

    def step(acc: Column, x: Column) -> Column:
        f = x * kf + acc["fast"] * (1 - kf)
        s = x * ks + acc["slow"] * (1 - ks)
        return F.struct(f.alias("fast"), s.alias("slow"), (acc["sum"] + (f - s)).alias("sum"))

    folded = F.aggregate(_rest(closes, slow), start, step)
    macd, macd_signal = F.col("macd"), F.col("macd_signal")
    return (
        df.withColumn("_macd", _none_below(frame, n, folded))
        .withColumn("macd", F.round(F.col("_macd.fast") - F.col("_macd.slow"), 8))
        .withColumn("macd_signal", F.round(F.col("_macd.sum") / signal, 8))
        .withColumn("macd_hist", F.round(macd - macd_signal, 8))
        .drop("_macd")
    )


def with_bollinger(df: DataFrame, period: int = 20) -> DataFrame:
    """Mean of the last closes plus and minus two sample deviations, and the band's width."""
    frame = F.col("frame")
    closes = last(frame, period)["close"]
    mid, dev = F.col("_mid"), F.col("_dev")
    upper, lower = mid + 2 * dev, mid - 2 * dev
    spread = _total(closes, lambda x: (x - F.col("_mid")) * (x - F.col("_mid")))
    return (
        df.withColumn("_mid", _none_below(frame, period, _mean(closes, period)))
        .withColumn("_dev", F.sqrt(spread / (period - 1)))
        .withColumn("bb_upper", F.round(upper, 8))
        .withColumn("bb_middle", F.round(mid, 8))
        .withColumn("bb_lower", F.round(lower, 8))
        .withColumn("bb_width", F.when(mid != 0, F.round((upper - lower) / mid * 100, 6)))
        .drop("_mid", "_dev")
    )


def with_atr(df: DataFrame, period: int = 14, lookback: int = LOOKBACK) -> DataFrame:
    ranges = _pairs(
        last(F.col("frame"), lookback),
        lambda cur, prev: F.greatest(
            cur["high"] - cur["low"],
            F.abs(cur["high"] - prev["close"]),
            F.abs(cur["low"] - prev["close"]),
        ),
    )
    value = F.round(_wilder(ranges, period), 8)
    return df.withColumn("atr_14", _none_below(F.col("frame"), period + 1, value))


def with_obv(df: DataFrame, lookback: int = LOOKBACK) -> DataFrame:
    """Volume signed by the close's move, over the look-back only."""
    signed = _pairs(
        last(F.col("frame"), lookback),
        lambda cur, prev: F.signum(cur["close"] - prev["close"]) * cur["volume"],
    )
    return df.withColumn("obv", F.round(_total(signed), 8))


def rsi(df, keys, period=14, lookback=LOOKBACK, block_ms=BLOCK_MS) -> DataFrame:
    return with_rsi(with_frame(df, keys, lookback, block_ms), period, lookback).drop("frame")


def macd(df, keys, fast=12, slow=26, signal=9, block_ms=BLOCK_MS) -> DataFrame:
    framed = with_frame(df, keys, slow + signal - 1, block_ms)
    return with_macd(framed, fast, slow, signal).drop("frame")


def bollinger(df, keys, period=20, block_ms=BLOCK_MS) -> DataFrame:
    return with_bollinger(with_frame(df, keys, period, block_ms), period).drop("frame")


def atr(df, keys, period=14, lookback=LOOKBACK, block_ms=BLOCK_MS) -> DataFrame:
    return with_atr(with_frame(df, keys, lookback, block_ms), period, lookback).drop("frame")


def obv(df, keys, lookback=LOOKBACK, block_ms=BLOCK_MS) -> DataFrame:
    return with_obv(with_frame(df, keys, lookback, block_ms), lookback).drop("frame")


def technical_indicators(klines: DataFrame, block_ms: int = BLOCK_MS) -> DataFrame:
    """The indicator fact of each stored candle (one row a candle, keys unique)."""
    candles = klines.select(
        "symbol_key", "interval_key", "datetime_key", "open_time",
        "high", "low", "close", "volume",
    )
    return over_frames(with_frame(candles, ["symbol_key", "interval_key"], MACD_FRAME, block_ms))


def over_frames(framed: DataFrame) -> DataFrame:
    """The indicator fact of candles that have their ``frame``."""
    for step in (with_rsi, with_macd, with_bollinger, with_atr, with_obv):
        framed = step(framed)
    return conform(framed, "technical_indicator")
