"""Candles: validity and the closed-candle fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions import clock
from tickloom.functions.numbers import pct_change, safe_div
from tickloom.operators.keys import resolve_interval, resolve_keys
from tickloom.operators.rejects import AMOUNT_LIMIT, PRICE_LIMIT, absent_or_within, within
from tickloom.schemas import conform


def closed_klines(df: DataFrame) -> DataFrame:
    """Closed candles with a symbol, a positive close and a volume; numbers finite and within the stored types."""
    return df.filter(
        F.col("is_closed") & F.col("symbol").isNotNull() & within("close", PRICE_LIMIT)
        & (F.col("volume") >= 0) & (F.col("volume") < AMOUNT_LIMIT)
        & absent_or_within(df, ["open", "high", "low"], PRICE_LIMIT)
    )


def kline_fact(df: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    keyed = resolve_interval(resolve_keys(df, dims["symbol"]), dims["kline_interval"])
    return conform(
        keyed.withColumn("datetime_key", clock.datetime_key("open_time"))
        .withColumn("price_change", F.col("close") - F.col("open"))
        .withColumn("price_change_pct", pct_change("close", "open"))
        .withColumn(
            "amplitude", safe_div(F.col("high") - F.col("low"), F.col("open"), 0.0) * 100
        )
        .withColumn("is_bullish", F.col("close") >= F.col("open")),
        "kline_closed",
    )
