"""Quotes: one-second averages and the spread fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions import clock
from tickloom.functions.numbers import exact_avg, safe_div
from tickloom.operators.keys import resolve_keys
from tickloom.operators.rejects import AMOUNT_LIMIT, PRICE_LIMIT, absent_or_within, within
from tickloom.schemas import conform


def valid_quotes(df: DataFrame) -> DataFrame:
    """Quotes with a symbol and positive prices; all numbers finite and within the stored types."""
    return df.filter(
        F.col("symbol").isNotNull() & within("bid_price", PRICE_LIMIT) & within("ask_price", PRICE_LIMIT)
        & absent_or_within(df, ["bid_qty", "ask_qty"], AMOUNT_LIMIT)
    )


def spread_snapshot(df: DataFrame, duration: str = "1 second") -> DataFrame:
    """Mean bid and ask, price and quantity, a symbol and window."""
    sides = ("bid_price", "ask_price", "bid_qty", "ask_qty")
    return (
        df.groupBy(F.window("event_time", duration), "symbol")
        .agg(*[exact_avg(c).alias(f"avg_{c}") for c in sides])
        .select(
            F.unix_millis("window.start").alias("window_start"), "symbol",
            *[f"avg_{c}" for c in sides],
        )
    )


def spread_fact(snapshots: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Spread measures of uncrossed books; the book is judged after averaging."""
    bid, ask = F.col("avg_bid_price"), F.col("avg_ask_price")
    bid_qty, ask_qty = F.col("avg_bid_qty"), F.col("avg_ask_qty")
    mid = (bid + ask) / 2
    keyed = resolve_keys(snapshots.filter((bid > 0) & (ask > bid)), dims["symbol"])
    return conform(
        keyed.select(
            "symbol_key",
            clock.datetime_key("window_start").alias("datetime_key"),
            F.col("window_start").alias("snapshot_time"),
            bid.alias("bid_price"), ask.alias("ask_price"), mid.alias("mid_price"),
            (ask - bid).alias("spread"),
            safe_div((ask - bid), mid, 0.0).alias("_share"),
            bid_qty.alias("bid_qty"), ask_qty.alias("ask_qty"),
            safe_div(bid_qty - ask_qty, bid_qty + ask_qty, 0.0).alias("liquidity_imbalance"),
        ).withColumn("spread_pct", F.col("_share") * 100),
        "spread_snapshot",
    )
