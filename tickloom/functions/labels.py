"""Signal labels. The views and the read queries use different bounds and spellings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rsi_state(rsi: Column) -> Column:
    return (
        F.when(rsi > 70, "overbought").when(rsi < 30, "oversold").otherwise("neutral")
    )


def macd_state(line: Column, signal: Column) -> Column:
    return (
        F.when(line > signal, "bullish").when(line < signal, "bearish").otherwise("neutral")
    )


def composite(rsi: Column, macd: Column) -> Column:
    return (
        F.when((rsi == "oversold") & (macd == "bullish"), "strong_buy")
        .when((rsi == "overbought") & (macd == "bearish"), "strong_sell")
        .when(macd == "bullish", "buy")
        .when(macd == "bearish", "sell")
        .otherwise("neutral")
    )


def rsi_flag(rsi: Column) -> Column:
    return (
        F.when(rsi >= 70, "OVERBOUGHT").when(rsi <= 30, "OVERSOLD").otherwise("NEUTRAL")
    )


def macd_flag(line: Column, signal: Column) -> Column:
    return F.when(line > signal, "BULLISH").otherwise("BEARISH")


def pressure_by_share(buy_pct: Column) -> Column:
    return (
        F.when(buy_pct > 55, "buy_dominated")
        .when(buy_pct < 45, "sell_dominated")
        .otherwise("balanced")
    )


def pressure_by_flow(net_flow: Column) -> Column:
    return (
        F.when(net_flow > 0, "BUY_PRESSURE")
        .when(net_flow < 0, "SELL_PRESSURE")
        .otherwise("NEUTRAL")
    )
