"""Marts. Spans are parameters; times are explicit, never read from the clock inside."""

from __future__ import annotations

import re
import time
from datetime import date as Date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions import clock, labels
from tickloom.functions.numbers import decimal_avg, round_numeric
from tickloom.operators.ordering import latest_per
from tickloom.plans import staging, states
from tickloom.plans.states import State


def _exact(column: str, scale: int) -> Column:
    """A staged double back at its stored scale, so sums do not depend on row order."""
    return F.col(column).cast(f"decimal(28,{scale})")


def _mean(column: str, scale: int) -> Column:
    return decimal_avg(F.sum(_exact(column, scale)), F.count(column))


def _sum(column: str) -> Column:
    return F.sum(_exact(column, 8)).cast("double")


def mart_latest_prices(tables) -> DataFrame:
    def seconds(from_ms: int | None = None, to_ms: int | None = None, **bounds) -> DataFrame:
        rows = staging.stg_trade_agg(tables, from_ms=from_ms, to_ms=to_ms, **bounds)
        return rows.filter(F.col("window_type") == "1s")

    of = F.col("window_key") == tables.window_key("1s")
    bounds = tables.newest_from("trade_agg", seconds, key="symbol", of=of)
    return latest_per(seconds(**bounds), ["symbol"], [F.col("window_start").desc()]).select(
        "symbol", "display_name", "category", F.col("close").alias("last_price"),
        "vwap", "volume", "price_change", "price_change_pct", "trade_count",
        clock.whole_seconds("window_start").alias("updated_at"), "trading_session",
    )


def mart_daily_performance(
    tables, as_of_ms: int | Column | None = None, days: int = 30
) -> DataFrame:
    today = clock.day(clock.as_of_or_now(as_of_ms))
    since = F.unix_date(F.date_sub(today, days)).cast("long") * clock.DAY
    candles = staging.stg_kline_closed(tables, from_ms=since)
    return (
        candles.groupBy("symbol", "date")
        .agg(
            F.round(F.min("low"), 8).alias("day_low"),
            F.round(F.max("high"), 8).alias("day_high"),
            F.round(F.min_by("open", "open_time"), 8).alias("day_open"),
            F.round(F.max_by("close", "open_time"), 8).alias("day_close"),
            F.round(_sum("volume"), 8).alias("day_volume"),
            F.sum("trade_count").alias("day_trade_count"),
            F.count("*").alias("candle_count"),
            F.count_if("is_bullish").alias("bullish_candles"),
            F.count_if(~F.col("is_bullish")).alias("bearish_candles"),
            round_numeric(_mean("amplitude", 6), 4).alias("avg_amplitude"),
        )
        .orderBy(F.col("date").desc(), "symbol")
    )


def _kept_sum(expression: str, scale: int) -> str:
    """As :func:`_exact` of stored columns, summed."""
    return f"sum({re.sub(r'[a-z_]+', lambda c: f'cast(double({c[0]}) as decimal(28,{scale}))', expression)})"


# What is kept of each symbol's candles of a day.
DAYS = State(
    "candle_days", "kline_closed",
    "symbol_key int, low double, high double, open double, close double, volume decimal(38,8), "
    "trades long, candles long, bullish long, bearish long, amplitude decimal(38,6), amplitudes long",
    {"symbol_key": "symbol_key"},
    {
        "low": "min(double(low))", "high": "max(double(high))",
        "open": "min_by(double(open), open_time)", "close": "max_by(double(close), open_time)",
        "volume": _kept_sum("volume", 8), "trades": "sum(trade_count)", "candles": "count(*)",
        "bullish": "count_if(is_bullish)", "bearish": "count_if(not is_bullish)",
        "amplitude": _kept_sum("amplitude", 6), "amplitudes": "count(amplitude)",
    },
)


def daily_performance_by_day(tables, as_of_ms: int | None = None, days: int = 30) -> DataFrame:
    """As :func:`mart_daily_performance`, reading candles of days that were written to since the last call."""
    now = _now() if as_of_ms is None else as_of_ms
    since = (now // clock.DAY - days) * clock.DAY
    kept = states.by_day(tables, DAYS, since).filter(_in_calendar(tables, F.unix_date("dt").cast("long") * clock.DAY))
    return kept.join(tables.symbols().select("symbol_key", "symbol"), "symbol_key").select(
        "symbol", F.col("dt").alias("date"),
        F.round("low", 8).alias("day_low"), F.round("high", 8).alias("day_high"),
        F.round("open", 8).alias("day_open"), F.round("close", 8).alias("day_close"),
        F.round(F.col("volume").cast("double"), 8).alias("day_volume"), F.col("trades").alias("day_trade_count"),
        F.col("candles").alias("candle_count"), F.col("bullish").alias("bullish_candles"),
        F.col("bearish").alias("bearish_candles"),
        round_numeric(decimal_avg(F.col("amplitude"), F.col("amplitudes")), 4).alias("avg_amplitude"),
    ).orderBy(F.col("date").desc(), "symbol")


def _now() -> int:
    return int(time.time() * 1000)


def _in_calendar(tables, ms: Column) -> Column:
    """Whether the computed calendar, which has whole days, holds a time."""
    return tables.calendar.holds(clock.datetime_key(ms))


def mart_technical_signals(tables) -> DataFrame:
    def signals(from_ms: int | None = None, to_ms: int | None = None, **bounds) -> DataFrame:
        bounds |= {"from_ms": from_ms, "to_ms": to_ms}
        candles = staging.stg_kline_closed(tables, **bounds).select(
            "symbol", "interval_key", "open_time", "open", "high", "low", "close", "volume",
            "is_bullish", "amplitude",
        )
        return staging.stg_technical_indicator(tables, **bounds).join(
            candles, ["symbol", "interval_key", "open_time"]
        )

    bounds = tables.newest_from("technical_indicator", signals, key="symbol")
    newest = latest_per(
        signals(**bounds), ["symbol"], [F.col("open_time").desc(), F.col("interval_key")]
    )
    return newest.select(
        "symbol", "open_time", clock.whole_seconds("open_time").alias("candle_time"),
        "open", "high", "low", "close", "volume", "is_bullish", "amplitude",
        "rsi_14", "rsi_signal", "macd", "macd_signal", "macd_hist", "macd_signal_dir",
        "bb_upper", "bb_middle", "bb_lower", "bb_width", "atr_14", "obv",
        labels.composite(F.col("rsi_signal"), F.col("macd_signal_dir")).alias(
            "composite_signal"
        ),
    )


def mart_orderflow_summary(
    tables, as_of_ms: int | Column | None = None, span_ms: int = 5 * clock.MINUTE
) -> DataFrame:
    since = clock.as_of_or_now(as_of_ms) - span_ms
    recent = (
        staging.stg_order_flow(tables, from_ms=since)
        .filter(F.col("window_type") == "1s")
        .groupBy("symbol")
        .agg(
            _sum("buy_volume").alias("total_buy"),
            _sum("sell_volume").alias("total_sell"),
            _sum("net_flow").alias("net_flow"),
            _mean("buy_pct", 3).alias("_share"),
            F.max("window_start").alias("_latest"),
        )
    )
    share = F.col("_share")
    return recent.select(
        "symbol", "total_buy", "total_sell",
        (F.col("total_buy") + F.col("total_sell")).alias("total_volume"), "net_flow",
        round_numeric(share, 2).alias("buy_pct"), round_numeric(100 - share, 2).alias("sell_pct"),
        labels.pressure_by_share(share).alias("pressure_state"),
        clock.whole_seconds("_latest").alias("as_of"),
    )


def mart_spread_by_session(
    tables, as_of_ms: int | Column | None = None, span_ms: int = clock.DAY
) -> DataFrame:
    since = clock.as_of_or_now(as_of_ms) - span_ms
    depth = F.sum(_exact("bid_qty", 8) + _exact("ask_qty", 8))
    return (
        staging.stg_spread_snapshot(tables, from_ms=since)
        .filter(F.col("snapshot_time") > since)
        .groupBy("symbol", "trading_session")
        .agg(
            round_numeric(_mean("spread_pct", 6), 4).alias("avg_spread_pct"),
            round_numeric(_mean("spread", 8), 8).alias("avg_spread_abs"),
            round_numeric(_mean("liquidity_imbalance", 6), 4).alias("avg_imbalance"),
            round_numeric(decimal_avg(depth, F.count("*")), 4).alias("avg_total_qty"),
            F.count("*").alias("snapshot_count"),
        )
        .orderBy(F.col("avg_spread_pct").desc(), "symbol", "trading_session")
    )


# What is kept of each symbol's snapshots of an hour.
HOURS = State(
    "spread_hours", "spread_snapshot",
    "symbol_key int, hour long, spread_pct decimal(38,6), spread_pcts long, spread decimal(38,8), "
    "spreads long, imbalance decimal(38,6), imbalances long, depth decimal(38,8), snapshots long",
    {"symbol_key": "symbol_key", "hour": f"floor(snapshot_time / double({clock.HOUR})) * {clock.HOUR}L"},
    {
        "spread_pct": _kept_sum("spread_pct", 6), "spread_pcts": "count(spread_pct)",
        "spread": _kept_sum("spread", 8), "spreads": "count(spread)",
        "imbalance": _kept_sum("liquidity_imbalance", 6), "imbalances": "count(liquidity_imbalance)",
        "depth": _kept_sum("bid_qty + ask_qty", 8), "snapshots": "count(*)",
    },
    "spread > 0",
)


def spread_by_session_by_day(tables, as_of_ms: int | None = None, span_ms: int = clock.DAY) -> DataFrame:
    """As :func:`mart_spread_by_session`: whole hours from kept sums, snapshots of the first hour only.

    A session begins and ends with an hour.
    """
    since = (_now() if as_of_ms is None else as_of_ms) - span_ms
    whole = since // clock.HOUR * clock.HOUR + clock.HOUR
    first = tables.fact("spread_snapshot", since, whole - 1).filter(F.col("snapshot_time") > since)
    hours = states.by_day(tables, HOURS, whole).drop("dt").filter(F.col("hour") >= whole).unionByName(states.summed(first, HOURS))

    def mean(parts: str, n: str, digits: int) -> Column:
        return round_numeric(decimal_avg(F.sum(parts), F.sum(n)), digits)

    return (
        hours.filter(_in_calendar(tables, F.col("hour")))
        .join(tables.symbols().select("symbol_key", "symbol"), "symbol_key")
        .groupBy("symbol", clock.trading_session("hour").alias("trading_session"))
        .agg(
            mean("spread_pct", "spread_pcts", 4).alias("avg_spread_pct"),
            mean("spread", "spreads", 8).alias("avg_spread_abs"),
            mean("imbalance", "imbalances", 4).alias("avg_imbalance"),
            mean("depth", "snapshots", 4).alias("avg_total_qty"),
            F.sum("snapshots").alias("snapshot_count"),
        )
        .orderBy(F.col("avg_spread_pct").desc(), "symbol", "trading_session")
    )


def mart_alert_summary(
    tables, as_of_ms: int | Column | None = None, span_ms: int = clock.DAY
) -> DataFrame:
    now = clock.as_of_or_now(as_of_ms)
    return (
        staging.stg_price_alert(tables, from_ms=now - span_ms)
        .filter(F.col("triggered_at") > now - span_ms)
        .select(
            "alert_key", "symbol", "alert_code", "alert_description", "severity",
            clock.whole_seconds("triggered_at").alias("triggered_at"),
            "trigger_value", "threshold_pct", "is_resolved",
            clock.whole_seconds("resolved_at").alias("resolved_at"), "trading_session",
            clock.age_ms("triggered_at", as_of_ms).alias("age_ms"),
        )
        .orderBy(F.col("triggered_at").desc(), "alert_key")
    )


def daily_summary(tables, day: Date) -> DataFrame:
    """One day's range and volume a symbol.

    ``day_change_pct`` is the highest close against the lowest open; ``open_close_pct`` is the
    day's move from first open to last close.
    """
    start = (day - Date(1970, 1, 1)).days * clock.DAY
    candles = staging.stg_kline_closed(tables, from_ms=start, to_ms=start + clock.DAY - 1)
    low, high = F.min("open"), F.max("close")
    first, final = F.min_by("open", "open_time"), F.max_by("close", "open_time")
    return (
        candles.groupBy("symbol")
        .agg(
            F.min("low").alias("day_low"),
            F.max("high").alias("day_high"),
            _sum("volume").alias("day_volume"),
            round_numeric(F.try_divide(high - low, low) * 100, 4).alias("day_change_pct"),
            round_numeric(F.try_divide(final - first, first) * 100, 4).alias("open_close_pct"),
        )
        .orderBy(F.col("day_change_pct").desc(), "symbol")
    )


def materialize(df: DataFrame, name: str, kind: str = "view") -> None:
    """Publishes a mart as a view, or as a stored table with fresh statistics."""
    if kind == "view":
        df.createOrReplaceTempView(name)
    elif kind == "table":
        df.sparkSession.catalog.dropTempView(name)  # a view of that name would hide the table
        df.write.mode("overwrite").saveAsTable(name)
        df.sparkSession.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")
    else:
        raise ValueError(f"kind must be view or table, not {kind}")


# Which marts are stored; the others are views.
STORED_MARTS = ("mart_daily_performance", "mart_spread_by_session")


def refresh_marts(
    tables, as_of_ms: int | Column | None = None, stored: tuple[str, ...] = STORED_MARTS
) -> list[str]:
    """Publishes all six marts, those of ``stored`` as tables.

    Over stored facts the two marts of a history merge kept results by day, so that a refresh
    reads the days that were written to since the last one.
    """
    merged = states.kept(tables) and not isinstance(as_of_ms, Column)
    daily = daily_performance_by_day if merged else mart_daily_performance
    sessions = spread_by_session_by_day if merged else mart_spread_by_session
    marts = {
        "mart_latest_prices": mart_latest_prices(tables),
        "mart_daily_performance": daily(tables, as_of_ms),
        "mart_technical_signals": mart_technical_signals(tables),
        "mart_orderflow_summary": mart_orderflow_summary(tables, as_of_ms),
        "mart_spread_by_session": sessions(tables, as_of_ms),
        "mart_alert_summary": mart_alert_summary(tables, as_of_ms),
    }
    for name, df in marts.items():
        materialize(df, name, "table" if name in stored else "view")
    return list(marts)
