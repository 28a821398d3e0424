"""Parameterised read queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions import clock, labels
from tickloom.functions.numbers import round_numeric
from tickloom.operators.ordering import asof_previous, latest_per, newest, tail
from tickloom.plans.staging import INDICATORS, natural_key, stg_spread_snapshot

# Allowed arguments.
WINDOWS = ("1s", "5s")
SEVERITIES = ("LOW", "MEDIUM", "HIGH")


def _one_of(name: str, value: str, allowed: tuple[str, ...]) -> None:
    if value not in allowed:
        raise ValueError(f"{name} must be one of {', '.join(allowed)}, not {value!r}")


def _limit(n: int, most: int) -> None:
    if not 1 <= n <= most:
        raise ValueError(f"limit must be from 1 to {most}, not {n}")


def require_rows(df: DataFrame, symbol: str) -> DataFrame:
    """The answer, or :class:`LookupError` where a symbol has none."""
    if df.isEmpty():
        raise LookupError(f"symbol {symbol.upper()} not found")
    return df


def _of_symbol(tables, df: DataFrame, symbol: str) -> DataFrame:
    """Rows of one symbol: its key is looked up first, so the scan can skip by it."""
    key = _named(tables, symbol).select("symbol_key").scalar()
    return df.filter(F.col("symbol_key") == key).withColumn("symbol", F.lit(symbol.upper()))


def _named(tables, symbol: str) -> DataFrame:
    return tables.dim("symbol").filter(F.col("symbol") == symbol.upper())


def _of_window(tables, df: DataFrame, window: str) -> DataFrame:
    return df.filter(F.col("window_key") == tables.window_key(window))


def _tail_of(tables, name: str, symbol: str, limit: int, window: str | None) -> DataFrame:
    """Enough of a symbol's newest stored days to hold its last ``limit`` rows."""

    def rows(from_ms: int | None = None, to_ms: int | None = None, **bounds) -> DataFrame:
        found = _of_symbol(tables, tables.fact(name, from_ms, to_ms, **bounds), symbol)
        return found if window is None else _of_window(tables, found, window)

    of = None if window is None else F.col("window_key") == tables.window_key(window)
    return rows(**tables.newest_from(name, rows, limit, symbols=_named(tables, symbol), of=of))


def latest_prices(tables, gap_ms: int = 60_000) -> DataFrame:
    """Newest one-second price a symbol, with its change against ``gap_ms`` earlier.

    By the record of what was seen when, only the days are read that hold a symbol's last rows
    and its last row before the gap, however old they are; symbols that never traded add none.
    """
    def seconds(low: int | None, high: int | None = None) -> DataFrame:
        return _of_window(tables, tables.fact("trade_agg", low, high), "1s")

    names = tables.dim("symbol").select("symbol_key", "symbol", "display_name", "category")
    symbols = names.select("symbol_key")
    one_second = F.col("window_key") == tables.window_key("1s")
    days = tables.newest_days("trade_agg", symbols, gap_ms, one_second)
    if days is not None:
        recent = tables.fact("trade_agg", days=days)
    else:
        recent = tables.fact("trade_agg", **tables.newest_from("trade_agg", seconds, symbols=names))
    newest_any = (
        recent.groupBy("symbol_key").agg(F.max("window_start").alias("newest"))
        .join(symbols, "symbol_key")
    )
    latest = latest_per(
        _of_window(tables, recent, "1s"), ["symbol_key"], [F.col("window_start").desc()]
    )
    if days is not None:
        earlier = _of_window(tables, recent, "1s")
    else:
        first = newest_any.agg(F.min("newest")).first()[0]
        cutoff = None if first is None else first - gap_ms
        earlier = seconds(tables.reach_back("trade_agg", symbols, cutoff, 1, seconds))
    previous = asof_previous(
        earlier.select("symbol_key", "window_start", F.col("close").alias("prev_close")),
        newest_any, "symbol_key", "window_start", gap_ms, tables.few_symbols,
    ).select("symbol_key", "prev_close")
    last, before = F.col("close").cast("double"), F.col("prev_close").cast("double")
    return (
        latest.join(names, "symbol_key")
        .join(previous, "symbol_key", "left")
        .select(
            "symbol", "display_name", "category", F.col("close").alias("last_price"),
            "vwap", "volume", "trade_count",
            clock.whole_seconds("window_start").alias("updated_at"),
            F.coalesce(F.col("close") - F.col("prev_close"), F.lit(0)).alias("price_change"),
            F.when(before != 0, round_numeric((last - before) / before * 100, 4))
            .otherwise(F.lit(0.0)).alias("price_change_pct"),
        )
        .orderBy("symbol")
    )


def price_history(tables, symbol: str, window: str = "1s", limit: int = 60) -> DataFrame:
    _one_of("window", window, WINDOWS)
    _limit(limit, 1440)
    rows = _tail_of(tables, "trade_agg", symbol, limit, window)
    return tail(rows, "window_start", limit).select(
        "window_start", "open", "high", "low", "close", "volume", "vwap", "trade_count",
        "price_change_pct",
    )


def orderflow_summary(
    tables, as_of_ms: int | Column | None = None, span_ms: int = 30 * clock.SECOND
) -> DataFrame:
    """Order flow of the last seconds a symbol, largest imbalance first."""
    since = clock.as_of_or_now(as_of_ms) - span_ms
    facts = _of_window(tables, tables.fact("order_flow", from_ms=since), "1s")
    names = tables.dim("symbol").select("symbol_key", "symbol")
    sums = facts.join(names, "symbol_key").groupBy("symbol").agg(
        F.sum("buy_volume").alias("total_buy"),
        F.sum("sell_volume").alias("total_sell"),
        F.sum("total_volume").alias("total_volume"),
        F.sum("net_flow").alias("net_flow"),
        F.max("window_start").alias("_latest"),
    )

    def share(part: str) -> Column:
        all_ = F.col("total_volume").cast("double")
        return F.when(
            all_ > 0, round_numeric(F.col(part).cast("double") / all_ * 100, 2)
        ).otherwise(F.lit(50.0))

    return sums.select(
        "symbol", "total_buy", "total_sell", "total_volume", "net_flow",
        share("total_buy").alias("buy_pct"), share("total_sell").alias("sell_pct"),
        labels.pressure_by_flow(F.col("net_flow")).alias("pressure_state"),
        clock.whole_seconds("_latest").alias("as_of"),
    ).orderBy(F.abs("net_flow").desc(), "symbol")


def orderflow_history(tables, symbol: str, limit: int = 60) -> DataFrame:
    _limit(limit, 300)
    rows = _tail_of(tables, "order_flow", symbol, limit, "1s")
    return tail(rows, "window_start", limit).select(
        "window_start", "buy_volume", "sell_volume", "total_volume", "buy_count",
        "sell_count", "buy_pct", "net_flow",
    )


def technical(tables, symbol: str, limit: int = 1) -> DataFrame:
    _limit(limit, 200)
    key = ["symbol_key", "interval_key", "open_time"]

    def signals(from_ms: int | None = None, to_ms: int | None = None, **bounds) -> DataFrame:
        facts = tables.fact("technical_indicator", from_ms, to_ms, **bounds)
        candles = tables.fact("kline_closed", from_ms, to_ms, **bounds).select(
            *key, "close_time", "open", "high", "low", "close", "volume", "is_bullish"
        )
        return _of_symbol(tables, facts, symbol).join(candles, key)

    bounds = tables.newest_from("technical_indicator", signals, limit, symbols=_named(tables, symbol))
    rows = newest(signals(**bounds), ["open_time", "interval_key"], limit)
    return rows.select(
        "symbol",
        clock.whole_seconds("open_time").alias("open_time"),
        clock.whole_seconds("close_time").alias("candle_time"),
        "open", "high", "low", "close", "volume", "is_bullish", "rsi_14",
        labels.rsi_flag(F.col("rsi_14")).alias("rsi_signal"),
        *INDICATORS[1:4],
        labels.macd_flag(F.col("macd"), F.col("macd_signal")).alias("macd_signal_dir"),
        *INDICATORS[4:],
    )


def alerts(
    tables, as_of_ms: int | Column | None = None, severity: str | None = None,
    resolved: bool | None = None, limit: int = 50, span_ms: int = clock.DAY,
) -> DataFrame:
    _limit(limit, 500)
    since = clock.as_of_or_now(as_of_ms) - span_ms
    rows = tables.fact("price_alert", from_ms=since).filter(F.col("triggered_at") > since)
    if severity is not None:
        _one_of("severity", severity, SEVERITIES)
        rows = rows.filter(F.col("severity") == severity)
    if resolved is not None:
        rows = rows.filter(F.col("is_resolved") == resolved)
    names = tables.dim("symbol").select("symbol_key", "symbol")
    kinds = tables.dim("alert_type").select(
        "alert_type_key", "alert_code", F.col("description").alias("alert_description")
    )
    named = rows.join(names, "symbol_key").join(kinds, "alert_type_key").withColumn(
        "alert_key", natural_key("symbol", "alert_code", "triggered_at")
    )
    return named.orderBy(F.col("triggered_at").desc(), "alert_key").limit(limit).select(
        "alert_key", "symbol", "alert_code", "alert_description", "severity",
        clock.whole_seconds("triggered_at").alias("triggered_at"),
        "trigger_value", "threshold_pct", "is_resolved",
        clock.whole_seconds("resolved_at").alias("resolved_at"),
        clock.alert_session("triggered_at").alias("trading_session"),
    )


def spread_history(tables, symbol: str, limit: int = 60) -> DataFrame:
    _limit(limit, 1440)

    def snapshots(from_ms: int | None = None, to_ms: int | None = None, **bounds) -> DataFrame:
        rows = stg_spread_snapshot(tables, from_ms=from_ms, to_ms=to_ms, **bounds)
        return rows.filter(F.col("symbol") == symbol.upper())

    bounds = tables.newest_from(
        "spread_snapshot", snapshots, limit, key="symbol", symbols=_named(tables, symbol)
    )
    return tail(snapshots(**bounds), "snapshot_time", limit).select(
        "snapshot_time", "bid_price", "ask_price", "mid_price", "spread", "spread_pct",
        "bid_qty", "ask_qty", "liquidity_imbalance",
    )
