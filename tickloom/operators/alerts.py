"""Anomaly detectors.

Each rule judges rows ``(symbol_key, ts, value, baseline)``. The as-of form feeds it the
newest row of each symbol; the replay form feeds it every row with its own trailing baseline.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.functions.clock import DAY, HOUR, MINUTE, as_of_or_now, datetime_key
from tickloom.functions.numbers import decimal_avg
from tickloom.operators.blocks import trailing_avg, with_previous
from tickloom.operators.keys import resolve_alert_type
from tickloom.operators.ordering import last_rows
from tickloom.schemas import FACTS, conform

BLOCK_MS = 6 * HOUR
KEY = ["symbol_key"]


@dataclass(frozen=True)
class Thresholds:
    """The default limits of the four rules."""

    spike_pct: float = 1.0
    spike_high_pct: float = 2.0
    surge_ratio: float = 3.0
    surge_high_ratio: float = 5.0
    widening_ratio: float = 2.0
    liquidity_pct: float = 20.0
    surge_span_ms: int = 30 * MINUTE
    widening_span_ms: int = HOUR
    liquidity_span_ms: int = DAY


DEFAULTS = Thresholds()


def _alerts(df: DataFrame, code: str, metric: Column, fires: Column, severity: Column):
    """Firing rows in the common alert shape; ``threshold_pct`` is the observed metric."""
    return (
        df.withColumn("_metric", metric)
        .filter(fires)
        .select(
            "symbol_key",
            F.lit(code).alias("alert_code"),
            F.col("ts").alias("triggered_at"),
            F.col("value").cast("double").alias("trigger_value"),
            F.round("_metric", 6).alias("threshold_pct"),
            severity.alias("severity"),
        )
    )


def _ratio() -> Column:
    return F.when(
        F.col("baseline") != 0, F.col("value").cast("double") / F.col("baseline")
    )


def _graded(limit: float) -> Column:
    return F.when(F.col("_metric") >= limit, "HIGH").otherwise("MEDIUM")


def spike_rule(df: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    """Close against the row before it, whatever the gap between them."""
    now, before = F.col("value").cast("double"), F.col("previous").cast("double")
    move = F.when(before != 0, F.abs(now - before) / before * 100)
    fires = F.col("_metric") >= t.spike_pct
    return _alerts(df, "price_spike", move, fires, _graded(t.spike_high_pct))


def surge_rule(df: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    fires = F.col("_metric") >= t.surge_ratio
    return _alerts(df, "volume_surge", _ratio(), fires, _graded(t.surge_high_ratio))


def widening_rule(df: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    fires = F.col("_metric") >= t.widening_ratio
    return _alerts(df, "spread_widening", _ratio(), fires, F.lit("MEDIUM"))


def liquidity_rule(df: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    fires = F.col("_metric") < t.liquidity_pct
    return _alerts(df, "low_liquidity", _ratio() * 100, fires, F.lit("LOW"))


def _closes(trade_agg: DataFrame) -> DataFrame:
    return trade_agg.select(
        "symbol_key", F.col("window_start").alias("ts"), F.col("close").alias("value")
    )


def _volumes(trade_agg: DataFrame) -> DataFrame:
    return trade_agg.select(
        "symbol_key", F.col("window_start").alias("ts"), F.col("volume").alias("value")
    )


def _spreads(snapshots: DataFrame) -> DataFrame:
    return snapshots.select(
        "symbol_key", F.col("snapshot_time").alias("ts"), F.col("spread").alias("value")
    )


def _depths(snapshots: DataFrame) -> DataFrame:
    depth = F.col("bid_qty") + F.col("ask_qty")
    return snapshots.select(
        "symbol_key", F.col("snapshot_time").alias("ts"), depth.alias("value")
    )


# -- as of a time ---------------------------------------------------------------------------


def _newest_with_baseline(
    df: DataFrame, span_ms: int, as_of_ms: int | Column | None, max_age_ms: int | None
) -> DataFrame:
    """Newest row of each symbol, with the mean of its rows in ``[as_of - span, as_of]``."""
    now = as_of_or_now(as_of_ms)
    recent = F.when(F.col("ts") >= now - span_ms, F.col("value"))
    both = (
        df.filter(F.col("ts") <= now).groupBy(*KEY)
        .agg(
            F.max(F.struct("ts", "value")).alias("_newest"),
            decimal_avg(F.sum(recent), F.count(recent)).alias("baseline"),
        )
        .filter(F.col("baseline").isNotNull())
        .select(*KEY, "_newest.ts", "_newest.value", "baseline")
    )
    return _fresh(both, now, max_age_ms)


def _fresh(df: DataFrame, now: Column, max_age_ms: int | None) -> DataFrame:
    return df if max_age_ms is None else df.filter(F.col("ts") >= now - max_age_ms)


def price_spikes(
    trade_agg: DataFrame, as_of_ms: int | Column | None = None,
    t: Thresholds = DEFAULTS, max_age_ms: int | None = None,
) -> DataFrame:
    now = as_of_or_now(as_of_ms)
    two = last_rows(
        _closes(trade_agg).filter(F.col("ts") <= now), KEY, [F.col("ts").desc()], 2
    )
    older = F.lead("value").over(Window.partitionBy(*KEY).orderBy(F.col("ts").desc()))
    newest = two.withColumn("previous", older).filter(F.col("_rank") == 1)
    return spike_rule(_fresh(newest, now, max_age_ms), t)


def volume_surges(trade_agg, as_of_ms=None, t: Thresholds = DEFAULTS, max_age_ms=None):
    return surge_rule(
        _newest_with_baseline(_volumes(trade_agg), t.surge_span_ms, as_of_ms, max_age_ms), t
    )


def spread_widening(snapshots, as_of_ms=None, t: Thresholds = DEFAULTS, max_age_ms=None):
    return widening_rule(
        _newest_with_baseline(_spreads(snapshots), t.widening_span_ms, as_of_ms, max_age_ms), t
    )


def low_liquidity(snapshots, as_of_ms=None, t: Thresholds = DEFAULTS, max_age_ms=None):
    return liquidity_rule(
        _newest_with_baseline(_depths(snapshots), t.liquidity_span_ms, as_of_ms, max_age_ms), t
    )


# -- replay ---------------------------------------------------------------------------------


def price_spikes_replay(trade_agg, t: Thresholds = DEFAULTS, block_ms: int = BLOCK_MS):
    rows = with_previous(_closes(trade_agg), KEY, "ts", block_ms, {"previous": "value"})
    return spike_rule(rows, t)


def _replayed(df: DataFrame, span_ms: int, block_ms: int) -> DataFrame:
    return trailing_avg(df, KEY, "ts", F.col("value"), span_ms, block_ms)


def volume_surges_replay(trade_agg, t: Thresholds = DEFAULTS, block_ms: int = BLOCK_MS):
    return surge_rule(_replayed(_volumes(trade_agg), t.surge_span_ms, block_ms), t)


def spread_widening_replay(snapshots, t: Thresholds = DEFAULTS, block_ms: int = BLOCK_MS):
    return widening_rule(_replayed(_spreads(snapshots), t.widening_span_ms, block_ms), t)


def low_liquidity_replay(snapshots, t: Thresholds = DEFAULTS, block_ms: int = BLOCK_MS):
    return liquidity_rule(_replayed(_depths(snapshots), t.liquidity_span_ms, block_ms), t)


# -- the alert fact -------------------------------------------------------------------------


def alert_fact(detected: list[DataFrame], dim_alert_type: DataFrame) -> DataFrame:
    rows = reduce(DataFrame.unionByName, detected)
    return conform(
        resolve_alert_type(rows, dim_alert_type)
        .withColumn("datetime_key", datetime_key("triggered_at"))
        .withColumn("is_resolved", F.lit(False))
        .withColumn("resolved_at", F.lit(None).cast("long")),
        "price_alert",
    )


def detect_alerts(
    tables, as_of_ms: int | Column | None = None, t: Thresholds = DEFAULTS, by_minutes: bool | None = None
):
    """All four rules on the newest rows, as alert facts; by default as of now.

    A store that keeps minute sums is read by these (``by_minutes=False``: by its rows), with the
    same result.
    """
    if as_of_ms is None:  # a number, so that stored days can be chosen by it
        as_of_ms = int(time.time() * 1000)
    if by_minutes is None:
        by_minutes = isinstance(as_of_ms, int) and tables.keeps_minutes
    if by_minutes:
        return alert_fact(_judged_by_minutes(tables, as_of_ms, t), tables.dim("alert_type"))
    trades, quotes = _recent_rows(tables, as_of_ms, t)
    detected = [
        price_spikes(trades, as_of_ms, t), volume_surges(trades, as_of_ms, t),
        spread_widening(quotes, as_of_ms, t), low_liquidity(quotes, as_of_ms, t),
    ]
    return alert_fact(detected, tables.dim("alert_type"))


# -- as of a time, by minute sums -----------------------------------------------------------

NEAR_MS = 2 * MINUTE


def _newest_rows(tables, name: str, rows: Callable[..., DataFrame], as_of_ms: int) -> DataFrame:
    """Each active symbol's last two rows are in the result: rows of the last two minutes, and,
    of symbols that were silent then, those of the days on which they had their last ones."""
    near = rows(from_ms=as_of_ms - NEAR_MS, to_ms=as_of_ms)
    busy = near.groupBy(*KEY).agg(F.count("*").alias("_n")).filter("_n > 1")
    silent = tables.symbols().join(busy, KEY, "left_anti").select(*KEY)
    if silent.isEmpty():
        return near

    def earlier(**bounds) -> DataFrame:
        return rows(to_ms=as_of_ms, **bounds).join(silent, KEY, "left_semi")

    bounds = tables.newest_from(name, earlier, 2, symbols=silent)
    return near.unionByName(earlier(**bounds).filter(F.col(FACTS[name].time) < as_of_ms - NEAR_MS))


def _baselines(
    tables, name: str, sums: DataFrame, value: str, rows: DataFrame, span_ms: int, as_of_ms: int
) -> DataFrame:
    """Mean of ``value`` in ``[as_of - span, as_of]``: whole minutes from ``sums``, the rest of the
    first and the last minute from ``rows``."""
    low, time = as_of_ms - span_ms, F.col("ts")
    first, last = -(-low // MINUTE) * MINUTE, (as_of_ms + 1) // MINUTE * MINUTE
    whole = sums.filter((F.col("minute") >= first) & (F.col("minute") < last)).select(*KEY, F.col(value).alias("s"), "n")
    edges = rows.filter((time >= low) & (time <= as_of_ms) & ((time < first) | (time >= last)))
    parts = whole.unionByName(edges.select(*KEY, F.col("value").cast("decimal(38,8)").alias("s"), F.lit(1).cast("long").alias("n")))
    return parts.groupBy(*KEY).agg(decimal_avg(F.sum("s"), F.sum("n")).alias("baseline"))


def _judged_by_minutes(tables, as_of_ms: int, t: Thresholds) -> list[DataFrame]:
    active, five = tables.symbols().select(*KEY), F.col("window_key") == tables.window_key("5s")

    def trades(**bounds) -> DataFrame:
        return tables.windowed("trade_agg", "5s", **bounds)

    def quotes(**bounds) -> DataFrame:
        return active_snapshots(tables, **bounds)

    def judged(name, rows, shape, value, span_ms, newest, narrow=None) -> DataFrame:
        low = as_of_ms - span_ms
        first, last = -(-low // MINUTE) * MINUTE, (as_of_ms + 1) // MINUTE * MINUTE
        sums = tables.minute_sums(name, first, last).join(active, KEY, "left_semi")
        edges = shape(rows(from_ms=low, to_ms=min(first - 1, as_of_ms))).unionByName(
            shape(rows(from_ms=max(last, low, first), to_ms=as_of_ms)))
        means = _baselines(tables, name, sums if narrow is None else sums.filter(narrow), value, edges, span_ms, as_of_ms)
        top = shape(newest).groupBy(*KEY).agg(F.max(F.struct("ts", "value")).alias("_newest"))
        return top.join(means.filter(F.col("baseline").isNotNull()), KEY).select(*KEY, "_newest.ts", "_newest.value", "baseline")

    last_trades = _newest_rows(tables, "trade_agg", trades, as_of_ms)
    last_quotes = _newest_rows(tables, "spread_snapshot", quotes, as_of_ms)
    return [
        price_spikes(last_trades, as_of_ms, t),
        surge_rule(judged("trade_agg", trades, _volumes, "volume", t.surge_span_ms, last_trades, five), t),
        widening_rule(judged("spread_snapshot", quotes, _spreads, "spread", t.widening_span_ms, last_quotes), t),
        liquidity_rule(judged("spread_snapshot", quotes, _depths, "depth", t.liquidity_span_ms, last_quotes), t),
    ]


def store_alerts(tables, as_of_ms: int, t: Thresholds = DEFAULTS) -> None:
    """Detects and stores; an alert that is stored already is not stored again."""
    found = detect_alerts(tables, as_of_ms, t).persist()
    try:
        low, high, rows = found.agg(
            F.min("triggered_at"), F.max("triggered_at"), F.count("*")
        ).first()
        if rows:
            tables.insert(found, "price_alert", span=(low, high), unique=True, rows=rows)
    finally:
        found.unpersist()


def _recent_rows(tables, as_of_ms, t: Thresholds) -> tuple[DataFrame, DataFrame]:
    """The stored days that hold all baselines and each symbol's last two rows.

    A time that is a column is not known before the query runs; then everything is read.
    """

    def trades(low: int | None, high: int | None = None) -> DataFrame:
        return tables.windowed("trade_agg", "5s", from_ms=low, to_ms=high)

    def quotes(low: int | None, high: int | None = None) -> DataFrame:
        return active_snapshots(tables, from_ms=low, to_ms=high)

    def since(name: str, rows, span_ms: int) -> int | None:
        if not isinstance(as_of_ms, int):
            return None
        symbols = tables.symbols().select("symbol_key")
        start = tables.reach_back(name, symbols, as_of_ms + 1, 2, rows)
        return None if start is None else min(start, as_of_ms - span_ms)

    quote_span = max(t.widening_span_ms, t.liquidity_span_ms)
    return (
        trades(since("trade_agg", trades, t.surge_span_ms)),
        quotes(since("spread_snapshot", quotes, quote_span)),
    )


def replay_alerts(tables, t: Thresholds = DEFAULTS, block_ms: int = BLOCK_MS):
    """All four rules on every stored row, as alert facts."""
    trades = tables.windowed("trade_agg", "5s")
    quotes = active_snapshots(tables)
    detected = [
        price_spikes_replay(trades, t, block_ms), volume_surges_replay(trades, t, block_ms),
        spread_widening_replay(quotes, t, block_ms), low_liquidity_replay(quotes, t, block_ms),
    ]
    return alert_fact(detected, tables.dim("alert_type"))


def active_snapshots(tables, **bounds) -> DataFrame:
    return tables.fact("spread_snapshot", **bounds).join(
        tables.symbols().select("symbol_key"), "symbol_key"
    )
