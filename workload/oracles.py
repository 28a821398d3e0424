"""The same results in SQL, written independently of the Spark side.

Each query is a SELECT over named parts; a part becomes a CTE with the parts it reads.
"""

from __future__ import annotations

import re

from tickloom.sources.dims import SEEDS
from workload.inputs import CALENDAR_AS_OF, SYMBOL_OF_USER, TICK_START, TICK_STEP
from workload.queries import DAY, LIMITS, SYMBOL

KLINE_MS = 21600000
TICK_AS_OF = f"(select {TICK_START} + max(event_id) * {TICK_STEP} from events)"


def _values(name: str) -> str:
    ddl, rows = SEEDS[name]
    columns = ", ".join(f.strip().split(" ")[0] for f in ddl.split(","))
    quoted = ", ".join(
        "(" + ", ".join(
            str(v).lower() if isinstance(v, (bool, int)) else "'" + v + "'" for v in row
        ) + ")"
        for row in rows
    )
    return f"select * from (values {quoted}) as t({columns})"


def _windows(ms: int) -> str:
    q = "cast(quantity as decimal(24,8))"
    return f"""
select *, cast((cast(notional * 100000000 as hugeint) * 200000000
    + cast(volume * 100000000 as hugeint)) // (cast(volume * 100000000 as hugeint) * 2) as double)
  / 100000000 as vwap from (
  select trade_time // {ms} * {ms} as window_start, trade_time // {ms} * {ms} + {ms} as window_end,
    symbol, arg_min(price, (trade_time, trade_id)) as open, max(price) as high,
    min(price) as low, arg_max(price, (trade_time, trade_id)) as close,
    sum({q}) as volume, sum(cast(price * quantity as decimal(28,8))) as notional,
    count(*) as trade_count,
    sum(case when not buyer_maker then {q} else 0 end) as buy_volume,
    sum(case when buyer_maker then {q} else 0 end) as sell_volume,
    count(*) filter (where not buyer_maker) as buy_count,
    count(*) filter (where buyer_maker) as sell_count
  from good_trades group by trade_time // {ms}, symbol)"""


def _dtkey(ms: str) -> str:
    return f"cast(strftime(make_timestamp({ms} * 1000), '%Y%m%d%H%M') as bigint)"


def _quotes(clock: str) -> str:
    return f"""
select case when event_id % 109 = 0 then null else sym end as symbol,
  10000 + value as bid_price, cast(1 + user_id % 50 as double) as bid_qty,
  case when event_id % 97 = 0 then 9999 + value
    else 10000 + value + 0.01::double + k * 0.1::double end as ask_price,
  cast(1 + event_id % 40 as double) as ask_qty, {clock} as ingested_at
from ev"""


def _snap(source: str) -> str:
    def avg(c: str) -> str:
        return f"cast(sum(cast({c} as decimal(24,8))) as double) / count({c}) as avg_{c}"

    return f"""
select ingested_at // 1000 * 1000 as window_start, symbol,
  {avg('bid_price')}, {avg('ask_price')}, {avg('bid_qty')}, {avg('ask_qty')}
from {source} where symbol is not null and bid_price > 0 and ask_price > 0
group by ingested_at // 1000, symbol"""


def _spread_fact(source: str) -> str:
    return f"""
select symbol_key, {_dtkey('window_start')} as datetime_key, window_start as snapshot_time,
  cast(avg_bid_price as decimal(18,8)) as bid_price,
  cast(avg_ask_price as decimal(18,8)) as ask_price,
  cast((avg_bid_price + avg_ask_price) / 2 as decimal(18,8)) as mid_price,
  cast(avg_ask_price - avg_bid_price as decimal(18,8)) as spread,
  cast((avg_ask_price - avg_bid_price) / ((avg_bid_price + avg_ask_price) / 2) * 100
    as decimal(24,6)) as spread_pct,
  cast(avg_bid_qty as decimal(24,8)) as bid_qty, cast(avg_ask_qty as decimal(24,8)) as ask_qty,
  cast(case when avg_bid_qty + avg_ask_qty <> 0
    then (avg_bid_qty - avg_ask_qty) / (avg_bid_qty + avg_ask_qty) else 0 end
    as decimal(24,6)) as liquidity_imbalance
from {source} join dim_symbol using (symbol)
where avg_bid_price > 0 and avg_ask_price > avg_bid_price"""


def _ema(values: str, period: int) -> str:
    k = 2 / (period + 1)
    mean = f"list_reduce({values}[1:{period}], lambda a, x: a + x, 0.0::double) / {period}"
    return (
        f"list_reduce({values}[{period + 1}:], "
        f"lambda a, x: x * {k!r}::double + a * {1 - k!r}::double, {mean})"
    )


def _half_up(total: str, scale: int, n: str, digits: int) -> str:
    """Exact mean of a DECIMAL total at ``scale``, rounded half away from zero."""
    units = f"cast(({total}) * {10 ** scale} as hugeint)"
    step = f"({10 ** (scale - digits)} * {n})"
    return (
        f"(sign({units}) * ((2 * abs({units}) + {step}) // (2 * {step})))::double"
        f" / {10 ** digits}"
    )


def _mean(column: str, scale: int, digits: int) -> str:
    return _half_up(f"sum(cast({column} as decimal(28,{scale})))", scale, "count(*)", digits)


def _wilder(values: str, n: int = 14) -> str:
    mean = f"list_reduce({values}[1:{n}], lambda a, x: a + x, 0.0::double) / {n}"
    return f"list_reduce({values}[{n + 1}:], lambda a, x: (a * {n - 1} + x) / {n}, {mean})"


def _sum(values: str) -> str:
    return f"list_reduce({values}, lambda a, x: a + x, 0.0::double)"


def _tail(values: str, n: int) -> str:
    return f"{values}[greatest(len({values}) - {n - 1}, 1):]"


def _indicator_parts(source: str, prefix: str) -> dict[str, str]:
    """Indicators of ``source(series, open_time, high, low, close, volume)``."""
    return {
        f"{prefix}_frames": f"""
select series, open_time, list(high) over w as h, list(low) over w as l, list(close) over w as c,
  list(volume) over w as v
from {source}
window w as (partition by series order by open_time rows between 33 preceding and current row)""",
        f"{prefix}_moves": f"""
select *, list_transform(range(2, len(c27) + 1), lambda i: c27[i] - c27[i-1]) as d,
  list_transform(range(2, len(c27) + 1), lambda i: greatest(h27[i] - l27[i],
    abs(h27[i] - c27[i-1]), abs(l27[i] - c27[i-1]))) as tr,
  list_transform(range(2, len(c27) + 1), lambda i: sign(c27[i] - c27[i-1]) * v27[i]) as sv
from (select series, open_time, c, {_tail('c', 20)} as c20, {_tail('c', 27)} as c27,
  {_tail('h', 27)} as h27, {_tail('l', 27)} as l27, {_tail('v', 27)} as v27
  from {prefix}_frames)""",
        f"{prefix}_steps": f"""
select *, list_transform(d, lambda x: greatest(x, 0.0::double)) as gains,
  list_transform(d, lambda x: greatest(-x, 0.0::double)) as losses,
  case when len(c20) = 20 then {_sum('c20')} / 20 end as mid,
  case when len(c) = 34 then list_transform(range(26, 35),
    lambda n: {_ema('c[1:n]', 12)} - {_ema('c[1:n]', 26)}) end as line
from {prefix}_moves""",
        f"{prefix}_values": f"""
select *, case when len(d) >= 14 then {_wilder('gains')} end as ag,
  case when len(d) >= 14 then {_wilder('losses')} end as al,
  case when mid is not null then sqrt({_sum('list_transform(c20, lambda x: (x - mid) * (x - mid))')}
    / 19) end as dev,
  round(line[9], 8) as macd,
  round(list_reduce(line, lambda a, x: a + x) / 9, 8) as macd_signal
from {prefix}_steps""",
        f"{prefix}": f"""
select series, open_time,
  case when len(d) < 14 then null when al = 0 then 100
    else round(100 - 100 / (1 + ag / al), 4) end as rsi_14,
  macd, macd_signal, round(macd - macd_signal, 8) as macd_hist,
  round(mid + 2 * dev, 8) as bb_upper, round(mid, 8) as bb_middle,
  round(mid - 2 * dev, 8) as bb_lower,
  case when mid <> 0 then round(((mid + 2 * dev) - (mid - 2 * dev)) / mid * 100, 6) end as bb_width,
  case when len(d) >= 14 then round({_wilder('tr')}, 8) end as atr_14,
  round({_sum('sv')}, 8) as obv
from {prefix}_values""",
    }


def _tech(source: str) -> str:
    return f"""
select series as symbol_key, {_dtkey('open_time')} as datetime_key, 1 as interval_key, open_time,
  cast(rsi_14 as decimal(8,4)) as rsi_14, cast(macd as decimal(18,8)) as macd,
  cast(macd_signal as decimal(18,8)) as macd_signal,
  cast(macd_hist as decimal(18,8)) as macd_hist, cast(bb_upper as decimal(18,8)) as bb_upper,
  cast(bb_middle as decimal(18,8)) as bb_middle, cast(bb_lower as decimal(18,8)) as bb_lower,
  cast(bb_width as decimal(24,6)) as bb_width, cast(atr_14 as decimal(18,8)) as atr_14,
  cast(obv as decimal(24,8)) as obv
from {source}"""


def _trailing(source: str, ts: str, value: str, span: int) -> str:
    return f"""
select symbol_key, {ts} as ts, cast({value} as double) as value,
  cast(sum({value}) over w as double) / count(*) over w as baseline
from {source}
window w as (partition by symbol_key order by {ts}
  range between {span} preceding and current row)"""


def _asof(source: str, ts: str, value: str, span: int) -> str:
    return f"""
select n.symbol_key, n.ts, cast(n.value as double) as value, b.baseline
from (select symbol_key, max({ts}) as ts, arg_max({value}, {ts}) as value
      from {source} group by symbol_key) n
join (select symbol_key, cast(sum({value}) as double) / count(*) as baseline from {source}
      where {ts} between {TICK_AS_OF} - {span} and {TICK_AS_OF} group by symbol_key) b
  using (symbol_key)"""


def _fires(code: str, source: str, metric: str, test: str, severity: str) -> str:
    return f"""
select symbol_key, '{code}' as alert_code, ts as triggered_at, value as trigger_value,
  round(metric, 6) as threshold_pct, {severity} as severity
from (select *, {metric} as metric from {source}) where metric {test}"""


RATIO = "case when baseline <> 0 then value / baseline end"
SPIKE = "case when previous <> 0 then abs(value - previous) / previous * 100 end"


def _graded(limit: float) -> str:
    return f"case when metric >= {limit} then 'HIGH' else 'MEDIUM' end"


def _rules(spike, surge, wide, thin, t) -> dict[str, str]:
    return {
        "spike": _fires("price_spike", spike, SPIKE, f">= {t.spike_pct}", _graded(t.spike_high_pct)),
        "surge": _fires("volume_surge", surge, RATIO, f">= {t.surge_ratio}", _graded(t.surge_high_ratio)),
        "wide": _fires("spread_widening", wide, RATIO, f">= {t.widening_ratio}", "'MEDIUM'"),
        "thin": _fires("low_liquidity", thin, RATIO + " * 100", f"< {t.liquidity_pct}", "'LOW'"),
    }


def _alert_fact(parts: list[str]) -> str:
    rows = " union all ".join(f"(select * from {p})" for p in parts)
    return f"""
select symbol_key, {_dtkey('triggered_at')} as datetime_key, alert_type_key, triggered_at,
  cast(trigger_value as decimal(24,8)) as trigger_value,
  cast(threshold_pct as decimal(24,6)) as threshold_pct, severity, false as is_resolved,
  cast(null as bigint) as resolved_at
from ({rows}) join dim_alert_type using (alert_code)"""


def _parts() -> dict[str, str]:
    from tickloom.operators.alerts import DEFAULTS

    parts = {
        "ev": f"""
select event_id, cast(json_extract_string(props, '$.k') as int) as k, value, user_id,
  epoch_us(ts) // 1000 as ts_ms, {TICK_START} + event_id * {TICK_STEP} as tick_ms,
  {SYMBOL_OF_USER} as sym
from events""",
        "trades": """
select case when event_id % 109 = 0 then null when event_id % 113 = 0 then 'XYZUSDT'
    else sym end as symbol, event_id as trade_id,
  case when event_id % 101 = 0 then null when event_id % 103 = 0 then 0::double
    else 10000 + value end as price,
  case when event_id % 107 = 0 then 0::double else cast(k + 1 as double) end as quantity,
  case when event_id % 127 = 0 then null else event_id % 2 = 0 end as buyer_maker,
  tick_ms as trade_time, tick_ms + (event_id % 7) * 500 as ingested_at
from ev""",
        "good_trades": """
select * from trades where price is not null and price > 0 and quantity is not null
  and quantity > 0 and symbol is not null""",
        "quotes": _quotes("tick_ms"),
        "quotes_c": _quotes("ts_ms"),
        "klines": f"""
select sym as symbol, '1m' as interval, ts_ms // {KLINE_MS} * {KLINE_MS} as open_time,
  ts_ms // {KLINE_MS} * {KLINE_MS} + {KLINE_MS - 1} as close_time,
  arg_min(10000 + value, (ts_ms, event_id)) as open, max(10000 + value) as high,
  min(10000 + value) as low, arg_max(10000 + value, (ts_ms, event_id)) as close,
  cast(sum(k + 1) as double) as volume, cast(count(*) as int) as trade_count,
  ts_ms // {KLINE_MS} % 17 <> 0 as is_closed
from ev group by sym, ts_ms // {KLINE_MS}""",
        "good_klines": "select * from klines where is_closed and close > 0 and volume >= 0",
        "w1": _windows(1000),
        "w5": _windows(5000),
        "snaps": _snap("quotes"),
        "snaps_c": _snap("quotes_c"),
        **{f"dim_{name}": _values(name) for name in SEEDS},
        "dim_datetime": """
select cast(strftime(m, '%Y%m%d%H%M') as bigint) as datetime_key, m as full_timestamp,
  cast(m as date) as date, year(m) as year, quarter(m) as quarter, month(m) as month,
  cast(strftime(m, '%W') as int) as week_of_year, day(m) as day_of_month,
  isodow(m) - 1 as day_of_week, isodow(m) >= 6 as is_weekend, hour(m) as hour,
  minute(m) as minute,
  case when isodow(m) >= 6 then 'Off' when hour(m) < 8 then 'Asia'
    when hour(m) < 16 then 'Europe' else 'US' end as trading_session
from (select unnest(generate_series(timestamp '2024-01-01', timestamp '2024-01-31 23:59:00',
  interval 1 minute)) as m)""",
        "bars": "select *, '1s' as window_label from w1 union all select *, '5s' from w5",
        "f_trade": f"""
select symbol_key, {_dtkey('window_start')} as datetime_key, window_key, window_start, window_end,
  cast(open as decimal(18,8)) as open, cast(high as decimal(18,8)) as high,
  cast(low as decimal(18,8)) as low, cast(close as decimal(18,8)) as close,
  cast(volume as decimal(24,8)) as volume, cast(vwap as decimal(18,8)) as vwap,
  cast(trade_count as int) as trade_count,
  cast(close - open as decimal(18,8)) as price_change,
  cast(case when open <> 0 then (close - open) / open * 100 else 0 end as decimal(24,6))
    as price_change_pct
from bars join dim_symbol using (symbol) join dim_window_type using (window_label)""",
        "f_flow": f"""
select symbol_key, {_dtkey('window_start')} as datetime_key, window_key, window_start,
  cast(buy_volume as decimal(24,8)) as buy_volume,
  cast(sell_volume as decimal(24,8)) as sell_volume,
  cast(buy_volume + sell_volume as decimal(24,8)) as total_volume,
  cast(buy_count as int) as buy_count, cast(sell_count as int) as sell_count,
  cast(case when buy_volume + sell_volume > 0 then cast(buy_volume as double)
    / (cast(buy_volume as double) + cast(sell_volume as double)) * 100 else 50 end
    as decimal(6,3)) as buy_pct,
  cast(buy_volume - sell_volume as decimal(24,8)) as net_flow
from bars join dim_symbol using (symbol) join dim_window_type using (window_label)""",
        "f_kline": f"""
select symbol_key, {_dtkey('open_time')} as datetime_key, interval_key, open_time, close_time,
  cast(open as decimal(18,8)) as open, cast(high as decimal(18,8)) as high,
  cast(low as decimal(18,8)) as low, cast(close as decimal(18,8)) as close,
  cast(volume as decimal(24,8)) as volume, trade_count,
  cast(close - open as decimal(18,8)) as price_change,
  cast(case when open <> 0 then (close - open) / open * 100 else 0 end as decimal(24,6))
    as price_change_pct,
  cast(case when open <> 0 then (high - low) / open * 100 else 0 end as decimal(24,6))
    as amplitude, close >= open as is_bullish
from good_klines join dim_symbol using (symbol)
  join dim_kline_interval on interval = interval_label""",
        "f_spread": _spread_fact("snaps"),
        "f_spread_c": _spread_fact("snaps_c"),
        "candles": """
select symbol_key as series, open_time, cast(high as double) as high, cast(low as double) as low,
  cast(close as double) as close, cast(volume as double) as volume from f_kline""",
        "raw_candles": "select symbol as series, open_time, high, low, close, volume from good_klines",
        **_indicator_parts("candles", "ind"),
        **_indicator_parts("raw_candles", "rawind"),
        "early_candles": f"select * from candles where open_time // {KLINE_MS} % 23 <> 5",
        **_indicator_parts("early_candles", "early"),
        "f_tech": _tech("ind"),
        "f_tech_early": _tech("early"),
        "t5": "select * from f_trade where window_key = 2",
        "depths": "select symbol_key, snapshot_time, spread, bid_qty + ask_qty as depth from f_spread",
        "r_spike": """
select symbol_key, window_start as ts, cast(close as double) as value,
  cast(lag(close) over (partition by symbol_key order by window_start) as double) as previous
from t5""",
        "r_surge": _trailing("t5", "window_start", "volume", 1800000),
        "r_wide": _trailing("depths", "snapshot_time", "spread", 3600000),
        "r_thin": _trailing("depths", "snapshot_time", "depth", 86400000),
        "n_spike": """
select * from r_spike where (symbol_key, ts) in
  (select symbol_key, max(window_start) from t5 group by symbol_key)""",
        "n_surge": _asof("t5", "window_start", "volume", 1800000),
        "n_wide": _asof("depths", "snapshot_time", "spread", 3600000),
        "n_thin": _asof("depths", "snapshot_time", "depth", 86400000),
    }
    for prefix, source, t in (("replay", "r", DEFAULTS), ("now", "n", LIMITS)):
        rules = _rules(*[f"{source}_{r}" for r in ("spike", "surge", "wide", "thin")], t)
        parts.update({f"{prefix}_{name}": sql for name, sql in rules.items()})
        parts[f"f_alert_{prefix}"] = _alert_fact([f"{prefix}_{name}" for name in rules])
    parts["f_alert"] = "select * from f_alert_replay"

    fl = "cast({0} as double) as {0}".format
    parts["s_trade"] = f"""
select concat_ws(':', symbol, window_start, window_label) as trade_agg_key, symbol, display_name,
  category, window_label as window_type, window_start, window_end, {fl('open')}, {fl('high')},
  {fl('low')}, {fl('close')}, {fl('volume')}, {fl('vwap')}, trade_count, {fl('price_change')},
  {fl('price_change_pct')}, trading_session, hour, day_of_week, is_weekend
from f_trade join dim_symbol using (symbol_key) join dim_window_type using (window_key)
  join dim_datetime using (datetime_key) where is_active"""
    parts["s_flow"] = f"""
select concat_ws(':', symbol, window_start, window_label) as order_flow_key, symbol,
  window_label as window_type, window_start, {fl('buy_volume')}, {fl('sell_volume')},
  {fl('total_volume')}, buy_count, sell_count, {fl('buy_pct')},
  cast(100 - buy_pct as double) as sell_pct, {fl('net_flow')}, trading_session, hour
from f_flow join dim_symbol using (symbol_key) join dim_window_type using (window_key)
  join dim_datetime using (datetime_key) where is_active"""
    parts["s_kline"] = f"""
select concat_ws(':', symbol, interval_key, open_time) as kline_key, symbol, interval_key,
  open_time, close_time, {fl('open')}, {fl('high')}, {fl('low')}, {fl('close')}, {fl('volume')},
  trade_count, {fl('price_change')}, {fl('price_change_pct')}, {fl('amplitude')}, is_bullish,
  trading_session, cast(date as varchar) as date, hour
from f_kline join dim_symbol using (symbol_key) join dim_datetime using (datetime_key)
where is_active"""
    measures = ("bid_price", "ask_price", "mid_price", "spread", "spread_pct", "bid_qty",
                "ask_qty", "liquidity_imbalance")
    for suffix in ("", "_c"):
        parts[f"s_spread{suffix}"] = f"""
select concat_ws(':', symbol, snapshot_time) as spread_key, symbol, snapshot_time,
  {', '.join(map(fl, measures))}, trading_session, hour, cast(date as varchar) as date
from f_spread{suffix} join dim_symbol using (symbol_key) join dim_datetime using (datetime_key)
where spread > 0 and is_active"""
    indicators = ("rsi_14", "macd", "macd_signal", "macd_hist", "bb_upper", "bb_middle",
                  "bb_lower", "bb_width", "atr_14", "obv")
    parts["s_tech"] = f"""
select concat_ws(':', symbol, interval_key, open_time) as tech_key, symbol, interval_key, open_time,
  {', '.join(map(fl, indicators))},
  case when rsi_14 > 70 then 'overbought' when rsi_14 < 30 then 'oversold' else 'neutral' end
    as rsi_signal,
  case when macd > macd_signal then 'bullish' when macd < macd_signal then 'bearish'
    else 'neutral' end as macd_signal_dir
from f_tech join dim_symbol using (symbol_key) where is_active"""
    parts["s_alert"] = f"""
select concat_ws(':', symbol, alert_code, triggered_at) as alert_key, symbol, alert_code,
  description as alert_description, triggered_at, {fl('trigger_value')}, {fl('threshold_pct')},
  severity, is_resolved, resolved_at, trading_session, cast(date as varchar) as date
from f_alert join dim_symbol using (symbol_key) join dim_alert_type using (alert_type_key)
  join dim_datetime using (datetime_key) where is_active"""

    def total(c: str) -> str:
        return f"cast(sum(cast({c} as decimal(28,8))) as double)"

    parts["days"] = f"""
select symbol, date, round(min(low), 8) as day_low, round(max(high), 8) as day_high,
  arg_min(open, open_time) as day_open, arg_max(close, open_time) as day_close,
  round({total('volume')}, 8) as day_volume, cast(sum(trade_count) as bigint) as day_trade_count,
  count(*) as candle_count, count(*) filter (where is_bullish) as bullish_candles,
  count(*) filter (where not is_bullish) as bearish_candles,
  {_mean('amplitude', 6, 4)} as avg_amplitude
from s_kline where date >= cast(cast(make_timestamp({CALENDAR_AS_OF} * 1000) as date)
  - interval 30 day as date)::varchar
group by symbol, date"""
    parts["signals"] = """
select t.*, k.open, k.high, k.low, k.close, k.volume, k.is_bullish, k.amplitude
from s_tech t join s_kline k using (symbol, interval_key, open_time)"""
    parts["envelope_counts"] = """
select 'trade' as route, symbol, count(*) as messages from trades
  where symbol is not null and price is not null and buyer_maker is not null group by symbol
union all select 'kline', symbol, count(*) from klines group by symbol
union all select 'bookticker', symbol, count(*) from quotes where symbol is not null
  group by symbol"""
    parts["broken_trades"] = """
select * from trades where symbol is null or price is null or buyer_maker is null"""
    parts["rejected_trades"] = """
select trade_id, case when symbol is null then 'no symbol' when price is null then 'no price'
    when price <= 0 then 'price not positive' else 'quantity not positive' end as reason
from trades where symbol is null or price is null or price <= 0 or quantity <= 0
union all
select trade_id + 10000000, ['price not finite', 'price not finite', 'price out of range', 'quantity not finite',
    'quantity not finite', 'quantity out of range', 'notional out of range'][trade_id % 10 + 1]
from trades where symbol is not null and trade_id % 10 < 7"""
    parts["trade_close"] = "select max(trade_time) - 2000 as mark from good_trades"
    parts["quote_close"] = """
select max(ingested_at) - 2000 as mark from quotes
where symbol is not null and bid_price > 0 and ask_price > 0"""
    return parts


def _doubles(columns: str) -> str:
    """Comma list where ``name*`` is a stored decimal shown as double."""
    out = []
    for c in (x.strip() for x in columns.split(",")):
        out.append(f"cast({c[:-1]} as double) as {c[:-1]}" if c.endswith("*") else c)
    return ", ".join(out)


F_TRADE = _doubles(
    "symbol_key, datetime_key, window_key, window_start, window_end, open*, high*, low*, close*, "
    "volume*, vwap*, trade_count, price_change*, price_change_pct*"
)
F_FLOW = _doubles(
    "symbol_key, datetime_key, window_key, window_start, buy_volume*, sell_volume*, "
    "total_volume*, buy_count, sell_count, buy_pct*, net_flow*"
)
F_KLINE = _doubles(
    "symbol_key, datetime_key, interval_key, open_time, close_time, open*, high*, low*, close*, "
    "volume*, trade_count, price_change*, price_change_pct*, amplitude*, is_bullish"
)
F_TECH = _doubles(
    "symbol_key, datetime_key, interval_key, open_time, rsi_14*, macd*, macd_signal*, macd_hist*, "
    "bb_upper*, bb_middle*, bb_lower*, bb_width*, atr_14*, obv*"
)
F_SPREAD = _doubles(
    "symbol_key, datetime_key, snapshot_time, bid_price*, ask_price*, mid_price*, spread*, "
    "spread_pct*, bid_qty*, ask_qty*, liquidity_imbalance*"
)
F_ALERT = _doubles(
    "symbol_key, datetime_key, alert_type_key, triggered_at, trigger_value*, threshold_pct*, "
    "severity, is_resolved, resolved_at"
)
BARS = _doubles(
    "window_start, window_end, symbol, open, high, low, close, volume*, "
    "vwap, trade_count"
)
FLOWS = _doubles(
    "window_start, window_end, symbol, buy_volume*, sell_volume*, buy_count, sell_count"
)
TRADE_COLUMNS = "symbol, trade_id, price, quantity, buyer_maker, trade_time, ingested_at"
QUOTE_COLUMNS = "symbol, bid_price, bid_qty, ask_price, ask_qty, ingested_at"
KLINE_COLUMNS = (
    "symbol, interval, open_time, close_time, open, high, low, close, volume, trade_count, is_closed"
)


def _alert_view(source: str, session: str) -> str:
    return f"""
select alert_key, symbol, alert_code, alert_description, severity,
  triggered_at // 1000 * 1000 as triggered_at, trigger_value, threshold_pct, is_resolved,
  resolved_at // 1000 * 1000 as resolved_at, {session} as trading_session from {source}"""


def _select() -> dict[str, str]:
    sessions = """case when isodow(t) >= 6 then 'Off' when hour(t) < 8 then 'Asia'
  when hour(t) < 16 then 'Europe' else 'US' end"""
    alert_hour = "hour(make_timestamp(triggered_at * 1000))"
    alert_sessions = f"""case when {alert_hour} between 1 and 8 then 'Asia'
  when {alert_hour} between 9 and 16 then 'Europe' else 'US' end"""
    known = ", ".join("'" + row[1] + "'" for row in SEEDS["symbol"][1])
    not_null = {
        "trade_agg": ("f_trade", F_TRADE, "window_start", "symbol_key, window_start, window_key",
                      {"symbol_key": "symbol", "window_key": "window_type"}),
        "order_flow": ("f_flow", F_FLOW, "window_start", "symbol_key, window_start, window_key",
                       {"symbol_key": "symbol", "window_key": "window_type"}),
        "spread_snapshot": ("f_spread", F_SPREAD, "snapshot_time", "symbol_key, snapshot_time",
                            {"symbol_key": "symbol"}),
        "kline_closed": ("f_kline", F_KLINE, "open_time", "symbol_key, interval_key, open_time",
                         {"symbol_key": "symbol", "interval_key": "kline_interval"}),
        "technical_indicator": ("f_tech", "symbol_key, datetime_key, interval_key, open_time", "open_time",
                                "symbol_key, interval_key, open_time", {"symbol_key": "symbol"}),
        "price_alert": ("f_alert", F_ALERT.replace(", resolved_at", ""), "triggered_at",
                        "symbol_key, alert_type_key, triggered_at",
                        {"symbol_key": "symbol", "alert_type_key": "alert_type"}),
    }
    checks = []
    for fact, (part, columns, ts, keys, refs) in not_null.items():
        def add(name, sql):
            checks.append(f"select '{fact}.{name}' as \"check\", ({sql}) as failures")

        for column in (re.sub(r".* as ", "", c.strip()) for c in columns.split(", ")):
            add(f"{column}.not_null", f"select count(*) from {part} where {column} is null")
        add(f"{ts}.not_future",
            f"select count(*) from {part} where {ts} > {TICK_AS_OF} - 60000 + 10000")
        for key, dim in refs.items():
            add(f"{key}.references", f"select count(*) from {part} anti join dim_{dim} using ({key})")
        add("datetime_key.references",
            f"select count(*) from {part} anti join dim_datetime using (datetime_key)")
        if fact == "technical_indicator":
            add("rsi_14.in_range", f"select count(*) from {part} where rsi_14 < 0 or rsi_14 > 100")
        if fact == "price_alert":
            add("severity.accepted", f"select count(*) from {part} where severity not in ('LOW', 'MEDIUM', 'HIGH')")
        if fact == "spread_snapshot":
            add("spread.positive", f"select count(*) from {part} where spread <= 0")
        add("key.unique", f"select count(*) from (select {keys} from {part} group by {keys}"
                          " having count(*) > 1)")

    stg = "select * from {}".format
    out = {
        "normalize_trades": f"""
select 'trade' as event_type, symbol, trade_id, price, quantity, buyer_maker, trade_time,
  0::bigint as ingested_at from trades
where symbol is not null and price is not null and buyer_maker is not null""",
        "normalize_klines": f"""
select 'kline' as event_type, {KLINE_COLUMNS}, 0::bigint as ingested_at from klines""",
        "normalize_booktickers": """
select 'bookticker' as event_type, symbol, bid_price, bid_qty, ask_price, ask_qty,
  0::bigint as ingested_at from quotes where symbol is not null""",
        "route_envelopes_counts": "select route as event_type, symbol, messages from envelope_counts",
        "ingest_counts": """
select route, cast(sum(messages) as bigint) as messages from envelope_counts group by route
union all select 'ignored', (select count(*) from events)
union all select 'malformed', (select count(*) from broken_trades)
  + (select count(*) from quotes where symbol is null) + 6 * (select count(*) from events)""",
        "malformed": """
select 'trade' as kind, (select count(*) from broken_trades) + 4 * (select count(*) from events) as messages
union all select 'bookTicker', (select count(*) from quotes where symbol is null)
  + (select count(*) from events)
union all select 'none', (select count(*) from events)""",
        "topic_payload": f"select 'trade' as event_type, {TRADE_COLUMNS} from trades",
        "valid_trades": f"select {TRADE_COLUMNS} from good_trades",
        "closed_klines": f"""
select {KLINE_COLUMNS}, open_time + {KLINE_MS} as ingested_at from good_klines""",
        "valid_quotes": f"""
select {QUOTE_COLUMNS} from quotes where symbol is not null and bid_price > 0 and ask_price > 0""",
        "archive_partitions": """
select symbol, strftime(t, '%Y') as year, strftime(t, '%m') as month, strftime(t, '%d') as day,
  strftime(t, '%H') as hour, count(*) as messages, min(ingested_at) as first_ms,
  max(ingested_at) as last_ms
from (select *, make_timestamp(ingested_at * 1000) as t from quotes_c)
where symbol is not null group by all""",
        "dim_datetime": f"""
select d.datetime_key, epoch_ms(full_timestamp) as full_timestamp,
  cast(date as varchar) as date, year, quarter, month, week_of_year, day_of_month, day_of_week,
  is_weekend, hour, minute, trading_session, coalesce(n, 0) as events
from dim_datetime d left join (select {_dtkey('ts_ms')} as datetime_key, count(*) as n
  from ev group by 1) using (datetime_key)""",
        "seed_dims": """
select symbol, base_asset, quote_asset, display_name, category, window_label as window_type,
  cast(sum(trade_count) as bigint) as trades
from f_trade join dim_symbol using (symbol_key) join dim_window_type using (window_key)
group by all""",
        "trading_session": f"""
select {sessions} as session, case when hour(t) between 1 and 8 then 'Asia'
  when hour(t) between 9 and 16 then 'Europe' else 'US' end as alert_session,
  cast(strftime(t, '%W') as int) as week, count(*) as events
from (select make_timestamp(ts_ms * 1000) as t from ev) group by all""",
        "datetime_key": f"select event_id, ts_ms, {_dtkey('ts_ms')} as datetime_key from ev",
        "ohlcv_1s": f"select {BARS} from w1",
        "ohlcv_5s": f"select {BARS} from w5",
        "ohlcv_rollup_5s": f"select {BARS} from w5",
        "ohlcv_small_amounts": """
select window_start, symbol, sum(q) / 1e9 as volume, sum(cast(p * q as hugeint)) / 1e17 as notional,
  round(sum(cast(p * q as hugeint)) / sum(q) / 1e8, 12) as vwap, count(*) as trade_count
from (select trade_time // 5000 * 5000 as window_start, symbol, 1000 + trade_id % 997 as p,
    1 + trade_id % 13 as q from trades where symbol is not null)
group by window_start, symbol""",
        "order_flow_1s": f"select {FLOWS} from w1",
        "order_flow_5s": f"select {FLOWS} from w5",
        "spread_snapshot": """
select window_start, symbol, round(avg_bid_price, 8) as avg_bid_price,
  round(avg_ask_price, 8) as avg_ask_price, round(avg_bid_qty, 8) as avg_bid_qty,
  round(avg_ask_qty, 8) as avg_ask_qty from snaps""",
        "fact_trade_agg": f"select {F_TRADE} from f_trade",
        "fact_order_flow": f"select {F_FLOW} from f_flow",
        "fact_kline_closed": f"select {F_KLINE} from f_kline",
        "fact_spread_snapshot": f"select {F_SPREAD} from f_spread",
        "stg_trade_agg": stg("s_trade"),
        "stg_order_flow": stg("s_flow"),
        "stg_kline_closed": stg("s_kline"),
        "stg_spread_snapshot": stg("s_spread"),
        "stg_technical_indicator": stg("s_tech"),
        "stg_price_alert": stg("s_alert"),
        "rsi": "select series as symbol, open_time, rsi_14 from rawind",
        "macd": "select series as symbol, open_time, macd, macd_signal, macd_hist from rawind",
        "bollinger": """
select series as symbol, open_time, bb_upper, bb_middle, bb_lower, bb_width from rawind""",
        "atr": "select series as symbol, open_time, atr_14 from rawind",
        "obv": "select series as symbol, open_time, obv from rawind",
        "technical_indicators": f"select {F_TECH} from f_tech",
        "price_spikes": stg("now_spike"),
        "volume_surges": stg("now_surge"),
        "spread_widening": stg("now_wide"),
        "low_liquidity": stg("now_thin"),
        "detect_alerts": f"select {F_ALERT} from f_alert_now",
        "detect_alerts_by_minutes": f"select {F_ALERT} from f_alert_now",
        "price_spikes_replay": stg("replay_spike"),
        "volume_surges_replay": _fires(
            "volume_surge", "r_surge", RATIO, f">= {LIMITS.surge_ratio}",
            _graded(LIMITS.surge_high_ratio),
        ),
        "spread_widening_replay": stg("replay_wide"),
        "low_liquidity_replay": stg("replay_thin"),
        "mart_latest_prices": """
select symbol, display_name, category, close as last_price, vwap, volume, price_change,
  price_change_pct, trade_count, window_start // 1000 * 1000 as updated_at, trading_session
from s_trade where window_type = '1s'
qualify row_number() over (partition by symbol order by window_start desc) = 1""",
        "mart_daily_performance": "select * from days",
        "mart_technical_signals": """
select symbol, open_time, open_time // 1000 * 1000 as candle_time, open, high, low, close, volume,
  is_bullish, amplitude, rsi_14, rsi_signal, macd, macd_signal, macd_hist, macd_signal_dir,
  bb_upper, bb_middle, bb_lower, bb_width, atr_14, obv,
  case when rsi_signal = 'oversold' and macd_signal_dir = 'bullish' then 'strong_buy'
    when rsi_signal = 'overbought' and macd_signal_dir = 'bearish' then 'strong_sell'
    when macd_signal_dir = 'bullish' then 'buy' when macd_signal_dir = 'bearish' then 'sell'
    else 'neutral' end as composite_signal
from signals qualify row_number() over (partition by symbol order by open_time desc) = 1""",
        "mart_orderflow_summary": f"""
select symbol, total_buy, total_sell, total_buy + total_sell as total_volume, net_flow,
  buy_pct, sell_pct,
  case when share > 55 then 'buy_dominated' when share < 45 then 'sell_dominated'
    else 'balanced' end as pressure_state, latest // 1000 * 1000 as as_of
from (select symbol, cast(sum(cast(buy_volume as decimal(28,8))) as double) as total_buy,
    cast(sum(cast(sell_volume as decimal(28,8))) as double) as total_sell,
    cast(sum(cast(net_flow as decimal(28,8))) as double) as net_flow,
    cast(sum(cast(buy_pct as decimal(28,3))) as double) / count(*) as share,
    {_mean('buy_pct', 3, 2)} as buy_pct, {_mean('100 - buy_pct', 3, 2)} as sell_pct,
    max(window_start) as latest
  from s_flow where window_type = '1s' and window_start >= {TICK_AS_OF} - 300000
  group by symbol)""",
        "mart_spread_by_session": f"""
select symbol, trading_session,
  {_mean('spread_pct', 6, 4)} as avg_spread_pct, {_mean('spread', 8, 8)} as avg_spread_abs,
  {_mean('liquidity_imbalance', 6, 4)} as avg_imbalance,
  {_mean('bid_qty + ask_qty', 8, 4)} as avg_total_qty, count(*) as snapshot_count
from s_spread_c where snapshot_time > {CALENDAR_AS_OF} - 86400000
group by symbol, trading_session""",
        "refreshed_daily_performance": "select * from days",
        "spread_by_session_merged": f"""
select symbol, trading_session,
  {_mean('spread_pct', 6, 4)} as avg_spread_pct, {_mean('spread', 8, 8)} as avg_spread_abs,
  {_mean('liquidity_imbalance', 6, 4)} as avg_imbalance,
  {_mean('bid_qty + ask_qty', 8, 4)} as avg_total_qty, count(*) as snapshot_count
from s_spread_c where snapshot_time > {CALENDAR_AS_OF} - 1234567 - 86400000
group by symbol, trading_session""",
        "mart_alert_summary": f"""
select v.*, {TICK_AS_OF} - a.triggered_at as age_ms
from ({_alert_view('s_alert', 'trading_session')}) v join s_alert a using (alert_key)
where a.triggered_at > {TICK_AS_OF} - 86400000""",
        "daily_summary": f"""
select symbol, min(low) as day_low, max(high) as day_high,
  cast(sum(cast(volume as decimal(28,8))) as double) as day_volume,
  round((max(close) - min(open)) / min(open) * 100, 4) as day_change_pct,
  round((arg_max(close, open_time) - arg_min(open, open_time)) / arg_min(open, open_time) * 100, 4)
    as open_close_pct
from s_kline where date = '{DAY}' group by symbol""",
        "top_movers": """
select * from (select date, symbol, change_pct,
    rank() over (partition by date order by change_pct desc) as rank
  from (select date, symbol, round((day_close - day_open) / day_open * 100, 6) as change_pct
    from days)) where rank <= 3""",
        "latest_prices": """
select l.symbol, l.display_name, l.category, l.close as last_price, l.vwap, l.volume,
  l.trade_count, l.window_start // 1000 * 1000 as updated_at,
  coalesce(cast(cast(l.close as decimal(18,8)) - cast(p.close as decimal(18,8)) as double), 0)
    as price_change,
  case when p.close is not null and p.close <> 0
    then round((l.close - p.close) / p.close * 100, 4) else 0 end as price_change_pct
from (select * from s_trade where window_type = '1s'
  qualify row_number() over (partition by symbol order by window_start desc) = 1) l
left join (select s.* from s_trade s
    join (select symbol, max(window_start) as newest from s_trade group by symbol) using (symbol)
  where window_type = '1s' and window_start < newest - 60000
  qualify row_number() over (partition by symbol order by window_start desc) = 1) p
  on l.symbol = p.symbol""",
        "price_history": f"""
select window_start, open, high, low, close, volume, vwap, trade_count, price_change_pct
from s_trade where symbol = '{SYMBOL}' and window_type = '5s'
order by window_start desc limit 60""",
        "orderflow_summary": f"""
select symbol, total_buy, total_sell, total_volume, net_flow,
  case when total_volume > 0 then round(total_buy / total_volume * 100, 2) else 50 end as buy_pct,
  case when total_volume > 0 then round(total_sell / total_volume * 100, 2) else 50 end
    as sell_pct,
  case when net_flow > 0 then 'BUY_PRESSURE' when net_flow < 0 then 'SELL_PRESSURE'
    else 'NEUTRAL' end as pressure_state, latest // 1000 * 1000 as as_of
from (select symbol, cast(sum(f.buy_volume) as double) as total_buy,
    cast(sum(f.sell_volume) as double) as total_sell,
    cast(sum(f.total_volume) as double) as total_volume,
    cast(sum(f.net_flow) as double) as net_flow, max(window_start) as latest
  from f_flow f join dim_symbol using (symbol_key)
  where window_key = 1 and window_start >= {TICK_AS_OF} - 30000 group by symbol)""",
        "orderflow_history": f"""
select window_start, buy_volume, sell_volume, total_volume, buy_count, sell_count, buy_pct,
  net_flow from s_flow where symbol = '{SYMBOL}' and window_type = '1s'
order by window_start desc limit 60""",
        "technical": f"""
select symbol, t.open_time // 1000 * 1000 as open_time, close_time // 1000 * 1000 as candle_time,
  k.open, k.high, k.low, k.close, k.volume, is_bullish, rsi_14,
  case when rsi_14 >= 70 then 'OVERBOUGHT' when rsi_14 <= 30 then 'OVERSOLD'
    else 'NEUTRAL' end as rsi_signal, macd, macd_signal, macd_hist,
  case when macd > macd_signal then 'BULLISH' else 'BEARISH' end as macd_signal_dir,
  bb_upper, bb_middle, bb_lower, bb_width, atr_14, obv
from s_tech t join s_kline k using (symbol, interval_key, open_time)
where symbol = '{SYMBOL}' order by t.open_time desc limit 20""",
        "alerts": _alert_view(f"""(
  select * from s_alert where severity = 'MEDIUM' and not is_resolved
    and triggered_at > {TICK_AS_OF} - 86400000
  order by triggered_at desc, alert_key limit 50)""", alert_sessions),
        "spread_history": f"""
select snapshot_time, bid_price, ask_price, mid_price, spread, spread_pct, bid_qty, ask_qty,
  liquidity_imbalance from s_spread where symbol = '{SYMBOL}'
order by snapshot_time desc limit 60""",
        "not_null": f"""
select {TRADE_COLUMNS} from trades
where symbol is null or price is null or buyer_maker is null""",
        "unique": """
select symbol, bid_price, count(*) as copies from quotes group by all having count(*) > 1""",
        "accepted_values": f"select {TRADE_COLUMNS} from trades where symbol not in ({known})",
        "no_future_timestamps": f"""
select symbol, window_type, window_start from s_trade
where window_start > {TICK_AS_OF} - 60000 + 10000""",
        "rsi_in_range": f"""
select {F_TECH} from (select * from f_tech union all select * replace (rsi_14 + 40 as rsi_14) from f_tech)
where rsi_14 < 0 or rsi_14 > 100""",
        "spread_positive": """
select * from (select symbol, ingested_at, round(ask_price - bid_price, 8) as spread from quotes)
where spread <= 0""",
        "null_rate": f"""
select *, case when total <> 0 then null_count / total else 0 end as rate from (
  select count(*) filter (where price is null or symbol is null) as null_count,
    count(*) as total from trades where trade_time > {TICK_AS_OF} - 3600000)""",
        "window_gaps": f"""
select symbol_key, count(*) as gaps from (
  select symbol_key, window_start,
    lag(window_start) over (partition by symbol_key order by window_start) as previous
  from f_trade where window_key = 1 and window_start > {TICK_AS_OF} - 3600000)
where window_start - previous > 2000 group by symbol_key""",
        "late_rate": """
select *, late_count / total as rate from (
  select count(*) filter (where ingested_at - trade_time > 2000) as late_count,
    count(*) as total from trades)""",
        "duplicate_rate": f"""
select *, (total - unique_count) / total as rate from (
  select count(*) as total, count(distinct (symbol, bid_price)) as unique_count from quotes
  where ingested_at > {TICK_AS_OF} - 3600000)""",
        "freshness": f"""
select count(*) as recent_rows, count(*) > 0 as is_fresh from f_trade
where window_start > {TICK_AS_OF} - 300000""",
        "insert_rate": """
select minute * 60000 as minute_start, rows, coalesce(minute - previous - 1, 0) as empty_minutes,
  coalesce(minute - previous - 1, 0) >= 3 as stalled
from (select *, lag(minute) over (order by minute) as previous
  from (select ingested_at // 60000 as minute, count(*) as rows from quotes_c group by 1))""",
        "orphans": f"select {TRADE_COLUMNS} from trades t where not exists"
                   " (select 1 from dim_symbol d where d.symbol = t.symbol)",
        "run_checks": " union all ".join(checks),
        "run_checks_by_day": " union all ".join(checks),
        "insert_if_absent": f"""
select {QUOTE_COLUMNS} from quotes q
where symbol is not null and not exists (select 1 from quotes o where o.symbol = q.symbol
    and o.bid_price = q.bid_price
    and o.ingested_at < {TICK_START} + ({TICK_AS_OF} - {TICK_START}) // 2)
qualify row_number() over (partition by symbol, bid_price order by ingested_at) = 1""",
        "retention": f"""
select symbol, count(*) as messages from quotes_c
  where ingested_at >= {CALENDAR_AS_OF} - 7 * 86400000 group by symbol
union all select '(deleted)', count(*) from quotes_c
  where ingested_at < {CALENDAR_AS_OF} - 7 * 86400000""",
        "stream_ohlcv_5s": f"""
select {F_TRADE} from f_trade, trade_close where window_key = 2 and window_end <= mark""",
        "stream_bad_trades": f"""
select {F_TRADE} from f_trade, trade_close where window_key = 2 and window_end <= mark""",
        "stream_rejects": """
select reason, count(*) as messages, min(trade_id) as first_id, max(trade_id) as last_id
from rejected_trades group by reason""",
        "rejected_rows": """
select 'trades' as source, reason, count(*) as messages from rejected_trades group by reason
union all select 'quotes', 'no symbol', count(*) from quotes where symbol is null having count(*) > 0
union all select 'klines', 'not closed', count(*) from klines where not is_closed having count(*) > 0""",
        "stream_late_rows": f"""
select {F_TRADE} from f_trade, trade_close where window_key = 2 and window_end <= mark""",
        "late_rows_logged": """
select 'late' as name, count(*) + count(*) filter (where trade_time < low + (high - low) // 2) as input_rows,
  true as some_late
from trades, (select min(trade_time) as low, max(trade_time) as high from trades)""",
        "stream_interval_trigger": f"""
select {F_SPREAD} from f_spread, quote_close where snapshot_time + 1000 <= mark""",
        "expire_stored": f"""
select symbol_key, count(*) as snapshots, min(snapshot_time) as first_ms from f_spread_c
where snapshot_time >= {CALENDAR_AS_OF} + (10 - 30) * 86400000 + 43200000 group by symbol_key""",
        "named_symbols": """
select symbol, count(*) as trades from trades where symbol in ('BTCUSDT', 'ETHUSDT') group by symbol""",
        "stream_order_flow_1s": f"""
select {F_FLOW} from f_flow, trade_close where window_key = 1 and window_start + 1000 <= mark""",
        "stream_spread_snapshot": f"""
select {F_SPREAD} from f_spread, quote_close where snapshot_time + 1000 <= mark""",
        "stream_klines_indicators": f"select {F_TECH} from f_tech",
        "stream_kept_indicators": f"""
select {F_TECH} from (select * from f_tech_early
  union all select * from f_tech where open_time // {KLINE_MS} % 23 = 5)""",
        "stream_alerts": f"""
select {F_ALERT} from f_alert, trade_close, quote_close
where case when alert_type_key in (1, 2) then triggered_at + 5000 <= trade_close.mark
  else triggered_at + 1000 <= quote_close.mark end""",
        "stream_archive": f"""
select 'trade' as event_type, {TRADE_COLUMNS}, strftime(t, '%Y') as year,
  strftime(t, '%m') as month, strftime(t, '%d') as day, strftime(t, '%H') as hour
from (select *, make_timestamp(trade_time * 1000) as t from trades) where symbol is not null""",
        "stream_archive_klines": f"""
select 'kline' as event_type, {KLINE_COLUMNS}, open_time + {KLINE_MS} as ingested_at,
  strftime(t, '%Y') as year, strftime(t, '%m') as month, strftime(t, '%d') as day
from (select *, make_timestamp(open_time * 1000) as t from klines)""",
        "stream_archive_bookticker": f"""
select 'bookticker' as event_type, {QUOTE_COLUMNS}, strftime(t, '%Y') as year,
  strftime(t, '%m') as month, strftime(t, '%d') as day, strftime(t, '%H') as hour
from (select *, make_timestamp(ingested_at * 1000) as t from quotes) where symbol is not null""",
        "stream_trades_1s_and_5s": f"""
select {F_TRADE} from f_trade, trade_close where window_end <= mark""",
        "alerts_stored_twice": f"select {F_ALERT} from f_alert_now",
    }
    return out


def _compose(select: str, parts: dict[str, str]) -> str:
    """``select`` preceded by the parts it needs, in definition order."""
    needed: set[str] = set()
    queue = [select]
    while queue:
        words = set(re.findall(r"[a-z_][a-z_0-9]*", queue.pop()))
        for name in words & parts.keys() - needed:
            needed.add(name)
            queue.append(parts[name])
    ctes = ",\n".join(f"{n} as ({parts[n].strip()})" for n in parts if n in needed)
    return f"with {ctes}\n{select.strip()}" if ctes else select.strip()


def all_sql() -> dict[str, str]:
    parts = _parts()
    return {name: _compose(sql, parts) for name, sql in _select().items()}
