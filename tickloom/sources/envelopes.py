"""Exchange envelopes ``{stream, data}``: routing and normalising.

The payload's keys differ by case alone (``t`` and ``T``), which a case-insensitive struct
cannot hold, so it is parsed as a string map and looked up by key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.clock import now_ms
from tickloom.schemas import BOOKTICKER, KLINE, TRADE

# The fields of each record, their payload keys and types.
TRADE_FIELDS = {
    "trade_id": ("t", "long"), "price": ("p", "double"), "quantity": ("q", "double"),
    "buyer_maker": ("m", "boolean"), "trade_time": ("T", "long"),
}
KLINE_FIELDS = {
    "interval": ("i", "string"), "open_time": ("t", "long"), "close_time": ("T", "long"),
    "open": ("o", "double"), "high": ("h", "double"), "low": ("l", "double"),
    "close": ("c", "double"), "volume": ("v", "double"), "trade_count": ("n", "int"),
    "is_closed": ("x", "boolean"),
}
QUOTE_FIELDS = {
    "bid_price": ("b", "double"), "bid_qty": ("B", "double"),
    "ask_price": ("a", "double"), "ask_qty": ("A", "double"),
}

_ENVELOPE = "stream string, data map<string,string>, _broken string"


def _value(source: str, key: str, kind: str) -> Column:
    value = F.try_element_at(source, F.lit(key))
    return value if kind == "string" else value.try_cast(kind)


def _readable(source: str, fields: dict[str, tuple[str, str]]) -> Column:
    """Whether every field is there and can be read as its type, numbers as finite ones."""
    def readable(key: str, kind: str) -> Column:
        value = _value(source, key, kind)
        return F.abs(value) < float("inf") if kind == "double" else value.isNotNull()

    return reduce(Column.__and__, [F.coalesce(readable(*f), F.lit(False)) for f in fields.values()])


def _parsed_once(df: DataFrame, name: str, parsed: Column) -> DataFrame:
    """Adds a parsed column as a generated row.

    As a plain projection it would be copied into every later filter and parsed again there.
    """
    return df.select("*", F.explode(F.array(parsed)).alias(name))


def parse_envelopes(df: DataFrame) -> DataFrame:
    """Adds ``data``, ``candle`` and ``route``: trade, kline, bookticker, ignored, malformed."""
    envelope = F.from_json(
        F.col("value").cast("string"), _ENVELOPE, {"columnNameOfCorruptRecord": "_broken"}
    )
    parsed = _parsed_once(df, "_e", envelope).withColumn("data", F.col("_e.data"))
    candle = F.from_json(F.try_element_at("data", F.lit("k")), "map<string,string>")
    parsed = _parsed_once(parsed, "candle", candle)
    kind = F.coalesce(F.try_element_at("data", F.lit("e")), F.lit(""))
    stream = F.coalesce(F.col("_e.stream"), F.lit(""))
    named = _value("data", "s", "string").isNotNull()

    def routed(name: str, complete: Column) -> Column:
        return F.when(named & complete, name).otherwise("malformed")

    route = (
        F.when(F.col("_e").isNull() | F.col("_e._broken").isNotNull(), "malformed")
        .when(kind == "trade", routed("trade", _readable("data", TRADE_FIELDS)))
        .when(kind == "kline", routed("kline", _readable("candle", KLINE_FIELDS)))
        .when(
            (kind == "bookTicker") | stream.contains("bookTicker"),
            routed("bookticker", _readable("data", QUOTE_FIELDS)),
        )
        .otherwise("ignored")
    )
    # Read by filters and by each record, so it is a generated row too: as a column it would be judged for each of them.
    return _parsed_once(parsed.drop("route"), "route", route).drop("_e")


def _fields(source: str, spec: dict[str, tuple[str, str]]) -> list[Column]:
    return [_value(source, *field).alias(name) for name, field in spec.items()]


def _symbol() -> Column:
    return F.upper(F.try_element_at("data", F.lit("s"))).alias("symbol")


def _stamp(ingested_at: Column | None) -> Column:
    return (now_ms() if ingested_at is None else ingested_at).alias("ingested_at")


def normalize_trades(df: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Typed trades out of parsed envelopes."""
    return df.filter(F.col("route") == "trade").select(
        F.lit("trade").alias("event_type"), _symbol(),
        *_fields("data", TRADE_FIELDS),
        _stamp(ingested_at),
    ).select(*TRADE.fieldNames())


def normalize_klines(df: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Typed candles out of parsed envelopes."""
    return df.filter(F.col("route") == "kline").select(
        F.lit("kline").alias("event_type"), _symbol(),
        *_fields("candle", KLINE_FIELDS),
        _stamp(ingested_at),
    ).select(*KLINE.fieldNames())


def normalize_booktickers(df: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Typed quotes out of parsed envelopes."""
    return df.filter(F.col("route") == "bookticker").select(
        F.lit("bookticker").alias("event_type"), _symbol(),
        *_fields("data", QUOTE_FIELDS),
        _stamp(ingested_at),
    ).select(*BOOKTICKER.fieldNames())


def route_envelopes(df: DataFrame, ingested_at: Column | None = None) -> dict[str, DataFrame]:
    """One mixed feed as three typed ones."""
    parsed = parse_envelopes(df)
    return {
        "trades": normalize_trades(parsed, ingested_at),
        "klines": normalize_klines(parsed, ingested_at),
        "bookticker": normalize_booktickers(parsed, ingested_at),
    }


def typed_envelopes(df: DataFrame) -> DataFrame:
    """Every message in one pass: its route and the record as one of three structs, else null.

    For a batch that is written to several outputs: persist this, then filter by route.
    """
    def record(route: str, source: str, spec: dict[str, tuple[str, str]]) -> Column:
        fields = F.struct(_symbol(), *_fields(source, spec))
        return F.when(F.col("route") == route, fields).alias(route)

    return parse_envelopes(df).select(
        "route", record("trade", "data", TRADE_FIELDS), record("kline", "candle", KLINE_FIELDS),
        record("bookticker", "data", QUOTE_FIELDS),
    )


def malformed(df: DataFrame) -> DataFrame:
    return parse_envelopes(df).filter(F.col("route") == "malformed").select("value")


def ingest_counts(df: DataFrame) -> DataFrame:
    """Messages by route; ``malformed`` counts the errors."""
    return parse_envelopes(df).groupBy("route").agg(F.count("*").alias("messages"))
