import json

import pytest
from pyspark.sql import functions as F

from tickloom import schemas
from tickloom.sources import envelopes
from tickloom.sources.topics import decode, encode, read_topic

TRADE = {"e": "trade", "s": "btcusdt", "t": 7, "p": "1.5", "q": "2", "m": True, "T": 99}
KLINE = {"e": "kline", "s": "ethusdt", "k": {
    "i": "1m", "t": 1, "T": 2, "o": "1", "h": "4", "l": "0.5", "c": "3", "v": "9", "n": 5, "x": False}}
QUOTE = {"s": "bnbusdt", "b": "1", "B": "2", "a": "3", "A": "4"}


def _without(d, key):
    return {k: v for k, v in d.items() if k != key}


@pytest.fixture(scope="module")
def feed(spark):
    lines = [
        {"stream": "x", "data": TRADE}, {"stream": "x", "data": KLINE},
        {"stream": "bnbusdt@bookTicker", "data": QUOTE},
        {"stream": "x", "data": {**QUOTE, "e": "bookTicker"}},
        {"stream": "x", "data": {**TRADE, "m": None}}, {"stream": "x", "data": {**TRADE, "p": "abc"}},
        {"stream": "x", "data": {**TRADE, "s": None}}, {"stream": "x", "data": {**TRADE, "T": "1.5x"}},
        {"stream": "x", "data": {"e": "depth"}}, {},  # ignored
        {"stream": "x", "data": _without(TRADE, "T")},
        {"stream": "x", "data": {**KLINE, "k": _without(KLINE["k"], "x")}},
        {"stream": "y@bookTicker", "data": _without(QUOTE, "s")},
    ]
    return spark.createDataFrame([(json.dumps(x),) for x in lines] + [("{",)], "value string")


def test_routes(feed):
    got = {r.route: r.messages for r in envelopes.ingest_counts(feed).collect()}
    assert got == {"trade": 1, "kline": 1, "bookticker": 2, "ignored": 2, "malformed": 8}
    assert envelopes.malformed(feed).count() == 8
    typed = envelopes.typed_envelopes(feed)
    assert typed.where("trade is not null and kline is null").first().trade.symbol == "BTCUSDT"
    assert typed.where("coalesce(trade.symbol, kline.symbol, bookticker.symbol) is not null").count() == 4


def test_normalized_rows_keep_keys_that_differ_by_case(feed):
    out = envelopes.route_envelopes(feed, F.lit(5).cast("long"))
    trade = out["trades"].filter("buyer_maker").first()
    assert tuple(trade) == ("trade", "BTCUSDT", 7, 1.5, 2.0, True, 99, 5)
    candle = out["klines"].first()
    assert tuple(candle) == ("kline", "ETHUSDT", "1m", 1, 2, 1.0, 4.0, 0.5, 3.0, 9.0, 5, False, 5)
    assert tuple(out["bookticker"].first()) == ("bookticker", "BNBUSDT", 1.0, 2.0, 3.0, 4.0, 5)
    for name, schema in (("trades", schemas.TRADE), ("klines", schemas.KLINE)):
        assert [f.dataType for f in out[name].schema] == [f.dataType for f in schema]


def test_default_stamp_is_the_clock(feed):
    out = envelopes.route_envelopes(feed)["trades"].first()
    assert out.ingested_at > 1_700_000_000_000


def test_messages_are_parsed_once(feed):
    plan = envelopes.normalize_trades(envelopes.parse_envelopes(feed))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("_broken,StringType") <= 2


def test_routes_are_judged_once(feed):
    """Filters on several records would each judge the route again, a test of every field."""
    typed = envelopes.typed_envelopes(feed)
    plan = typed.where("coalesce(trade.symbol, kline.symbol, bookticker.symbol) is not null").groupBy("route").count()
    assert plan._jdf.queryExecution().executedPlan().toString().count("THEN malformed WHEN") == 1


def test_decode_turns_malformed_messages_into_nulls(spark):
    df = spark.createDataFrame([('{"symbol":"A","price":1.5}',), ("{",), ("[]",)], "value string")
    rows = decode(df, schemas.TRADE).collect()
    assert [(r.symbol, r.price) for r in rows] == [("A", 1.5), (None, None), (None, None)]


def test_encode_keys_by_symbol(spark):
    df = spark.createDataFrame([("A", 1)], "symbol string, x int")
    assert tuple(encode(df).first()) == ("A", '{"symbol":"A","x":1}')


def test_read_topic_from_files_with_a_rate(spark, tmp_path):
    (tmp_path / "a.txt").write_text('{"symbol":"A"}\n')
    stream = read_topic(spark, str(tmp_path), fmt="text", max_per_trigger=1)
    assert stream.isStreaming and stream.columns == ["value"]
