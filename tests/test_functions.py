from datetime import datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tickloom.functions import clock, labels
from tickloom.functions.numbers import exact_avg, exact_sum, pct_change, round_numeric, safe_div

TIMES = [
    "2024-01-01T00:00:00", "2023-01-01T23:59:59", "2020-12-31T12:34:56", "2024-02-29T07:59:59",
    "2024-03-02T08:00:00", "2024-03-03T16:00:00", "2024-03-04T15:59:59", "2024-03-05T23:00:00",
    "1969-12-31T23:59:59", "2026-12-27T00:00:00",
]


def _ms(text):
    return int(datetime.fromisoformat(text).replace(tzinfo=timezone.utc).timestamp() * 1000)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_calendar_parts_match_python_in_any_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(_ms(t) + 7,) for t in TIMES], "ms long").select(
            "ms", clock.datetime_key("ms").alias("key"), clock.week_of_year("ms").alias("week"),
            clock.day_of_week("ms").alias("dow"), clock.trading_session("ms").alias("session"),
            clock.hour("ms").alias("hour"), clock.minute("ms").alias("minute"),
        )
        rows = df.collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    for row in rows:
        t = datetime.fromtimestamp(row.ms / 1000, tz=timezone.utc)
        assert row.key == int(t.strftime("%Y%m%d%H%M"))
        assert (row.week, row.dow) == (int(t.strftime("%W")), t.weekday())
        assert (row.hour, row.minute) == (t.hour, t.minute)
        by_hour = "Asia" if t.hour < 8 else "Europe" if t.hour < 16 else "US"
        assert row.session == ("Off" if t.weekday() >= 5 else by_hour)


def test_week_number_counts_from_first_monday(spark):
    cases = {"2024-01-01": 1, "2023-01-01": 0, "2020-12-31": 52}
    df = spark.createDataFrame([(_ms(d + "T00:00:00"),) for d in cases], "ms long")
    assert [r[0] for r in df.select(clock.week_of_year("ms")).collect()] == list(cases.values())


def test_alert_session_has_its_own_bounds(spark):
    hours = {0: "US", 1: "Asia", 8: "Asia", 9: "Europe", 16: "Europe", 17: "US"}
    df = spark.createDataFrame([(h * clock.HOUR,) for h in hours], "ms long")
    assert [r[0] for r in df.select(clock.alert_session("ms")).collect()] == list(hours.values())


def test_exact_sum_is_order_independent_and_keeps_eight_decimals(spark):
    values = [0.1, 0.2, 1e6 + 0.12345678, -3.5, 0.00000001, -0.99999999]
    df = spark.createDataFrame([(v,) for v in values + [None]], "x double")
    want = sum(Decimal(str(v)).quantize(Decimal("1e-8")) for v in values)
    for parts in (1, 3, 7):
        got = df.repartition(parts).agg(exact_sum("x")).first()[0]
        assert got == want
    mean = df.agg(exact_avg("x")).first()[0]
    assert mean == pytest.approx(float(want) / len(values))


def test_ratios_and_rounding(spark):
    row = spark.range(1).select(
        safe_div(F.lit(1.0), F.lit(0.0), 0.0).alias("a"),
        pct_change(F.lit(3.0), F.lit(0.0)).alias("b"),
        pct_change(F.lit(3.0), F.lit(2.0)).alias("c"),
        round_numeric(F.lit(0.36465) / 3, 4).alias("d"),
    ).first()
    assert tuple(row) == (0.0, 0.0, 50.0, 0.1216)


def test_signal_bounds_differ_between_views_and_reads(spark):
    df = spark.createDataFrame([(70.0, 1.0, 1.0), (30.0, 2.0, 1.0), (None, None, 1.0)],
                               "r double, m double, s double")
    rows = df.select(
        labels.rsi_state(F.col("r")), labels.rsi_flag(F.col("r")),
        labels.macd_state(F.col("m"), F.col("s")), labels.macd_flag(F.col("m"), F.col("s")),
    ).collect()
    assert [tuple(r) for r in rows] == [
        ("neutral", "OVERBOUGHT", "neutral", "BEARISH"),
        ("neutral", "OVERSOLD", "bullish", "BULLISH"),
        ("neutral", "NEUTRAL", "neutral", "BEARISH"),
    ]
