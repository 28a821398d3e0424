"""Data quality: checks return violating rows or metrics; guards raise past a threshold."""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions import clock
from tickloom.functions.numbers import safe_div
from tickloom.operators.blocks import with_previous
from tickloom.operators.keys import orphans
from tickloom.schemas import FACTS
from tickloom.sources.dims import Calendar

# Thresholds.
NULL_RATE = 0.001
LATE_RATE = 0.01
DUPLICATE_RATE = 0.0001
FUTURE_MS = 10_000
GAP_MS = 5_000
LATE_MS = 5_000
SEVERITIES = ["LOW", "MEDIUM", "HIGH"]


# -- violating rows -------------------------------------------------------------------------


def check_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.filter(reduce(Column.__or__, [F.col(c).isNull() for c in columns]))


def check_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)


def check_accepted(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Rows with another value; nulls pass, as :func:`check_not_null` covers them."""
    return df.filter(~F.col(column).isin(values))


def no_future_timestamps(df: DataFrame, ts: str, as_of_ms: int | Column | None = None):
    return df.filter(F.col(ts) > clock.as_of_or_now(as_of_ms) + FUTURE_MS)


def rsi_in_range(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("rsi_14").between(0, 100))


def spread_positive(df: DataFrame) -> DataFrame:
    return df.filter(F.col("spread") <= 0)


# -- metrics --------------------------------------------------------------------------------


def _recent(df: DataFrame, ts: str, as_of_ms, span_ms: int) -> DataFrame:
    return df.filter(F.col(ts) > clock.as_of_or_now(as_of_ms) - span_ms)


def null_rate(
    df: DataFrame, columns: list[str], as_of_ms=None, ts: str = "window_start",
    span_ms: int = clock.HOUR,
) -> DataFrame:
    """Share of recent rows with a null in any of the columns."""
    missing = reduce(Column.__or__, [F.col(c).isNull() for c in columns])
    counts = _recent(df, ts, as_of_ms, span_ms).agg(
        F.count_if(missing).alias("null_count"), F.count("*").alias("total")
    )
    return counts.withColumn("rate", safe_div(F.col("null_count"), F.col("total"), 0.0))


def window_gaps(
    windows: DataFrame, gap_ms: int = GAP_MS, as_of_ms=None, span_ms: int = clock.HOUR,
    block_ms: int = 6 * clock.HOUR,
) -> DataFrame:
    """Holes longer than ``gap_ms`` between a symbol's consecutive windows of one length."""
    recent = _recent(windows, "window_start", as_of_ms, span_ms).select(
        "symbol_key", "window_start"
    )
    pairs = with_previous(
        recent, ["symbol_key"], "window_start", block_ms, {"previous": "window_start"}
    )
    return (
        pairs.filter(F.col("window_start") - F.col("previous") > gap_ms)
        .groupBy("symbol_key").agg(F.count("*").alias("gaps"))
    )


def late_rate(trades: DataFrame, late_ms: int = LATE_MS) -> DataFrame:
    """Share of trades ingested more than ``late_ms`` after they happened."""
    late = F.col("ingested_at") - F.col("trade_time") > late_ms
    counts = trades.agg(F.count_if(late).alias("late_count"), F.count("*").alias("total"))
    return counts.withColumn("rate", safe_div(F.col("late_count"), F.col("total"), 0.0))


def duplicate_rate(
    df: DataFrame, keys: list[str], as_of_ms=None, ts: str = "window_start",
    span_ms: int = clock.HOUR,
) -> DataFrame:
    """Share of recent rows that repeat a key."""
    per_key = _recent(df, ts, as_of_ms, span_ms).groupBy(*keys).agg(F.count("*").alias("n"))
    counts = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count("*").alias("unique_count")
    )
    extra = F.col("total") - F.col("unique_count")
    return counts.withColumn("rate", safe_div(extra, F.col("total"), 0.0))


def check_fresh(
    df: DataFrame, ts: str, as_of_ms=None, span_ms: int = 5 * clock.MINUTE
) -> DataFrame:
    """Number of rows in the last minutes and whether there is any."""
    recent = F.col(ts) > clock.as_of_or_now(as_of_ms) - span_ms
    return df.filter(recent).agg(F.count("*").alias("recent_rows")).withColumn(
        "is_fresh", F.col("recent_rows") > 0
    )


def insert_rate(df: DataFrame, ts: str, stall_minutes: int = 3) -> DataFrame:
    """Rows by minute, and how many empty minutes came before each.

    ``stalled`` marks a minute that follows ``stall_minutes`` or more empty ones.
    """
    per_minute = df.groupBy(clock.floor_div(ts, clock.MINUTE).alias("minute")).agg(
        F.count("*").alias("rows")
    )
    series = per_minute.withColumn("_all", F.lit(0))
    pairs = with_previous(
        series, ["_all"], "minute", 10_080, {"_before": "minute"}
    )
    empty = F.coalesce(F.col("minute") - F.col("_before") - 1, F.lit(0))
    return pairs.select(
        (F.col("minute") * clock.MINUTE).alias("minute_start"), "rows",
        empty.alias("empty_minutes"), (empty >= stall_minutes).alias("stalled"),
    )


# -- guards ---------------------------------------------------------------------------------


class QualityError(ValueError):
    """A quality threshold was passed."""


def require_rate(metric: DataFrame, most: float, what: str) -> None:
    rate = metric.first()["rate"]
    if rate > most:
        raise QualityError(f"{what} {rate:.4%} is over {most:.4%}")


def require_empty(violations: DataFrame, what: str) -> None:
    if not violations.isEmpty():
        raise QualityError(f"{what}: violating rows found")


def require_fresh(metric: DataFrame, what: str) -> None:
    if not metric.first()["is_fresh"]:
        raise QualityError(f"{what}: no recent rows")


# -- the suite ------------------------------------------------------------------------------


def row_checks(fact: str, as_of_ms=None) -> dict[str, Column]:
    """Checks that look at one row at a time, by name."""
    spec = FACTS[fact]
    future = F.col(spec.time) > clock.as_of_or_now(as_of_ms) + FUTURE_MS
    checks = {f"{fact}.{c}.not_null": F.col(c).isNull() for c in spec.required}
    checks[f"{fact}.{spec.time}.not_future"] = future
    if fact == "technical_indicator":
        checks[f"{fact}.rsi_14.in_range"] = ~F.col("rsi_14").between(0, 100)
    if fact == "spread_snapshot":
        checks[f"{fact}.spread.positive"] = F.col("spread") <= 0
    if fact == "price_alert":
        checks[f"{fact}.severity.accepted"] = ~F.col("severity").isin(SEVERITIES)
    return checks


def _long(df: DataFrame, names: list[str]) -> DataFrame:
    """One row of counts as rows ``(check, failures)``."""
    cells = F.array(*[
        F.struct(F.lit(n).alias("check"), F.col(f"`{n}`").alias("failures")) for n in names
    ])
    return df.select(F.inline(cells))


def _scanned(tables, fact: str, df: DataFrame, as_of_ms) -> tuple[DataFrame, dict[str, Column]]:
    """The rows with what the row checks need, and all checks that look at one row."""
    spec, checks = FACTS[fact], row_checks(fact, as_of_ms)
    for key, dim in spec.references:
        # Small dimension: its keys are joined once and tested in the same scan.
        known = tables.dim(dim).select(key, F.lit(True).alias(f"_{dim}"))
        df = df.join(known, key, "left")
        checks[f"{fact}.{key}.references"] = F.col(key).isNotNull() & F.col(f"_{dim}").isNull()
    if isinstance(tables.calendar, Calendar):
        inside = tables.calendar.holds(F.col("datetime_key"))
        checks[f"{fact}.datetime_key.references"] = ~inside
    return df, checks


def _fact_checks(tables, fact: str, as_of_ms) -> list[DataFrame]:
    """All checks of one fact: one scan for the row checks, one grouping for the key."""
    spec = FACTS[fact]
    df, checks = _scanned(tables, fact, tables.fact(fact), as_of_ms)
    one_row = df.agg(*[F.count_if(test).alias(name) for name, test in checks.items()])
    out = [_long(one_row, list(checks))]
    if not isinstance(tables.calendar, Calendar):
        missing = orphans(tables.fact(fact), tables.calendar, "datetime_key")
        out.append(missing.agg(F.count("*").alias("failures")).select(
            F.lit(f"{fact}.datetime_key.references").alias("check"), "failures"
        ))
    copies = check_unique(tables.fact(fact), list(spec.keys))
    out.append(copies.agg(F.count("*").alias("failures")).select(
        F.lit(f"{fact}.key.unique").alias("check"), "failures"
    ))
    return out


_LEDGER = "fact string, dt date, version string, check string, failures bigint, last bigint, as_of bigint"


def _known_keys(tables, fact: str) -> str:
    """A digest of what the reference checks compare with."""
    sums = [tables.dim(dim).agg(F.count("*"), F.bit_xor(F.xxhash64(key))).first() for key, dim in FACTS[fact].references]
    return f"{tables.calendar}{[tuple(s) for s in sums]}"


def _checked_days(tables, fact: str, as_of_ms: int, days: list) -> DataFrame:
    """``(dt, check, failures, last)`` of some days; natural keys hold the time, so copies share a day."""
    spec = FACTS[fact]
    rows = tables.fact(fact, days=days).withColumn("dt", clock.day(spec.time))
    df, checks = _scanned(tables, fact, rows, as_of_ms)
    by_day = df.groupBy("dt").agg(
        F.max(spec.time).alias("last"), *[F.count_if(test).alias(name) for name, test in checks.items()])
    cells = F.array(*[F.struct(F.lit(n).alias("check"), F.col(f"`{n}`").alias("failures")) for n in checks])
    copies = rows.groupBy("dt", *spec.keys).agg((F.count("*") > 1).cast("long").alias("n")).groupBy("dt").agg(F.sum("n").alias("failures"))
    unique = copies.select("dt", F.lit(f"{fact}.key.unique").alias("check"), "failures", F.lit(None).cast("long").alias("last"))
    return by_day.select("dt", F.inline(cells), "last").select("dt", "check", "failures", "last").unionByName(unique)


def run_checks_by_day(tables, as_of_ms: int, facts: list[str] | None = None) -> DataFrame:
    """As :func:`run_checks` of a stored catalog with a computed calendar, reading only what changed.

    A ledger beside the facts keeps each day's results with the version of its files and of the
    dimensions. A day is read again if either changed, or if it has rows later than ``as_of_ms`` allows.
    """
    spark, path, current, names = tables.spark, f"{tables.root}/checks", [], []
    if not isinstance(tables.calendar, Calendar):
        raise ValueError("results by day need a computed calendar")
    known = spark.read.schema(_LEDGER).parquet(path) if tables.keeps(path) else spark.createDataFrame([], _LEDGER)
    for fact in facts or list(FACTS):
        keys = hashlib.md5(_known_keys(tables, fact).encode()).hexdigest()[:8]
        versions = {d: f"{v}-{keys}" for d, v in tables.versions(fact).items()}
        checks = [*_scanned(tables, fact, tables.fact(fact, days=[]), as_of_ms)[1], f"{fact}.key.unique"]
        names += [(c,) for c in checks]
        # As many entries as day folders; results by day stay in the ledger.
        done = known.filter((F.col("fact") == fact) & F.col("check").endswith(".not_future") & (F.col("failures") == 0))
        fresh = {(r.dt, r.version) for r in done.filter(F.col("last") <= as_of_ms + FUTURE_MS).select("dt", "version").collect()}
        changed = [d for d, v in versions.items() if (d, v) not in fresh]
        if changed:
            stamped = F.create_map(*[F.lit(x) for d in changed for x in (d, versions[d])])
            found = _checked_days(tables, fact, as_of_ms, changed).select(
                F.lit(fact).alias("fact"), "dt", stamped[F.col("dt")].alias("version"), "check", "failures", "last",
                F.lit(as_of_ms).cast("long").alias("as_of"))
            found.repartition(1).write.mode("append").parquet(path)
        current += [(fact, d, v) for d, v in versions.items()]
    ledger = spark.read.schema(_LEDGER).parquet(path) if tables.keeps(path) else known
    live = spark.createDataFrame(current, "fact string, dt date, version string")
    # A day can be read twice in one version, as its future rows are judged anew: now, or else the last time.
    latest = F.struct(F.col("as_of") == as_of_ms, "as_of")
    own = ledger.join(live, ["fact", "dt", "version"]).groupBy("fact", "dt", "check").agg(F.max_by("failures", latest).alias("failures"))
    total = own.groupBy("check").agg(F.sum("failures").alias("failures"))
    return spark.createDataFrame(names, "check string").join(total, "check", "left").select("check", F.coalesce("failures", F.lit(0)).alias("failures"))


def run_checks(tables, as_of_ms=None, facts: list[str] | None = None) -> DataFrame:
    """Every declared constraint of the facts, as ``(check, failures)``."""
    parts = [
        part for fact in (facts or list(FACTS)) for part in _fact_checks(tables, fact, as_of_ms)
    ]
    return reduce(DataFrame.unionByName, parts)
