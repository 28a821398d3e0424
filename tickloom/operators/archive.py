"""Raw archive rows and their partition columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions import clock

# Partition columns and time column of the three archives.
ARCHIVES = {
    "trades": (("symbol", "year", "month", "day", "hour"), "trade_time"),
    "klines": (("symbol", "year", "month", "day"), "open_time"),
    "bookticker": (("symbol", "year", "month", "day", "hour"), "ingested_at"),
}


def archivable(df: DataFrame) -> DataFrame:
    return df.filter(F.col("symbol").isNotNull())


def _two(c: Column) -> Column:
    return F.lpad(c.cast("string"), 2, "0")


def add_partition_cols(df: DataFrame, ts: str) -> DataFrame:
    d = clock.day(ts)
    return (
        df.withColumn("year", F.year(d).cast("string"))
        .withColumn("month", _two(F.month(d)))
        .withColumn("day", _two(F.dayofmonth(d)))
        .withColumn("hour", _two(clock.hour(ts)))
    )


def partition_range(from_ms: int, to_ms: int) -> Column:
    """The archive folders of ``[from_ms, to_ms]``, as a predicate on partition columns."""
    stamp = F.concat(F.col("year"), F.col("month"), F.col("day"))
    first, last = F.lit(from_ms), F.lit(to_ms)
    return stamp.between(
        F.date_format(clock.day(first), "yyyyMMdd"), F.date_format(clock.day(last), "yyyyMMdd")
    )
