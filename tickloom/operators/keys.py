"""Natural names to surrogate keys, and the reverse check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.sources.dims import active_symbols


def resolve_keys(df: DataFrame, dim_symbol: DataFrame) -> DataFrame:
    """Adds ``symbol_key``; rows with unknown or inactive symbols are dropped."""
    return df.join(active_symbols(dim_symbol), "symbol")


def resolve_window(df: DataFrame, dim_window: DataFrame) -> DataFrame:
    """Adds ``window_key`` by the length of each row's window."""
    lengths = dim_window.select(
        "window_key", F.col("duration_ms").cast("long").alias("_length")
    )
    return df.withColumn("_length", F.col("window_end") - F.col("window_start")).join(
        lengths, "_length"
    ).drop("_length")


def resolve_interval(df: DataFrame, dim_interval: DataFrame) -> DataFrame:
    return df.join(
        dim_interval.select("interval_key", F.col("interval_label").alias("interval")),
        "interval",
    )


def resolve_alert_type(df: DataFrame, dim_alert_type: DataFrame) -> DataFrame:
    return df.join(dim_alert_type.select("alert_type_key", "alert_code"), "alert_code")


def orphans(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact rows whose key the dimension lacks."""
    return fact.join(dim.select(key), key, "left_anti")
