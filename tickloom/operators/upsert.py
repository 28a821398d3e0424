"""Keyed inserts and retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.clock import DAY, as_of_or_now
from tickloom.operators.ordering import latest_per


def insert_if_absent(
    existing: DataFrame, incoming: DataFrame, keys: list[str], order_by: list[Column]
) -> DataFrame:
    """The incoming rows to add: the first of each key by ``order_by``, if not stored yet.

    Copies of one key are cut to one row a task before the shuffle, so a key with very many
    copies does not pile up anywhere.
    """
    firsts = latest_per(incoming, keys, order_by)
    return firsts.join(existing.select(*keys), keys, "left_anti").select(*incoming.columns)


def retained(df: DataFrame, ts: str, days: int, as_of_ms: int | Column) -> DataFrame:
    return df.filter(F.col(ts) >= as_of_or_now(as_of_ms) - days * DAY)


def apply_retention(
    df: DataFrame, ts: str, days: int, as_of_ms: int | Column
) -> tuple[DataFrame, DataFrame]:
    """The kept rows, and a one-row frame with the number deleted."""
    expired = F.col(ts) < as_of_or_now(as_of_ms) - days * DAY
    return retained(df, ts, days, as_of_ms), df.agg(F.count_if(expired).alias("deleted"))
