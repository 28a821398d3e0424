"""Turns of conversations in one global order, split evenly: a long conversation lies in several parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import stored


def digest(role: Column, text: Column) -> Column:
    """128 bits that stand for a turn's role and text (neither null)."""
    size = F.char_length(role).cast("string")
    return F.unhex(F.md5(F.concat(size, F.lit(":"), role, text)))


def in_order(rows: DataFrame, keys: list[str], purpose: str) -> DataFrame:
    """Stored ``rows`` with ``at``, which grows with ``keys`` (nulls first), and ``part``.

    Rows are dealt out by range of the keys and a number of their own, so that neither a long
    conversation nor many equal rows make one part larger than the others. Within a part, the rows
    of a conversation have consecutive ``at``.
    """
    numbered = rows.withColumn("_own", F.monotonically_increasing_id())
    by_range = numbered.repartitionByRange(*keys, "_own").sortWithinPartitions(*keys, "_own")
    out = by_range.withColumn("at", F.monotonically_increasing_id()).drop("_own")
    return stored(out.withColumn("part", F.shiftright("at", 33).cast("int")), purpose)
