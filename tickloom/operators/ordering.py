"""Latest rows, tails and as-of lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def last_rows(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows a key by ``order``.

    The rank filter is applied inside each task before the shuffle, so a task sends at most
    ``n`` rows a key however many it read.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= n)


def latest_per(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return last_rows(df, keys, order, 1).drop("_rank")


def newest(df: DataFrame, order: str | list[str], n: int) -> DataFrame:
    """Last ``n`` rows, newest first; further columns settle ties."""
    columns = [order] if isinstance(order, str) else order
    return df.orderBy(*[F.col(c).desc() for c in columns]).limit(n)


def tail(df: DataFrame, order: str, n: int) -> DataFrame:
    """Last ``n`` rows, oldest first."""
    return newest(df, order, n).orderBy(F.col(order).asc())


def asof_previous(
    df: DataFrame, newest_per_key: DataFrame, key: str, ts: str, gap_ms: int, small: bool
) -> DataFrame:
    """Each key's last row more than ``gap_ms`` before its ``newest`` time.

    ``newest_per_key`` has one row a key. ``small`` says that this was checked to be few
    enough rows to broadcast; otherwise the join is left to adaptive execution.
    """
    bound = F.broadcast(newest_per_key) if small else newest_per_key
    before = df.join(bound, key).filter(F.col(ts) < F.col("newest") - gap_ms)
    return latest_per(before, [key], [F.col(ts).desc()]).drop("newest")


def top_movers(df: DataFrame, group: str, measure: str, k: int) -> DataFrame:
    """The ``k`` largest by ``measure`` in each group, ties included."""
    w = Window.partitionBy(group).orderBy(F.col(measure).desc())
    return df.withColumn("rank", F.rank().over(w)).filter(F.col("rank") <= k)
