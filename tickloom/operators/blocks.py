"""Ordered frames over long series, cut into time blocks.

A window partitioned by symbol alone would sort a symbol's whole history in one task. Here a
series is cut into blocks of fixed length, each with what it needs from before it, so the
parallelism grows with the covered time and no task holds more than a block.

``block_ms=None`` leaves a series whole: for spans known to fit in one block, such as a
micro-batch with its look-back, the cutting would only add steps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.functions.clock import floor_div


def _with_borrowed_rows(
    df: DataFrame, keys: list[str], ts: str, depth: int, block_ms: int | None
) -> DataFrame:
    """Rows by ``_block``, plus copies (``_own`` false) of the ``depth`` rows before each.

    Only the last ``depth`` rows of a block can be borrowed. A block that follows a sparse
    one borrows from several: how many rows each earlier block lends is worked out on the
    small table of row counts.
    """
    if block_ms is None:
        return df.withColumn("_block", F.lit(0)).withColumn("_own", F.lit(True))
    own = df.withColumn("_block", floor_div(ts, block_ms)).withColumn("_own", F.lit(True))
    by_block = [*keys, "_block"]
    newest_first = Window.partitionBy(*by_block).orderBy(F.col(ts).desc())
    tails = own.withColumn("_back", F.row_number().over(newest_first)).filter(
        F.col("_back") <= depth
    )

    # `upto` counts lendable rows up to and including a block; every listed block has at
    # least one, so `depth` earlier blocks always suffice.
    in_order = Window.partitionBy(*keys).orderBy("_block")
    sizes = tails.groupBy(*by_block).agg(F.max("_back").alias("_size"))
    sizes = sizes.withColumn("_upto", F.sum("_size").over(in_order))
    lenders = F.collect_list(F.struct("_block", "_upto")).over(in_order.rowsBetween(-depth, -1))
    loans = (
        sizes.withColumn("_lenders", lenders)
        .withColumn("_total", F.col("_upto") - F.col("_size"))
        .select(
            *keys, F.col("_block").alias("_target"), "_total",
            F.explode("_lenders").alias("_lender"),
        )
        .select(
            *keys, "_target", F.col("_lender._block").alias("_block"),
            (F.lit(depth) - (F.col("_total") - F.col("_lender._upto"))).alias("_lend"),
        )
        .filter("_lend > 0")
    )
    borrowed = (
        tails.join(loans, by_block)
        .filter(F.col("_back") <= F.col("_lend"))
        .withColumn("_block", F.col("_target"))
        .withColumn("_own", F.lit(False))
    )
    return own.unionByName(borrowed.select(*own.columns))


def over_last_rows(
    df: DataFrame, keys: list[str], ts: str, depth: int, block_ms: int | None,
    columns: dict[str, Column],
) -> DataFrame:
    """Adds aggregates over each row and the ``depth`` rows before it in its series.

    ``ts`` must be unique within a series. Same result as
    ``agg OVER (PARTITION BY keys ORDER BY ts ROWS BETWEEN depth PRECEDING AND CURRENT ROW)``.
    """
    w = Window.partitionBy(*keys, "_block").orderBy(ts).rowsBetween(-depth, 0)
    rows = _with_borrowed_rows(df, keys, ts, depth, block_ms)
    return (
        rows.select("*", *[c.over(w).alias(name) for name, c in columns.items()])
        .filter("_own").drop("_own", "_block")
    )


def with_previous(
    df: DataFrame, keys: list[str], ts: str, block_ms: int | None, columns: dict[str, str]
) -> DataFrame:
    """Adds columns of the row before, null for a series' first row."""
    w = Window.partitionBy(*keys, "_block").orderBy(ts)
    rows = _with_borrowed_rows(df, keys, ts, 1, block_ms)
    return (
        rows.select("*", *[F.lag(c).over(w).alias(name) for name, c in columns.items()])
        .filter("_own").drop("_own", "_block")
    )


def trailing_avg(
    df: DataFrame, keys: list[str], ts: str, value: Column, span_ms: int,
    block_ms: int | None, name: str = "baseline",
) -> DataFrame:
    """Adds the mean of a DECIMAL ``value`` over ``[ts - span_ms, ts]`` of each row's series.

    Each row adds its value at its time and takes it back just after it leaves the span, so
    the running total at a row is its span's total: linear work however long the span is.
    A block starts from the net total of the blocks before it. The decimals are exact, hence
    nothing is lost by subtracting.
    """
    row, count = F.struct(*df.columns), F.lit(1).cast("long")
    enter = F.struct(
        F.col(ts).alias("_at"), value.alias("_v"), count.alias("_n"), row.alias("_row")
    )
    leave = F.struct(
        (F.col(ts) + (span_ms + 1)).alias("_at"), (-value).alias("_v"), (-count).alias("_n"),
        F.when(F.lit(False), row).alias("_row"),
    )
    changes = df.select(*keys, F.inline(F.array(enter, leave)))
    running = Window.partitionBy(*keys, "_block").orderBy("_at").rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    if block_ms is None:
        changes = changes.withColumn("_block", F.lit(0))
    else:
        changes = changes.withColumn("_block", floor_div("_at", block_ms))
        carried = _carried(changes, keys, block_ms)
        changes = changes.unionByName(carried, allowMissingColumns=True)
    total, n = F.sum("_v").over(running), F.sum("_n").over(running)
    return (
        changes.withColumn("_total", total).withColumn("_count", n)
        .filter(F.col("_row").isNotNull())
        .select("_row.*", (F.col("_total").cast("double") / F.col("_count")).alias(name))
    )


def _carried(changes: DataFrame, keys: list[str], block_ms: int) -> DataFrame:
    """One row a block with the net total of the blocks before it, placed at its start."""
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return (
        changes.groupBy(*keys, "_block")
        .agg(F.sum("_v").alias("_v"), F.sum("_n").alias("_n"))
        .withColumn("_v", F.sum("_v").over(earlier))
        .withColumn("_n", F.sum("_n").over(earlier))
        .withColumn("_at", F.col("_block") * block_ms)
    )
