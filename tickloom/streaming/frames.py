"""Look-back frames kept as keyed state, so that a stream's indicators need no stored history.

Each series keeps its last candles on the state store. A new candle leaves with the frame of
candles up to it, over which :func:`tickloom.operators.indicators.over_frames` folds in the JVM.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickloom.operators.indicators import MACD_FRAME
from tickloom.operators.ordering import last_rows
from tickloom.schemas import FACTS

SERIES = ("symbol_key", "interval_key")
DEPTH = MACD_FRAME - 1
KEPT = 2 * DEPTH  # candles kept a series: one may be DEPTH candles late and still find its frame
VALUES = ("high", "low", "close", "volume")
TAIL = "open_time bigint, " + ", ".join(f"{c} double" for c in VALUES)
OUTPUT = "row string, " + ", ".join(f"{c} array<double>" for c in VALUES)
ROWS_PER_FRAME = 2_000  # rows that a task holds with their frames


class LastCandles(StatefulProcessor):
    """Keeps the last candles of a series and gives each new candle its frame.

    The first candle of an opening time holds; copies leave with its frame, so a replay completes
    what is missing. Candles of one batch count for each other whatever their order. A candle that
    is so late that its frame may reach beyond what is kept leaves without one.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._tail = handle.getListState("tail", TAIL)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        rows = [tuple(r) for r in _plain(initialState[["open_time", *VALUES]])]
        self._tail.put(sorted([*self._tail.get(), *rows], key=lambda r: r[0])[-KEPT:])

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        import pandas as pd

        tail = [tuple(r) for r in self._tail.get()]
        held, arrived = {r[0]: r for r in tail}, {}
        for part in rows:
            for close_time, trades, row, *candle in _plain(part[["close_time", "trade_count", "row", "open_time", *VALUES]]):
                rank = (close_time, -1 if trades is None else trades, row)
                if candle[0] not in arrived or rank < arrived[candle[0]][0]:
                    arrived[candle[0]] = (rank, tuple(candle))
        for at, (_, candle) in arrived.items():
            held.setdefault(at, candle)
        series = [held[at] for at in sorted(held)]
        place = {candle[0]: i for i, candle in enumerate(series)}
        # A full tail says nothing of what was before it.
        first = place[tail[0][0]] if len(tail) >= KEPT else -DEPTH
        columns = list(zip(*series))[1:]
        out = sorted(arrived)
        for low in range(0, len(out), ROWS_PER_FRAME):
            part = out[low:low + ROWS_PER_FRAME]
            ends = [place[at] if place[at] - DEPTH >= first else None for at in part]
            yield pd.DataFrame({
                "row": [arrived[at][0][2] for at in part],
                **{name: [None if i is None else list(values[max(i - DEPTH, 0):i + 1]) for i in ends]
                   for name, values in zip(VALUES, columns)},
            })
        self._tail.put(series[-KEPT:])

    def close(self) -> None:
        pass


def _plain(part) -> Iterator[list]:
    """Rows of plain values: missing ones as None."""
    columns = [[None if v != v else v for v in part[c].astype(object).tolist()] for c in part.columns]
    return (list(r) for r in zip(*columns))


def last_candles(tables) -> DataFrame:
    """The last stored candles of each series: what a query without a checkpoint starts from."""
    name, series = "kline_closed", list(SERIES)
    seen, days = tables.seen(name), None
    if seen is not None:
        days = tables.preceding_days(name, seen.select(*series).distinct(), None, KEPT)
    rows = last_rows(tables.fact(name, days=days), series, [F.col("open_time").desc()], KEPT)
    return rows.select(*series, "open_time", *[F.col(c).cast("double").alias(c) for c in VALUES])


def with_kept_frame(facts: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """The rows of a stream of candle facts, each with ``frame``: up to 33 candles before it, and itself.

    One row an opening time and batch leaves. ``frame`` is null where the candle is later than the
    kept ones reach. ``history`` (see :func:`last_candles`) fills the state of a new query; with a
    checkpoint it is not read. A task holds one series of a batch, which the source's rate cap bounds,
    and its frames a part at a time.
    """
    spec = FACTS["kline_closed"]
    rows = facts.select(
        *SERIES, "open_time", "close_time", "trade_count", F.to_json(F.struct(*spec.columns)).alias("row"),
        *[F.col(c).cast("double").alias(c) for c in VALUES],
    )
    framed = rows.groupBy(*SERIES).transformWithStateInPandas(
        LastCandles(), OUTPUT, "append", "none",
        None if history is None else history.groupBy(*SERIES),
    )
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in spec.schema)
    frame = F.when(F.col("close").isNotNull(), F.arrays_zip(*VALUES)).alias("frame")
    return framed.select(F.from_json("row", types).alias("fact"), frame).select("fact.*", "frame")
