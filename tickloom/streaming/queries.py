"""Starting, running and inspecting streaming queries."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tickloom.operators.trades import with_event_time
from tickloom.session import SETTINGS

# Watermark delay, rate cap and trigger intervals of the running jobs.
WATERMARK = "2 seconds"
TRADES_PER_TRIGGER = 50_000
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
HEAP_STORE = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
TRIGGERS = {
    "trades_1s": "1 second", "trades_5s": "5 seconds", "klines": "1 minute",
    "quotes": "1 second", "archive": "5 minutes", "alerts": "5 seconds",
}


def watermarked(df: DataFrame, ms: str, delay: str = WATERMARK) -> DataFrame:
    """Event time with a watermark: later rows than ``delay`` are dropped from windows."""
    return with_event_time(df, ms).withWatermark("event_time", delay)


@dataclass
class Spec:
    """One query: its frame, per-batch sink, checkpoint folder and trigger."""

    name: str
    frame: DataFrame
    sink: Callable[[DataFrame, int], None]
    checkpoint: str
    trigger: str | None = None  # processing-time interval; None reads what is there and ends


def start(spec: Spec, mode: str = "append") -> StreamingQuery:
    writer = (
        spec.frame.writeStream.queryName(spec.name).outputMode(mode)
        .option("checkpointLocation", spec.checkpoint).foreachBatch(spec.sink)
    )
    with state_off_heap(spec.frame.sparkSession):
        return trigger(writer, spec.trigger).start()


@contextmanager
def state_off_heap(spark: SparkSession) -> Iterator[None]:
    """Queries started within keep their state on RocksDB, also in a session with Spark's own settings.

    A query takes the session's settings when it starts, or its checkpoint's store if it has one. A store
    that the session names, other than Spark's default, is left; keyed state needs one with column families.
    """
    wanted = {k: v for k, v in SETTINGS.items() if ".stateStore." in k}
    if not spark.conf.get(STATE_STORE, HEAP_STORE).endswith(".HDFSBackedStateStoreProvider"):
        wanted = {}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def trigger(writer, interval: str | None):
    if interval is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval)


def run_all(spark: SparkSession, specs: list[Spec]) -> list[StreamingQuery]:
    """Runs the queries side by side.

    Bounded queries are waited for, all of them. With interval triggers the call returns when
    the first query ends, after stopping the others, and raises its error if it failed.
    """
    running = [start(spec) for spec in specs]
    try:
        if all(spec.trigger is None for spec in specs):
            for query in running:
                query.awaitTermination()
        else:
            spark.streams.awaitAnyTermination()
    finally:
        for query in running:
            if query.isActive:
                query.stop()
    return running


def late_drops(query: StreamingQuery) -> int:
    """Rows dropped for being older than the watermark, over the recorded progress."""
    return sum(
        int(op["numRowsDroppedByWatermark"])
        for progress in query.recentProgress
        for op in progress["stateOperators"]
    )
