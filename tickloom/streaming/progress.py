"""A durable log of query progress, and rules on it: lag, stalled ingest, slow batches, late rows."""

from __future__ import annotations

import json
import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tickloom.functions.clock import DAY, MINUTE, SECOND
from tickloom.operators.blocks import trailing_avg
from tickloom.sources.shared import Shared

# Limits of the three rules and how long each must hold.
MAX_LAG, LAG_FOR_MS = 10_000, 2 * MINUTE
STALLED_FOR_MS = 3 * MINUTE
SLOW_BATCH_MS = 5 * SECOND

_PROGRESS = (
    "name string, timestamp string, batchId long, numInputRows long, "
    "durationMs map<string,long>, sources array<struct<metrics: map<string,string>>>"
)


class ProgressLog(StreamingQueryListener):
    """Keeps each trigger's progress as one small file of a shared folder, whichever driver ran it.

    A session remembers the last 100 triggers of a query only, and forgets them when it ends.
    Files are named by run, batch and time, so a repeated event replaces itself.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder.rstrip("/")
        self._shared, self._ended = Shared(spark, folder), set()
        self._changed = threading.Condition()

    def record(self, progress: str) -> None:
        p = json.loads(progress)
        stamp = p["timestamp"].replace(":", "")
        self._shared.write_text(f"{self._folder}/{p['runId']}-{p['batchId']}-{stamp}.json", " ".join(progress.split()) + "\n")

    def rows(self) -> DataFrame:
        """All recorded progress as JSON rows."""
        if not self._shared.data_files(self._folder):
            return self._spark.createDataFrame([], "value string")
        return self._spark.read.text(self._folder)

    def compact(self) -> None:
        """One file for all that is recorded so far."""
        files = self._shared.data_files(self._folder)
        if len(files) > 1:
            self._spark.read.text(files).coalesce(1).write.mode("append").text(self._folder)
            for f in files:
                self._shared.delete(f)

    def wait_for(self, queries: list[StreamingQuery], seconds: float = 60.0) -> None:
        """Events come after a query has ended: waits until all of these have."""
        runs, until = {str(q.runId) for q in queries}, time.monotonic() + seconds
        with self._changed:
            while not runs <= self._ended and (left := until - time.monotonic()) > 0:
                self._changed.wait(left)
        if not runs <= self._ended:
            raise TimeoutError("progress of ended queries has not arrived")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.record(event.progress.json)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()


def late_rows(df: DataFrame) -> DataFrame:
    """Of progress JSON, by query: rows read, and rows that came too late for their windows.

    Late rows are counted where they would enter the state, after a task has combined its own.
    """
    schema = "name string, numInputRows long, stateOperators array<struct<numRowsDroppedByWatermark: long>>"
    p = df.select(F.from_json("value", schema).alias("p"))
    dropped = F.aggregate("p.stateOperators", F.lit(0).cast("long"), lambda a, s: a + F.coalesce(s["numRowsDroppedByWatermark"], F.lit(0)))
    return p.groupBy(F.col("p.name").alias("name")).agg(
        F.sum("p.numInputRows").alias("input_rows"), F.sum(F.coalesce(dropped, F.lit(0))).alias("late_rows"))


def progress_rows(spark: SparkSession, queries: list[StreamingQuery]) -> DataFrame:
    """The progress a session still remembers, as JSON rows to be appended to a log."""
    lines = [(json.dumps(dict(p), default=str),) for q in queries for p in q.recentProgress]
    return spark.createDataFrame(lines, "value string")


def parse_progress(df: DataFrame) -> DataFrame:
    """Progress JSON as ``(name, ts, batch_id, input_rows, batch_ms, lag)``."""
    p = df.select(F.from_json("value", _PROGRESS).alias("p"))
    lag = F.aggregate(
        F.transform(
            "p.sources",
            lambda s: F.coalesce(
                F.try_element_at(s["metrics"], F.lit("maxOffsetsBehindLatest"))
                .try_cast("double"),
                F.lit(0.0),
            ),
        ),
        F.lit(0.0), lambda a, b: F.greatest(a, b),
    )
    return p.select(
        F.col("p.name").alias("name"),
        F.unix_millis(F.to_timestamp("p.timestamp")).alias("ts"),
        F.col("p.batchId").alias("batch_id"),
        F.col("p.numInputRows").alias("input_rows"),
        F.try_element_at("p.durationMs", F.lit("triggerExecution")).alias("batch_ms"),
        lag.cast("long").alias("lag"),
    )


def progress_alerts(df: DataFrame) -> DataFrame:
    """Batches at which a rule fires; lag and stall must have held for their whole span."""
    first = df.groupBy("name").agg(F.min("ts").alias("_first"))
    rows = df.join(first, "name")
    held = {
        "lag": (F.col("lag") > MAX_LAG, LAG_FOR_MS),
        "stalled": (F.col("input_rows") == 0, STALLED_FOR_MS),
    }
    tests = {"slow_batch": F.col("batch_ms") > SLOW_BATCH_MS}
    for rule, (breach, span_ms) in held.items():
        share = breach.cast("int").cast("decimal(18,0)")
        rows = trailing_avg(rows, ["name"], "ts", share, span_ms, DAY, f"_{rule}")
        tests[rule] = (F.col(f"_{rule}") == 1) & (F.col("ts") - F.col("_first") >= span_ms)
    fired = F.array_compact(F.array(*[F.when(test, F.lit(n)) for n, test in tests.items()]))
    return rows.select("name", "batch_id", "ts", F.explode(fired).alias("rule"))
