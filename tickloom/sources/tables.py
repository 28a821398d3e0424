"""The catalog of dimensions and facts."""

from __future__ import annotations

import copy
import hashlib
import re
import threading
import time
import uuid
from collections import defaultdict
from collections.abc import Callable, Collection, Mapping
from datetime import date, timedelta
from functools import cached_property

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.functions import clock
from tickloom.operators.upsert import insert_if_absent, retained
from tickloom.schemas import FACTS, conform
from tickloom.sources import dims
from tickloom.sources.shared import Shared

# The calendar range of the star schema.
DEFAULT_CALENDAR = dims.Calendar(date(2025, 1, 1), date(2027, 1, 1))
SMALL_DIM_ROWS = 100_000
ROWS_PER_FILE = 2_000_000

#: Sums that are kept for each minute of a series, where a store keeps them.
MINUTE_SUMS = {
    "trade_agg": {"volume": "volume"},
    "spread_snapshot": {"spread": "spread", "depth": "bid_qty + ask_qty"},
}

_locks: defaultdict[str, threading.Lock] = defaultdict(threading.Lock)
_locking = threading.Lock()


def _lock(path: str) -> threading.Lock:
    with _locking:
        return _locks[path]


def _day(ms: int) -> date:
    return date(1970, 1, 1) + timedelta(days=ms // clock.DAY)


class Tables:
    """Facts by name, either given as DataFrames or stored as Parquet by writer and day under
    ``root``. Queries that write side by side each take a catalog of :meth:`written_by`.

    A day is rewritten as a generation: a folder beside the writer's own (``writer=<name>+<id>``)
    that appears by one rename and names the files it stands for. Files that are appended
    meanwhile are not among them, so a rewrite never loses rows.

    Beside each fact lies a record of what its series have on which days. It is written after
    the rows; days without a record are always looked at.
    """

    def __init__(
        self, spark: SparkSession, root: str | None = None,
        facts: Mapping[str, DataFrame] | None = None,
        calendar: dims.Calendar | DataFrame = DEFAULT_CALENDAR,
        dimensions: dict[str, DataFrame] | None = None, writer: str = "main",
    ):
        self.spark = spark
        self.root = root.rstrip("/") if root else None
        self.calendar = calendar
        self.writer = writer
        self._facts = {} if facts is None else facts
        self._dims = {**dims.seed_dims(spark), **(dimensions or {})}

    @classmethod
    def from_jdbc(cls, spark: SparkSession, url: str, predicates: dict[str, list[str]],
                  properties: dict[str, str], **kwargs) -> Tables:
        """Facts in a database, each read in parallel by its list of predicates."""
        facts = {
            name: spark.read.jdbc(url, f"fact_{name}", predicates=parts, properties=properties)
            for name, parts in predicates.items()
        }
        return cls(spark, facts=facts, **kwargs)

    def dim(self, name: str) -> DataFrame:
        return self._dims[name]

    @cached_property
    def few_symbols(self) -> bool:
        """Whether a one-row-per-symbol table is small enough to broadcast."""
        head = self.dim("symbol").limit(SMALL_DIM_ROWS + 1)
        return head.count() <= SMALL_DIM_ROWS

    # -- reading ------------------------------------------------------------------------

    def path(self, name: str) -> str:
        if not self.root:
            raise LookupError(f"fact {name} is not given and the catalog has no root")
        return f"{self.root}/fact_{name}"

    @cached_property
    def _shared(self) -> Shared:
        return Shared(self.spark, self.root)

    def _folders(self, name: str) -> list[tuple[str, date]]:
        """(writer, day) of the stored folders; no file is listed."""
        found = " ".join(self._shared.matching(f"{self.path(name)}/writer=*/dt=*"))
        return sorted(
            (w, date.fromisoformat(d))
            for w, d in re.findall(r"/writer=([^/]+)/dt=(\d{4}-\d\d-\d\d)", found)
        )

    def _replaced(self, name: str) -> set[str]:
        """Files that a generation stands for, as ``writer=.../dt=.../file``."""
        notes = self._shared.matching(f"{self.path(name)}/writer=*/_replaces")
        return {line for n in notes for line in self._shared.read_text(n).split("\n") if line}

    def _sources(self, name: str, folders: list[tuple[str, date]]) -> list[str]:
        """Folders to read; of those that a generation replaces in part, the other files."""
        replaced, out = self._replaced(name), []
        partly = {f.rpartition("/")[0] for f in replaced}
        for writer, day in folders:
            folder = f"writer={writer}/dt={day}"
            if folder not in partly:
                out.append(f"{self.path(name)}/{folder}")
            else:
                out += [
                    f for f in self._shared.data_files(f"{self.path(name)}/{folder}")
                    if "/".join(f.rsplit("/", 3)[1:]) not in replaced
                ]
        return out

    def days(self, name: str) -> list[date]:
        """Days the stored fact has, from the folder names."""
        return sorted({d for _, d in self._folders(name)})

    def keeps(self, path: str) -> bool:
        """Whether a folder of the store is there."""
        return self._shared.exists(path)

    def versions(self, name: str) -> dict[date, str]:
        """By stored day, a digest of the files that hold it: it changes with each write to the day."""
        self._folders(name)  # a catalog that builds its facts does it now
        replaced, files = self._replaced(name), defaultdict(list)
        for path in self._shared.matching(f"{self.path(name)}/writer=*/dt=*/*"):
            file = "/".join(path.rsplit("/", 3)[1:])
            if file not in replaced and not re.search(r"/[._][^/]*$", file):
                files[date.fromisoformat(file.split("/")[1].removeprefix("dt="))].append(file)
        return {d: hashlib.md5("\n".join(sorted(f)).encode()).hexdigest() for d, f in files.items()}

    def fact(
        self, name: str, from_ms: int | Column | None = None, to_ms: int | Column | None = None,
        days: Collection[date] | None = None,
    ) -> DataFrame:
        """The fact, optionally within ``[from_ms, to_ms]`` or of some days; no other is read."""
        spec = FACTS[name]
        if name in self._facts:
            df = self._facts[name]
        elif not (paths := self._paths(name, from_ms, to_ms, days)):
            return self.spark.range(0).filter(F.lit(False)).select(
                *[F.lit(None).cast(f.dataType).alias(f.name) for f in spec.schema]
            )
        else:
            df = self.spark.read.option("basePath", self.path(name)).schema(
                ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in spec.schema)
                + ", dt date"
            ).parquet(*paths)
        for bound, keep in ((from_ms, "__ge__"), (to_ms, "__le__")):
            if bound is None:
                continue
            limit = bound if isinstance(bound, Column) else F.lit(bound)
            df = df.filter(getattr(F.col(spec.time), keep)(limit))
            if "dt" in df.columns:
                df = df.filter(getattr(F.col("dt"), keep)(clock.day(limit)))
        return df.select(*spec.columns)

    def _paths(
        self, name: str, from_ms, to_ms, days: Collection[date] | None = None
    ) -> list[str]:
        """The day folders that can hold rows of the range: no other is opened or listed."""
        low, high = (
            _day(b) if isinstance(b, int) else edge
            for b, edge in ((from_ms, date.min), (to_ms, date.max))
        )
        return self._sources(name, [
            (w, d) for w, d in self._folders(name)
            if low <= d <= high and (days is None or d in days)
        ])

    # -- what was seen when -------------------------------------------------------------

    def _seen_path(self, name: str) -> str:
        return f"{self.root}/seen_{name}"

    def _seen_schema(self, name: str) -> str:
        keys = ", ".join(f"{c} {FACTS[name].schema[c].dataType.simpleString()}" for c in FACTS[name].series)
        return f"{keys}, dt date, first bigint, last bigint, rows bigint"

    def _note(self, name: str, rows: DataFrame) -> None:
        """Records days, first and last time and number of the rows of each series.

        ``rows`` are all stored by now; some may have been before, so ``rows`` of the record is
        a number that is not exceeded.
        """
        spec = FACTS[name]
        found = rows.withColumn("dt", clock.day(spec.time)).groupBy(*spec.series, "dt").agg(
            F.min(spec.time).alias("first"), F.max(spec.time).alias("last"),
            F.count("*").alias("rows"),
        )
        path = f"{self._seen_path(name)}/writer={self.writer}"
        with _lock(path):
            # Not coalesced, which would have one task aggregate all shuffled parts one after another.
            found.repartition(1).write.mode("append").parquet(path)

    def seen(self, name: str) -> DataFrame | None:
        """(series, dt, first, last, rows) of the stored fact; ``None`` without a record."""
        if name in self._facts:
            return None
        self._folders(name)  # a catalog that builds its facts does it now
        notes = self._shared.matching(f"{self._seen_path(name)}/writer=*")
        if not notes:
            return None
        found = self.spark.read.schema(self._seen_schema(name)).parquet(*notes)
        return found.groupBy(*FACTS[name].series, "dt").agg(
            F.min("first").alias("first"), F.max("last").alias("last"), F.sum("rows").alias("rows")
        )

    def compact_record(self, name: str) -> None:
        """One file for the record of this catalog's writer."""
        path = f"{self._seen_path(name)}/writer={self.writer}"
        with _lock(path):
            files = self._shared.data_files(path)
            if len(files) < 2:
                return
            whole = self.spark.read.schema(self._seen_schema(name)).parquet(*files)
            merged = whole.groupBy(*FACTS[name].series, "dt").agg(
                F.min("first").alias("first"), F.max("last").alias("last"),
                F.sum("rows").alias("rows"))
            merged.repartition(1).write.mode("append").parquet(path)
            for f in files:
                self._shared.delete(f)

    def newest_days(
        self, name: str, keys: DataFrame, gap_ms: int | None = None,
        of: Column | None = None,
    ) -> list[date] | None:
        """Days that together hold the newest row of each of ``keys``.

        ``of`` narrows the series that count. With ``gap_ms``, also the newest row of any
        series, and the newest counted one that is more than this before it. ``None``: there is
        no record, so it isn't known.
        """
        seen = self.seen(name)
        if seen is None:
            return None
        seen, counts = seen.withColumn("_of", F.lit(True) if of is None else of), F.col("_of")
        by_day = seen.join(keys, keys.columns, "left_semi").groupBy(*keys.columns, "dt").agg(
            F.max("last").alias("any"), F.max(F.when(counts, F.col("last"))).alias("last"),
            F.min(F.when(counts, F.col("first"))).alias("first"),
        )
        own = Window.partitionBy(*keys.columns)
        wanted = F.col("last") == F.max("last").over(own)
        if gap_ms is not None:
            newest = F.max("any").over(own)
            early = F.when(F.col("first") < newest - gap_ms, F.col("dt"))
            wanted = wanted | (F.col("any") == newest) | (early == F.max(early).over(own))
        marked = by_day.withColumn("_wanted", wanted).filter("_wanted").select("dt").distinct()
        known = {r[0] for r in seen.select("dt").distinct().collect()}  # as many as day folders
        stored = set(self.days(name))
        return sorted(({r[0] for r in marked.collect()} & stored) | (stored - known))

    def reach_back(
        self, name: str, keys: DataFrame, before_ms: int | None, depth: int,
        rows: Callable[[int, int | None], DataFrame] | None = None,
    ) -> int | None:
        """A time from which each of ``keys`` has ``depth`` rows before ``before_ms``.

        Looks at 1, 4, 16, … stored days back until all keys have enough rows or the table
        ends, so usually only the last day is read. ``None`` means: from the beginning.
        ``before_ms=None`` starts at the newest row. ``rows(from_ms, to_ms)`` gives the rows
        to count where not all rows of the fact do.
        """
        if name in self._facts:
            return None
        days, last = self.days(name), None
        if before_ms is not None:
            last = before_ms - 1
            days = [d for d in days if (d - date(1970, 1, 1)).days * clock.DAY <= last]
        if rows is None:
            rows = lambda low, high: self.fact(name, low, high)
        seen = self.seen(name)
        if seen is not None and set(keys.columns) <= set(FACTS[name].series):
            # Keys that never had enough rows must not make this look at everything.
            had = seen if last is None else seen.filter(F.col("first") <= last)
            enough = had.groupBy(*keys.columns).agg(F.sum("rows").alias("_n")).filter(F.col("_n") >= depth)
            keys = keys.join(enough, keys.columns, "left_semi")
        back = 1
        while back < len(days):
            start = (days[-back] - date(1970, 1, 1)).days * clock.DAY
            seen = rows(start, last).groupBy(*keys.columns).agg(F.count("*").alias("_n"))
            short = keys.join(seen.filter(F.col("_n") >= depth), keys.columns, "left_anti")
            if short.isEmpty():
                return start
            back *= 4
        return None

    def preceding_days(
        self, name: str, keys: DataFrame, before_ms: int | None, depth: int
    ) -> list[date] | None:
        """Days that hold the newest ``depth`` rows of each of ``keys`` before ``before_ms``.

        ``keys`` are columns of the recorded series. Of a key with fewer rows it is all its days, so
        a series that is short or was silent opens its own days and none between. ``None``: no record.
        """
        seen, by = self.seen(name), keys.columns
        if seen is None:
            return None
        known = {r[0] for r in seen.select("dt").distinct().collect()}  # as many as day folders
        last = None if before_ms is None else before_ms - 1
        stored = {d for d in self.days(name) if last is None or d <= _day(last)}
        had = seen if last is None else seen.filter(F.col("first") <= last)
        # Of a day that goes on after the time, it isn't known how many rows count.
        rows = F.col("rows") if last is None else F.when(F.col("last") <= last, F.col("rows")).otherwise(0)
        newer = Window.partitionBy(*by).orderBy(F.desc("dt")).rowsBetween(Window.unboundedPreceding, -1)
        own = (
            had.withColumn("rows", rows).join(keys, by, "left_semi")
            .groupBy(*by, "dt").agg(F.sum("rows").alias("rows"))
            .withColumn("newer", F.coalesce(F.sum("rows").over(newer), F.lit(0)))
        )
        taken = depth
        while True:  # a recorded number may exceed the stored one: what the days hold is counted
            found = own.filter(F.col("newer") < taken).select("dt").distinct().collect()
            days = sorted(({r[0] for r in found} & stored) | (stored - known))
            more = own.filter(F.col("newer") >= taken).select(*by).distinct()
            counted = self.fact(name, to_ms=last, days=days).groupBy(*by).agg(F.count("*").alias("_n"))
            if more.join(counted.filter(F.col("_n") >= depth), by, "left_anti").isEmpty():
                return days
            taken *= 4

    def newest_from(
        self, name: str, rows: Callable[..., DataFrame], depth: int = 1,
        key: str = "symbol_key", symbols: DataFrame | None = None, of: Column | None = None,
    ) -> dict:
        """Bounds of :meth:`fact` within which each of the symbols has its newest ``depth`` rows.

        ``symbols`` must be all those that the caller's ``rows`` can hold: by default the
        active ones. By the record these are the symbols' own days, however old, and what they
        hold is checked (``of`` narrows the recorded series). Without a record: a span of days.
        """
        names = (self.symbols() if symbols is None else symbols).select("symbol_key", *{key} - {"symbol_key"})
        seen = self.seen(name)
        if seen is None:
            return {"from_ms": self.reach_back(name, names.select(key), None, depth, rows)}
        known = {r[0] for r in seen.select("dt").distinct().collect()}  # as many as day folders
        stored = set(self.days(name))
        own = (
            (seen if of is None else seen.filter(of)).join(names, "symbol_key")
            .groupBy(key, "dt").agg(F.sum("rows").alias("rows"))
        )
        newer = Window.partitionBy(key).orderBy(F.desc("dt")).rowsBetween(Window.unboundedPreceding, -1)
        own = own.withColumn("newer", F.coalesce(F.sum("rows").over(newer), F.lit(0)))
        taken = depth
        while True:
            found = own.filter(F.col("newer") < taken).select("dt").distinct().collect()
            days = sorted(({r[0] for r in found} & stored) | (stored - known))
            more = own.filter(F.col("newer") >= taken).select(key).distinct()
            enough = rows(days=days).groupBy(key).agg(F.count("*").alias("_n")).filter(F.col("_n") >= depth)
            if more.join(enough, key, "left_anti").isEmpty():
                return {"days": days}
            taken *= 4

    # -- sums by minute -----------------------------------------------------------------

    @property
    def keeps_minutes(self) -> bool:
        """Whether every write to this store also brings its minutes up to date."""
        return self.root is not None and self._shared.exists(f"{self.root}/_minutes")

    def keep_minutes(self) -> None:
        """From now on, this store keeps the sums of each minute; those of stored rows are added."""
        if self.keeps_minutes:
            return
        self._shared.write_text(f"{self.root}/_minutes", "")
        for name in MINUTE_SUMS:
            if days := self.days(name):
                low, high = ((d - date(1970, 1, 1)).days * clock.DAY for d in (days[0], days[-1]))
                self._sum_minutes(name, low, high + clock.DAY - 1)

    def _sum_minutes(self, name: str, low: int, high: int) -> None:
        """Sums the minutes from ``low`` to ``high`` from what is stored by now.

        A minute that gets more rows is summed again: of its entries the one of most rows holds.
        So replays, late rows and writers side by side need no bookkeeping.
        """
        if name not in MINUTE_SUMS or not self.keeps_minutes:
            return
        spec, minute = FACTS[name], clock.MINUTE
        rows = self.fact(name, low // minute * minute, high // minute * minute + minute - 1)
        sums = rows.groupBy(*spec.series, (clock.floor_div(spec.time, minute) * minute).alias("minute")).agg(
            F.count("*").alias("n"),
            *[F.sum(F.expr(e)).cast("decimal(38,8)").alias(c) for c, e in MINUTE_SUMS[name].items()],
        ).withColumn("dt", clock.day("minute"))
        short = high - low <= clock.HOUR
        path = f"{self.root}/minutes_{name}/writer={self.writer}"
        with _lock(path):
            (sums.repartition(1) if short else sums.repartition("dt")).write.mode("append").partitionBy("dt").parquet(path)

    def minute_sums(self, name: str, low: int, high: int) -> DataFrame:
        """(series, minute, n, sums) of the minutes that begin in ``[low, high)``."""
        series = [f"{c} {FACTS[name].schema[c].dataType.simpleString()}" for c in FACTS[name].series]
        sums = [f"{c} decimal(38,8)" for c in MINUTE_SUMS[name]]
        schema = ", ".join([*series, "minute bigint", "n bigint", *sums])
        root = f"{self.root}/minutes_{name}"
        days = {str(_day(low) + timedelta(days=k)) for k in range((_day(high) - _day(low)).days + 1)}
        folders = [f for f in self._shared.matching(f"{root}/writer=*/dt=*") if f.rpartition("dt=")[2] in days]
        if not folders:
            return self.spark.createDataFrame([], schema)
        found = self.spark.read.schema(schema).parquet(*folders).filter((F.col("minute") >= low) & (F.col("minute") < high))
        best = F.max_by(F.struct("n", *MINUTE_SUMS[name]), "n").alias("s")
        return found.groupBy(*FACTS[name].series, "minute").agg(best).select(*FACTS[name].series, "minute", "s.*")

    def window_key(self, window_type: str) -> Column:
        labels = self.dim("window_type").filter(F.col("window_label") == window_type)
        return labels.select("window_key").scalar()

    # -- writing ------------------------------------------------------------------------

    def written_by(self, writer: str) -> Tables:
        """The same catalog for one of several queries that write side by side.

        Each writes to a folder of its own under a fact; readers see all of them.
        """
        other = copy.copy(self)
        other.writer = writer
        return other

    def append(self, df: DataFrame, name: str, rows: int | None = None) -> None:
        """Adds rows under their days, sorted by symbol and time within a file.

        ``rows``, if known, sets the number of writing tasks: a stream's batches are not
        rebalanced at run time. Otherwise a rebalance splits large days and merges small ones,
        and the record is taken from the days that were written to, not from ``df`` again.
        """
        stored = conform(df, name)
        if rows is not None:
            self._write(stored, name, rows)
            self._note(name, stored)
            if name in MINUTE_SUMS and self.keeps_minutes:
                low, high = stored.agg(F.min(FACTS[name].time), F.max(FACTS[name].time)).first()
                if low is not None:
                    self._sum_minutes(name, low, high)
            return
        days = Observation()
        dt = clock.day(FACTS[name].time)
        self._write(stored.observe(days, F.min(dt).alias("low"), F.max(dt).alias("high")), name, None)
        try:
            low, high = days.get["low"], days.get["high"]
        except Py4JJavaError:  # a plan that turns out to be empty has no metrics
            low = high = None
        if low is not None:
            touched = [(w, d) for w, d in self._stored_folders(name) if w == self.writer and low <= d <= high]
            schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in FACTS[name].schema)
            self._note(name, self.spark.read.schema(schema).parquet(*self._sources(name, touched)))
            first, last = ((d - date(1970, 1, 1)).days * clock.DAY for d in (low, high))
            self._sum_minutes(name, first, last + clock.DAY - 1)

    def _stored_folders(self, name: str) -> list[tuple[str, date]]:
        return Tables._folders(self, name)

    def _write(self, stored: DataFrame, name: str, rows: int | None) -> None:
        spec = FACTS[name]
        stored = stored.withColumn("dt", clock.day(spec.time))
        dealt = (
            stored.hint("rebalance", "dt") if rows is None
            else stored.repartition(1 + rows // ROWS_PER_FILE, *spec.keys)
        )
        path = f"{self.path(name)}/writer={self.writer}"
        with _lock(path):  # two appends of one writer would clear each other's temporary files
            (
                dealt.sortWithinPartitions("dt", "symbol_key", spec.time)
                .write.mode("append").partitionBy("dt").parquet(path)
            )

    def reject(self, rows: DataFrame, source: str, batch: str) -> None:
        """Keeps rows that are not used, with their ``reason``; a replayed batch replaces its own."""
        kept = rows.select("reason", F.to_json(F.struct(*[c for c in rows.columns if c != "reason"])).alias("row"))
        if kept.isEmpty():
            return
        path = f"{self.root}/rejects/source={source}/writer={self.writer}/batch={batch}"
        kept.write.mode("overwrite").parquet(path)

    def rejects(self, source: str | None = None) -> DataFrame:
        """(reason, row, source, writer, batch) of what was not used; ``row`` as JSON."""
        schema = "reason string, row string, source string, writer string, batch string"
        folders = self._shared.matching(f"{self.root}/rejects/source={source or '*'}")
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.option("basePath", f"{self.root}/rejects").schema(schema).parquet(*folders)

    def compact(self, name: str, day: date) -> None:
        """Rewrites a closed day, a few large files for each of its writers, and the record.

        Raises :class:`tickloom.sources.shared.Busy` while another driver rewrites the fact.
        """
        with self._shared.lease(f"{self.path(name)}/_rewriting"):
            for writer in {w.partition("+")[0] for w, d in self._folders(name) if d == day}:
                self._rewrite(name, writer, day, lambda df: df)
        self.compact_record(name)

    def _rewrite(
        self, name: str, writer: str, day: date, keep: Callable[[DataFrame], DataFrame]
    ) -> None:
        """Puts a generation in place of the files that a writer's day has now."""
        spec, root, shared = FACTS[name], self.path(name), self._shared
        folders = [(w, d) for w, d in self._folders(name) if d == day and w.partition("+")[0] == writer]
        sources = self._sources(name, folders)
        files = [f for s in sources for f in ([s] if s.endswith(".parquet") else shared.data_files(s))]
        if not files:
            return
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in spec.schema)
        kept = keep(self.spark.read.schema(schema).parquet(*files))
        made = f"{writer}+{uuid.uuid4().hex[:12]}"
        draft = f"{root}/_draft-{made}"
        try:
            (
                kept.withColumn("dt", F.lit(day)).hint("rebalance")
                .sortWithinPartitions("symbol_key", spec.time)
                .write.partitionBy("dt").parquet(draft)
            )
            shared.write_text(f"{draft}/_replaces", "\n".join("/".join(f.rsplit("/", 3)[1:]) for f in files))
            shared.rename(draft, f"{root}/writer={made}")
        finally:
            shared.delete(draft)

    def vacuum(self, name: str, older_than_s: float = 3600.0) -> int:
        """Deletes files that a generation has stood for long enough for reads of them to end."""
        shared, root, gone = self._shared, self.path(name), 0
        with shared.lease(f"{root}/_rewriting"):
            for note in shared.matching(f"{root}/writer=*/_replaces"):
                if time.time() - shared.modified(note) < older_than_s:
                    continue
                for line in shared.read_text(note).split("\n"):
                    if line and shared.exists(f"{root}/{line}"):
                        shared.delete(f"{root}/{line}")
                        gone += 1
                generation = note.rpartition("/")[0]
                replaced_itself = shared.matching(f"{generation}/dt=*") and not any(
                    shared.data_files(d) for d in shared.matching(f"{generation}/dt=*"))
                # A generation whose own files are gone, or whose sources are, needs its note no more.
                shared.delete(generation if replaced_itself else note)
            for folder in shared.matching(f"{root}/writer=*/dt=*"):
                if not shared.matching(f"{folder}/*") and time.time() - shared.modified(folder) > older_than_s:
                    shared.delete(folder)
        return gone

    def insert(
        self, df: DataFrame, name: str, order_by: list[Column] | None = None,
        span: tuple[int, int] | None = None, unique: bool = False, rows: int | None = None,
    ) -> None:
        """Adds the rows whose natural key is not stored yet; the first of a key wins.

        Safe to repeat: a replayed or half-written batch adds only what is missing. ``span``
        is the time range of the rows if the caller knows it, ``rows`` their number; only the
        days of the range are compared.
        ``unique`` says that the rows come from a grouping by the key, so none repeats.
        """
        spec = FACTS[name]
        incoming = conform(df, name)
        held = incoming.persist() if span is None else None
        try:
            if span is None:
                low, high, rows = incoming.agg(
                    F.min(spec.time), F.max(spec.time), F.count("*")
                ).first()
            else:
                low, high = span
            if low is None:
                return
            known, keys = self.fact(name, low, high), list(spec.keys)
            order = order_by or [F.col(c) for c in spec.columns]
            fresh = (
                incoming.join(known.select(*keys), keys, "left_anti") if unique
                else insert_if_absent(known, incoming, keys, order)
            )
            # The first write of a batch; its record is of all its rows, as a replay adds no others.
            self._write(fresh, name, rows)
            self._note(name, incoming)
            self._sum_minutes(name, low, high)
        finally:
            if held is not None:
                held.unpersist()

    def expire(self, name: str, as_of_ms: int) -> int:
        """Applies the fact's retention; returns the number of deleted rows.

        Whole days go by folder; only the day the cutoff falls in is rewritten.
        """
        spec = FACTS[name]
        cutoff = as_of_ms - spec.retention_days * clock.DAY
        edge = date(1970, 1, 1) + timedelta(days=cutoff // clock.DAY)
        with self._shared.lease(f"{self.path(name)}/_rewriting"):
            stored = self._folders(name)
            deleted = self.fact(name, to_ms=cutoff - 1).count() if stored else 0
            if cutoff % clock.DAY and deleted:
                for writer in {w.partition("+")[0] for w, d in stored if d == edge}:
                    self._rewrite(
                        name, writer, edge,
                        lambda df: retained(df, spec.time, spec.retention_days, as_of_ms))
            for writer, d in stored:
                if d < edge:
                    self._shared.delete(f"{self.path(name)}/writer={writer}/dt={d}")
        return deleted

    # -- joined shapes ------------------------------------------------------------------

    def symbols(self) -> DataFrame:
        return self.dim("symbol").filter("is_active")

    def windowed(self, name: str, window_type: str | None = None, **bounds) -> DataFrame:
        """A windowed fact with its active symbol and window label."""
        labels = self.dim("window_type").select(
            "window_key", F.col("window_label").alias("window_type")
        )
        if window_type is not None:
            labels = labels.filter(F.col("window_type") == window_type)
        return (
            self.fact(name, **bounds)
            .join(labels, "window_key")
            .join(dims.active_symbols(self.dim("symbol")), "symbol_key")
        )
