"""Partial results by day, kept beside a fact: marts merge them instead of reading its history.

A folder ``states/<name>/run=/dt=/version=`` holds one day's groups. The version digests the day's
files, so a day is summed again only after a write to it, whoever wrote. A run appears by one
rename; where two drivers summed the same version, one of them is read.
"""

from __future__ import annotations

import re
import time
import uuid
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions import clock
from tickloom.schemas import FACTS
from tickloom.sources.dims import Calendar
from tickloom.sources.shared import Shared
from tickloom.sources.tables import Tables


@dataclass(frozen=True)
class State:
    """Groups of a fact and what is kept of each: values that merge by sum, minimum or maximum.

    Groups, parts and the condition are SQL expressions.
    """

    name: str
    fact: str
    schema: str  # of the groups and the parts
    groups: dict[str, str]
    parts: dict[str, str]
    where: str = "true"


def kept(tables: Tables) -> bool:
    """Whether a catalog can keep states: its facts are stored and a day has the same calendar throughout."""
    return tables.root is not None and not tables._facts and isinstance(tables.calendar, Calendar)


def _runs(tables: Tables, state: State) -> dict[tuple[date, str], str]:
    """The run to read for each (day, version)."""
    path = f"{tables.root}/states/{state.name}"
    found = {}
    for folder in sorted(Shared(tables.spark, tables.root).matching(f"{path}/run=*/dt=*/version=*")):
        run, day, version = re.search(r"/run=([^/]+)/dt=([^/]+)/version=([^/]+)$", folder).groups()
        found.setdefault((date.fromisoformat(day), version), f"{path}/run={run}/dt={day}/version={version}")
    return found


def _sum_days(tables: Tables, state: State, versions: dict[date, str]) -> None:
    spec = FACTS[state.fact]
    rows = tables.fact(state.fact, days=list(versions)).withColumn("dt", clock.day(spec.time))
    stamped = F.create_map(*[F.lit(x) for item in versions.items() for x in item])
    found = summed(rows, state, "dt").withColumn("version", stamped[F.col("dt")])
    path, run = f"{tables.root}/states/{state.name}", uuid.uuid4().hex[:12]
    shared, draft = Shared(tables.spark, tables.root), f"{path}/_draft-{run}"
    try:
        # A day's groups are few: its symbols, or these by hour.
        found.repartition("dt").write.partitionBy("dt", "version").parquet(draft)
        shared.rename(draft, f"{path}/run={run}")
    finally:
        shared.delete(draft)


def summed(rows: DataFrame, state: State, *by: str) -> DataFrame:
    """The groups of some rows of the fact, also by the columns ``by``."""
    groups = [F.expr(e).alias(n) for n, e in state.groups.items()]
    return rows.filter(state.where).groupBy(*by, *groups).agg(*[F.expr(e).alias(n) for n, e in state.parts.items()])


def by_day(tables: Tables, state: State, from_ms: int, to_ms: int | None = None) -> DataFrame:
    """The groups of each day from ``from_ms`` to ``to_ms``, with ``dt``; only changed days are read."""
    low, high = day_of(from_ms), date.max if to_ms is None else day_of(to_ms)
    versions = {d: v for d, v in tables.versions(state.fact).items() if low <= d <= high}
    done = _runs(tables, state)
    if changed := {d: v for d, v in versions.items() if (d, v) not in done}:
        _sum_days(tables, state, changed)
        done = _runs(tables, state)
    # A day of which no row counts has no folder.
    paths = [done[item] for item in versions.items() if item in done]
    if not paths:
        return tables.spark.createDataFrame([], f"{state.schema}, dt date")
    schema = f"{state.schema}, run string, dt date, version string"
    read = tables.spark.read.option("basePath", f"{tables.root}/states/{state.name}")
    return read.schema(schema).parquet(*paths).drop("run", "version")


def vacuum(tables: Tables, state: State, older_than_s: float = 3600.0) -> int:
    """Deletes days of versions that no longer stand, once reads of them have ended."""
    shared, versions, gone = Shared(tables.spark, tables.root), tables.versions(state.fact), 0
    for folder in shared.matching(f"{tables.root}/states/{state.name}/run=*/dt=*/version=*"):
        day, version = re.search(r"/dt=([^/]+)/version=([^/]+)$", folder).groups()
        stale = versions.get(date.fromisoformat(day)) != version
        if stale and time.time() - shared.modified(folder) >= older_than_s:
            shared.delete(folder)
            gone += 1
    return gone


def day_of(ms: int) -> date:
    return date.fromordinal(date(1970, 1, 1).toordinal() + ms // clock.DAY)
