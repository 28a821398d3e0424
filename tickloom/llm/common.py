"""Helpers that the operators share: reading, text functions over Arrow batches, checked broadcasts."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.session import scratch_dir

#: Rows of one Arrow batch. Texts can be long, and a batch is all that a Python worker holds.
BATCH_ROWS = 256

#: name -> (Arrow type, Spark type) of what a text function may return.
TYPES = {
    "long": (pa.int64(), T.LongType()), "double": (pa.float64(), T.DoubleType()),
    "string": (pa.string(), T.StringType()), "binary": (pa.binary(), T.BinaryType()), "longs": (pa.list_(pa.int64()), T.ArrayType(T.LongType())),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def python_settings(spark: SparkSession) -> None:
    """Bounds what a Python worker holds at once, and lets workers import this package.

    Call it before a text function is used: both are read when a plan is made. Where executors don't
    share the driver's folders, the package is installed there or sent with ``--py-files``.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    root = str(Path(__file__).resolve().parents[2])
    own = spark.sparkContext.environment
    if root not in (paths := own.get("PYTHONPATH", "").split(os.pathsep)):
        own["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def per_batch(make: Callable[[], Callable[[list], list[tuple]]], fields: dict[str, str]) -> Callable[..., Column]:
    """A column function from a text column to a struct of ``fields`` (name -> name in ``TYPES``).

    ``make()`` runs once a task and returns what maps the texts of a batch (None for null) to tuples.
    """
    kinds = [TYPES[t][0] for t in fields.values()]
    names = list(fields)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        f = make()
        for batch in batches:
            out = f(batch.to_pylist())
            columns = zip(*out, strict=True) if out else [()] * len(names)
            yield pa.StructArray.from_arrays(
                [pa.array(list(c), kind) for c, kind in zip(columns, kinds, strict=True)], names)

    # The evaluation type is inferred from real annotations, not from their strings.
    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, T.StructType([T.StructField(n, TYPES[t][1]) for n, t in fields.items()]))


def per_pair(make: Callable[[], Callable[[str, str], tuple]], fields: dict[str, str]) -> Callable[..., Column]:
    """As ``per_batch``, of two text columns; ``make()`` gives what maps two texts to a tuple."""
    kinds = [TYPES[t][0] for t in fields.values()]
    names = list(fields)

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        f = make()
        for a, b in batches:
            out = [f(*texts) for texts in zip(a.to_pylist(), b.to_pylist(), strict=True)]
            columns = zip(*out, strict=True) if out else [()] * len(names)
            yield pa.StructArray.from_arrays(
                [pa.array(list(c), kind) for c, kind in zip(columns, kinds, strict=True)], names)

    run.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, T.StructType([T.StructField(n, TYPES[t][1]) for n, t in fields.items()]))


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Writes ``df`` to the shared scratch folder and reads it back: computed once, lineage cut."""
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if(df: DataFrame, most_rows: int) -> DataFrame:
    """Broadcasts a stored frame of at most ``most_rows`` narrow rows; a larger one is shuffled."""
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df
