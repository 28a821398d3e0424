"""Reading and decoding message topics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_topic(
    spark: SparkSession, topic: str, fmt: str = "kafka",
    max_per_trigger: int | None = None, **options: str,
) -> DataFrame:
    """Stream of messages with a ``value`` column.

    ``fmt="kafka"`` subscribes to the topic from the latest offset and does not fail on data
    loss; with a file format the topic is a folder of messages, one a line.
    """
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        reader = (
            reader.option("subscribe", topic)
            .option("startingOffsets", "latest")
            .option("failOnDataLoss", "false")
        )
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
        return reader.options(**options).load()
    if max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    return reader.options(**options).load(topic)


def decode(df: DataFrame, schema: StructType) -> DataFrame:
    """JSON ``value`` as flat columns; a malformed message becomes all nulls."""
    message = F.from_json(F.col("value").cast("string"), schema)
    return df.select(message.alias("d")).select("d.*")


def encode(df: DataFrame) -> DataFrame:
    """Rows as ``key`` (the symbol) and JSON ``value``."""
    return df.select(
        F.col("symbol").alias("key"), F.to_json(F.struct("*")).alias("value")
    )
