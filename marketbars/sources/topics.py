"""Message topics: Kafka, or folders of JSON lines with the same columns.

Readers give ``value`` (text) and ``position``, which orders the messages of a batch; rows
of equal position keep their order of arrival.
The Kafka reader and writer need the Kafka connector on the class path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketbars.schemas import Cadence


def kafka_rows(rows: DataFrame, *keep: str) -> DataFrame:
    """Kafka's columns as ``value`` and ``position``; ``keep`` names further ones to carry along.

    Time of arrival first: original and correction of one bar may lie in different partitions.
    Then the partition as a number and the offset, which orders a partition's messages.
    """
    position = F.struct(F.col("timestamp").alias("arrived"), F.col("partition"), F.col("offset"))
    value = F.col("value").cast("string")
    return rows.select(value.alias("value"), position.alias("position"), *keep)


def kafka_options(cadence: Cadence, servers: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "subscribe": cadence.topic}


def stream_kafka(spark: SparkSession, cadence: Cadence, servers: str, **options) -> DataFrame:
    """The topic from its earliest message; later starts resume from the checkpoint."""
    rows = (
        spark.readStream.format("kafka")
        .options(**kafka_options(cadence, servers), startingOffsets="earliest", **options)
        .load()
    )
    return kafka_rows(rows)


def write_kafka(messages: DataFrame, cadence: Cadence, servers: str) -> None:
    """Without a key, so that a busy symbol spreads over all topic partitions."""
    (
        messages.select("value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", cadence.topic)
        .save()
    )


def _file_position() -> Column:
    # Files in order of arrival, splits of a file by offset.
    return F.struct(
        F.col("_metadata.file_modification_time").alias("arrived"),
        F.col("_metadata.file_name").alias("source"),
        F.col("_metadata.file_block_start").alias("offset"),
    )


def read_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select("value", _file_position().alias("position"))


def stream_files(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    rows = spark.readStream.format("text").option("maxFilesPerTrigger", max_files).load(path)
    return rows.select("value", _file_position().alias("position"))


# Compressed files are read by one task each.
FILE_ROWS = 1_000_000


def write_files(messages: DataFrame, path: str) -> None:
    """Compressed: messages repeat their field names, and shrink to a fraction."""
    lines = messages.select("value").write.mode("append")
    lines.option("maxRecordsPerFile", FILE_ROWS).text(path, compression="lz4")
