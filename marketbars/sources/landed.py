"""Landed quote responses.

The service's responses are landed as files by whatever fetches them; this package reads
them. An envelope row holds the requested symbol, the HTTP status and the response body.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketbars.schemas import LANDED_SCHEMA


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """Envelopes from JSON lines."""
    return spark.read.schema(LANDED_SCHEMA).json(path)


def stream_landed(spark: SparkSession, path: str, max_bytes: int = 10_000_000_000) -> DataFrame:
    """Envelopes from JSON lines as they land, about ``max_bytes`` of files per batch."""
    reader = spark.readStream.schema(LANDED_SCHEMA).option("maxBytesPerTrigger", max_bytes)
    return reader.json(path)


def read_landed_bodies(spark: SparkSession, path: str) -> DataFrame:
    """One bare response body per file; the file's folder ``symbol=...`` names the symbol."""
    schema = "value string, symbol string"
    return (
        spark.read.schema(schema)
        .option("wholetext", True)
        .text(path)
        .selectExpr("symbol", "200 AS status", "value AS body")
    )
