"""Bars and final rows kept by symbol, so that windows and merges need not shuffle them again.

A bucketed table deals symbols to a fixed number of buckets when it is written. Series then lie
together when they are read: the windows over them, and the merge of two tables bucketed alike,
start without an exchange. A symbol too large for one task is not put into a bucket; it is kept
beside them in plain files, and goes the way of hot symbols.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketbars.operators.indicators import analytics
from marketbars.operators.skew import GROUP_ROWS, hot_groups
from marketbars.operators.upsert import upsert
from marketbars.schemas import Cadence

# A merge on symbol and time needs no exchange where both sides lie by symbol alone; Spark asks
# for all keys unless told otherwise.
CO_LOCATED = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}


# Rows of a bucket that one task sorts and merges with ease.
BUCKET_ROWS = 500_000


def buckets_for(rows: int, least: int) -> int:
    """Buckets for so many rows: ``least``, and as many more as keep a bucket one task's work."""
    return max(least, math.ceil(rows / BUCKET_ROWS))


@dataclass(frozen=True)
class Bucketed:
    """Rows of a table: those in buckets, and those of symbols too large for one."""

    buckets: DataFrame
    hot: DataFrame | None = None

    def rows(self) -> DataFrame:
        return self.buckets if self.hot is None else self.buckets.unionByName(self.hot)


def write_bucketed(
    rows: DataFrame, cadence: Cadence, path: str, buckets: int, max_group: int = GROUP_ROWS
) -> Bucketed:
    """Store rows below ``path``: by symbol in ``buckets`` buckets, sorted by time within them.

    ``buckets`` is for the data to come (``buckets_for``): rows of a bucket, a few symbols, are one
    task's work.
    Symbols of more than ``max_group`` rows stay outside. The table gets a name of its own in the
    session's catalog; its files lie below ``path``.
    """
    spark = rows.sparkSession
    hot = hot_groups(rows, ["symbol"], max_group)
    cold = rows if hot is None else rows.join(hot, "symbol", "left_anti")
    name = f"bucketed_{uuid.uuid4().hex}"
    (
        # One file a bucket; the buckets are as even as the symbols.
        cold.repartition(buckets, "symbol")
        .write.bucketBy(buckets, "symbol")
        .sortBy("symbol", cadence.time_col)
        .option("path", f"{path}/buckets")
        .format("parquet")
        .saveAsTable(name)
    )
    table = spark.table(name)
    if hot is None:
        return Bucketed(table)
    rows.join(hot, "symbol", "left_semi").write.parquet(f"{path}/hot")
    return Bucketed(table, spark.read.schema(rows.schema).parquet(f"{path}/hot"))


def bucketed_analytics(
    bars: Bucketed, cadence: Cadence, as_of: Column, max_group: int = GROUP_ROWS
) -> Bucketed:
    """Final-table rows of all bars; those in buckets are worked out where they lie."""
    rows = analytics(bars.buckets, cadence, as_of, gathered=True)
    if bars.hot is None:
        return Bucketed(rows)
    options = {"max_group": max_group} if cadence.name == "intraday" else {}
    return Bucketed(rows, analytics(bars.hot, cadence, as_of, **options))


def bucketed_upsert(target: Bucketed, source: Bucketed, cadence: Cadence) -> DataFrame:
    """``upsert`` of two tables bucketed alike; a symbol may be hot on one side only."""
    if target.hot is None and source.hot is None:
        return upsert(target.buckets, source.buckets, cadence)
    sides = [side.hot for side in (target, source) if side.hot is not None]
    hot = sides[0].select("symbol")
    hot = hot if len(sides) == 1 else hot.unionByName(sides[1].select("symbol"))
    # As many as rows / max_group at most.
    hot = F.broadcast(hot.distinct())
    cold = [side.buckets.join(hot, "symbol", "left_anti") for side in (target, source)]
    large = [side.rows().join(hot, "symbol", "left_semi") for side in (target, source)]
    return upsert(*cold, cadence).unionByName(upsert(*large, cadence))
