"""The stored tables: raw, staging, final and sums per cadence, plus quarantine and a log.

Layout below one root folder, Parquet, partitioned by ``period`` (day of an intraday bar,
month of a daily bar) and ``batch``, so that ingest and merge only read and write the periods
they touch. Writing a batch again replaces exactly its own files, which makes a replay
harmless.

The log says which (period, batch) folders of staging, final and sums are live. A merge writes a
new version of the periods it touches beside the old one, and one appended log file then puts
all of them in force: readers see the old or the new version, and no path is overwritten while
it is read. Readers open the live folders by name; nothing else is listed.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketbars.schemas import ATTEMPTS_SCHEMA, QUARANTINE_SCHEMA, RUNS_SCHEMA, Cadence

PERIOD, BATCH = "period", "batch"
LAYERS = ("raw", "staging", "final", "sums", "latest", "quarantine", "attempts", "runs")
# Layers without periods.
UNDATED = ("latest", "quarantine", "attempts", "runs")
# Log entries: a staged folder, a final version, a version of the sums, a merged batch, a version
# of the last staged times.
STAGED, FINAL, SUMS, MERGED, LATEST = "staged", "final", "sums", "merged", "latest"
LOG_SCHEMA = "kind string, period date, batch string, at bigint"

Folder = tuple[date, str]


@dataclass(frozen=True)
class State:
    """What the log says at one moment: its entries, each with the time it was last written."""

    entries: list[tuple[str, date | None, str, int]]

    def of(self, kind: str) -> list[tuple[date | None, str, int]]:
        return [entry[1:] for entry in self.entries if entry[0] == kind]

    @cached_property
    def staging(self) -> list[Folder]:
        return sorted((period, batch) for period, batch, _ in self.of(STAGED))

    def versions(self, kind: str) -> dict[date, str]:
        """The newest version of every period."""
        newest = sorted(self.of(kind), key=lambda entry: entry[2])
        return {period: batch for period, batch, _ in newest}

    @cached_property
    def outstanding(self) -> list[str]:
        """Staged batches that no merge has covered yet."""
        merged = {batch for _, batch, _ in self.of(MERGED)}
        return sorted({batch for _, batch in self.staging} - merged)

    @cached_property
    def latest(self) -> str | None:
        newest = max(self.of(LATEST), key=lambda entry: entry[2], default=None)
        return newest and newest[1]

    def live(self, layer: str) -> list[Folder]:
        """Folders in force: a few per period, and periods are bounded by the calendar."""
        return self.staging if layer == "staging" else sorted(self.versions(layer).items())


@dataclass(frozen=True)
class Tables:
    """Paths and schemas of one cadence's tables."""

    root: str
    cadence: Cadence

    def path(self, layer: str) -> str:
        names = {
            "raw": f"raw/{self.cadence.bars_table}",
            "staging": f"staging/{self.cadence.bars_table}",
            "final": f"final/{self.cadence.analytics_table}",
            "sums": f"sums/{self.cadence.bars_table}",
            "latest": f"latest/{self.cadence.bars_table}",
            "quarantine": f"quarantine/{self.cadence.bars_table}",
            "attempts": f"attempts/{self.cadence.bars_table}",
            "runs": f"runs/{self.cadence.bars_table}",
            "log": f"log/{self.cadence.bars_table}",
        }
        return f"{self.root.rstrip('/')}/{names[layer]}"

    def schema(self, layer: str) -> T.StructType:
        return {
            "raw": self.cadence.raw_schema,
            "staging": self.cadence.staging_schema,
            "final": self.cadence.final_schema,
            "sums": self.cadence.sums_schema,
            "latest": T.StructType(
                [
                    T.StructField("symbol", T.StringType()),
                    T.StructField("last_update", self.cadence.time_type),
                ]
            ),
            "quarantine": QUARANTINE_SCHEMA,
            "attempts": ATTEMPTS_SCHEMA,
            "runs": RUNS_SCHEMA,
        }[layer]

    def partitions(self, layer: str) -> list[str]:
        return [BATCH] if layer in UNDATED else [PERIOD, BATCH]

    def create(self, spark: SparkSession) -> None:
        """Create missing tables, empty; existing ones stay untouched."""
        for layer in LAYERS:
            empty = spark.createDataFrame([], self._stored(layer))
            empty.write.mode("ignore").partitionBy(*self.partitions(layer)).parquet(
                self.path(layer)
            )
        spark.createDataFrame([], LOG_SCHEMA).write.mode("ignore").parquet(self.path("log"))

    def _stored(self, layer: str) -> T.StructType:
        schema = T.StructType(list(self.schema(layer)))
        for name in self.partitions(layer):
            schema = schema.add(name, T.DateType() if name == PERIOD else T.StringType())
        return schema

    # --- the log -------------------------------------------------------------------------

    def state(self, spark: SparkSession) -> State:
        """The log, read once: a few short rows per batch and merge."""
        log = spark.read.schema(LOG_SCHEMA).parquet(self.path("log"))
        newest = log.groupBy("kind", PERIOD, BATCH).agg(F.max("at"))
        return State([tuple(r) for r in newest.collect()])

    def commit(self, spark: SparkSession, entries: Iterable[tuple[str, date | None, str]]) -> None:
        """Append entries in one file: all of them count, or none. One writer at a time."""
        now = time.time_ns()
        rows = [
            {"kind": kind, "period": period and period.isoformat(), "batch": batch, "at": now}
            for kind, period, batch in entries
        ]
        if rows:
            entries = F.from_json(F.lit(json.dumps(rows)), f"array<struct<{LOG_SCHEMA}>>")
            frame = spark.range(0, 1, 1, 1).select(F.inline(entries))
            frame.write.mode("append").parquet(self.path("log"))

    def live(self, spark: SparkSession, layer: str) -> list[Folder]:
        return self.state(spark).live(layer)

    def outstanding(self, spark: SparkSession) -> list[str]:
        return self.state(spark).outstanding

    def latest(self, spark: SparkSession, state: State | None = None) -> DataFrame:
        """Last staged time of every symbol, as the newest batch left it: one row per symbol."""
        names = self.schema("latest").fieldNames()
        newest = (state or self.state(spark)).latest
        if newest is None:
            return spark.createDataFrame([], self.schema("latest"))
        path = f"{self.path('latest')}/{BATCH}={newest}"
        return spark.read.schema(self.schema("latest")).parquet(path).select(*names)

    # --- rows ----------------------------------------------------------------------------

    def read(
        self,
        spark: SparkSession,
        layer: str,
        where: Callable[[date, str], bool] | None = None,
        state: State | None = None,
        not_batch: str | None = None,
    ) -> DataFrame:
        """Rows of a layer in table columns; of versioned layers only folders ``where`` takes.

        Of the others all, or all but those of one batch.
        """
        names = self.schema(layer).fieldNames()
        if layer not in ("staging", "final", "sums"):
            rows = spark.read.schema(self._stored(layer)).parquet(self.path(layer))
            if not_batch is not None:
                rows = rows.filter(F.col(BATCH) != not_batch)
            return rows.select(*names)
        live = (state or self.state(spark)).live(layer)
        folders = [f for f in live if where is None or where(*f)]
        return self.read_folders(spark, layer, folders).select(*names)

    def read_folders(self, spark: SparkSession, layer: str, folders: list[Folder]) -> DataFrame:
        """Rows of the given folders, partition columns included."""
        if not folders:
            # Known to be empty when planned: a merge into it shuffles nothing.
            return spark.createDataFrame([], self._stored(layer)).limit(0)
        reader = spark.read.schema(self._stored(layer)).option("basePath", self.path(layer))
        return reader.parquet(*[self.folder(layer, f) for f in folders])

    def folder(self, layer: str, folder: Folder) -> str:
        return f"{self.path(layer)}/{PERIOD}={folder[0].isoformat()}/{BATCH}={folder[1]}"

    def arrange(self, rows: DataFrame, batch: str, layer: str = "staging") -> DataFrame:
        """Rows as they are stored: with period and batch, rebalanced and sorted.

        The rebalance hint lets adaptive execution merge small and split large partitions,
        so a period holding a third of the rows is written by many tasks. Files are sorted
        by key: that compresses well and lets scans skip row groups of other symbols. The
        sort starts with the partition columns, so it is the one the writer needs anyway.
        """
        sums = layer == "sums"
        period = self.cadence.sums_period() if sums else self.cadence.period()
        keys = ["symbol", "stretch"] if sums else self.cadence.keys
        dealt = rows.withColumn(PERIOD, period).hint("rebalance", F.col(PERIOD))
        dealt = dealt.withColumn(BATCH, F.lit(batch))
        return dealt.sortWithinPartitions(PERIOD, BATCH, *keys)

    def stage_raw(self, spark: SparkSession, periods: Iterable[date], batch: str) -> DataFrame:
        """Write a batch's raw rows to staging as well; returns them as they are stored.

        They lie in raw by period already, so each task writes what it reads: no shuffle.
        """
        rows = self.read_folders(spark, "raw", [(period, batch) for period in periods])
        self.write(
            rows.sortWithinPartitions(PERIOD, BATCH, *self.cadence.keys),
            "staging",
            batch,
            arranged=True,
        )
        return rows

    def write(self, rows: DataFrame, layer: str, batch: str, arranged: bool = False) -> None:
        """Replace the folders of ``batch`` that ``rows`` covers; all others stay as they are.

        ``arranged`` rows come from ``arrange`` and are not dealt and sorted again.
        """
        columns = self.schema(layer).fieldNames()
        if layer in UNDATED:
            stored = rows.select(*columns).withColumn(BATCH, F.lit(batch))
        elif arranged:
            stored = rows.select(*columns, PERIOD, BATCH)
        else:
            stored = self.arrange(rows.select(*columns), batch, layer)
        (
            stored.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*self.partitions(layer))
            .parquet(self.path(layer))
        )

    @contextmanager
    def scratch(self, rows: DataFrame) -> Iterator[DataFrame]:
        """``rows`` worked out once and kept in files below the root, which go afterwards.

        For rows of a whole batch: a cache of them takes memory, and where that is short several
        times the disk of these files.
        """
        spark = rows.sparkSession
        path = f"{self.root.rstrip('/')}/scratch/{self.cadence.bars_table}/{uuid.uuid4().hex}"
        try:
            rows.write.parquet(path, compression="zstd")
            yield spark.read.schema(rows.schema).parquet(path)
        finally:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)

    def periods_of(self, rows: DataFrame) -> set[date]:
        """The periods of ``rows``: years 1 to 9999, so bounded by the calendar."""
        period = self.cadence.period().alias(PERIOD)
        return {r[0] for r in rows.select(period).distinct().collect()}
