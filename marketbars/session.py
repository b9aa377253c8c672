"""Session settings the package is written for, and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Adaptive execution resizes shuffles, splits skewed join partitions and turns a join into
# a broadcast only after the small side's real size is known.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    # Checkpoint files go when what was checkpointed is no longer used.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

CACHED_ROWS_SETTING = "spark.sql.inMemoryColumnarStorage.batchSize"
# Rows of a cached batch, see ``cached_by_few_rows``; landed documents hold hundreds of bars each.
CACHED_ROWS, CACHED_DOCUMENTS = 500, 10


def build_session(
    app: str = "marketbars", master: str | None = None, extra: dict[str, str] | None = None
) -> SparkSession:
    """A session with the package settings; ``master`` is left to spark-submit by default."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared folder named by ``spark.checkpoint.dir``.

    Only where that setting is absent (local tests) is a temporary folder used.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="marketbars-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Keep the session's checkpoint folder; set one only where none is set."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(work_dir(spark, "checkpoints"))


@contextmanager
def having(spark: SparkSession, setting: str, value: int | str) -> Iterator[None]:
    """The session with another value of a setting, and as it was afterwards."""
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, str(value))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)


def cached_by_few_rows(spark: SparkSession, rows: int = CACHED_ROWS):
    """What is first computed in here and persisted is cached in batches of ``rows`` rows.

    A task that stores a cached partition holds up to a hundred of its batches at once
    (``spark.serializer.objectStreamReset``), by default of 4 MB each, whatever its heap.
    """
    return having(spark, CACHED_ROWS_SETTING, rows)
