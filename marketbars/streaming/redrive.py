"""Rejected messages tried again: accepted once mended, parked when they keep failing."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketbars.operators.messages import classify_messages
from marketbars.operators.skew import GROUP_ROWS
from marketbars.session import ensure_checkpoint_dir
from marketbars.sources.tables import Tables
from marketbars.streaming.ingest import ingest_batch

# A message rejected so often is parked.
MOST_ATTEMPTS = 3
WAITING, ACCEPTED, PARKED = "waiting", "accepted", "parked"
# Not a fault of the message: its bar is stored already.
FINAL_REASON = "duplicate_key"


def retries(
    spark: SparkSession,
    tables: Tables,
    most: int = MOST_ATTEMPTS,
    without: str | None = None,
) -> DataFrame:
    """message_id, value, copies, attempts, reason and status of every rejected message.

    Equal texts are one message, however often they were rejected. ``reason`` is the newest one,
    NULL once accepted. ``without`` leaves out what one batch tried: what a replay of it starts
    from. Copies are counted and attempts looked up by the hash of a text, partially aggregated,
    so that a text that comes again and again does not gather in one task.
    """
    quarantine = tables.read(spark, "quarantine", not_batch=without)
    rejected = quarantine.filter((F.col("source") == "message") & (F.col("reason") != FINAL_REASON))
    messages = rejected.groupBy(F.sha2("value", 256).alias("message_id")).agg(
        F.max("value").alias("value"),
        F.count("*").alias("copies"),
        F.max("reason").alias("first_reason"),
    )
    tried = (
        tables.read(spark, "attempts", not_batch=without)
        .groupBy("message_id")
        .agg(
            F.count("*").cast("int").alias("attempts"),
            F.max_by("reason", "attempt").alias("last_reason"),
            F.bool_or(F.col("reason").isNull()).alias("accepted"),
        )
    )
    attempts = F.coalesce("attempts", F.lit(0))
    status = (
        F.when(F.col("accepted"), ACCEPTED)
        .when(attempts >= most, PARKED)
        .otherwise(WAITING)
    )
    reason = F.when(attempts == 0, F.col("first_reason")).when(
        ~F.col("accepted"), F.col("last_reason")
    )
    return messages.join(tried, "message_id", "left").select(
        "message_id",
        "value",
        "copies",
        attempts.alias("attempts"),
        reason.alias("reason"),
        status.alias("status"),
    )


def redrive(
    spark: SparkSession,
    tables: Tables,
    mend: Callable[[Column], Column] = lambda value: value,
    run_id: str | None = None,
    most: int = MOST_ATTEMPTS,
    max_group: int = GROUP_ROWS,
) -> dict[str, int]:
    """Try all waiting messages again, their texts passed through ``mend``; returns counts.

    Bars of messages that are good now are staged like those of any batch, so a bar is stored
    once, whatever else brought it meanwhile. The others count one attempt more. A rerun under the
    same ``run_id`` starts from what the first one found and replaces what it wrote.
    """
    batch = f"redrive-{run_id or uuid.uuid4().hex}"
    ensure_checkpoint_dir(spark)
    waiting = retries(spark, tables, most, without=batch).filter(F.col("status") == WAITING)
    tried = waiting.select(
        "message_id", mend(F.col("value")).alias("value"), (F.col("attempts") + 1).alias("attempt")
    )
    tried = tried.checkpoint()
    # Judged once; of the bars only those of good messages are stored.
    judged = classify_messages(tried, tables.cadence)
    judged = judged.select("message_id", "attempt", "reason", "value")
    judged = judged.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _stored(judged, tables, batch, most, max_group)
    finally:
        judged.unpersist()


def _stored(
    judged: DataFrame, tables: Tables, batch: str, most: int, max_group: int
) -> dict[str, int]:
    counts = judged.agg(
        F.count("*").alias("n_retried"),
        F.count_if(F.col("reason").isNull()).alias("n_accepted"),
        F.count_if(F.col("reason").isNotNull() & (F.col("attempt") >= most)).alias("n_parked"),
    ).first()
    position = F.struct(F.col("message_id").alias("message"))
    good = judged.filter(F.col("reason").isNull())
    messages = good.select("value", position.alias("position"))
    ingest_batch(messages, tables, batch, max_group, keep_rejected=False)
    tables.write(judged.drop("value"), "attempts", batch)
    return counts.asDict()
