"""Topic messages into raw, staging and quarantine, batch by batch."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import ExitStack

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marketbars.functions.documents import bar_message
from marketbars.operators.dedupe import arrival, mark_duplicates, met_again
from marketbars.operators.delta import latest_per_symbol
from marketbars.operators.messages import classify_messages, good_bars, rejected_messages
from marketbars.operators.metrics import observed, total_columns
from marketbars.operators.skew import GROUP_ROWS
from marketbars.session import cached_by_few_rows
from marketbars.sources.tables import LATEST, STAGED, Tables
from marketbars.streaming.repeats import state_on_disk, without_repeats


def ingest_batch(
    messages: DataFrame,
    tables: Tables,
    batch: str,
    max_group: int = GROUP_ROWS,
    keep_rejected: bool = True,
) -> dict[str, int]:
    """Store one batch of ``value`` / ``position`` rows; returns its message counts.

    Rejected messages go to quarantine, unless their keeper says that they are there already.

    All three outputs are derived from the same input and replace only the files of
    ``batch``. A replay after a failure between two writes therefore completes the missing
    one, and bars staged by the failed attempt do not count as duplicates.
    """
    with cached_by_few_rows(messages.sparkSession):
        return _ingest_batch(messages, tables, batch, max_group, keep_rejected)


def _ingest_batch(
    messages: DataFrame, tables: Tables, batch: str, max_group: int, keep_rejected: bool
) -> dict[str, int]:
    cadence, spark = tables.cadence, messages.sparkSession
    # Row ids grow along a split, so lines of one file keep their order.
    order = F.struct("position.*", F.monotonically_increasing_id().alias("row"))
    messages = messages.select("value", order.alias("position"))
    # Counted while they are written: no pass of its own.
    classified, totals = observed(classify_messages(messages, cadence), **total_columns())
    # Of good messages only the bars are read again.
    bad = F.col("reason").isNotNull()
    classified = classified.withColumn("value", F.when(bad, F.col("value")))
    with ExitStack() as kept:
        classified = kept.enter_context(tables.scratch(classified))
        bars = good_bars(classified, cadence, position="position")
        came, state = arrival(bars, cadence), tables.state(spark)
        staged = tables.read(
            spark, "staging", lambda period, name: period in came.periods and name != batch, state
        )
        met = met_again(bars, staged, cadence.keys, came)
        marked = mark_duplicates(bars, staged, cadence.keys, "position", max_group, came, met)
        names = tables.schema("raw").fieldNames()
        marked = marked.select(*names, "duplicate")
        if met.n:
            # Ranked once.
            marked = kept.enter_context(tables.scratch(marked))
        rows = marked.filter(~F.col("duplicate")).select(*names)
        tables.write(rows, "raw", batch)
        periods = sorted(tables.periods_of(rows) if met.n else came.periods)
        copies = marked.filter("duplicate").select(
            F.lit("message").alias("source"),
            bar_message(cadence).alias("value"),
            F.lit("duplicate_key").alias("reason"),
        )
        rejected = copies
        if keep_rejected:
            rejected = rejected_messages(classified, "message").unionByName(copies)
        tables.write(rejected, "quarantine", batch)
        # Raw and staging hold the same rows: dealt once for both.
        accepted = tables.stage_raw(spark, periods, batch)
        # From here on the bars count, for readers, the next merge and the next extract.
        if periods:
            version = f"{batch}-{uuid.uuid4().hex}"
            newest = tables.latest(spark, state).unionByName(latest_per_symbol(accepted, cadence))
            newest = newest.groupBy("symbol").agg(F.max("last_update").alias("last_update"))
            tables.write(newest, "latest", version)
            staged_now = [(STAGED, period, batch) for period in periods]
            tables.commit(spark, [*staged_now, (LATEST, None, version)])
    return dict(totals.get)


def stream_ingest(
    messages: DataFrame,
    tables: Tables,
    checkpoint: str,
    max_group: int = GROUP_ROWS,
    on_batch: Callable[[str, dict[str, int]], None] = lambda batch, totals: None,
    repeats_within: str | None = None,
) -> StreamingQuery:
    """Ingest everything the topic holds now, then stop.

    Messages that come again, word for word, ``repeats_within`` a time are dropped before they
    are stored or counted (``without_repeats``); without it all go to the tables' key check.

    ``on_batch`` receives name and message counts of every stored batch.

    Offsets live in ``checkpoint``: the next start resumes behind the last finished batch.
    Batch names start with the query's id, so a new checkpoint never overwrites old batches.
    """
    context = messages.sparkSession.sparkContext
    if repeats_within is not None:
        messages = without_repeats(messages, repeats_within)

    def store(batch: DataFrame, batch_id: int) -> None:
        query = context.getLocalProperty("sql.streaming.queryId")
        if not query:
            raise RuntimeError("the batch does not know its streaming query")
        name = f"{query}-{batch_id}"
        on_batch(name, ingest_batch(batch, tables, name, max_group))

    with state_on_disk(messages.sparkSession):
        return (
            messages.writeStream.foreachBatch(store)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
