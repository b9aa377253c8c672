"""The user-visible jobs: extract the delta, ingest it, refresh the analytics."""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Callable, Iterable
from datetime import date, datetime

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketbars.operators import delta
from marketbars.operators.indicators import analytics
from marketbars.operators.metrics import observed
from marketbars.operators.reach import reached_analytics
from marketbars.operators.skew import GROUP_ROWS, small_side
from marketbars.operators.sums import Sums, Touched, corrected, stretch_sums
from marketbars.operators.upsert import affected_rows, upsert
from marketbars.schemas import DEFAULT_SYMBOLS, RUNS_SCHEMA, moment
from marketbars.session import CACHED_DOCUMENTS, cached_by_few_rows, ensure_checkpoint_dir
from marketbars.sources.tables import FINAL, MERGED, SUMS, State, Tables
from marketbars.streaming.ingest import stream_ingest


def extract_delta(
    landed: DataFrame,
    tables: Tables,
    send: Callable[[DataFrame], None],
    symbols=DEFAULT_SYMBOLS,
    run_id: str | None = None,
) -> int:
    """Send the landed bars that staging lacks; returns the number of messages sent.

    Unusable responses go to quarantine with a reason; a rerun under the same ``run_id``
    replaces them instead of adding them again. ``symbols=None`` takes all symbols.
    """
    with cached_by_few_rows(landed.sparkSession, CACHED_DOCUMENTS):
        return _extract_delta(landed, tables, send, symbols, run_id)


def _extract_delta(
    landed: DataFrame,
    tables: Tables,
    send: Callable[[DataFrame], None],
    symbols,
    run_id: str | None,
) -> int:
    cadence, spark = tables.cadence, landed.sparkSession
    if symbols is not None:
        landed = delta.tracked(landed, symbols)
    classified = delta.classify_documents(landed, cadence)
    # Of good documents only what was parsed is read again.
    body = F.when(F.col("reason").isNotNull(), F.col("body"))
    classified = classified.withColumn("body", body).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        entries = delta.document_entries(classified, cadence)
        ensure_checkpoint_dir(spark)
        known = small_side(last_updates(spark, tables, classified).checkpoint())
        fresh = delta.newer_than(entries, known, cadence)
        # Written once: what is counted is what is sent, and ``send`` may do as it likes.
        messages = delta.encode_messages(fresh, cadence).checkpoint()
        sent = messages.count()
        send(messages)
        rejected = delta.rejected_documents(classified).unionByName(
            delta.rejected_entries(classified, cadence)
        )
        tables.write(rejected, "quarantine", f"extract-{run_id or uuid.uuid4().hex}")
    finally:
        classified.unpersist()
    return sent


def extract_stream(
    landed: DataFrame,
    tables: Tables,
    send: Callable[[DataFrame], None],
    checkpoint: str,
    symbols=DEFAULT_SYMBOLS,
) -> int:
    """Send the new bars of all responses landed since the last call; returns messages sent.

    ``landed`` is a stream of landed responses. What has been extracted is remembered in
    ``checkpoint``: no folder is named by the caller or read twice. Each batch looks up the last
    staged times as they are when it starts. A batch that died is done again under its own name:
    its rejects are replaced, its messages sent again (ingest takes a bar once).
    """
    spark, sent = landed.sparkSession, []
    tables.create(spark)

    def extract(batch: DataFrame, batch_id: int) -> None:
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not query:
            raise RuntimeError("the batch does not know its streaming query")
        sent.append(extract_delta(batch, tables, send, symbols, f"{query}-{batch_id}"))

    (
        landed.writeStream.foreachBatch(extract)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return sum(sent)


def refresh(
    spark: SparkSession,
    tables: Tables,
    as_of: datetime | Column | None = None,
    max_group: int = GROUP_ROWS,
    state: State | None = None,
) -> int:
    """Recompute the analytics and sums of all staged bars and merge them; returns affected rows.

    The explicit repair; scheduled runs merge what is outstanding (``refresh_outstanding``).
    """
    cadence, state = tables.cadence, state or tables.state(spark)
    if not state.staging:
        return 0
    options = {"max_group": max_group} if cadence.name == "intraday" else {}
    bars = tables.read_folders(spark, "staging", state.staging)
    bars = bars.select(*tables.schema("staging").fieldNames())
    rows = analytics(bars, cadence, _stamp(as_of), **options)
    staged = {period for period, _ in state.staging}
    version = f"v-{uuid.uuid4().hex}"
    tables.write(stretch_sums(bars, cadence), "sums", version)
    periods = staged | set(state.versions(FINAL))
    sums = {cadence.sums_period_of(period) for period in staged}
    merged = {batch for _, batch in state.staging}
    return _merge(spark, rows, tables, state, version, periods, sums, merged)


def refresh_batches(
    spark: SparkSession,
    tables: Tables,
    batches: list[str],
    as_of: datetime | Column | None = None,
    max_group: int = GROUP_ROWS,
    state: State | None = None,
) -> int:
    """Merge only the analytics that the named ingest batches can have changed.

    Batches that wait for their first merge are taken along, since the stored sums must count all
    staged bars or none of a batch. Values equal a full refresh; untouched rows also keep their
    ``last_refreshed``.
    """
    cadence, state = tables.cadence, state or tables.state(spark)
    if state.versions(FINAL) and not state.versions(SUMS):
        return refresh(spark, tables, as_of, max_group, state)
    new = set(state.outstanding)
    wanted = new | set(batches)
    if not any(batch in wanted for _, batch in state.staging):
        return 0
    ensure_checkpoint_dir(spark)

    def staged(of: set[str]) -> DataFrame:
        return tables.read(spark, "staging", lambda _, batch: batch in of, state)

    arrived = staged(wanted)
    change = stretch_sums(staged(new), cadence).checkpoint()
    fresh_ones = touched = Touched.of(change)
    if wanted != new:
        touched = Touched.of(stretch_sums(arrived, cadence).checkpoint())
    # The sums of the periods in question with what arrived: written now, in force once merged.
    version = f"v-{uuid.uuid4().hex}"
    fresh = {cadence.sums_period_of(day) for day in fresh_ones.dates}
    stored = tables.read(spark, "sums", lambda period, _: period in fresh, state)
    if fresh:
        tables.write(corrected(stored, change, cadence), "sums", version)
    folders = state.versions(SUMS) | dict.fromkeys(fresh, version)

    def read_sums(periods: Iterable[date]) -> DataFrame:
        found = tables.read_folders(spark, "sums", [(p, folders[p]) for p in periods])
        return found.select(*tables.schema("sums").fieldNames())

    def read_bars(periods: Iterable[date]) -> DataFrame:
        wanted = set(periods)
        return tables.read(spark, "staging", lambda period, _: period in wanted, state)

    sums = Sums(sorted(folders), read_sums)
    reached = reached_analytics(
        read_bars, sums, arrived, cadence, _stamp(as_of), max_group, touched
    )
    return _merge(
        spark, reached.rows, tables, state, version, reached.periods, fresh, wanted
    )


def refresh_outstanding(
    spark: SparkSession,
    tables: Tables,
    as_of: datetime | Column | None = None,
    max_group: int = GROUP_ROWS,
) -> int:
    """Merge the batches staged since the last merge, and those a failed merge left over.

    The first merge of a table takes everything.
    """
    state = tables.state(spark)
    if not state.outstanding:
        return 0
    if not state.versions(FINAL):
        return refresh(spark, tables, as_of, max_group, state)
    return refresh_batches(spark, tables, state.outstanding, as_of, max_group, state)


def last_updates(spark: SparkSession, tables: Tables, classified: DataFrame) -> DataFrame:
    """Last staged time of every symbol in the landed documents, without reading any bar."""
    good = classified.filter(F.col("reason").isNull()).select("symbol").distinct()
    return tables.latest(spark).join(good, "symbol", "left_semi")


def ingest(
    messages: DataFrame, tables: Tables, checkpoint: str, repeats_within: str | None = None
) -> dict[str, int]:
    """Store what the topic holds now; returns message counts summed over its batches.

    The counts of every batch, taken while it was stored, are kept in the ``runs`` table, with the
    time that the stream's progress reports for it.
    """
    spark, counted = messages.sparkSession, {}
    tables.create(spark)
    query = stream_ingest(
        messages, tables, checkpoint, on_batch=counted.__setitem__, repeats_within=repeats_within
    )
    query.awaitTermination()
    seconds = {
        f"{query.id}-{p['batchId']}": p["batchDuration"] / 1000 for p in query.recentProgress
    }
    rows = [(name, *totals.values(), seconds.get(name)) for name, totals in counted.items()]
    if rows:
        # A row per batch of one run.
        tables.write(spark.createDataFrame(rows, RUNS_SCHEMA).coalesce(1), "runs", f"{query.runId}")
    totals: Counter[str] = Counter()
    for of in counted.values():
        totals.update(of)
    return dict(totals)


def run(
    spark: SparkSession,
    tables: Tables,
    landed: DataFrame,
    send: Callable[[DataFrame], None],
    receive: Callable[[], DataFrame],
    checkpoint: str,
    as_of: datetime | Column | None = None,
    symbols=DEFAULT_SYMBOLS,
    run_id: str | None = None,
) -> dict[str, int]:
    """One scheduled run: extract, ingest, merge what is new. Scheduling is left to the caller.

    ``landed`` are the responses of this run, or a stream of all responses (``landed`` beside the
    ingest's ``checkpoint`` then remembers what was extracted).
    """
    tables.create(spark)
    if landed.isStreaming:
        offsets = f"{checkpoint.rstrip('/')}-landed"
        sent = extract_stream(landed, tables, send, offsets, symbols)
    else:
        sent = extract_delta(landed, tables, send, symbols, run_id)
    totals = ingest(receive(), tables, checkpoint)
    affected = refresh_outstanding(spark, tables, as_of)
    return {
        "messages_sent": sent,
        "messages_processed": totals.get("n_processed", 0),
        "messages_rejected": totals.get("n_rejected", 0),
        "rows_affected": affected,
    }


def _stamp(as_of: datetime | Column | None) -> Column:
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else moment(as_of)


def _merge(
    spark: SparkSession,
    rows: DataFrame,
    tables: Tables,
    state: State,
    version: str,
    periods: set[date],
    sums: set[date],
    batches: set[str],
) -> int:
    """Write a new version of the ``periods`` that ``rows`` reach, then put it in force.

    One commit does so for final rows and sums, and names the batches that both now count.
    """
    affected = 0
    if periods:
        target = tables.read(spark, "final", lambda period, _: period in periods, state)
        merged, counted = observed(upsert(target, rows, tables.cadence), affected=affected_rows())
        tables.write(merged, "final", version)
        affected = counted.get["affected"] or 0
    tables.commit(
        spark,
        [(FINAL, p, version) for p in sorted(periods)]
        + [(SUMS, p, version) for p in sorted(sums)]
        + [(MERGED, None, b) for b in sorted(batches)],
    )
    return affected
