"""Every operator as a query over the test tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketbars.operators import delivery, delta, metrics
from marketbars.operators import messages as msg
from marketbars.operators.constraints import constraint_violations
from marketbars.operators.dedupe import arrival, first_write_wins, known_keys
from marketbars.operators.indicators import analytics, bar_columns, generated_columns, indicators
from marketbars.operators.reach import Reader, reached_analytics
from marketbars.operators.sums import sums_of
from marketbars.operators.upsert import upsert
from marketbars.plans import jobs
from marketbars.schemas import DAILY, INTRADAY, PRICE, Cadence, moment
from marketbars.session import work_dir
from marketbars.sources import fixtures as fx
from marketbars.sources import landed as landed_source
from marketbars.sources import topics
from marketbars.sources.bucketed import (
    bucketed_analytics,
    bucketed_upsert,
    buckets_for,
    write_bucketed,
)
from marketbars.sources.tables import Tables
from marketbars.streaming.ingest import ingest_batch
from marketbars.streaming.redrive import redrive, retries

Query = Callable[[SparkSession, str], DataFrame]

FIRST_RUN = datetime(2025, 1, 31, 12, 0)
SECOND_RUN = datetime(2025, 1, 31, 13, 0)
# Bars before these times count as stored by an earlier run.
STAGED_UNTIL = {"intraday": "2024-01-20 00:00:00", "daily": "1998-01-01"}
# The upsert's target ends here, its source starts at STAGED_UNTIL.
TARGET_UNTIL = {"intraday": "2024-01-25 00:00:00", "daily": "2000-01-01"}
LATE_MONTH = "1995-03-01"
LATE_FROM, LATE_UNTIL = "2024-01-10 12:00:00", "2024-01-10 18:00:00"
TRACKED = ("click", "purchase", "view")
UNSTAGED = {"intraday": "signup", "daily": "S1"}
# Bars per landed document, by event number.
PAGE = 500
# Landed documents per file.
FILE_DOCUMENTS = 2000
# Small enough to send the test tables through the hot-group paths.
HOT_GROUP = 50
# Some of the symbols have more bars than this, before or after the split of the upsert.
HOT_BUCKET = 130
# At least; more bars take more.
BUCKETS = 8


def bars_of(spark: SparkSession, sf_dir: str, cadence: Cadence, *extra: str) -> DataFrame:
    if cadence.name == "intraday":
        return fx.intraday_bars(spark, sf_dir, extra=extra)
    return fx.daily_bars(spark, sf_dir)


def kept_bars(spark: SparkSession, sf_dir: str, cadence: Cadence, base: str) -> DataFrame:
    """The bars, worked out once and written, for queries that read them again and again."""
    return kept(bars_of(spark, sf_dir, cadence), base)


def kept(bars: DataFrame, base: str) -> DataFrame:
    bars.write.parquet(f"{base}/bars")
    return bars.sparkSession.read.schema(bars.schema).parquet(f"{base}/bars")


def _time(cadence: Cadence) -> Column:
    return F.col(cadence.time_col)


def _at(cadence: Cadence, text: str) -> Column:
    return F.lit(text).cast(cadence.time_type)


def _indicator(cadence: Cadence, *columns: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        bars = bars_of(spark, sf_dir, cadence)
        return indicators(bars, cadence).select(*cadence.keys, *columns)

    return query


def _generated(cadence: Cadence, *columns: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = bar_columns(bars_of(spark, sf_dir, cadence), cadence)
        return generated_columns(rows, cadence).select(*cadence.keys, *columns)

    return query


def _analytics(cadence: Cadence, **options) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        bars = bars_of(spark, sf_dir, cadence)
        return analytics(bars, cadence, moment(FIRST_RUN), **options)

    return query


def symbol_universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delta.tracked(fx.intraday_bars(spark, sf_dir), TRACKED)


def latest_per_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delta.latest_per_symbol(fx.intraday_bars(spark, sf_dir, "user_id"), INTRADAY)


def latest_bar_per_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delta.latest_bar_per_symbol(fx.intraday_bars(spark, sf_dir, "user_id"), INTRADAY)


# --- documents -------------------------------------------------------------------------


def landed(spark: SparkSession, sf_dir: str, cadence: Cadence) -> DataFrame:
    """All bars as landed responses, a bounded number of bars per response."""
    if cadence.name == "intraday":
        page = F.floor(F.col("event_id") / PAGE).alias("page")
        documents = fx.documents(bars_of(spark, sf_dir, cadence, "event_id"), cadence, page)
    else:
        documents = fx.documents(
            bars_of(spark, sf_dir, cadence), cadence, F.year("date").alias("page")
        )
    return documents.withColumn("status", F.lit(200))


def _land(cadence: Cadence) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        classified = delta.classify_documents(landed(spark, sf_dir, cadence), cadence)
        entries = delta.document_entries(classified, cadence)
        return entries.select(
            *cadence.keys,
            "last_refreshed",
            *[
                F.col("fields")[field].try_cast(kind).alias(name)
                for field, name, kind in (
                    ("1. open", "open_price", PRICE),
                    ("2. high", "high_price", PRICE),
                    ("3. low", "low_price", PRICE),
                    ("4. close", "close_price", PRICE),
                    ("5. volume", "volume", "bigint"),
                )
            ],
        )

    return query


def validate_api(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses with ten kinds of defects, one kind per page; symbols' pages per reason."""
    documents = landed(spark, sf_dir, INTRADAY)
    kind, body = F.pmod(F.col("page"), F.lit(11)), F.col("body")
    broken = (
        F.when(kind == 1, F.lit('{"Error Message": "unknown symbol"}'))
        .when(kind == 2, F.lit('{"Note": null}'))
        .when(kind == 3, F.replace(body, F.lit('"Meta Data"'), F.lit('"Other"')))
        .when(kind == 4, F.replace(body, F.lit('"Time Series (5min)"'), F.lit('"Other"')))
        .when(kind == 5, F.concat(F.lit("["), body, F.lit("]")))
        .when(kind == 6, F.replace(body, F.lit("}}"), F.lit("")))
        .when(kind == 7, F.replace(body, F.lit('Refreshed":"2'), F.lit('Refreshed":"x')))
        .when(kind == 8, F.lit('{"Meta Data": {}, "Time Series (5min)": {}}'))
        .when(kind == 9, F.replace(body, F.lit('Refreshed":"2'), F.lit('Refreshed":"12')))
        .otherwise(body)
    )
    defective = documents.withColumn("body", broken).withColumn(
        "status", F.when(kind == 0, 503).otherwise(F.col("status"))
    )
    classified = delta.classify_documents(defective, INTRADAY)
    # A page of many bars is several documents.
    return classified.groupBy(F.coalesce("reason", F.lit("ok")).alias("reason")).agg(
        F.count_distinct(F.struct("symbol", "page")).alias("n")
    )


def _staged(spark: SparkSession, sf_dir: str, cadence: Cadence) -> DataFrame:
    return bars_of(spark, sf_dir, cadence).filter(
        (_time(cadence) < _at(cadence, STAGED_UNTIL[cadence.name]))
        & (F.col("symbol") != UNSTAGED[cadence.name])
    )


def _delta(cadence: Cadence) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        staged = _staged(spark, sf_dir, cadence)
        sent = delta.delta_messages(landed(spark, sf_dir, cadence), staged, cadence)
        return msg.parse_messages(sent, cadence).drop("raw_data")

    return query


def _extract_stream(cadence: Cadence) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Documents landing in two arrivals, extracted by a stream; what was sent."""
        base = work_dir(spark, f"extract-{cadence.name}")
        tables = Tables(f"{base}/tables", cadence)
        tables.create(spark)
        staged = fx.messages(_staged(spark, sf_dir, cadence), cadence)
        ingest_batch(staged.withColumn("position", F.struct(F.lit(0))), tables, "staged")
        documents = landed(spark, sf_dir, cadence)
        for odd in (0, 1):
            arrived = documents.filter(F.col("page") % 2 == odd)
            # Compressed files are read by one task each.
            envelopes = arrived.select("symbol", "status", "body").write.mode("append")
            envelopes.option("maxRecordsPerFile", FILE_DOCUMENTS).json(
                f"{base}/landed", compression="lz4"
            )
            jobs.extract_stream(
                landed_source.stream_landed(spark, f"{base}/landed"),
                tables,
                lambda messages: topics.write_files(messages, f"{base}/topic"),
                f"{base}/offsets",
                symbols=None,
            )
        return msg.parse_messages(topics.read_files(spark, f"{base}/topic"), cadence).drop("raw_data")

    return query


# --- messages --------------------------------------------------------------------------


def _emit(cadence: Cadence) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        entries = bars_of(spark, sf_dir, cadence).select(
            *cadence.keys, fx.time_text(cadence).alias("time_text"), fx.payload().alias("fields")
        )
        return delta.encode_messages(entries, cadence, *cadence.keys)

    return query


def _parse(cadence: Cadence, *drop: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        texts = fx.messages(bars_of(spark, sf_dir, cadence), cadence)
        return msg.parse_messages(texts, cadence).drop(*drop)

    return query


def raw_audit_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parse(INTRADAY)(spark, sf_dir).select("symbol", "timestamp", "raw_data")


def defective_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages, most of them with a defect picked by event number."""
    texts = fx.messages(
        fx.intraday_bars(spark, sf_dir, extra=("event_id",)), INTRADAY, "event_id"
    )
    kind, value = F.pmod(F.col("event_id"), F.lit(15)), F.col("value")
    broken = (
        F.when(kind == 0, F.lit('{"terminate": true}'))
        .when(kind == 1, F.lit('{"Error Message": "unknown symbol"}'))
        .when(kind == 2, F.replace(value, F.lit('{"symbol"'), F.lit('{"Note":null,"symbol"')))
        .when(kind == 3, F.lit('{"symbol":"","data":{}}'))
        .when(kind == 4, F.replace(value, F.lit('"data"'), F.lit('"other"')))
        .when(kind == 5, F.concat(F.lit("["), value, F.lit("]")))
        .when(kind == 6, F.lit("null"))
        .when(kind == 7, F.concat(F.lit("{"), value))
        .when(kind == 8, F.replace(value, F.lit('"4. close"'), F.lit('"4. other"')))
        .when(kind == 9, F.replace(value, F.lit('"5. volume":"'), F.lit('"5. volume":"1.')))
        .when(kind == 10, F.replace(value, F.lit('"1. open":"'), F.lit('"1. open":"nan')))
        .when(kind == 11, F.replace(value, F.lit('{"2024-'), F.lit('{"2024-13-')))
        .when(kind == 12, F.replace(value, F.lit('{"2024-'), F.lit('{"12345-')))
        .when(kind == 13, F.replace(value, F.lit('{"2024-'), F.lit('{"0000-')))
        .otherwise(value)
    )
    return texts.select("event_id", broken.alias("value"))


def validate_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    classified = msg.classify_messages(defective_messages(spark, sf_dir), INTRADAY)
    return classified.groupBy(F.coalesce("reason", F.lit("ok")).alias("reason")).agg(
        F.count("*").alias("n")
    )


def message_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.message_totals(
        msg.classify_messages(defective_messages(spark, sf_dir), INTRADAY)
    )


# --- ingest ----------------------------------------------------------------------------


def stage_first_write_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every bar sent twice, the second time with another close, over a half-filled table."""
    bars = fx.intraday_bars(spark, sf_dir, extra=("event_id",))
    again = bars.withColumn("close_price", (F.col("close_price") + 1).cast(PRICE))
    sent = bars.withColumn("position", F.struct(F.lit(1).alias("send"), "event_id"))
    resent = again.withColumn("position", F.struct(F.lit(2).alias("send"), "event_id"))
    staged = bars.filter(_time(INTRADAY) < _at(INTRADAY, STAGED_UNTIL["intraday"]))
    batch = resent.unionByName(sent)
    accepted = first_write_wins(
        batch, staged, INTRADAY.keys, "position", came=arrival(batch, INTRADAY)
    )
    return accepted.select(*INTRADAY.staging_schema.fieldNames())


def staged_keys_compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of all staged keys, those that a batch of some symbols and days is compared with."""
    bars = fx.intraday_bars(spark, sf_dir, extra=("event_id",))
    staged = bars.filter(F.col("event_id") % 3 != 0)
    until = _at(INTRADAY, STAGED_UNTIL["intraday"])
    days = _time(INTRADAY).between(_at(INTRADAY, LATE_FROM), until)
    batch = bars.filter(days & F.col("symbol").isin(*TRACKED))
    return known_keys(staged, batch, INTRADAY.keys, arrival(batch, INTRADAY))


def stage_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the batch are copies of one key; only the copy sent first is accepted."""
    bars = fx.intraday_bars(spark, sf_dir, extra=("event_id",))
    # Read from the rows, as a constant would be taken out of the joins on it.
    hot = F.concat(F.lit("HOT"), F.coalesce(F.substring("symbol", 1, 0), F.lit("")))
    copies = bars.withColumn("symbol", hot).withColumn(
        "timestamp", _at(INTRADAY, STAGED_UNTIL["intraday"])
    )
    batch = bars.unionByName(copies).withColumnRenamed("event_id", "position")
    accepted = first_write_wins(
        batch, bars.filter(F.lit(False)), INTRADAY.keys, "position", max_group=HOT_GROUP
    )
    return accepted.select(*INTRADAY.staging_schema.fieldNames())


def _stream(cadence: Cadence) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        """All bars as messages in a folder, streamed into the tables; the staged rows."""
        base = work_dir(spark, f"stream-{cadence.name}")
        topics.write_files(
            fx.messages(bars_of(spark, sf_dir, cadence), cadence), f"{base}/topic"
        )
        tables = Tables(f"{base}/tables", cadence)
        stream = topics.stream_files(spark, f"{base}/topic")
        jobs.ingest(stream, tables, f"{base}/offsets")
        return tables.read(spark, "staging")

    return query


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The defective messages streamed into the tables; rejected messages per reason."""
    base = work_dir(spark, "stream-quarantine")
    topics.write_files(defective_messages(spark, sf_dir), f"{base}/topic")
    tables = Tables(f"{base}/tables", INTRADAY)
    stream = topics.stream_files(spark, f"{base}/topic")
    jobs.ingest(stream, tables, f"{base}/offsets")
    rejected = tables.read(spark, "quarantine")
    return rejected.groupBy("source", "reason").agg(F.count("*").alias("n"))


def redrive_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The defective messages tried again four times, one kind of defect mended; copies by fate."""
    base = work_dir(spark, "redrive")
    topics.write_files(defective_messages(spark, sf_dir), f"{base}/topic")
    tables = Tables(f"{base}/tables", INTRADAY)
    jobs.ingest(topics.stream_files(spark, f"{base}/topic"), tables, f"{base}/offsets")
    for attempt in range(4):
        redrive(
            spark,
            tables,
            mend=lambda value: F.replace(value, F.lit('"4. other"'), F.lit('"4. close"')),
            run_id=str(attempt),
        )
    found = retries(spark, tables).groupBy("status", "reason", "attempts")
    return found.agg(F.sum("copies").alias("copies"))


def redriven_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is staged once one kind of defect is mended: the good messages and the mended ones."""
    base = work_dir(spark, "redriven")
    tables = Tables(f"{base}/tables", INTRADAY)
    tables.create(spark)
    messages = defective_messages(spark, sf_dir)
    messages = messages.select("value", F.struct("event_id").alias("position"))
    ingest_batch(messages, tables, "first")
    for run_id in ("a", "a", "b"):
        redrive(
            spark,
            tables,
            mend=lambda value: F.replace(value, F.lit('"4. other"'), F.lit('"4. close"')),
            run_id=run_id,
        )
    return tables.read(spark, "staging")


def topic_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All bars as messages with the columns of a Kafka reader, and the batch that reads them.

    Four partitions, offsets in order of event number. Of 97 events one is never delivered, one in
    fifty is delivered twice, the second time with the next batch, and seven in a row out of every
    400 come only with the next batch.
    """
    bars = fx.intraday_bars(spark, sf_dir, extra=("event_id",))
    number = F.col("event_id")
    rows = fx.messages(bars, INTRADAY, "event_id", "timestamp").filter(number % 97 != 13)
    batch = F.floor(number / 1000) + F.when(number % 400 < 7 * 4, 1).otherwise(0)
    batches = F.when(number % 50 == 7, F.array(batch, batch + 1)).otherwise(F.array(batch))
    return rows.select(
        F.col("value").cast("binary").alias("value"),
        (number % 4).cast("int").alias("partition"),
        F.floor(number / 4).alias("offset"),
        F.col("timestamp").cast("timestamp").alias("timestamp"),
        F.explode(batches).alias("batch"),
    )


def delivery_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lost, repeated and late ranges of the offsets that the rows of a topic came with."""
    rows = topics.kafka_rows(topic_rows(spark, sf_dir), "batch")
    return delivery.delivery_audit(
        rows.select("position.partition", "position.offset", "batch"), chunk=64
    )


def topic_rows_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows ingested batch by batch: every bar that was delivered, once."""
    tables = Tables(work_dir(spark, "topic-rows"), INTRADAY)
    tables.create(spark)
    rows = topics.kafka_rows(topic_rows(spark, sf_dir), "batch")
    for odd in (0, 1):
        ingest_batch(rows.filter(F.col("batch") % 2 == odd).drop("batch"), tables, f"read-{odd}")
    return tables.read(spark, "staging")


def stream_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every bar sent, sent again as it was, and sent with another close; over a restart.

    The staged rows, and how many messages reached the tables: each text once.
    """
    base = work_dir(spark, "repeats")
    bars = fx.intraday_bars(spark, sf_dir)
    again = bars.withColumn("close_price", (F.col("close_price") + 1).cast(PRICE))
    tables = Tables(f"{base}/tables", INTRADAY)
    for sent in (bars, bars.unionAll(again), again):
        topics.write_files(fx.messages(sent, INTRADAY), f"{base}/topic")
        stream = topics.stream_files(spark, f"{base}/topic")
        jobs.ingest(stream, tables, f"{base}/offsets", repeats_within="1 hour")
    reached = tables.read(spark, "runs").agg(F.sum("n_messages").alias("n_messages"))
    n_messages = reached.first()[0]
    return tables.read(spark, "staging").withColumn(
        "n_messages", F.lit(n_messages).cast("bigint")
    )


def ingest_run_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of a stream of several batches, as the run table keeps them."""
    base = work_dir(spark, "run-table")
    messages = defective_messages(spark, sf_dir)
    topics.write_files(messages.repartition(3, "event_id"), f"{base}/topic")
    tables = Tables(f"{base}/tables", INTRADAY)
    jobs.ingest(topics.stream_files(spark, f"{base}/topic", 1), tables, f"{base}/offsets")
    names = ("n_messages", "n_processed", "n_rejected", "n_bars")
    sums = [F.sum(name).alias(name) for name in names]
    return tables.read(spark, "runs").agg(F.count_distinct("ingested").alias("n_batches"), *sums)


def _scheduled_run(cadence: Cadence) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Landed documents through extract, ingest and refresh into the final table."""
        base = work_dir(spark, f"run-{cadence.name}")
        tables = Tables(f"{base}/tables", cadence)
        jobs.run(
            spark,
            tables,
            landed(spark, sf_dir, cadence),
            send=lambda messages: topics.write_files(messages, f"{base}/topic"),
            receive=lambda: topics.stream_files(spark, f"{base}/topic"),
            checkpoint=f"{base}/offsets",
            as_of=FIRST_RUN,
            symbols=None,
        )
        return tables.read(spark, "final")

    return query


def _second_run(cadence: Cadence) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Half of the documents, then late messages and all documents: two merges, one table."""
        base = work_dir(spark, f"second-run-{cadence.name}")
        tables = Tables(f"{base}/tables", cadence)
        documents = landed(spark, sf_dir, cadence)
        for envelopes, as_of in (
            (documents.filter(F.col("page") % 4 < 2), FIRST_RUN),
            (documents, SECOND_RUN),
        ):
            if as_of == SECOND_RUN:
                late = bars_of(spark, sf_dir, cadence, "event_id").filter(is_late(cadence))
                topics.write_files(fx.messages(late, cadence), f"{base}/topic")
            jobs.run(
                spark,
                tables,
                envelopes,
                send=lambda messages: topics.write_files(messages, f"{base}/topic"),
                receive=lambda: topics.stream_files(spark, f"{base}/topic"),
                checkpoint=f"{base}/offsets",
                as_of=as_of,
                symbols=None,
            )
        return tables.read(spark, "final").drop("last_refreshed")

    return query


def is_late(cadence: Cadence) -> Column:
    """The bars that come as messages between the two runs."""
    if cadence.name == "intraday":
        return F.col("event_id") % 50 == 7
    return (F.month("date") == 2) & (F.dayofmonth("date") == 13)


def _null_edges(cadence: Cadence) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Zero closes, and days on which nothing was traded: ratios without a base."""
        bars = bars_of(spark, sf_dir, cadence, "event_id")
        number = F.col("event_id") if cadence.name == "intraday" else F.dayofmonth("date")
        day = F.dayofmonth(cadence.time_col)
        edged = bars.withColumns(
            {
                "close_price": F.when(number % 7 == 0, 0).otherwise(F.col("close_price")).cast(PRICE),
                "volume": F.when(day % 3 == 0, 0).otherwise(F.col("volume")).cast("bigint"),
            }
        ).select(*cadence.staging_schema.fieldNames())
        return indicators(edged, cadence)

    return query


def stage_same_key_in_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each message holds its bar's time in two spellings; the first counts on either path."""
    # Dealt first: a split of small rows becomes much JSON.
    bars = fx.intraday_bars(spark, sf_dir, extra=("event_id",)).repartition("event_id")
    texts = fx.messages(bars, INTRADAY, "event_id")
    fields = '{"1. open":"9","2. high":"9","3. low":"9","4. close":"9","5. volume":"9"}'
    again = F.replace(F.get_json_object("value", "$.timestamp"), F.lit(" "), F.lit("T"))
    head = F.left("value", F.length("value") - 2)
    doubled = F.concat(head, F.lit(',"'), again, F.lit(f'":{fields}}}}}'))
    classified = msg.classify_messages(texts.withColumn("value", doubled), INTRADAY)
    names = INTRADAY.staging_schema.fieldNames()
    bars = msg.good_bars(classified, INTRADAY, position="event_id").select(*names, "event_id")
    # Parsed once: either path reads its bars again and again.
    bars = kept(bars, work_dir(spark, "same-key"))
    paths = [
        first_write_wins(bars, bars.limit(0), INTRADAY.keys, "event_id", max_group=limit)
        .select(*names)
        .withColumn("max_group", F.lit(limit))
        for limit in (1, 1_000_000)
    ]
    return paths[0].unionAll(paths[1])


def constraint_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars sent twice with missing symbols, volumes and over-large prices; violation counts."""
    bars = fx.intraday_bars(spark, sf_dir, extra=("event_id",))
    kind = F.pmod(F.col("event_id"), F.lit(10))
    defective = bars.select(
        F.when(kind != 1, F.col("symbol")).alias("symbol"),
        "timestamp",
        "open_price",
        "high_price",
        "low_price",
        (F.col("close_price") + F.when(kind == 2, 10**8).otherwise(0)).alias("close_price"),
        F.when(kind != 3, F.col("volume")).alias("volume"),
    )
    return constraint_violations(defective.unionAll(bars.drop("event_id")), INTRADAY)


# --- merge -----------------------------------------------------------------------------


def _upsert(cadence: Cadence) -> Query:
    """Old rows of the target, new rows of the source, and a stretch where they overlap."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        bars = bars_of(spark, sf_dir, cadence)
        old = bars.filter(_time(cadence) < _at(cadence, TARGET_UNTIL[cadence.name]))
        new = bars.filter(_time(cadence) >= _at(cadence, STAGED_UNTIL[cadence.name]))
        return upsert(
            analytics(old, cadence, moment(FIRST_RUN)),
            analytics(new, cadence, moment(SECOND_RUN)),
            cadence,
        )

    return query


def _bucketed_upsert(cadence: Cadence, **options) -> Query:
    """The same from bars and a target that are kept by symbol, in buckets."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        base = work_dir(spark, f"bucketed-{cadence.name}")
        bars = kept_bars(spark, sf_dir, cadence, base)
        buckets = buckets_for(bars.count(), BUCKETS)
        sides = []
        for name, part, as_of in (
            ("old", _time(cadence) < _at(cadence, TARGET_UNTIL[cadence.name]), FIRST_RUN),
            ("new", _time(cadence) >= _at(cadence, STAGED_UNTIL[cadence.name]), SECOND_RUN),
        ):
            stored = write_bucketed(
                bars.filter(part), cadence, f"{base}/{name}", buckets, **options
            )
            sides.append(bucketed_analytics(stored, cadence, moment(as_of), **options))
        old, new = sides
        target = write_bucketed(old.rows(), cadence, f"{base}/final", buckets, **options)
        return bucketed_upsert(target, new, cadence)

    return query


def upsert_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upsert(INTRADAY)(spark, sf_dir).groupBy("action").agg(F.count("*").alias("n"))


def upsert_guard_edge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets stamped older, equal, newer or not at all; only the older ones are replaced."""
    bars = fx.intraday_bars(spark, sf_dir, extra=("event_id",))
    rows = analytics(bars.drop("event_id"), INTRADAY, moment(SECOND_RUN))
    kind = F.pmod(F.second("timestamp"), F.lit(4))
    stamp = (
        F.when(kind == 0, moment(FIRST_RUN))
        .when(kind == 1, moment(SECOND_RUN))
        .when(kind == 2, moment(datetime(2025, 1, 31, 14, 0)))
    )
    target = rows.withColumn("last_refreshed", stamp.cast("timestamp_ntz")).withColumn(
        "volume", F.lit(-1).cast("bigint")
    )
    return upsert(target, rows, INTRADAY).select(
        *INTRADAY.keys, "volume", "last_refreshed", "action"
    )


def reader_of(bars: DataFrame, cadence: Cadence) -> Reader:
    """Period-wise reading of bars that are not stored by period."""

    def read(periods: Iterable[date]) -> DataFrame:
        return bars.filter(cadence.period().isin(*periods))

    return read


def late_bar_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of one afternoon arrive late; only what they reach is recomputed and merged."""
    bars = fx.intraday_bars(spark, sf_dir)
    late = _time(INTRADAY).between(_at(INTRADAY, LATE_FROM), _at(INTRADAY, LATE_UNTIL))
    before = analytics(bars.filter(~late), INTRADAY, moment(FIRST_RUN))
    reached = reached_analytics(
        reader_of(bars, INTRADAY),
        sums_of(bars, INTRADAY),
        bars.filter(late),
        INTRADAY,
        moment(SECOND_RUN),
    )
    return upsert(before, reached.rows, INTRADAY).drop("last_refreshed", "action")


def late_bar_repair_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month of daily bars arrives late; only the rows from there on are recomputed."""
    bars = kept_bars(spark, sf_dir, DAILY, work_dir(spark, "late-repair"))
    late = F.trunc("date", "month") == F.lit(STAGED_UNTIL["daily"]).cast("date")
    before = analytics(bars.filter(~late), DAILY, moment(FIRST_RUN))
    reached = reached_analytics(
        reader_of(bars, DAILY),
        sums_of(bars, DAILY),
        bars.filter(late),
        DAILY,
        moment(SECOND_RUN),
    )
    return upsert(before, reached.rows, DAILY).drop("last_refreshed", "action")


def merged_late(spark: SparkSession, sf_dir: str, cadence: Cadence) -> Tables:
    """Tables in which some bars arrive after the first merge, and are merged by a second."""
    tables = Tables(work_dir(spark, f"late-{cadence.name}"), cadence)
    tables.create(spark)
    bars = bars_of(spark, sf_dir, cadence)
    for late, as_of in ((False, FIRST_RUN), (True, SECOND_RUN)):
        arrived = bars.filter(arrives_late(cadence) == late)
        messages = fx.messages(arrived, cadence)
        ingest_batch(messages.withColumn("position", F.struct(F.lit(0))), tables, f"late-{late}")
        jobs.refresh_outstanding(spark, tables, as_of)
    return tables


def arrives_late(cadence: Cadence) -> Column:
    """One afternoon, or one month of some symbols."""
    if cadence.name == "intraday":
        return _time(cadence).between(_at(cadence, LATE_FROM), _at(cadence, LATE_UNTIL))
    late = F.trunc("date", "month") == F.lit(LATE_MONTH).cast("date")
    return late & (F.length("symbol") == 2)


def _late_merge(cadence: Cadence) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        """The final table: rows that no late bar reaches keep their stamp."""
        return merged_late(spark, sf_dir, cadence).read(spark, "final")

    return query


def _late_sums(cadence: Cadence) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        """The stored sums, corrected by what came late."""
        return merged_late(spark, sf_dir, cadence).read(spark, "sums")

    return query


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.bars_per_symbol(fx.intraday_bars(spark, sf_dir, "user_id"))


QUERIES: dict[str, Query] = {
    "daily_price_change_pct": _indicator(DAILY, "close_price", "price_change_pct_daily"),
    "daily_moving_avg_50": _indicator(DAILY, "close_price", "moving_avg_50d"),
    "daily_moving_avg_200": _indicator(DAILY, "close_price", "moving_avg_200d"),
    "daily_volume_avg_20": _indicator(DAILY, "volume", "volume_avg_20d"),
    "daily_generated_cols": _generated(DAILY, "high", "low", "daily_range"),
    "daily_analytics_full": _analytics(DAILY),
    "intraday_prev_close": _indicator(INTRADAY, "close_price", "prev_close"),
    "intraday_price_change_pct": _indicator(INTRADAY, "close_price", "price_change_pct"),
    "intraday_vwap": _indicator(INTRADAY, "close_price", "volume", "vwap"),
    "intraday_generated_cols": _generated(INTRADAY, "high_low_spread", "price_change"),
    "intraday_analytics_full": _analytics(INTRADAY),
    "intraday_hot_symbols": _analytics(INTRADAY, max_group=HOT_GROUP),
    "symbol_universe": symbol_universe,
    "latest_per_symbol": latest_per_symbol,
    "latest_bar_per_symbol": latest_bar_per_symbol,
    "land_api_intraday": _land(INTRADAY),
    "land_api_daily": _land(DAILY),
    "validate_api": validate_api,
    "incremental_delta_intraday": _delta(INTRADAY),
    "incremental_delta_daily": _delta(DAILY),
    "emit_messages_intraday": _emit(INTRADAY),
    "emit_messages_daily": _emit(DAILY),
    "parse_messages_intraday": _parse(INTRADAY, "raw_data"),
    "parse_messages_daily": _parse(DAILY, "raw_data"),
    "validate_messages": validate_messages,
    "message_totals": message_totals,
    "raw_audit_json": raw_audit_json,
    "stage_first_write_wins": stage_first_write_wins,
    "staged_keys_compared": staged_keys_compared,
    "stage_hot_key": stage_hot_key,
    "stream_ingest_intraday": _stream(INTRADAY),
    "stream_ingest_daily": _stream(DAILY),
    "stream_quarantine": stream_quarantine,
    "extract_stream_intraday": _extract_stream(INTRADAY),
    "extract_stream_daily": _extract_stream(DAILY),
    "stream_repeats": stream_repeats,
    "ingest_run_table": ingest_run_table,
    "delivery_audit": delivery_audit,
    "topic_rows_staged": topic_rows_staged,
    "redrive_quarantine": redrive_quarantine,
    "redriven_staging": redriven_staging,
    "scheduled_run_intraday": _scheduled_run(INTRADAY),
    "scheduled_run_daily": _scheduled_run(DAILY),
    "scheduled_run_second_intraday": _second_run(INTRADAY),
    "scheduled_run_second_daily": _second_run(DAILY),
    "indicator_null_edges_intraday": _null_edges(INTRADAY),
    "indicator_null_edges_daily": _null_edges(DAILY),
    "stage_same_key_in_message": stage_same_key_in_message,
    "constraint_check": constraint_check,
    "upsert_intraday": _upsert(INTRADAY),
    "upsert_daily": _upsert(DAILY),
    "bucketed_upsert_intraday": _bucketed_upsert(INTRADAY),
    "bucketed_upsert_daily": _bucketed_upsert(DAILY),
    "bucketed_upsert_hot_symbols": _bucketed_upsert(INTRADAY, max_group=HOT_BUCKET),
    "upsert_counts": upsert_counts,
    "upsert_guard_edge": upsert_guard_edge,
    "late_bar_repair": late_bar_repair,
    "late_bar_repair_daily": late_bar_repair_daily,
    "late_merge_intraday": _late_merge(INTRADAY),
    "late_merge_daily": _late_merge(DAILY),
    "late_sums_intraday": _late_sums(INTRADAY),
    "late_sums_daily": _late_sums(DAILY),
    "run_metrics": run_metrics,
}
