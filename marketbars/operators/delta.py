"""Landed quote documents to messages newer than what staging holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketbars.functions import documents as doc
from marketbars.operators.skew import small_side
from marketbars.schemas import LAST_REFRESHED_KEY, META_KEY, Cadence
from marketbars.session import ensure_checkpoint_dir


def tracked(df: DataFrame, symbols) -> DataFrame:
    """Rows of the tracked symbols; the list reaches the scan as a pushed-down IN."""
    return df.filter(F.col("symbol").isin(*symbols))


def classify_documents(landed: DataFrame, cadence: Cadence) -> DataFrame:
    """Add ``reason`` (NULL when good) and the parsed document to landed responses."""
    parsed = doc.computed_once(landed, _document=doc.parse_document(F.col("body"), cadence))
    reason = doc.document_problem(F.col("status"), F.col("_document"), F.col("body"), cadence)
    return parsed.withColumn("reason", reason)


def rejected_documents(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("reason").isNotNull()).select(
        F.lit("document").alias("source"), F.col("body").alias("value"), "reason"
    )


def with_last_refreshed(classified: DataFrame, cadence: Cadence) -> DataFrame:
    last = doc.parse_time(F.col("_document")[META_KEY][LAST_REFRESHED_KEY], cadence)
    return classified.withColumn("last_refreshed", last)


def _all_entries(classified: DataFrame, cadence: Cadence) -> DataFrame:
    good = with_last_refreshed(classified.filter(F.col("reason").isNull()), cadence)
    entries = good.select(
        "symbol",
        "last_refreshed",
        F.explode(F.col("_document")[cadence.series_key]).alias("time_text", "fields"),
    )
    return entries.withColumn(cadence.time_col, doc.parse_time(F.col("time_text"), cadence))


def document_entries(classified: DataFrame, cadence: Cadence) -> DataFrame:
    """One row per series entry: symbol, last refreshed, time text, fields, typed time.

    An entry whose time does not parse is rejected alone, its neighbours are not.
    """
    return _all_entries(classified, cadence).filter(F.col(cadence.time_col).isNotNull())


def rejected_entries(classified: DataFrame, cadence: Cadence) -> DataFrame:
    """Entries without a usable time, as the messages they would have been."""
    bad = _all_entries(classified, cadence).filter(F.col(cadence.time_col).isNull())
    return encode_messages(bad, cadence).select(
        F.lit("entry").alias("source"), "value", F.lit("bad_value").alias("reason")
    )


def latest_per_symbol(staging: DataFrame, cadence: Cadence) -> DataFrame:
    """Last staged time of every symbol: one partially aggregated MAX over two columns."""
    return staging.groupBy("symbol").agg(F.max(cadence.time_col).alias("last_update"))


def latest_bar_per_symbol(staging: DataFrame, cadence: Cadence) -> DataFrame:
    """The whole last bar of every symbol.

    One MAX_BY per column keeps fixed-width buffers, hence a hash aggregate with map-side
    combine; a struct or a ranked window would sort all rows first.
    """
    time = cadence.time_col
    values = [c for c in cadence.staging_schema.fieldNames() if c not in cadence.keys]
    return staging.groupBy("symbol").agg(
        F.max(time).alias(time), *[F.max_by(c, time).alias(c) for c in values]
    )


def newer_than(entries: DataFrame, last_updates: DataFrame, cadence: Cadence) -> DataFrame:
    """Entries strictly newer than their symbol's ``last_update``.

    A symbol without one starts a day before its document's last refresh. The lookup has
    one row per symbol; pass it through ``small_side``: counted and broadcast, so that a
    symbol with many entries is not gathered, and beyond that size a plain shuffle join
    over a materialised side, which adaptive execution can split.
    """
    cutoff = F.coalesce(
        F.col("last_update"), (F.col("last_refreshed") - F.expr("INTERVAL 1 DAY"))
    ).cast(cadence.time_type)
    return (
        entries.join(last_updates, "symbol", "left")
        .filter(F.col(cadence.time_col) > cutoff)
        .drop("last_update")
    )


def encode_messages(entries: DataFrame, cadence: Cadence, *keep: str) -> DataFrame:
    """Entries as topic messages, one bar each."""
    value = doc.encode_message(cadence, F.col("time_text"), F.col("fields"))
    return entries.select(value.alias("value"), *keep)


def delta_messages(
    landed: DataFrame, staging: DataFrame, cadence: Cadence, *keep: str
) -> DataFrame:
    """Landed responses to the messages still missing from staging."""
    entries = document_entries(classify_documents(landed, cadence), cadence)
    ensure_checkpoint_dir(staging.sparkSession)
    known = small_side(latest_per_symbol(staging, cadence).checkpoint())
    fresh = newer_than(entries, known, cadence)
    return encode_messages(fresh, cadence, *keep)
