"""From message text to typed bars, with every rejected message kept and explained."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketbars.functions import documents as doc
from marketbars.schemas import Cadence

CONTROL = "control"


def classify_messages(messages: DataFrame, cadence: Cadence) -> DataFrame:
    """Add ``reason`` (NULL when good), ``symbol`` and typed ``bars`` to rows of ``value``.

    A message is taken or rejected as a whole: one bad bar rejects all bars of its message.
    No shuffle, no Python; each message is turned into columns once.
    """
    parsed = doc.computed_once(messages, _message=doc.parse_message(F.col("value")))
    typed = doc.computed_once(parsed, bars=doc.typed_bars(F.col("_message.data"), cadence))
    reason = doc.message_problem(F.col("_message"), F.col("value"), F.col("bars"), cadence)
    return typed.select(
        *messages.columns, reason.alias("reason"), F.col("_message.symbol").alias("symbol"), "bars"
    )


def good_bars(
    classified: DataFrame, cadence: Cadence, *keep: str, position: str | None = None
) -> DataFrame:
    """One row per bar of the good messages, in raw-table columns.

    ``position`` names the column that orders messages; the bar's place in its message is added
    to it, because one message can hold a key twice (one time, written in two ways).
    """
    names = [n for n in cadence.raw_schema.fieldNames() if n != "symbol"]
    kept = [F.col(c) for c in keep]
    if position:
        kept.append(F.struct(F.col(position).alias("message"), F.col("bar_no")).alias(position))
    return (
        classified.filter(F.col("reason").isNull())
        .select("*", F.posexplode("bars").alias("bar_no", "bar"))
        .select("symbol", *[F.col("bar")[n].alias(n) for n in names], *kept)
    )


def parse_messages(messages: DataFrame, cadence: Cadence, *keep: str) -> DataFrame:
    return good_bars(classify_messages(messages, cadence), cadence, *keep)


def rejected_messages(classified: DataFrame, source: str) -> DataFrame:
    """Rejected messages in quarantine columns; control messages are neither data nor errors."""
    return classified.filter(F.col("reason") != CONTROL).select(
        F.lit(source).alias("source"), "value", "reason"
    )
