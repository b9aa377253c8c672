"""Repeated messages dropped while they stream, with a state that time bounds."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import ExitStack, contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketbars.session import having

_STORE = "spark.sql.streaming.stateStore"
# What is kept of the state in memory, by each executor for all its partitions of it.
STATE_MB = 256
STATE_SETTINGS = {
    f"{_STORE}.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    f"{_STORE}.rocksdb.boundedMemoryUsage": "true",
    f"{_STORE}.rocksdb.maxMemoryUsageMB": STATE_MB,
}


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """A stream that is first started in here keeps its state on the executors' disks.

    By default every hash of the state lies on the heap, in up to three versions. A stream that
    has a checkpoint goes on with the store that it was started with.
    """
    with ExitStack() as settings:
        for setting, value in STATE_SETTINGS.items():
            settings.enter_context(having(spark, setting, value))
        yield


def without_repeats(messages: DataFrame, within: str) -> DataFrame:
    """A stream of messages without those whose text came already ``within`` that time.

    Producers that retry send a message again, word for word, and soon; such copies need not
    reach the tables to be found out there. The state holds one hash per message seen lately.
    Time is that of the micro-batch, not of the bar or of the sender: it never runs back, so no
    message is late, however old its bar, and none is lost; what is older than ``within`` is
    forgotten, and a copy that comes later still is left to the key check of the tables.

    Only equal texts are dropped. Two different bars of one key both go on, and the tables take
    the first. Of equal texts in one micro-batch any one goes on, in its own place: the order
    against a different bar of the same key, sent between them, holds where a partition of the
    topic brings all three.
    """
    seen = messages.withColumns(
        {"_seen": F.current_timestamp(), "_digest": F.unhex(F.sha2("value", 256))}
    )
    # A null text has no hash; it is no message, but its rejection is counted like any other.
    digest = F.coalesce("_digest", F.lit(b""))
    kept = seen.withColumn("_digest", digest).withWatermark("_seen", within)
    return kept.dropDuplicatesWithinWatermark(["_digest"]).drop("_seen", "_digest")
