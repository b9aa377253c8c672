"""Finding the few key groups too large for one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketbars.session import ensure_checkpoint_dir

# Rows one task may hold as a single group.
GROUP_ROWS = 1_000_000
# Largest side, as JSON text, to be broadcast; beyond it the join shuffles.
BROADCAST_BYTES = 64_000_000


def hot_groups(df: DataFrame, keys: list[str], max_rows: int) -> DataFrame | None:
    """Keys with more than ``max_rows`` rows, or None when there are none.

    One partially aggregated count over the key columns only. The result has fewer than
    rows / ``max_rows`` entries. It is written to the checkpoint folder, so later joins
    neither recount nor depend on the executors that counted.
    """
    ensure_checkpoint_dir(df.sparkSession)
    hot = df.groupBy(*keys).count().filter(F.col("count") > max_rows).select(*keys).checkpoint()
    return None if hot.isEmpty() else small_side(hot)


def json_bytes() -> Column:
    """Aggregate: size of all rows as JSON text."""
    return F.sum(F.octet_length(F.to_json(F.struct("*"))))


def small_side(df: DataFrame) -> DataFrame:
    """Mark a materialised side for broadcast only when its measured size allows it."""
    return sized_side(df, df.agg(json_bytes()).head()[0])


def sized_side(df: DataFrame, size: int | None) -> DataFrame:
    """The same for a side that is known to be no larger than ``size``."""
    return F.broadcast(df) if (size or 0) <= BROADCAST_BYTES else df
