"""First write wins: the table key accepts a bar once, later copies are set aside.

Staged keys that no incoming bar can meet are left out before anything is shuffled: bounds of the
incoming keys are pushed into the scan of staging, and what they let through is filtered by the
incoming keys themselves, map-side, while those are few enough to be sent to all tasks.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketbars.operators.skew import GROUP_ROWS, hot_groups, sized_side, small_side
from marketbars.schemas import Cadence
from marketbars.session import ensure_checkpoint_dir


@dataclass(frozen=True)
class Arrival:
    """What one pass over a batch tells of its keys: storage periods, bounds and size."""

    periods: set[date]
    bounds: dict[str, tuple[Any, Any]]
    size: int


def arrival(incoming: DataFrame, cadence: Cadence) -> Arrival:
    """One job; periods are days or months of the years 1 to 9999, so bounded by the calendar."""
    edges = [edge(key) for key in cadence.keys for edge in (F.min, F.max)]
    size = F.sum(F.octet_length("symbol") + 8)
    periods, size, *edges = incoming.agg(
        F.collect_set(cadence.period()), size, *edges
    ).first()
    bounds = dict(zip(cadence.keys, zip(edges[::2], edges[1::2], strict=True), strict=True))
    return Arrival(set(periods), bounds, size or 0)


def known_keys(staged: DataFrame, incoming: DataFrame, keys: list[str], came: Arrival) -> DataFrame:
    """The staged keys that incoming bars can meet.

    All between the bounds of the incoming ones; only those that do meet one while the incoming
    keys are small enough to be broadcast.
    """
    found = staged.select(*keys)
    for key, (low, high) in came.bounds.items():
        if low is None:
            return found.limit(0)
        # As text: a zone-free time stays what it is, whatever zone driver and session are in.
        edges = [F.lit(str(edge)).cast(incoming.schema[key].dataType) for edge in (low, high)]
        found = found.filter(F.col(key).between(*edges))
    mine = incoming.select(*keys)
    side = sized_side(mine, came.size)
    return found if side is mine else found.join(side, keys, "left_semi")


@dataclass(frozen=True)
class Met:
    """Hashes of keys that more than one bar has, their number, and the most bars that share one."""

    hashes: DataFrame
    n: int
    most: int


def met_again(
    incoming: DataFrame, staged: DataFrame, keys: list[str], came: Arrival | None = None
) -> Met:
    """What incoming and staged bars say of keys that are met more than once.

    Equal keys have equal hashes, so no other bar can be a copy.
    """
    ensure_checkpoint_dir(incoming.sparkSession)
    known = _known(incoming, staged, keys, came)
    hashes = [rows.select(F.xxhash64(*keys).alias(_HASH)) for rows in (incoming, known)]
    counted = hashes[0].unionAll(hashes[1]).groupBy(_HASH).count().filter("count > 1")
    counted = counted.checkpoint()
    n, most = counted.agg(F.count("*"), F.max("count")).first()
    return Met(counted.select(_HASH), n, most or 0)


def _known(
    incoming: DataFrame, staged: DataFrame, keys: list[str], came: Arrival | None
) -> DataFrame:
    known = staged if came is None else known_keys(staged, incoming, keys, came)
    return known.select(*keys)


def mark_duplicates(
    incoming: DataFrame,
    staged: DataFrame,
    keys: list[str],
    position: str,
    max_group: int = GROUP_ROWS,
    came: Arrival | None = None,
    met: Met | None = None,
) -> DataFrame:
    """Add ``duplicate``: True for a bar whose key is staged or came earlier in the batch.

    ``position`` orders the batch. Staged keys take part as rows ranked before every
    incoming one, so one exchange settles both questions; given what ``came``, only staged keys
    that it can meet do. A key with more than
    ``max_group`` copies is spread over as many tasks as its copies need; its first position,
    found by a partially aggregated MIN, then decides instead of the rank inside a task.

    Most keys come once. Their hashes are counted first, so that only bars whose hash is met again
    travel, while those hashes are few enough to be broadcast; the others stay where they are.
    ``met`` are those hashes, if known.
    """
    names = incoming.columns
    known = _known(incoming, staged, keys, came)
    met = met or met_again(incoming, staged, keys, came)
    suspect, most = met.hashes, met.most
    if not met.n:
        return incoming.withColumn("duplicate", F.lit(False))
    side = sized_side(suspect, met.n * _HASH_BYTES)
    if side is suspect:
        return _ranked(incoming, known, keys, position, max_group, most)
    tagged = incoming.withColumn(_HASH, F.xxhash64(*keys))
    sure = tagged.join(side, _HASH, "left_anti").select(*names, F.lit(False).alias("duplicate"))
    open_, known = (
        rows.withColumn(_HASH, F.xxhash64(*keys)).join(side, _HASH, "left_semi").drop(_HASH)
        for rows in (incoming, known)
    )
    return sure.unionByName(_ranked(open_, known, keys, position, max_group, most))


_HASH = "_hash"
# Of a hash in a broadcast table.
_HASH_BYTES = 32


def _ranked(
    incoming: DataFrame,
    known: DataFrame,
    keys: list[str],
    position: str,
    max_group: int,
    most: int,
) -> DataFrame:
    names = incoming.columns
    known = known.withColumn("_came", F.lit(0))
    rows = incoming.withColumn("_came", F.lit(1)).unionByName(known, allowMissingColumns=True)

    spread, repeats = [], F.col("_rank") > 1
    # Staged keys are unique: only copies that arrive can crowd a key.
    hot = hot_groups(incoming, keys, max_group) if most > max_group else None
    if hot is not None:
        order = F.struct("_came", position)
        first = (
            rows.join(hot, keys)
            .groupBy(*keys)
            .agg(F.min(order).alias("_first"), F.count("*").alias("_copies"))
        )
        # One row per hot key: written out and counted like ``hot`` itself.
        rows = rows.join(small_side(first.checkpoint()), keys, "left")
        # NULL, hence no spread, for keys that are not hot.
        tasks = F.ceil(F.col("_copies") / max_group)
        rows = rows.withColumn("_task", F.pmod(F.xxhash64(position), tasks))
        spread = ["_task"]
        repeats = F.coalesce(order != F.col("_first"), repeats)

    # Two plain columns: a struct of them would be shuffled beside the position that it repeats.
    group = Window.partitionBy(*keys, *spread).orderBy("_came", position)
    return (
        rows.withColumn("_rank", F.row_number().over(group))
        .filter("_came = 1")
        .select(*names, repeats.alias("duplicate"))
    )


def first_write_wins(
    incoming: DataFrame,
    staged: DataFrame,
    keys: list[str],
    position: str,
    max_group: int = GROUP_ROWS,
    came: Arrival | None = None,
) -> DataFrame:
    """The incoming bars the table accepts."""
    marked = mark_duplicates(incoming, staged, keys, position, max_group, came)
    return marked.filter(~F.col("duplicate")).drop("duplicate")
