"""What a topic delivered: ranges of offsets that came, came again, came late or never came."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketbars.operators.skew import small_side
from marketbars.session import ensure_checkpoint_dir

# Offsets of a partition that are ranged in one piece by one task.
CHUNK = 1_000_000
DELIVERED, LOST, REPEATED, LATE = "delivered", "lost", "repeated", "late"


def ranges(offsets: DataFrame, keys: list[str], chunk: int = CHUNK) -> DataFrame:
    """Runs of consecutive offsets: ``keys``, first_offset, last_offset.

    ``offsets`` has each offset once. A run is what keeps the same distance to its row number.
    Rows are numbered in chunks of offsets, so that a busy partition is dealt to many tasks; runs
    that touch at the edge of a chunk are joined afterwards, one row per run.
    """
    edge = F.floor(F.col("offset") / chunk).alias("_chunk")
    inside = Window.partitionBy(*keys, "_chunk").orderBy("offset")
    runs = (
        offsets.select(*keys, "offset", edge)
        .withColumn("_run", F.col("offset") - F.row_number().over(inside))
        .groupBy(*keys, "_chunk", "_run")
        .agg(F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"))
    )
    series = Window.partitionBy(*keys).orderBy("first_offset")
    apart = F.col("first_offset") - F.lag("last_offset").over(series) > 1
    joined = runs.withColumn("_new", F.coalesce(apart, F.lit(True)).cast("int"))
    joined = joined.withColumn("_range", F.sum("_new").over(series))
    return (
        joined.groupBy(*keys, "_range")
        .agg(F.min("first_offset").alias("first_offset"), F.max("last_offset").alias("last_offset"))
        .drop("_range")
    )


def delivery_audit(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """kind, partition, batch, first_offset, last_offset and n_offsets of every range.

    ``rows`` has partition, offset and batch (a number that grows with every batch) of each
    message read. Delivered ranges are those of a partition over all batches, lost ones the gaps
    between them; both have no batch. Repeated ranges were read before, in the same batch or an
    earlier one; late ranges were first read after a higher offset of their partition had come
    with an earlier batch. Both name the batch that brought them. Whether offsets are missing in
    front of the first or behind the last one seen cannot be told from the rows.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    offsets = rows.groupBy("partition", "offset", "batch").agg(F.count("*").alias("_n"))
    inside = Window.partitionBy("partition", "offset").orderBy("batch")
    read = offsets.withColumn("_before", F.row_number().over(inside) - 1).checkpoint()
    first = read.filter("_before = 0")

    whole = ranges(first.select("partition", "offset"), ["partition"], chunk)
    whole = whole.withColumn("batch", F.lit(None).cast("bigint"))
    series = Window.partitionBy("partition").orderBy("first_offset")
    behind = F.lead("first_offset").over(series)
    gaps = whole.select(
        "partition",
        "batch",
        (F.col("last_offset") + 1).alias("first_offset"),
        (behind - 1).alias("last_offset"),
    ).filter(F.col("last_offset").isNotNull())

    again = read.filter("_before > 0 OR _n > 1").select("partition", "offset", "batch")
    # A row per partition and batch: the highest offset that earlier batches had brought.
    earlier = Window.partitionBy("partition").orderBy("batch").rowsBetween(
        Window.unboundedPreceding, -1
    )
    highest = read.groupBy("partition", "batch").agg(F.max("offset").alias("_highest"))
    highest = highest.withColumn("_highest", F.max("_highest").over(earlier)).checkpoint()
    late = first.join(small_side(highest), ["partition", "batch"])
    late = late.filter(F.col("offset") < F.col("_highest")).select("partition", "offset", "batch")

    by_batch = ["partition", "batch"]
    found = None
    for kind, of in (
        (DELIVERED, whole),
        (LOST, gaps),
        (REPEATED, ranges(again, by_batch, chunk)),
        (LATE, ranges(late, by_batch, chunk)),
    ):
        part = of.select(
            F.lit(kind).alias("kind"),
            "partition",
            "batch",
            "first_offset",
            "last_offset",
            (F.col("last_offset") - F.col("first_offset") + 1).alias("n_offsets"),
        )
        found = part if found is None else found.unionByName(part)
    return found
