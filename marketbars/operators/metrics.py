"""Per-run counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from marketbars.operators.messages import CONTROL
from marketbars.session import ensure_checkpoint_dir


def bars_per_symbol(bars: DataFrame) -> DataFrame:
    """Bars per symbol and the running total in symbol order.

    Counts are dealt to tasks by ranges of symbols, whatever the symbols look like, and written
    out, so that a range stays what it is. Running totals inside a range then start from the sum
    of the ranges before it: one row per task.
    """
    ensure_checkpoint_dir(bars.sparkSession)
    counts = bars.groupBy("symbol").agg(F.count("*").alias("n_bars"))
    ranged = counts.repartitionByRange("symbol")
    ranged = ranged.withColumn("_range", F.spark_partition_id()).checkpoint()
    sums = ranged.groupBy("_range").agg(F.sum("n_bars").alias("_total")).collect()
    before, total = {}, 0
    for row in sorted(sums):
        before[row["_range"]] = total
        total += row["_total"]
    started = bars.sparkSession.createDataFrame(
        list(before.items()), "_range int, _before bigint"
    )
    inside = Window.partitionBy("_range").orderBy("symbol")
    return ranged.join(F.broadcast(started), "_range").select(
        "symbol",
        "n_bars",
        (F.col("_before") + F.sum("n_bars").over(inside)).alias("running_total"),
    )


def total_columns() -> dict[str, Column]:
    """Aggregates over classified messages: seen, processed, rejected, and the bars they carried."""
    good = F.col("reason").isNull()
    control = F.coalesce(F.col("reason") == CONTROL, F.lit(False))
    return {
        "n_messages": F.count(F.lit(1)),
        "n_processed": F.count_if(~control),
        "n_rejected": F.count_if(~good & ~control),
        "n_bars": F.coalesce(F.sum(F.when(good, F.size("bars"))), F.lit(0)),
    }


def message_totals(classified: DataFrame) -> DataFrame:
    """One row: messages seen, processed, rejected, and bars they carried."""
    return classified.agg(*[a.alias(name) for name, a in total_columns().items()])


def observed(df: DataFrame, **aggregates) -> tuple[DataFrame, Observation]:
    """Count while another action runs, so a live run needs no second pass.

    For logs: a stage that reruns after an executor loss is counted again.
    """
    observation = Observation()
    return df.observe(
        observation, *[a.alias(name) for name, a in aggregates.items()]
    ), observation
