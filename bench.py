"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketbars.operators.indicators import indicators
from marketbars.operators.messages import classify_messages
from marketbars.plans import jobs
from marketbars.plans.registry import LATE_FROM, LATE_UNTIL, QUERIES, bars_of
from marketbars.schemas import CADENCES, INTRADAY
from marketbars.session import build_session, work_dir
from marketbars.sources import fixtures as fx
from marketbars.sources import topics
from marketbars.sources.tables import Tables
from marketbars.streaming.ingest import ingest_batch

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))
HEADLINE = (
    "daily_analytics_full",
    "daily_moving_avg_200",
    "daily_price_change_pct",
    "intraday_analytics_full",
    "intraday_hot_symbols",
    "intraday_vwap",
    "latest_bar_per_symbol",
    "land_api_intraday",
    "incremental_delta_intraday",
    "incremental_delta_daily",
    "parse_messages_daily",
    "validate_messages",
    "stage_first_write_wins",
    "stage_hot_key",
    "stream_ingest_intraday",
    "upsert_daily",
    "upsert_intraday",
    "late_bar_repair",
    "run_metrics",
)


def staged_bars(spark: SparkSession) -> dict[str, DataFrame]:
    """Bars stored as the jobs find them, so that shaping the test tables is not timed."""
    base = work_dir(spark, "bench")
    for cadence in CADENCES.values():
        bars_of(spark, SF_DIR, cadence).write.parquet(f"{base}/{cadence.name}")
    return {name: spark.read.parquet(f"{base}/{name}") for name in CADENCES}


def staged_messages(spark: SparkSession) -> DataFrame:
    """All events as messages in sixteen files: the test table itself is one split."""
    path = f"{work_dir(spark, 'bench')}/topic"
    messages = fx.messages(bars_of(spark, SF_DIR, INTRADAY), INTRADAY)
    topics.write_files(messages.repartition(16), path)
    return topics.read_files(spark, path)


def ingest_seconds(spark: SparkSession, messages: DataFrame) -> float:
    """One batch into fresh tables: raw, quarantine, staging, last times and the log."""
    times = []
    for _ in range(RUNS):
        tables = Tables(work_dir(spark, "bench"), INTRADAY)
        tables.create(spark)
        start = time.perf_counter()
        ingest_batch(messages, tables, "bench-0")
        times.append(time.perf_counter() - start)
    return round(min(times), 3)


def merge_seconds(spark: SparkSession) -> tuple[float, float]:
    """One late afternoon merged into a filled final table, and the same by a full refresh."""
    tables = Tables(work_dir(spark, "bench"), INTRADAY)
    tables.create(spark)
    bars = bars_of(spark, SF_DIR, INTRADAY)
    late = F.col("timestamp").between(F.lit(LATE_FROM), F.lit(LATE_UNTIL))
    seconds = []
    for batch, rows in enumerate((bars.filter(~late), bars.filter(late))):
        messages = fx.messages(rows, INTRADAY).withColumn("position", F.struct(F.lit(0)))
        ingest_batch(messages, tables, f"bench-{batch}")
        start = time.perf_counter()
        jobs.refresh_outstanding(spark, tables)
        seconds.append(time.perf_counter() - start)
    start = time.perf_counter()
    jobs.refresh(spark, tables)
    return round(seconds[1], 3), round(time.perf_counter() - start, 3)


def best(run) -> float:
    """Every column of every row is computed, nothing is stored."""
    times = []
    for _ in range(RUNS):
        start = time.perf_counter()
        run().write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    return round(min(times), 3)


def main() -> None:
    spark = build_session(
        "marketbars-bench",
        master=f"local[{CPUS}]",
        extra={
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {name: best(lambda q=QUERIES[name]: q(spark, SF_DIR)) for name in HEADLINE}
    for name, bars in staged_bars(spark).items():
        seconds[f"staged_{name}_indicators"] = best(
            lambda bars=bars, cadence=CADENCES[name]: indicators(bars, cadence)
        )
    messages = staged_messages(spark)
    seconds["staged_classify_messages"] = best(lambda: classify_messages(messages, INTRADAY))
    seconds["staged_ingest_batch"] = ingest_seconds(spark, messages)
    seconds["staged_merge_late"], seconds["staged_refresh_full"] = merge_seconds(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total of best runs",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
