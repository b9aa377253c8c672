"""Command line for spark-submit: one job per call, counts as one JSON line.

    python -m marketbars run --cadence daily --tables s3a://bucket/bars \
        --landed s3a://bucket/landed/today --servers broker:9092 \
        --offsets s3a://bucket/offsets/daily
"""

from __future__ import annotations

import argparse
import json
from datetime import datetime
from functools import partial

from marketbars.plans import jobs
from marketbars.schemas import CADENCES, DEFAULT_SYMBOLS
from marketbars.session import build_session
from marketbars.sources import topics
from marketbars.sources.landed import read_landed
from marketbars.sources.tables import Tables
from marketbars.streaming.redrive import redrive

# Options each job needs.
NEEDS = {
    "extract": ("landed", "topic"),
    "ingest": ("topic", "offsets"),
    "refresh": (),
    "merge": (),
    "redrive": (),
    "run": ("landed", "topic", "offsets"),
}


def parse(arguments: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="marketbars", description=__doc__.splitlines()[0])
    parser.add_argument("job", choices=NEEDS)
    parser.add_argument("--cadence", choices=CADENCES, required=True)
    parser.add_argument("--tables", required=True, help="root folder of the stored tables")
    parser.add_argument("--landed", help="landed responses, JSON lines")
    parser.add_argument("--servers", help="Kafka bootstrap servers")
    parser.add_argument("--topic-dir", help="folder of JSON lines used instead of Kafka")
    parser.add_argument("--offsets", help="checkpoint folder of the ingest query")
    parser.add_argument("--as-of", type=datetime.fromisoformat, help="stamp of refreshed rows")
    parser.add_argument("--run-id", help="a rerun under the same name replaces its rejects")
    parser.add_argument("--symbols", default=",".join(DEFAULT_SYMBOLS), help="list, or 'all'")
    options = parser.parse_args(arguments)
    given = {**vars(options), "topic": options.servers or options.topic_dir}
    missing = [name for name in NEEDS[options.job] if not given[name]]
    if missing:
        parser.error(f"{options.job} needs {', '.join(missing)}")
    return options


def main(arguments: list[str] | None = None) -> None:
    options = parse(arguments)
    cadence = CADENCES[options.cadence]
    spark = build_session(f"marketbars-{options.job}-{cadence.name}")
    tables = Tables(options.tables, cadence)
    symbols = None if options.symbols == "all" else options.symbols.split(",")
    if options.servers:
        send = partial(topics.write_kafka, cadence=cadence, servers=options.servers)
        receive = partial(topics.stream_kafka, spark, cadence, options.servers)
    else:
        send = partial(topics.write_files, path=options.topic_dir)
        receive = partial(topics.stream_files, spark, options.topic_dir)

    tables.create(spark)
    if options.job == "extract":
        landed = read_landed(spark, options.landed)
        sent = jobs.extract_delta(landed, tables, send, symbols, options.run_id)
        counts = {"messages_sent": sent}
    elif options.job == "ingest":
        counts = jobs.ingest(receive(), tables, options.offsets)
    elif options.job == "merge":
        affected = jobs.refresh_outstanding(spark, tables, options.as_of)
        counts = {"rows_affected": affected}
    elif options.job == "redrive":
        counts = redrive(spark, tables, run_id=options.run_id)
    elif options.job == "refresh":
        counts = {"rows_affected": jobs.refresh(spark, tables, options.as_of)}
    else:
        landed = read_landed(spark, options.landed)
        counts = jobs.run(
            spark,
            tables,
            landed,
            send,
            receive,
            options.offsets,
            options.as_of,
            symbols,
            options.run_id,
        )
    print(json.dumps(counts))


if __name__ == "__main__":
    main()
