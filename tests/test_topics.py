"""Kafka's columns as position, on a plain frame."""

import datetime as dt

import pytest

from marketbars.operators.delivery import delivery_audit
from marketbars.sources import topics
from marketbars.sources.topics import kafka_rows


def test_arrival_orders_messages_of_different_partitions(spark):
    base = dt.datetime(2025, 1, 31, 9, 30)
    rows = [
        (b"late", 2, 0, base + dt.timedelta(seconds=5)),
        (b"first", 10, 7, base),
        (b"tie2", 10, 9, base + dt.timedelta(seconds=1)),
        (b"tie1", 9, 50, base + dt.timedelta(seconds=1)),
    ]
    frame = spark.createDataFrame(rows, "value binary, partition int, offset bigint, timestamp timestamp")
    got = [r.value for r in kafka_rows(frame).orderBy("position").collect()]
    assert got == ["first", "tie1", "tie2", "late"]


def audit(spark, rows, chunk):
    frame = spark.createDataFrame(rows, "partition int, offset bigint, batch bigint")
    return sorted(
        ((r.kind, r.partition, r.batch, r.first_offset, r.last_offset, r.n_offsets)
         for r in delivery_audit(frame, chunk).collect()),
        key=str,
    )


@pytest.mark.parametrize("chunk", [3, 1_000_000])
def test_lost_repeated_and_late_offsets(spark, chunk):
    rows = [(0, o, 0) for o in [*range(10, 20), *range(23, 30)]]
    # Read again: within a batch, and by a later one; late: behind what batch 0 had brought.
    rows += [(0, 15, 0), (0, 28, 1), (0, 29, 1), (0, 21, 1), (0, 30, 1), (0, 9, 2), (0, 21, 2)]
    rows += [(1, 5, 4), (1, 4, 4), (1, 7, 5)]
    assert audit(spark, rows, chunk) == sorted(
        [
            ("delivered", 0, None, 9, 19, 11),
            ("delivered", 0, None, 21, 21, 1),
            ("delivered", 0, None, 23, 30, 8),
            ("delivered", 1, None, 4, 5, 2),
            ("delivered", 1, None, 7, 7, 1),
            ("lost", 0, None, 20, 20, 1),
            ("lost", 0, None, 22, 22, 1),
            ("lost", 1, None, 6, 6, 1),
            ("repeated", 0, 0, 15, 15, 1),
            ("repeated", 0, 1, 28, 29, 2),
            ("repeated", 0, 2, 21, 21, 1),
            ("late", 0, 1, 21, 21, 1),
            ("late", 0, 2, 9, 9, 1),
        ],
        key=str,
    )


def test_one_busy_partition_and_none(spark):
    rows = [(7, o, 0) for o in range(1000) if o % 100 != 50] + [(8, 1, 0)]
    found = audit(spark, rows, 64)
    assert len([r for r in found if r[0] == "lost"]) == 10
    assert sum(r[5] for r in found if r[0] == "delivered") == 991
    assert audit(spark, [], 64) == []


def test_written_topics_are_compressed_and_read_in_order(spark, tmp_path):
    path = str(tmp_path / "topic")
    texts = [f'{{"n":{i}}}' for i in range(50)]
    frame = spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1)
    topics.write_files(frame, path)
    files = [f.name for f in (tmp_path / "topic").glob("part-*")]
    assert files and all(name.endswith(".lz4") for name in files)
    assert [r.value for r in topics.read_files(spark, path).collect()] == texts
