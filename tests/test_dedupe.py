import datetime as dt
import random
import re

import pytest
from helpers import TIME0, bar, intraday_frame
from pyspark.sql import functions as F

from marketbars.operators.constraints import constraint_violations
from marketbars.operators import skew
from marketbars.operators.dedupe import arrival, first_write_wins, known_keys, mark_duplicates
from marketbars.schemas import INTRADAY


def batch(spark, rows):
    """Rows of bar + position."""
    schema = ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in INTRADAY.staging_schema
    )
    return spark.createDataFrame(rows, f"{schema}, position bigint")


def stored_bars(spark, path, rows):
    intraday_frame(spark, rows).write.parquet(path)
    return spark.read.schema(INTRADAY.staging_schema).parquet(path)


@pytest.mark.parametrize("limit", [skew.BROADCAST_BYTES, 0])
def test_only_staged_keys_that_can_be_met_are_compared(spark, tmp_path, limit, monkeypatch):
    monkeypatch.setattr(skew, "BROADCAST_BYTES", limit)
    minutes = {s: range(60) for s in ("A", "B", "C", "D")}
    rows = [bar(s, TIME0 + dt.timedelta(minutes=m), m) for s, of in minutes.items() for m in of]
    staged = stored_bars(spark, str(tmp_path / "staged"), rows)
    late = [("B", 10), ("B", 12), ("B", 99), ("C", 20), ("C", 20), ("Bx", 15)]
    incoming = batch(
        spark,
        [(*bar(s, TIME0 + dt.timedelta(minutes=m), 1), i) for i, (s, m) in enumerate(late)],
    )
    came = arrival(incoming, INTRADAY)
    assert came.periods == {TIME0.date()}
    assert came.bounds["symbol"] == ("B", "C")
    known = known_keys(staged, incoming, INTRADAY.keys, came)
    found = sorted((r.symbol, (r.timestamp - TIME0).seconds // 60) for r in known.collect())
    between = [(s, m) for s in ("B", "C") for m in range(10, 60)]
    assert found == ([("B", 10), ("B", 12), ("C", 20)] if limit else between)
    marked = mark_duplicates(incoming, staged, INTRADAY.keys, "position", came=came)
    accepted = [r for r in marked.collect() if not r.duplicate]
    assert sorted((r.symbol, r.position) for r in accepted) == [("B", 2), ("Bx", 5)]
    # Bounds reach the scan, and the keys meet before the exchange of the window.
    text = marked._sc._jvm.PythonSQLUtils.explainString(marked._jdf.queryExecution(), "formatted")
    for pushed in ("GreaterThanOrEqual(symbol,B)", "LessThanOrEqual(symbol,C)"):
        assert pushed in text
    assert re.search(r"PushedFilters: [^\n]*GreaterThanOrEqual\(timestamp,", text)
    assert ("LeftSemi" in text) == bool(limit)


def test_nothing_arrived(spark):
    staged = intraday_frame(spark, [bar("A", TIME0, 1)])
    nothing = batch(spark, [])
    came = arrival(nothing, INTRADAY)
    assert (came.periods, came.size) == (set(), 0)
    assert known_keys(staged, nothing, INTRADAY.keys, came).collect() == []
    assert mark_duplicates(nothing, staged, INTRADAY.keys, "position", came=came).collect() == []


@pytest.mark.parametrize("max_group", [10**6, 5])
def test_first_copy_wins_and_staged_keys_are_taken(spark, max_group):
    rng = random.Random(3)
    rows = []
    for position in range(300):
        # A third of all rows are copies of one key.
        minute = 0 if position % 3 == 0 else rng.randint(1, 40)
        rows.append((*bar("A", TIME0 + dt.timedelta(minutes=minute), position), position))
    staged_times = {TIME0 + dt.timedelta(minutes=m) for m in (5, 6, 7)}
    staged = intraday_frame(spark, [bar("A", t, 1) for t in staged_times])
    expected = {}
    for row in rows:
        if row[1] not in staged_times:
            expected.setdefault(row[1], row)
    rng.shuffle(rows)
    incoming = batch(spark, rows)
    accepted = first_write_wins(incoming, staged, INTRADAY.keys, "position", max_group)
    assert sorted(tuple(r) for r in accepted.collect()) == sorted(expected.values())
    marked = mark_duplicates(incoming, staged, INTRADAY.keys, "position", max_group)
    assert marked.count() == len(rows)
    assert marked.filter("duplicate").count() == len(rows) - len(expected)


@pytest.mark.parametrize("max_group", [10**6, 5])
def test_hot_staged_key_rejects_all_copies(spark, max_group):
    incoming = batch(spark, [(*bar("A", TIME0, i), i) for i in range(50)])
    staged = intraday_frame(spark, [bar("A", TIME0, 1)])
    marked = mark_duplicates(incoming, staged, INTRADAY.keys, "position", max_group)
    assert marked.filter("duplicate").count() == 50


def test_constraint_violations(spark):
    rows = [bar("A", TIME0, 1), bar("A", TIME0, 2), bar("B", TIME0, 1)]
    frame = intraday_frame(spark, rows)
    broken = frame.withColumn("volume", F.when(F.col("symbol") != "B", F.col("volume"))).withColumn(
        "open_price", F.lit("1e9")
    )
    got = {r["check"]: r.violations for r in constraint_violations(broken, INTRADAY).collect()}
    assert {k: v for k, v in got.items() if v} == {
        "not_null:volume": 1,
        "range:open_price": 3,
        "unique:key": 1,
    }
    empty = constraint_violations(intraday_frame(spark, []), INTRADAY).collect()
    assert all(r.violations == 0 for r in empty)


@pytest.mark.parametrize("limit", [0, 64_000_000])
def test_only_bars_met_again_are_ranked(spark, monkeypatch, limit):
    monkeypatch.setattr(skew, "BROADCAST_BYTES", limit)
    rows = [bar("A", TIME0 + dt.timedelta(minutes=i), i) for i in range(5)]
    single = intraday_frame(spark, rows).withColumn("position", F.lit(0))
    empty = intraday_frame(spark, [])
    marked = mark_duplicates(single, empty, INTRADAY.keys, "position")
    text = marked._sc._jvm.PythonSQLUtils.explainString(marked._jdf.queryExecution(), "simple")
    assert "Window" not in text and "Exchange" not in text
    assert marked.filter("duplicate").count() == 0
    again = intraday_frame(spark, rows[:1]).withColumn("position", F.lit(1))
    marked = mark_duplicates(
        single.unionByName(again), intraday_frame(spark, rows[4:]), INTRADAY.keys, "position"
    )
    found = sorted((r.timestamp.minute - 30, r.position, r.duplicate) for r in marked.collect())
    assert found == [
        (0, 0, False),
        (0, 1, True),
        (1, 0, False),
        (2, 0, False),
        (3, 0, False),
        (4, 0, True),
    ]
