import datetime as dt
import json
import time

import pytest
from helpers import DAY0, TIME0, message
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from marketbars import session
from marketbars.schemas import DAILY, INTRADAY
from marketbars.sources import topics
from marketbars.sources.tables import Tables
from marketbars.streaming import ingest
from marketbars.streaming.ingest import ingest_batch, stream_ingest
from marketbars.streaming.repeats import STATE_SETTINGS


@pytest.fixture()
def tables(spark, tmp_path):
    made = Tables(str(tmp_path / "tables"), INTRADAY)
    made.create(spark)
    return made


def write_lines(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(line + "\n" for line in lines))


def times(n, start=0):
    return [str(TIME0 + dt.timedelta(minutes=5 * (start + i))) for i in range(n)]


def run_stream(spark, tables, topic, offsets, **options):
    query = stream_ingest(topics.stream_files(spark, str(topic), **options), tables, str(offsets))
    query.awaitTermination()
    return query


def rows(spark, tables, layer):
    return sorted(map(tuple, tables.read(spark, layer).collect()), key=str)


def reasons(spark, tables):
    return sorted(r.reason for r in tables.read(spark, "quarantine").collect())


def test_stream_with_restart(spark, tables, tmp_path):
    topic, offsets = tmp_path / "topic", tmp_path / "offsets"
    write_lines(topic, "a.json", [message("A", t) for t in times(40)] + ["[]"])
    write_lines(topic, "b.json", [message("B", t) for t in times(40)] + ['{"terminate": true}'])
    query = run_stream(spark, tables, topic, offsets, max_files=1)
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 2
    assert len(rows(spark, tables, "staging")) == 80
    # A repeated bar with another close loses; a second start only sees the new file.
    write_lines(topic, "c.json", [message("A", times(1)[0], close="9.99")] + [
        message("A", t) for t in times(3, start=40)
    ])
    run_stream(spark, tables, topic, offsets)
    staged = rows(spark, tables, "staging")
    assert len(staged) == 83
    assert {str(r[5]) for r in staged} == {"1.50"}
    assert [r[:7] for r in rows(spark, tables, "raw")] == staged
    assert reasons(spark, tables) == ["duplicate_key", "not_object"]
    loser = tables.read(spark, "quarantine").filter("reason = 'duplicate_key'").head()
    assert json.loads(loser.value) == json.loads(message("A", times(1)[0], close="9.99"))
    # Nothing new: nothing changes.
    run_stream(spark, tables, topic, offsets)
    assert rows(spark, tables, "staging") == staged


def test_first_line_of_a_file_wins(spark, tables, tmp_path):
    topic = tmp_path / "topic"
    write_lines(topic, "a.json", [message("A", times(1)[0], close=f"{i}.00") for i in range(1, 60)])
    run_stream(spark, tables, topic, tmp_path / "offsets")
    assert [str(r[5]) for r in rows(spark, tables, "staging")] == ["1.00"]
    assert reasons(spark, tables) == ["duplicate_key"] * 58


def read_batch(spark, tmp_path, lines):
    write_lines(tmp_path / "batch", "a.json", lines)
    return topics.read_files(spark, str(tmp_path / "batch"))


def test_replay_changes_nothing(spark, tables, tmp_path):
    lines = [message("A", t) for t in times(5)] * 2 + ["{bad"]
    batch = read_batch(spark, tmp_path, lines)
    ingest_batch(batch, tables, "q-0")
    before = [rows(spark, tables, layer) for layer in ("raw", "staging", "quarantine")]
    ingest_batch(batch, tables, "q-0")
    assert [rows(spark, tables, layer) for layer in ("raw", "staging", "quarantine")] == before
    # The same messages in a later batch are duplicates.
    ingest_batch(batch, tables, "q-1")
    assert rows(spark, tables, "staging") == before[1]
    assert len(rows(spark, tables, "quarantine")) == len(before[2]) + len(lines)


def test_replay_completes_a_half_written_batch(spark, tables, tmp_path, monkeypatch):
    batch = read_batch(spark, tmp_path, [message("A", t) for t in times(5)])
    write = Tables.write

    def failing(self, frame, layer, name, **options):
        if layer == "staging":
            raise OSError("storage is gone")
        write(self, frame, layer, name, **options)

    monkeypatch.setattr(Tables, "write", failing)
    with pytest.raises(OSError):
        ingest_batch(batch, tables, "q-0")
    monkeypatch.undo()
    assert len(rows(spark, tables, "raw")) == 5
    assert rows(spark, tables, "staging") == []
    ingest_batch(batch, tables, "q-0")
    assert len(rows(spark, tables, "raw")) == 5
    assert len(rows(spark, tables, "staging")) == 5
    assert rows(spark, tables, "quarantine") == []


def test_failed_batch_fails_the_query(spark, tables, tmp_path, monkeypatch):
    write_lines(tmp_path / "topic", "a.json", [message("A", t) for t in times(3)])

    def failing(*args, **kwargs):
        raise OSError("storage is gone")

    with monkeypatch.context() as patch:
        patch.setattr(ingest, "ingest_batch", failing)
        with pytest.raises(Exception, match="storage is gone"):
            run_stream(spark, tables, tmp_path / "topic", tmp_path / "offsets")
    run_stream(spark, tables, tmp_path / "topic", tmp_path / "offsets")
    assert len(rows(spark, tables, "staging")) == 3


def test_empty_batch(spark, tables, tmp_path):
    ingest_batch(read_batch(spark, tmp_path, []), tables, "q-0")
    for layer in ("raw", "staging", "quarantine"):
        assert rows(spark, tables, layer) == []


def test_only_control_messages(spark, tables, tmp_path):
    ingest_batch(read_batch(spark, tmp_path, ['{"terminate": true}'] * 3), tables, "q-0")
    for layer in ("raw", "staging", "quarantine"):
        assert rows(spark, tables, layer) == []


def test_hot_key_batch(spark, tables, tmp_path):
    lines = [message("A", times(1)[0], close=f"{i}.00") for i in range(1, 40)]
    batch = read_batch(spark, tmp_path, lines + [message("A", t) for t in times(20, start=1)])
    ingest_batch(batch, tables, "q-0", max_group=5)
    staged = rows(spark, tables, "staging")
    assert len(staged) == 21
    assert [str(r[5]) for r in staged if r[1] == TIME0] == ["1.00"]
    assert len(rows(spark, tables, "quarantine")) == 38


def test_created_tables_keep_their_rows(spark, tmp_path):
    tables = Tables(str(tmp_path / "tables"), DAILY)
    tables.create(spark)
    lines = [message("A", str(DAY0 + dt.timedelta(days=40 * i)), cadence="daily") for i in range(4)]
    ingest_batch(read_batch(spark, tmp_path, lines), tables, "q-0")
    tables.create(spark)
    assert tables.read(spark, "staging").count() == 4
    one_month = tables.read(spark, "staging", where=lambda period, _: period == DAY0)
    assert one_month.count() == 1
    # Only that month's folder is listed.
    assert all(f"period={DAY0}" in file for file in one_month.inputFiles())
    assert len(tables.read(spark, "staging").inputFiles()) > len(one_month.inputFiles())


def test_files_are_sorted_by_key(spark, tables, tmp_path):
    lines = [message(s, t) for t in reversed(times(30)) for s in ("C", "A", "B")]
    ingest_batch(read_batch(spark, tmp_path, lines), tables, "q-0")
    for file in spark.read.parquet(tables.path("staging")).inputFiles():
        keys = [(r.symbol, r.timestamp) for r in spark.read.parquet(file).collect()]
        assert keys == sorted(keys)


def test_bars_of_other_periods_are_not_read(spark, tables, tmp_path):
    batch = read_batch(spark, tmp_path, [message("A", t) for t in times(2)])
    ingest_batch(batch, tables, "q-0")
    periods = tables.periods_of(tables.read(spark, "staging"))
    assert periods == {TIME0.date()}
    some = tables.read(spark, "staging", where=lambda period, _: period in periods)
    assert some.count() == 2
    assert tables.periods_of(some.filter(F.lit(False))) == set()
    assert tables.read(spark, "staging", where=lambda *_: False).count() == 0


def test_a_year_out_of_range_blocks_nothing(spark, tables, tmp_path):
    topic, offsets = tmp_path / "topic", tmp_path / "offsets"
    odd = ["12345-01-01 00:00:00", "0000-01-01 00:00:00", "-0001-01-01 00:00:00"]
    write_lines(topic, "a.json", [message("A", t) for t in [*times(3), *odd]])
    run_stream(spark, tables, topic, offsets)
    assert len(rows(spark, tables, "staging")) == 3
    assert reasons(spark, tables) == ["bad_value"] * 3
    # The offsets moved on: a second start finds nothing to do.
    query = run_stream(spark, tables, topic, offsets)
    assert not any(p["numInputRows"] for p in query.recentProgress)


@pytest.mark.parametrize("limit", [1_000_000, 1])
def test_a_key_twice_in_one_message(spark, tables, tmp_path, limit):
    """One time in two spellings: one bar is staged whatever path the key takes."""
    first = json.loads(message("A", times(1)[0], close="1.00"))
    first["data"][times(1)[0].replace(" ", "T")] = json.loads(
        message("A", times(1)[0], close="2.00")
    )["data"][times(1)[0]]
    batch = read_batch(spark, tmp_path, [json.dumps(first), message("A", times(2)[1])])
    ingest_batch(batch, tables, "q-0", max_group=limit)
    assert [str(r[5]) for r in rows(spark, tables, "staging")] == ["1.00", "1.50"]
    assert reasons(spark, tables) == ["duplicate_key"]


def test_last_times_follow_every_batch(spark, tables, tmp_path):
    topic, offsets = tmp_path / "topic", tmp_path / "offsets"
    assert tables.latest(spark).collect() == []
    write_lines(topic, "a.json", [message("A", t) for t in times(5)] + [message("B", times(9)[8])])
    run_stream(spark, tables, topic, offsets)
    # Older bars and rejected ones do not move a time back or on.
    write_lines(topic, "b.json", [message("B", times(1)[0]), message("C", times(2)[1]), "[]"])
    run_stream(spark, tables, topic, offsets)
    got = {r.symbol: str(r.last_update) for r in tables.latest(spark).collect()}
    assert got == {"A": times(5)[4], "B": times(9)[8], "C": times(2)[1]}


def stateful(spark, tables, topic, offsets, within):
    query = stream_ingest(
        topics.stream_files(spark, str(topic)), tables, str(offsets), repeats_within=within
    )
    query.awaitTermination()
    return [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]


def test_repeats_are_dropped_before_they_are_stored(spark, tables, tmp_path):
    topic, offsets = tmp_path / "topic", tmp_path / "offsets"
    first = [message("A", t) for t in times(20)]
    write_lines(topic, "a.json", first + first[:5] + ["[]", "[]"])
    assert stateful(spark, tables, topic, offsets, "1 hour")[-1] == 21
    assert len(rows(spark, tables, "staging")) == 20
    assert reasons(spark, tables) == ["not_object"]
    # A restart knows them still; another bar of a known key goes to the tables and loses there,
    # and a bar far older than all others is taken.
    other = message("A", times(1)[0], close="9.99")
    old = message("A", "2001-01-01 09:30:00")
    write_lines(topic, "b.json", [*first, "[]", other, old, other])
    stateful(spark, tables, topic, offsets, "1 hour")
    staged = rows(spark, tables, "staging")
    assert len(staged) == 21 and {str(r[5]) for r in staged} == {"1.50"}
    assert reasons(spark, tables) == ["duplicate_key", "not_object"]


def test_the_state_of_repeats_shrinks_as_time_goes_on(spark, tables, tmp_path):
    topic, offsets = tmp_path / "topic", tmp_path / "offsets"
    sizes = []
    for i in range(4):
        write_lines(topic, f"{i}.json", [message("A", t) for t in times(30, start=30 * (i // 3))])
        sizes += stateful(spark, tables, topic, offsets, "1 second")
        time.sleep(1.5)
    # What has been forgotten is found out by the tables.
    assert len(rows(spark, tables, "staging")) == 60
    assert set(reasons(spark, tables)) <= {"duplicate_key"}
    assert max(sizes) <= 60
    write_lines(topic, "last.json", ["{bad"])
    assert stateful(spark, tables, topic, offsets, "1 second")[-1] < 30


def test_cached_batches_have_few_rows(spark, tables, monkeypatch):
    # By default a task that stores a cached partition holds up to a hundred batches of 4 MB.
    setting, seen = session.CACHED_ROWS_SETTING, []
    before = spark.conf.get(setting)
    write = tables.write

    def watched(*args, **options):
        seen.append(int(spark.conf.get(setting)))
        return write(*args, **options)

    monkeypatch.setattr(Tables, "write", lambda self, *args, **options: watched(*args, **options))
    messages = spark.createDataFrame([(message("A", t),) for t in times(3)], "value string")
    ingest_batch(messages.withColumn("position", F.struct(F.lit(0))), tables, "first")
    assert seen and max(seen) <= 1000
    assert spark.conf.get(setting) == before
    assert len(rows(spark, tables, "staging")) == 3


def test_the_state_of_repeats_lies_on_disk(spark, tables, tmp_path):
    topic, offsets = tmp_path / "topic", tmp_path / "offsets"
    write_lines(topic, "a.json", [message("A", t) for t in [*times(20), *times(5)]])
    before = {setting: spark.conf.get(setting, None) for setting in STATE_SETTINGS}
    query = stream_ingest(
        topics.stream_files(spark, str(topic)), tables, str(offsets), repeats_within="1 hour"
    )
    query.awaitTermination()
    state = query.recentProgress[0]["stateOperators"][0]
    assert state["numRowsTotal"] == 20
    assert any(name.startswith("rocksdb") for name in state["customMetrics"])
    assert {setting: spark.conf.get(setting, None) for setting in STATE_SETTINGS} == before
    assert len(rows(spark, tables, "staging")) == 20


def test_a_batch_is_kept_in_files_that_go(spark, tables, tmp_path, monkeypatch):
    cached = []
    persist = DataFrame.persist
    monkeypatch.setattr(DataFrame, "persist", lambda s, *a: cached.append(s) or persist(s, *a))
    lines = [message("A", t) for t in [*times(3), times(1)[0]]]
    frame = spark.createDataFrame([(line,) for line in [*lines, "[]"]], "value string")
    ingest_batch(frame.withColumn("position", F.struct(F.lit(0))), tables, "first")
    assert not cached
    assert len(rows(spark, tables, "staging")) == 3
    assert [r[:7] for r in rows(spark, tables, "raw")] == rows(spark, tables, "staging")
    assert reasons(spark, tables) == ["duplicate_key", "not_object"]
    assert list((tmp_path / "tables" / "scratch" / INTRADAY.bars_table).iterdir()) == []
