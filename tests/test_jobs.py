import datetime as dt
import json
from decimal import Decimal

import pytest
from helpers import brute_daily, brute_intraday, document, fields
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from marketbars import session
from marketbars.__main__ import main
from marketbars.operators.indicators import analytics
from marketbars.operators.metrics import bars_per_symbol, message_totals
from marketbars.operators.messages import classify_messages
from marketbars.operators.sums import stretch_sums
from marketbars.operators.upsert import upsert
from marketbars.plans import jobs
from marketbars.schemas import DAILY, INTRADAY, moment
from marketbars.sources import landed as landed_source
from marketbars.sources import topics
from marketbars.sources.tables import Tables
from marketbars.streaming.ingest import ingest_batch

RUN1, RUN2, RUN3 = (dt.datetime(2025, 2, 1, h) for h in (10, 11, 12))


def series(times, shift=0):
    return {
        str(t): fields(close=f"{(7 * i + shift) % 50 + 1}.25", volume=str(i + 1))
        for i, t in enumerate(times)
    }


def land(folder, envelopes):
    folder.mkdir(exist_ok=True)
    path = folder / "envelopes.json"
    path.write_text("".join(json.dumps(e) + "\n" for e in envelopes))
    return str(folder)


def counts(sent, processed, affected):
    return {
        "messages_sent": sent,
        "messages_processed": processed,
        "messages_rejected": 0,
        "rows_affected": affected,
    }


class World:
    """One cadence's folders and a shorthand for a scheduled run."""

    def __init__(self, spark, tmp_path, cadence):
        self.spark, self.cadence, self.tmp = spark, cadence, tmp_path
        self.tables = Tables(str(tmp_path / "tables"), cadence)
        self.topic = str(tmp_path / "topic")

    def run(self, envelopes, as_of, symbols=("A", "B")):
        path = land(self.tmp / f"landed-{as_of:%H}", envelopes)
        return jobs.run(
            self.spark,
            self.tables,
            landed_source.read_landed(self.spark, path),
            send=lambda messages: topics.write_files(messages, self.topic),
            receive=lambda: topics.stream_files(self.spark, self.topic),
            checkpoint=str(self.tmp / "offsets"),
            as_of=as_of,
            symbols=symbols,
        )

    def rows(self, layer):
        return [tuple(r) for r in self.tables.read(self.spark, layer).collect()]


def envelope(symbol, last, data, key="Time Series (5min)", status=200):
    return {"symbol": symbol, "status": status, "body": document(str(last), data, key)}


@pytest.fixture()
def hours():
    start = dt.datetime(2025, 1, 31, 9)
    return [start + dt.timedelta(minutes=20 * i) for i in range(60)]


def test_intraday_runs(spark, tmp_path, hours):
    world = World(spark, tmp_path, INTRADAY)
    first = world.run(
        [
            envelope("A", hours[39], series(hours[:40])),
            envelope("B", hours[39], series(hours[:40], shift=3)),
            envelope("X", hours[39], series(hours[:40])),
            {"symbol": "A", "status": 200, "body": '{"Note": "slow down"}'},
        ],
        RUN1,
    )
    # Untracked X is not sent.
    assert first == counts(80, 80, 80)
    # Landed again with new bars: only these are sent, only rows they reach are refreshed.
    second = world.run([envelope("A", hours[-1], series(hours))], RUN2)
    assert second == counts(20, 20, 60)
    # Nothing new and not a newer stamp: no row changes.
    third = world.run([envelope("A", hours[-1], series(hours))], RUN2)
    assert third == counts(0, 0, 0)

    expected = brute_intraday(world.rows("staging"))
    final = world.tables.read(spark, "final").collect()
    assert {
        (r.symbol, r.timestamp): (r.prev_close, r.price_change_pct, r.vwap) for r in final
    } == expected
    assert {(r.symbol, r.last_refreshed) for r in final} == {("A", RUN2), ("B", RUN1)}
    assert [r[2] for r in world.rows("quarantine")] == ["rate_limit"]


def test_daily_runs_and_batch_refresh(spark, tmp_path):
    world = World(spark, tmp_path, DAILY)
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(130)]
    key = "Time Series (Daily)"
    # The first landing reaches back one day only, so stage the history as messages.
    world.tables.create(spark)
    history = [
        json.dumps({"symbol": s, "date": d, "data": {d: f}})
        for s, shift in (("A", 0), ("B", 5))
        for d, f in series(days[:100], shift).items()
    ]
    (tmp_path / "topic").mkdir()
    (tmp_path / "topic" / "history.json").write_text("\n".join(history) + "\n")
    first = world.run([envelope("A", days[99], series(days[:100]), key)], RUN1)
    # A one-day look-back exclusive of its start: only the newest bar, staged before as history.
    assert first == counts(1, 201, 200)

    full = {r[:2]: r for r in world.rows("final")}
    known = {r.batch for r in spark.read.parquet(world.tables.path("staging")).collect()}
    sent = jobs.extract_delta(
        landed_source.read_landed(
            spark, land(tmp_path / "more", [envelope("A", days[-1], series(days), key)])
        ),
        world.tables,
        lambda messages: topics.write_files(messages, world.topic),
        symbols=None,
    )
    assert sent == 30
    jobs.stream_ingest(
        topics.stream_files(spark, world.topic), world.tables, str(tmp_path / "offsets")
    ).awaitTermination()
    stored = spark.read.parquet(world.tables.path("staging"))
    new = [r.batch for r in stored.select("batch").distinct().collect() if r.batch not in known]
    # Only the new bars of A are touched; values equal those of a full refresh.
    assert jobs.refresh_batches(spark, world.tables, new, RUN2) == 30
    final = {r[:2]: r for r in world.rows("final")}
    assert len(final) == 230
    assert all(final[k] == full[k] for k in full)
    expected = brute_daily(world.rows("staging"))
    assert {k: (r[8], r[9], r[10], r[11]) for k, r in final.items()} == expected
    assert jobs.refresh(spark, world.tables, RUN3) == 230
    assert {r[:2]: (r[8], r[9], r[10], r[11]) for r in world.rows("final")} == expected


def test_late_intraday_bar_is_repaired(spark, tmp_path, hours):
    world = World(spark, tmp_path, INTRADAY)
    world.tables.create(spark)
    (tmp_path / "topic").mkdir()

    def send(name, times):
        lines = [
            json.dumps({"symbol": "A", "timestamp": t, "data": {t: f}})
            for t, f in series(hours).items()
            if t in {str(x) for x in times}
        ]
        (tmp_path / "topic" / name).write_text("\n".join(lines) + "\n")
        jobs.stream_ingest(
            topics.stream_files(spark, world.topic), world.tables, str(tmp_path / "offsets")
        ).awaitTermination()
        stored = spark.read.parquet(world.tables.path("staging"))
        return {r.batch for r in stored.select("batch").distinct().collect()}

    before = send("a.json", [t for i, t in enumerate(hours) if i != 5])
    assert jobs.refresh(spark, world.tables, RUN1) == 59
    after = send("b.json", [hours[5]])
    jobs.refresh_batches(spark, world.tables, list(after - before), RUN2, max_group=4)
    final = world.tables.read(spark, "final").collect()
    assert {
        (r.symbol, r.timestamp): (r.prev_close, r.price_change_pct, r.vwap) for r in final
    } == brute_intraday(world.rows("staging"))


def stage(world, name, times, symbol="A"):
    folder = world.tmp / "topic"
    folder.mkdir(exist_ok=True)
    lines = [
        json.dumps({"symbol": symbol, "timestamp": t, "data": {t: f}})
        for t, f in series(times).items()
    ]
    (folder / name).write_text("\n".join(lines) + "\n")
    return jobs.ingest(
        topics.stream_files(world.spark, world.topic), world.tables, str(world.tmp / "offsets")
    )


def test_a_failed_merge_is_made_up(spark, tmp_path, hours, monkeypatch):
    world = World(spark, tmp_path, INTRADAY)
    stage(world, "a.json", hours[:30])
    assert jobs.refresh_outstanding(spark, world.tables, RUN1) == 30
    before = world.rows("final")
    stage(world, "b.json", hours[30:40])

    def failing(*args, **kwargs):
        raise OSError("storage is gone")

    # The new version is written, but never put in force.
    with monkeypatch.context() as patch:
        patch.setattr(Tables, "commit", failing)
        with pytest.raises(OSError):
            jobs.refresh_outstanding(spark, world.tables, RUN2)
    assert sorted(world.rows("final")) == sorted(before)
    stage(world, "c.json", hours[40:])
    assert len(world.tables.outstanding(spark)) == 2
    jobs.refresh_outstanding(spark, world.tables, RUN3)
    assert world.tables.outstanding(spark) == []
    final = world.tables.read(spark, "final").collect()
    assert {
        (r.symbol, r.timestamp): (r.prev_close, r.price_change_pct, r.vwap) for r in final
    } == brute_intraday(world.rows("staging"))


def test_a_merge_touches_only_its_periods(spark, tmp_path):
    world = World(spark, tmp_path, INTRADAY)
    days = [dt.datetime(2025, 1, 1) + dt.timedelta(days=i) for i in range(6)]
    for day in days:
        stage(world, f"{day:%d}.json", [day, day + dt.timedelta(hours=1)])
    jobs.refresh_outstanding(spark, world.tables, RUN1)
    first = dict(world.tables.live(spark, "final"))
    stage(world, "late.json", [days[2] + dt.timedelta(hours=2)])
    jobs.refresh_outstanding(spark, world.tables, RUN2)
    second = dict(world.tables.live(spark, "final"))
    changed = {p for p in second if first[p] != second[p]}
    assert changed == {days[2].date(), days[3].date()}
    assert len(world.rows("final")) == 13


def sums_of_staging(world):
    bars = world.tables.read(world.spark, "staging")
    return sorted(map(tuple, stretch_sums(bars, world.cadence).collect()))


@pytest.mark.parametrize("cadence", [INTRADAY, DAILY])
def test_sums_follow_every_merge(spark, tmp_path, hours, cadence, monkeypatch):
    world = World(spark, tmp_path, cadence)
    world.tables.create(spark)
    start = dt.datetime(2025, 1, 27, 9)
    times = [start + dt.timedelta(hours=13 * i) for i in range(24)]
    if cadence is DAILY:
        times = [(start + dt.timedelta(days=5 * i)).date() for i in range(24)]

    def put(batch, some, symbols=("A", "B")):
        name = "timestamp" if cadence is INTRADAY else "date"
        lines = [
            (json.dumps({"symbol": s, name: t, "data": {t: f}}),)
            for s in symbols
            for t, f in series(times).items()
            if t in {str(x) for x in some}
        ]
        frame = spark.createDataFrame(lines, "value string")
        ingest_batch(frame.withColumn("position", F.struct(F.lit(0))), world.tables, batch)

    def check():
        assert sorted(world.rows("sums")) == sums_of_staging(world)
        brute = brute_intraday if cadence is INTRADAY else brute_daily
        columns = (9, 10, 11) if cadence is INTRADAY else (8, 9, 10, 11)
        final = {r[:2]: tuple(r[c] for c in columns) for r in world.rows("final")}
        assert final == brute(world.rows("staging"))

    put("b0", times[::2])
    assert jobs.refresh_outstanding(spark, world.tables, RUN1) == 24
    check()
    put("b1", times[5:12])
    put("b2", times[20:], symbols=("C", "A"))
    jobs.refresh_outstanding(spark, world.tables, RUN2)
    check()
    # A merge that fails leaves the sums as they were; merging a batch again adds nothing.
    put("b3", times[12:])
    with monkeypatch.context() as patch:
        patch.setattr(Tables, "commit", lambda *args: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            jobs.refresh_outstanding(spark, world.tables, RUN2)
    put("b4", times[:5])
    jobs.refresh_batches(spark, world.tables, ["b1", "b4"], RUN3)
    check()
    assert jobs.refresh_batches(spark, world.tables, ["b3"], RUN3) == 0
    check()


def test_a_table_without_sums_is_refreshed_as_a_whole(spark, tmp_path, hours, monkeypatch):
    world = World(spark, tmp_path, INTRADAY)
    stage(world, "a.json", hours[:30])
    commit = Tables.commit

    def before_there_were_sums(self, spark, entries):
        commit(self, spark, [e for e in entries if e[0] != "sums"])

    with monkeypatch.context() as patch:
        patch.setattr(Tables, "commit", before_there_were_sums)
        jobs.refresh_outstanding(spark, world.tables, RUN1)
    assert world.rows("sums") == []
    stage(world, "b.json", hours[30:])
    assert jobs.refresh_outstanding(spark, world.tables, RUN2) == 60
    assert sorted(world.rows("sums")) == sums_of_staging(world)


def test_a_late_bar_opens_its_day_and_the_next_one_with_bars(spark, tmp_path, monkeypatch):
    world = World(spark, tmp_path, INTRADAY)
    days = [dt.datetime(2024, 1, 1) + dt.timedelta(days=100 * i) for i in range(7)]
    for i, day in enumerate(days):
        stage(world, f"{i}.json", [day, day + dt.timedelta(hours=1)])
    jobs.refresh_outstanding(spark, world.tables, RUN1)
    stage(world, "late.json", [days[4] + dt.timedelta(hours=2)])
    opened = []
    read = Tables.read_folders

    def watched(self, spark, layer, folders):
        opened.extend((layer, period) for period, _ in folders)
        return read(self, spark, layer, folders)

    monkeypatch.setattr(Tables, "read_folders", watched)
    jobs.refresh_outstanding(spark, world.tables, RUN2)
    day, next_ = days[4].date(), days[5].date()
    assert {p for layer, p in opened if layer == "staging"} == {day, next_}
    assert {p for layer, p in opened if layer == "final"} == {day, next_}
    final = {r.timestamp: r for r in world.tables.read(spark, "final").collect()}
    changed = {t for t, r in final.items() if r.last_refreshed == RUN2}
    late = days[4] + dt.timedelta(hours=2)
    assert changed == {days[4], days[4] + dt.timedelta(hours=1), late, days[5]}
    assert final[days[5]].prev_close == final[late].close


def test_sending_may_run_no_job(spark, tmp_path, hours):
    world = World(spark, tmp_path, INTRADAY)
    world.tables.create(spark)
    path = land(tmp_path / "landed", [envelope("A", hours[-1], series(hours))])
    landed = landed_source.read_landed(spark, path)
    assert jobs.extract_delta(landed, world.tables, lambda messages: None, symbols=None) == 60


def test_a_document_dated_far_ahead(spark, tmp_path, hours):
    world = World(spark, tmp_path, INTRADAY)
    stage(world, "a.json", hours[:30])
    ahead = dt.datetime(9000, 1, 1)
    path = land(
        tmp_path / "landed",
        [envelope("A", hours[-1], series(hours)), envelope("B", ahead, series(hours))]
        + [envelope("C", "12345-01-01 00:00:00", series(hours))],
    )
    landed = landed_source.read_landed(spark, path)
    sent = jobs.extract_delta(landed, world.tables, lambda messages: None, symbols=None)
    # B has nothing within a day of its date, C is rejected alone; A is looked up as ever.
    assert sent == 30
    assert [r[2] for r in world.rows("quarantine")] == ["bad_value"]


def test_empty_tables_refresh(spark, tmp_path):
    for cadence in (INTRADAY, DAILY):
        tables = Tables(str(tmp_path / cadence.name), cadence)
        tables.create(spark)
        assert jobs.refresh(spark, tables, RUN1) == 0
        assert jobs.refresh_batches(spark, tables, ["unknown"], RUN1) == 0
        assert tables.read(spark, "final").count() == 0


@pytest.mark.parametrize("envelopes", [[], [{"symbol": "A", "status": 500, "body": "{}"}]])
def test_nothing_usable_landed(spark, tmp_path, envelopes):
    world = World(spark, tmp_path, INTRADAY)
    assert world.run(envelopes, RUN1) == counts(0, 0, 0)
    assert len(world.rows("quarantine")) == len(envelopes)


def test_a_rerun_replaces_its_rejects(spark, tmp_path):
    world = World(spark, tmp_path, INTRADAY)
    world.tables.create(spark)
    path = land(tmp_path / "landed", [{"symbol": "A", "status": 500, "body": "{}"}])
    landed = landed_source.read_landed(spark, path)
    for run_id in ("r1", "r1", "r2"):
        jobs.extract_delta(landed, world.tables, lambda messages: None, None, run_id)
    assert [r[2] for r in world.rows("quarantine")] == ["http_status"] * 2


def test_landed_responses_are_extracted_once_as_they_come(spark, tmp_path, hours):
    world = World(spark, tmp_path, INTRADAY)
    folder = tmp_path / "landed"
    folder.mkdir()

    def put(name, envelopes):
        (folder / name).write_text("".join(json.dumps(e) + "\n" for e in envelopes))

    def run(as_of):
        return jobs.run(
            spark,
            world.tables,
            landed_source.stream_landed(spark, str(folder), 1000),
            send=lambda messages: topics.write_files(messages, world.topic),
            receive=lambda: topics.stream_files(spark, world.topic),
            checkpoint=str(tmp_path / "offsets"),
            as_of=as_of,
            symbols=("A", "B"),
        )

    put("1.json", [envelope("A", hours[29], series(hours[:30])), envelope("X", hours[0], {})])
    put("2.json", [{"symbol": "B", "status": 500, "body": "{}"}])
    assert run(RUN1) == counts(30, 30, 30)
    assert run(RUN2) == counts(0, 0, 0)
    put("3.json", [envelope("A", hours[39], series(hours[:40]))])
    put("4.json", [envelope("B", hours[39], series(hours[:40]))])
    assert run(RUN2)["messages_sent"] == 50
    assert len(world.rows("staging")) == 80
    assert [r[2] for r in world.rows("quarantine")] == ["http_status"]
    # Each batch of messages is counted as it is stored.
    runs = world.tables.read(spark, "runs").collect()
    assert sum(r.n_bars for r in runs) == 80 and all(r.seconds > 0 for r in runs)


def test_a_died_extract_batch_is_done_again(spark, tmp_path, hours):
    world = World(spark, tmp_path, INTRADAY)
    folder = land(tmp_path / "landed", [envelope("A", hours[-1], series(hours)), {"symbol": "A"}])
    sent = []

    def extract(send):
        return jobs.extract_stream(
            landed_source.stream_landed(spark, folder), world.tables, send,
            str(tmp_path / "offsets"), symbols=None,
        )

    def dying(messages):
        sent.append(messages.count())
        raise OSError("the broker is gone")

    with pytest.raises(Exception, match="the broker is gone"):
        extract(dying)
    assert extract(lambda messages: sent.append(messages.count())) == 60
    assert sent == [60, 60]
    assert [r[2] for r in world.rows("quarantine")] == ["http_status"]
    assert extract(lambda messages: sent.append(-1)) == 0


def test_bare_bodies(spark, tmp_path):
    folder = tmp_path / "bodies" / "symbol=A"
    folder.mkdir(parents=True)
    (folder / "1.json").write_text(document("2025-01-31 13:00:00", {}))
    row = landed_source.read_landed_bodies(spark, str(tmp_path / "bodies")).head()
    assert (row.symbol, row.status) == ("A", 200)
    assert json.loads(row.body)["Time Series (5min)"] == {}


def test_metrics(spark):
    bars = spark.createDataFrame(
        [(s,) for s in ["AA1"] * 3 + ["AA2"] * 2 + ["B"] + ["ZZ"] * 4], "symbol string"
    )
    got = [tuple(r) for r in bars_per_symbol(bars).orderBy("symbol").collect()]
    assert got == [("AA1", 3, 3), ("AA2", 2, 5), ("B", 1, 6), ("ZZ", 4, 10)]
    # Symbols that all begin alike are dealt to many tasks none the less.
    same = spark.range(2000).selectExpr("concat('US00', lpad(id % 500, 6, '0')) AS symbol")
    totals = bars_per_symbol(same).orderBy("symbol").collect()
    assert [r.running_total for r in totals] == [4 * (i + 1) for i in range(500)]
    assert bars_per_symbol(same.limit(0)).collect() == []

    texts = ['{"terminate": true}', "[]", json.dumps(
        {"symbol": "A", "data": {str(RUN1): fields(), str(RUN2): fields()}}
    )]
    frame = spark.createDataFrame([(t,) for t in texts], "value string")
    totals = message_totals(classify_messages(frame, INTRADAY)).head()
    assert totals.asDict() == {
        "n_messages": 3, "n_processed": 2, "n_rejected": 1, "n_bars": 2,
    }


def test_command_line(spark, tmp_path, hours, capsys):
    folder = land(tmp_path / "landed", [envelope("AAPL", hours[-1], series(hours))])
    common = ["--cadence", "intraday", "--tables", str(tmp_path / "tables")]
    topic = ["--topic-dir", str(tmp_path / "topic")]
    offsets = ["--offsets", str(tmp_path / "offsets")]
    stamp = ["--as-of", "2025-02-01T10:00:00"]

    def call(*arguments):
        main(list(arguments))
        return json.loads(capsys.readouterr().out.strip().splitlines()[-1])

    assert call("extract", *common, *topic, "--landed", folder) == {"messages_sent": 60}
    assert call("ingest", *common, *topic, *offsets)["n_bars"] == 60
    assert call("refresh", *common, *stamp) == {"rows_affected": 60}
    again = call("run", *common, *topic, *offsets, *stamp, "--landed", folder)
    assert again == counts(0, 0, 0)
    with pytest.raises(SystemExit):
        main(["extract", *common, *topic])


def test_documents_are_cached_by_few_and_without_the_text_of_good_ones(spark, tmp_path, monkeypatch):
    # A task that caches holds up to a hundred batches; by default each has 4 MB of documents.
    tables = Tables(str(tmp_path / "tables"), INTRADAY)
    tables.create(spark)
    time = dt.datetime(2024, 1, 31, 9, 30)
    envelopes = [envelope(s, time, series([time])) for s in "AB"]
    envelopes.append(envelope("C", time, series([time]), status=503))
    landed = landed_source.read_landed(spark, land(tmp_path / "landed", envelopes))
    before, rows, cached = spark.conf.get(session.CACHED_ROWS_SETTING), [], []
    persist = DataFrame.persist
    monkeypatch.setattr(DataFrame, "persist", lambda s, *a: cached.append(s) or persist(s, *a))

    def send(messages):
        rows.append(int(spark.conf.get(session.CACHED_ROWS_SETTING)))

    assert jobs.extract_delta(landed, tables, send, symbols=None) == 2
    assert rows == [session.CACHED_DOCUMENTS] and rows[0] <= 50
    assert spark.conf.get(session.CACHED_ROWS_SETTING) == before
    kept = {r.symbol: r.body for r in cached[0].collect()}
    assert kept["A"] is None and kept["B"] is None and "Time Series" in kept["C"]
    quarantine = tables.read(spark, "quarantine").collect()
    assert [(r.reason, r.value) for r in quarantine] == [("http_status", kept["C"])]


def test_a_merge_into_an_empty_table_joins_nothing(spark, tmp_path):
    tables = Tables(str(tmp_path / "tables"), DAILY)
    tables.create(spark)
    row = ("A", dt.date(2024, 1, 1), *[Decimal("1.00")] * 4, 5)
    bars = spark.createDataFrame([row], DAILY.staging_schema)
    fresh = analytics(bars, DAILY, moment(RUN1))
    merged = upsert(tables.read(spark, "final"), fresh, DAILY)
    assert "Join" not in merged._jdf.queryExecution().optimizedPlan().toString()
    [got] = merged.collect()
    assert (got.symbol, got.close, got.action) == ("A", Decimal("1.00"), "insert")
