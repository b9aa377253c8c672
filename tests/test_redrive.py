import json

import pytest
from helpers import message
from pyspark.sql import functions as F
from test_ingest import reasons, rows, times

from marketbars.schemas import INTRADAY
from marketbars.sources.tables import Tables
from marketbars.streaming import redrive as module
from marketbars.streaming.ingest import ingest_batch
from marketbars.streaming.redrive import redrive, retries


@pytest.fixture()
def tables(spark, tmp_path):
    made = Tables(str(tmp_path / "tables"), INTRADAY)
    made.create(spark)
    return made


def put(spark, tables, batch, lines):
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "n int, value string")
    ingest_batch(frame.select("value", F.struct("n").alias("position")), tables, batch)


def fate(spark, tables):
    return {
        r.value: (r.copies, r.attempts, r.reason, r.status)
        for r in retries(spark, tables).collect()
    }


def mended(value):
    return F.replace(value, F.lit("?"), F.lit("1"))


BAD = message("A", times(2)[1], close="?.50")
HOPELESS = message("A", times(3)[2], close="x")


def counts(retried, accepted, parked=0):
    return {"n_retried": retried, "n_accepted": accepted, "n_parked": parked}


def test_mended_once_and_parked_after_three_attempts(spark, tables):
    put(spark, tables, "q-0", [message("A", times(1)[0]), BAD, HOPELESS, BAD, "[]"])
    assert fate(spark, tables)[BAD] == (2, 0, "bad_value", "waiting")
    # Tried as it is: nothing changes but the attempts.
    assert redrive(spark, tables) == counts(3, 0)
    assert len(rows(spark, tables, "staging")) == 1
    assert redrive(spark, tables, mended) == counts(3, 1)
    assert [str(r[5]) for r in rows(spark, tables, "staging")] == ["1.50", "1.50"]
    assert redrive(spark, tables, mended) == counts(2, 0, 2)
    assert redrive(spark, tables, mended) == counts(0, 0)
    assert fate(spark, tables) == {
        BAD: (2, 2, None, "accepted"),
        HOPELESS: (1, 3, "bad_value", "parked"),
        "[]": (1, 3, "not_object", "parked"),
    }
    # What was rejected again is not rejected anew; the tables know the mended bar.
    assert reasons(spark, tables) == ["bad_value"] * 3 + ["not_object"]
    assert tables.latest(spark).first().last_update.isoformat(sep=" ") == times(2)[1]
    # The same text again, later: it has been accepted already.
    put(spark, tables, "q-1", [BAD])
    assert fate(spark, tables)[BAD] == (3, 2, None, "accepted")


def test_a_rerun_changes_nothing(spark, tables):
    put(spark, tables, "q-0", [BAD, HOPELESS])
    for _ in range(2):
        assert redrive(spark, tables, mended, run_id="r") == counts(2, 1)
        assert len(rows(spark, tables, "staging")) == 1
        assert len(rows(spark, tables, "attempts")) == 2
        assert fate(spark, tables)[HOPELESS][1] == 1


def test_a_run_that_died_before_its_attempts_were_noted(spark, tables, monkeypatch):
    put(spark, tables, "q-0", [BAD])
    write = Tables.write

    def failing(self, frame, layer, *args, **options):
        if layer == "attempts":
            raise OSError("storage is gone")
        write(self, frame, layer, *args, **options)

    with monkeypatch.context() as patch:
        patch.setattr(Tables, "write", failing)
        with pytest.raises(OSError):
            redrive(spark, tables, mended, run_id="r")
    # Under another name: the bar is there, the message is done, the bar is not stored twice.
    assert redrive(spark, tables, mended) == counts(1, 1)
    assert len(rows(spark, tables, "staging")) == 1
    assert reasons(spark, tables) == ["bad_value", "duplicate_key"]
    assert module.redrive(spark, tables, mended) == counts(0, 0)


def test_nothing_to_try(spark, tables):
    assert redrive(spark, tables) == counts(0, 0)
    put(spark, tables, "q-0", [message("A", times(1)[0])] * 3 + [json.dumps({"terminate": True})])
    # Copies of a stored bar are no fault of the message.
    assert redrive(spark, tables) == counts(0, 0)
    assert retries(spark, tables).collect() == []


def test_only_good_messages_are_stored_again(spark, tables, monkeypatch):
    put(spark, tables, "first", [BAD, HOPELESS])
    stored = []

    def store(messages, *args, **kwargs):
        stored.extend(r.value for r in messages.collect())
        return ingest_batch(messages, *args, **kwargs)

    monkeypatch.setattr(module, "ingest_batch", store)
    assert redrive(spark, tables, mended, "a") == counts(2, 1)
    assert stored == [BAD.replace("?", "1")]
    assert fate(spark, tables)[HOPELESS] == (1, 1, "bad_value", "waiting")
