import datetime as dt
import json
from decimal import Decimal

import pytest
from helpers import fields, message
from pyspark.sql import functions as F

from marketbars.operators.messages import (
    classify_messages,
    good_bars,
    parse_messages,
    rejected_messages,
)
from marketbars.schemas import DAILY, INTRADAY

T0 = "2025-01-31 13:00:00"

CASES = [
    (message("A", T0), None),
    ("[]", "not_object"),
    ('[{"symbol":"A"}]', "not_object"),
    ("null", "not_object"),
    ('"text"', "not_object"),
    ("{bad", "bad_json"),
    ("", "bad_json"),
    (message("A", T0)[:-1], "bad_json"),
    (message("A", T0) + " trailing", "bad_json"),
    (message("A", T0) + message("B", T0), "bad_json"),
    (message("A", T0) + "," + message("B", T0), "bad_json"),
    (" " + message("A", T0) + " \n", None),
    # Braces that must not pass for the message's own.
    (message("A", T0) + "}", "bad_json"),
    (message("A", T0)[:-3] + "}} }", None),
    (message("A", T0)[:-1] + "\f}", "bad_json"),
    (message("A", T0) + "\f", "bad_json"),
    (message("{", T0), None),
    (message("}", T0), None),
    (message("{", T0)[:-1] + "}}", "bad_json"),
    (message("A}", T0)[:-1], "bad_json"),
    ('{"symbol":"A","data":{"%s":null},"more":{}}' % T0, "bad_value"),
    ('{"symbol":"A","data":{},"more":{"a":{}}}', "missing_field"),
    (message("A", "12345-01-01 00:00:00"), "bad_value"),
    (message("A", "0000-01-01 00:00:00"), "bad_value"),
    (message("A", "-0001-01-01 00:00:00"), "bad_value"),
    (message("A", "9999-12-31 23:59:59"), None),
    ('{"terminate": true}', "control"),
    ('{"terminate": "yes", "symbol": "A"}', "control"),
    ('{"terminate": false}', "missing_field"),
    ('{"Error Message": "x"}', "api_error"),
    ('{"Note": null}', "rate_limit"),
    ('{"N\\u006fte": "x", "symbol": "A"}', "rate_limit"),
    ('{"symbol":"","data":{}}', "missing_field"),
    ('{"symbol":"A"}', "missing_field"),
    ('{"symbol":"A","data":{}}', "missing_field"),
    ('{"data":{"%s":{}}}' % T0, "missing_field"),
    ('{"symbol":"A","data":"text"}', "bad_value"),
    ('{"symbol":"A","data":{"%s":null}}' % T0, "bad_value"),
    (message("A", T0, volume="12.5"), "bad_value"),
    (message("A", T0, **{"4. close": None}), "bad_value"),
    (message("A", T0, **{"1. open": "nan"}), "bad_value"),
    (message("A", T0, **{"1. open": "123456789.00"}), "bad_value"),
    (message("A", "yesterday"), "bad_value"),
]


def text_frame(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_reasons(spark):
    frame = spark.createDataFrame(
        [(i, t) for i, (t, _) in enumerate(CASES)], "i int, value string"
    )
    got = {r.i: r.reason for r in classify_messages(frame, INTRADAY).collect()}
    assert got == {i: reason for i, (_, reason) in enumerate(CASES)}


def test_every_message_is_accounted_for(spark):
    frame = text_frame(spark, [t for t, _ in CASES])
    classified = classify_messages(frame, INTRADAY).cache()
    good = classified.filter(F.col("reason").isNull()).count()
    control = classified.filter("reason = 'control'").count()
    rejected = rejected_messages(classified, "message")
    assert good + control + rejected.count() == len(CASES)
    assert rejected.columns == ["source", "value", "reason"]
    classified.unpersist()


def test_typed_values_and_audit(spark):
    texts = [
        message("A", T0, **{"1. open": "2.675", "2. high": " 3 ", "5. volume": "007"}),
        json.dumps({"symbol": "B", "data": {T0: {**fields(), "4. close": 1.25}}}),
    ]
    a, b = parse_messages(text_frame(spark, texts), INTRADAY).orderBy("symbol").collect()
    assert a.timestamp == dt.datetime(2025, 1, 31, 13)
    # The text is rounded half up, not its nearest binary fraction.
    assert (a.open_price, a.high_price, a.volume) == (Decimal("2.68"), Decimal("3.00"), 7)
    assert json.loads(a.raw_data) == {
        T0: {**fields(), "1. open": "2.675", "2. high": " 3 ", "5. volume": "007"}
    }
    assert b.close_price == Decimal("1.25")


def test_many_bars_in_one_message(spark):
    times = [f"2025-01-31 13:{m:02d}:00" for m in range(0, 60, 5)]
    good = json.dumps({"symbol": "A", "data": {t: fields() for t in times}})
    bad = json.dumps({"symbol": "B", "data": {times[0]: fields(), times[1]: fields(volume="x")}})
    classified = classify_messages(text_frame(spark, [good, bad]), INTRADAY)
    rows = good_bars(classified, INTRADAY).collect()
    # One bad bar rejects its whole message.
    assert {r.symbol for r in rows} == {"A"}
    assert len(rows) == len(times)


@pytest.mark.parametrize("text", ["2025-01-31", "2025-01-31 16:00:00"])
def test_daily_time(spark, text):
    row = parse_messages(text_frame(spark, [message("A", text, cadence="daily")]), DAILY).collect()
    assert row[0].date == dt.date(2025, 1, 31)


def test_json_is_parsed_once(spark):
    frame = text_frame(spark, [message("A", T0)]).repartition(2)
    plan = parse_messages(frame, INTRADAY)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1
    assert "Python" not in plan
