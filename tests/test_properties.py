"""Random small inputs: results do not depend on grouping limits, row order or repetition."""

import datetime as dt
from decimal import Decimal

from helpers import TIME0, bar, brute_intraday, intraday_frame
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketbars.operators.indicators import analytics, intraday_indicators
from marketbars.operators.upsert import upsert
from marketbars.schemas import INTRADAY, moment

few = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)

# Times crowd around a few instants, so that days, hours, minutes and seconds all collide.
offsets = st.one_of(
    st.integers(0, 50),
    st.integers(0, 5_000_000),
    st.integers(0, 3 * 86_400).map(lambda s: s * 1_000_000),
)
keys = st.tuples(st.sampled_from(["A", "B"]), offsets)
prices = st.integers(0, 20_000).map(lambda c: Decimal(c) / 100)
series = st.dictionaries(keys, st.tuples(prices, st.integers(0, 1000)), min_size=1, max_size=40)


def rows_of(drawn):
    return [
        bar(symbol, TIME0 + dt.timedelta(microseconds=offset), close, volume)
        for (symbol, offset), (close, volume) in drawn.items()
    ]


@few
@given(series, st.integers(1, 12))
def test_intraday_any_grouping(spark, drawn, max_group):
    rows = rows_of(drawn)
    got = intraday_indicators(intraday_frame(spark, rows), max_group=max_group).collect()
    assert len(got) == len(rows)
    assert {
        (r.symbol, r.timestamp): (r.prev_close, r.price_change_pct, r.vwap) for r in got
    } == brute_intraday(rows)


@few
@given(series, series)
def test_upsert_is_idempotent_and_complete(spark, old, new):
    first, second = moment(TIME0), moment(TIME0 + dt.timedelta(hours=1))
    target = analytics(intraday_frame(spark, rows_of(old)), INTRADAY, first)
    source = analytics(intraday_frame(spark, rows_of(new)), INTRADAY, second)
    merged = upsert(target, source, INTRADAY)
    actions = {r.action: r["count"] for r in merged.groupBy("action").count().collect()}
    overlap = set(old) & set(new)
    assert actions == {
        name: n
        for name, n in {
            "update": len(overlap),
            "insert": len(set(new) - overlap),
            "keep": len(set(old) - overlap),
        }.items()
        if n
    }
    names = INTRADAY.final_schema.fieldNames()
    once = merged.select(*names)
    again = upsert(once, source, INTRADAY)
    assert again.filter(F.col("action") != "keep").count() == 0
    assert once.exceptAll(again.select(*names)).count() == 0
