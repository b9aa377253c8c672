import dataclasses
import datetime as dt
import random
from decimal import Decimal

import pytest
from helpers import (
    DAY0,
    TIME0,
    bar,
    brute_daily,
    brute_intraday,
    daily_frame,
    intraday_frame,
)
from pyspark.sql import functions as F

from marketbars.operators.indicators import (
    analytics,
    daily_indicators,
    intraday_indicators,
    with_slices,
)
from marketbars.operators.reach import reached_analytics
from marketbars.operators.sums import (
    Touched,
    blocks_needed,
    corrected,
    neighbours,
    stretch_sums,
    sums_of,
)
from marketbars.plans.registry import reader_of as reader
from marketbars.schemas import DAILY, INTRADAY, moment

D = Decimal


def daily_result(frame):
    return {
        (r.symbol, r.date): (
            r.price_change_pct_daily,
            r.moving_avg_50d,
            r.moving_avg_200d,
            r.volume_avg_20d,
        )
        for r in daily_indicators(frame).collect()
    }


def intraday_result(frame, **options):
    return {
        (r.symbol, r.timestamp): (r.prev_close, r.price_change_pct, r.vwap)
        for r in intraday_indicators(frame, **options).collect()
    }


def random_daily(seed=1, symbols=("A", "B", "C"), days=320):
    rng = random.Random(seed)
    rows = []
    for i, symbol in enumerate(symbols):
        for day in range(0, days // (i + 1), 1 + i):
            rows.append(
                bar(
                    symbol,
                    DAY0 + dt.timedelta(days=day),
                    rng.randint(0, 50000) / 100,
                    rng.randint(0, 10**9),
                )
            )
    rng.shuffle(rows)
    return rows


def random_intraday(seed=2, rows=400):
    """A hot symbol with a burst inside single seconds, and two quiet ones."""
    rng = random.Random(seed)
    times, out = set(), []
    for _ in range(rows):
        symbol = rng.choice(["HOT", "HOT", "HOT", "A", "B"])
        if symbol == "HOT" and rng.random() < 0.6:
            time = TIME0 + dt.timedelta(microseconds=rng.randint(0, 3_000_000))
        else:
            time = TIME0 + dt.timedelta(minutes=5 * rng.randint(0, 1500))
        if (symbol, time) in times:
            continue
        times.add((symbol, time))
        out.append(bar(symbol, time, rng.randint(0, 9999) / 100, rng.randint(0, 500)))
    return out


def test_daily_matches_brute_force(spark):
    rows = random_daily()
    assert daily_result(daily_frame(spark, rows)) == brute_daily(rows)


def test_first_bar_and_short_frames(spark):
    rows = [bar("A", DAY0, "0.01"), bar("A", DAY0 + dt.timedelta(10), "0.02", 11)]
    got = daily_result(daily_frame(spark, rows))
    assert got["A", DAY0] == (None, D("0.01"), D("0.01"), D("10.00"))
    # A gap of days is one row; 0.015 rounds up.
    assert got["A", DAY0 + dt.timedelta(10)] == (D("100.00"), D("0.02"), D("0.02"), D("10.50"))


def test_large_mean_volume_is_kept(spark):
    rows = [
        bar("A", DAY0 + dt.timedelta(i), 1, v) for i, v in enumerate((2**63 - 1, 2**63 - 2))
    ]
    got = daily_result(daily_frame(spark, rows))
    assert got["A", DAY0][3] == D("9223372036854775807.00")
    assert got["A", DAY0 + dt.timedelta(1)][3] == D("9223372036854775806.50")
    rows = [bar("A", DAY0, 1, 300_000_000), bar("A", DAY0 + dt.timedelta(1), 1, 300_000_001)]
    got = daily_result(daily_frame(spark, rows))
    assert got["A", DAY0 + dt.timedelta(1)][3] == D("300000000.50")


@pytest.mark.parametrize("max_group", [10**6, 40, 5, 1])
def test_intraday_matches_brute_force(spark, max_group):
    rows = random_intraday()
    got = intraday_result(intraday_frame(spark, rows), max_group=max_group)
    assert got == brute_intraday(rows)


def test_slices_are_bounded_and_ordered(spark):
    rows = random_intraday(rows=900)
    limit = 150
    sliced = with_slices(intraday_frame(spark, rows), limit).cache()
    groups = sliced.groupBy("symbol", "_day", "_part").agg(
        F.count("*").alias("n"), F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi")
    ).collect()
    assert sum(g.n for g in groups) == len(rows)
    one_second = dt.timedelta(seconds=1)
    assert all(g.n <= limit or g.hi - g.lo < one_second for g in groups)
    for symbol in ("HOT", "A", "B"):
        mine = sorted((g for g in groups if g.symbol == symbol), key=lambda g: (g._day, g._part))
        assert all(a.hi < b.lo for a, b in zip(mine, mine[1:], strict=False))
    sliced.unpersist()


def test_zero_close_zero_volume_and_day_boundary(spark):
    next_day = TIME0 + dt.timedelta(days=1)
    rows = [
        bar("A", TIME0, "0.00", 0),
        bar("A", TIME0 + dt.timedelta(minutes=5), "5.00", 0),
        bar("A", next_day, "6.00", 1),
        bar("A", next_day + dt.timedelta(minutes=5), "9.00", 2),
    ]
    for max_group in (10**6, 1):
        got = intraday_result(intraday_frame(spark, rows), max_group=max_group)
        assert got["A", rows[0][1]] == (None, None, None)
        assert got["A", rows[1][1]] == (D("0.00"), None, None)
        assert got["A", rows[2][1]] == (D("5.00"), D("20.00"), D("8.00"))
        assert got["A", rows[3][1]] == (D("6.00"), D("50.00"), D("8.00"))


def test_vwap_survives_huge_totals(spark):
    rows = [
        bar("A", TIME0 + dt.timedelta(minutes=i), "99999999.99", 9 * 10**18) for i in range(4)
    ]
    assert {v[2] for v in intraday_result(intraday_frame(spark, rows)).values()} == {
        D("99999999.99")
    }


def test_analytics_columns_and_types(spark):
    as_of = dt.datetime(2025, 1, 1)
    rows = [bar("A", DAY0, "2.00", 5, open_="1.00", high="3.00", low="0.50")]
    frame = analytics(daily_frame(spark, rows), DAILY, moment(as_of))
    assert [(f.name, f.dataType) for f in frame.schema] == [
        (f.name, f.dataType) for f in DAILY.final_schema
    ]
    row = frame.collect()[0]
    assert (row.daily_range, row.rsi_14, row.last_refreshed) == (D("2.50"), None, as_of)

    rows = [bar("A", TIME0, "2.00", 5, open_="3.00", high="3.00", low="0.50")]
    frame = analytics(intraday_frame(spark, rows), INTRADAY, moment(as_of))
    assert [(f.name, f.dataType) for f in frame.schema] == [
        (f.name, f.dataType) for f in INTRADAY.final_schema
    ]
    row = frame.collect()[0]
    assert (row.high_low_spread, row.price_change) == (D("2.50"), D("-1.00"))


def test_empty_input(spark):
    assert analytics(daily_frame(spark, []), DAILY, F.lit(None)).collect() == []
    assert analytics(intraday_frame(spark, []), INTRADAY, F.lit(None)).collect() == []


@pytest.mark.parametrize("max_group", [10**6, 3])
def test_reached_rows_equal_full_recompute_intraday(spark, max_group):
    rows = random_intraday(seed=5, rows=200)
    frame = intraday_frame(spark, rows)
    late = rows[:7]
    reached = reached_analytics(
        reader(frame, INTRADAY),
        sums_of(frame, INTRADAY),
        intraday_frame(spark, late),
        INTRADAY,
        F.lit(None),
        max_group,
    ).rows.drop("last_refreshed")
    full = analytics(frame, INTRADAY, F.lit(None)).drop("last_refreshed")
    before = analytics(intraday_frame(spark, rows[7:]), INTRADAY, F.lit(None)).drop(
        "last_refreshed"
    )
    expected = {(r.symbol, r.timestamp): r for r in full.collect()}
    got = {(r.symbol, r.timestamp): r for r in reached.collect()}
    stale = {(r.symbol, r.timestamp): r for r in before.collect()}
    assert all(expected[k] == v for k, v in got.items())
    changed = {k for k, v in expected.items() if stale.get(k) != v}
    assert changed <= set(got)


def test_reached_rows_equal_full_recompute_daily(spark):
    rows = random_daily(seed=7, days=260)
    frame = daily_frame(spark, rows)
    late = rows[:3]
    reached = reached_analytics(
        reader(frame, DAILY),
        sums_of(frame, DAILY),
        daily_frame(spark, late),
        DAILY,
        F.lit(None),
    ).rows
    full = {(r.symbol, r.date): r for r in analytics(frame, DAILY, F.lit(None)).collect()}
    stale = {
        (r.symbol, r.date): r
        for r in analytics(daily_frame(spark, rows[3:]), DAILY, F.lit(None)).collect()
    }
    got = {(r.symbol, r.date): r for r in reached.collect()}
    assert all(full[k] == v for k, v in got.items())
    assert {k for k, v in full.items() if stale.get(k) != v} <= set(got)


def test_reached_daily_rows_of_long_and_sparse_series(spark):
    """One symbol's recent rows cover the longest frame, the other's do not."""
    dense = [bar("DENSE", DAY0 + dt.timedelta(days=i), i % 37 + 1, i) for i in range(900)]
    sparse = [bar("SPARSE", DAY0 + dt.timedelta(days=9 * i), i % 11 + 1, i) for i in range(100)]
    rows = dense + sparse
    frame = daily_frame(spark, rows)
    late = [dense[880], dense[890], sparse[98]]
    reached = reached_analytics(
        reader(frame, DAILY),
        sums_of(frame, DAILY),
        daily_frame(spark, late),
        DAILY,
        F.lit(None),
    ).rows.collect()
    full = {(r.symbol, r.date): r for r in analytics(frame, DAILY, F.lit(None)).collect()}
    assert sorted((r.symbol, r.date) for r in reached) == sorted(
        (r[0], r[1]) for r in dense[880:] + sparse[98:]
    )
    assert all(full[r.symbol, r.date] == r for r in reached)


def watched(sums, asked):
    def read(periods):
        asked.append(sorted(periods))
        return sums.read(periods)

    return dataclasses.replace(sums, read=read)


def touched_of(spark, pairs):
    return Touched.of(spark.createDataFrame(pairs, "symbol string, stretch date"))


def test_neighbours_are_sought_further_only_for_symbols_without_near_ones(spark):
    days = {"NEAR": [0, 1, 2, 40, 400], "FAR": [0, 900], "LONE": [300], "EDGE": [0, 30, 60]}
    rows = [
        bar(s, TIME0 + dt.timedelta(days=d, minutes=m), d + m, 10 + m)
        for s, of in days.items()
        for d in of
        for m in (0, 5)
    ]
    asked = []
    sums = watched(sums_of(intraday_frame(spark, rows), INTRADAY), asked)
    day = {d: DAY0 + dt.timedelta(days=d) for of in days.values() for d in of}

    def found(*pairs):
        asked.clear()
        touched = touched_of(spark, [(s, day[d]) for s, d in pairs])
        return {
            (r.symbol, r.stretch): (
                r.n_bars,
                r.before_close,
                r.behind and (r.behind.stretch, r.behind.first_time, int(r.behind.volume)),
            )
            for r in neighbours(sums, touched, INTRADAY).collect()
        }

    def behind(d):
        return (day[d], TIME0 + dt.timedelta(days=d), 25)

    assert found(("NEAR", 1)) == {("NEAR", day[1]): (2, D("5.00"), behind(2))}
    # January and February of the first year are enough.
    assert asked == [[DAY0, dt.date(2024, 2, 1)]]
    # A month nearby without bars of the symbol: wider and wider, for this symbol only.
    assert found(("FAR", 0), ("NEAR", 40), ("EDGE", 60)) == {
        ("FAR", day[0]): (2, None, behind(900)),
        ("NEAR", day[40]): (2, D("7.00"), behind(400)),
        ("EDGE", day[60]): (2, D("35.00"), None),
    }
    assert 1 < len(asked) <= 5
    assert found(("LONE", 300), ("FAR", 900), ("NEAR", 400)) == {
        ("LONE", day[300]): (2, None, None),
        ("FAR", day[900]): (2, D("5.00"), None),
        ("NEAR", day[400]): (2, D("45.00"), None),
    }


def test_sums_are_corrected_by_what_arrives(spark):
    for rows, frame, cadence in (
        (random_intraday(seed=9, rows=150), intraday_frame, INTRADAY),
        (random_daily(seed=9, days=150), daily_frame, DAILY),
    ):
        whole = stretch_sums(frame(spark, rows), cadence)
        parts = [stretch_sums(frame(spark, rows[i::3]), cadence) for i in range(3)]
        once = corrected(corrected(parts[2], parts[0], cadence), parts[1], cadence)
        assert sorted(once.collect()) == sorted(whole.collect())
        types = [(f.name, f.dataType) for f in cadence.sums_schema]
        assert [(f.name, f.dataType) for f in once.schema] == types


def daily_series(symbol, days):
    return [bar(symbol, DAY0 + dt.timedelta(days=i), i % 37 + 1, i) for i in days]


def test_months_between_the_edges_of_frames_are_not_read(spark):
    rows = daily_series("DENSE", range(1500)) + daily_series("SPARSE", range(0, 1500, 40))
    sums = sums_of(daily_frame(spark, rows), DAILY)

    def months(symbol, index):
        day = DAY0 + dt.timedelta(days=index)
        touched = touched_of(spark, [(symbol, day.replace(day=1))])
        got = blocks_needed(sums, touched, DAILY, (20, 50, 200)).collect()
        return sorted(r.stretch for r in got), {r.stretch: r for r in got}

    # The newest bar: its month, and where its frames of 20, 50 and 200 rows begin.
    wanted, found = months("DENSE", 1499)
    assert len(wanted) <= 8
    first = next(r for r in rows if r[1] == min(wanted))
    base = found[min(wanted)]
    for stretch, block in found.items():
        # Counted and added up from one place for all months of a symbol.
        between = [r for r in rows[:1500] if first[1] <= r[1] < stretch]
        assert block.rows_before - base.rows_before == len(between)
        assert block.amount_before - base.amount_before == sum(100 * r[5] for r in between)
        assert block.volume_before - base.volume_before == sum(r[6] for r in between)
    # A bar in the middle: nothing behind the 199 rows that it reaches.
    wanted, _ = months("DENSE", 700)
    reach = DAY0 + dt.timedelta(days=700 + 31 + 199 + 31)
    assert max(wanted) <= reach and min(wanted) >= DAY0 + dt.timedelta(days=700 - 31 - 231 - 31)
    # Few bars a month: the frames go back to the start of the series.
    assert len(months("SPARSE", 1480)[0]) > 8


@pytest.mark.parametrize(
    "late", [[1499], [700], [3], [0], [100, 101, 900], [1200, 1450], [250, 449, 450, 451]]
)
def test_a_late_daily_bar_reaches_199_rows(spark, late):
    rows = daily_series("A", range(1500)) + daily_series("B", range(0, 4000, 9))
    frame = daily_frame(spark, rows)
    arrived = [rows[i] for i in late] + [rows[1500 + i % 440] for i in late]
    got = {
        (r.symbol, r.date): r
        for r in reached_analytics(
            reader(frame, DAILY), sums_of(frame, DAILY), daily_frame(spark, arrived), DAILY,
            F.lit(None),
        ).rows.collect()
    }
    full = {(r.symbol, r.date): r for r in analytics(frame, DAILY, F.lit(None)).collect()}
    assert all(full[k] == v for k, v in got.items())
    reached = set()
    for series_, at in ((rows[:1500], late), (rows[1500:], [i % 440 for i in late])):
        reached |= {(r[0], r[1]) for i in at for r in series_[i : i + 200]}
    assert set(got) == reached
