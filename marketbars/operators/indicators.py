"""Windowed indicators over staged bars, and the analytics rows built from them.

Partitioning
------------
Daily. A symbol has at most one bar per calendar date, so a symbol's series is bounded by
the calendar (36,525 rows a century) however large the table is. One exchange on
``symbol``, one sort, running sums instead of re-summed 50 / 200 / 20-row frames.

Intraday. Keys carry microseconds, so one symbol can hold any share of the table. While
every series fits one task: one exchange on ``symbol`` and one sort serve both windows.
Otherwise the series are cut into time slices, see :func:`with_slices`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketbars.functions import exact
from marketbars.operators.skew import GROUP_ROWS, hot_groups
from marketbars.schemas import PRICE, SPREAD, Cadence

_DAY, _PART = "_day", "_part"
# Successive slice widths in seconds below a day. A second holds at most a million
# microsecond keys per symbol, so the last level bounds every slice whatever the data.
_WIDTHS = (3600, 60, 1)
SLICE_KEYS = ["symbol", _DAY, _PART]


def by_symbol(bars: DataFrame) -> DataFrame:
    """Bring each series together.

    The windows ask for the same exchange; asked for here, it carries the plain columns
    instead of the window inputs derived from them.
    """
    return bars.repartition("symbol")


# --- daily -----------------------------------------------------------------------------


# Rows of the two price frames and of the volume frame.
SHORT, LONG, VOLUMES = 50, 200, 20


def daily_indicators(bars: DataFrame, gathered: bool = False) -> DataFrame:
    """Add daily change and the 50 / 200-row price and 20-row volume averages.

    Series that lie together already (``gathered``) are not shuffled.

    Frames count rows, not days, and average whatever rows exist. A frame of n rows is the
    running sum here minus the running sum n rows back: work per row does not grow with n.
    """
    series = Window.partitionBy("symbol").orderBy("date")
    so_far = series.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    close = F.col("close_price")

    running = (bars if gathered else by_symbol(bars)).select(
        "*",
        F.lag(close).over(series).alias("_before"),
        F.row_number().over(series).alias("_row"),
        F.sum(exact.cents(close)).over(so_far).alias("_closes"),
        F.sum(F.col("volume").cast("decimal(19,0)")).over(so_far).alias("_volumes"),
    ).select(
        "*",
        F.lag("_closes", 50, 0).over(series).alias("_closes_50"),
        F.lag("_closes", 200, 0).over(series).alias("_closes_200"),
        F.lag("_volumes", 20).over(series).alias("_volumes_20"),
    )

    def rows(n: int) -> Column:
        return F.least(F.col("_row"), F.lit(n))

    closes, volumes = F.col("_closes"), F.col("_volumes")
    earlier_volumes = F.coalesce("_volumes_20", F.lit(0))
    return running.select(
        *bars.columns,
        exact.pct_change(close, F.col("_before")).alias("price_change_pct_daily"),
        exact.mean_price(closes - F.col("_closes_50"), rows(50)).alias("moving_avg_50d"),
        exact.mean_price(closes - F.col("_closes_200"), rows(200)).alias("moving_avg_200d"),
        exact.mean_volume(volumes - earlier_volumes, rows(20)).alias("volume_avg_20d"),
    )


# --- intraday --------------------------------------------------------------------------


def intraday_indicators(
    bars: DataFrame, max_group: int = GROUP_ROWS, gathered: bool = False
) -> DataFrame:
    """Add previous close, change against it, and the whole-day VWAP.

    The previous close runs across days; the VWAP is one value per symbol and day. Series that
    lie together already (``gathered``) are neither counted nor shuffled.
    """
    if gathered:
        priced = _by_symbol(bars, gathered)
    elif (hot := hot_groups(bars, ["symbol"], max_group)) is None:
        priced = _by_symbol(bars)
    else:
        # Only the few large series are cut into slices.
        sliced = _by_slice(bars.join(hot, "symbol", "left_semi"), max_group)
        whole = _by_symbol(bars.join(hot, "symbol", "left_anti"))
        wanted = [*bars.columns, "prev_close", "vwap"]
        priced = whole.select(*wanted).unionByName(sliced.select(*wanted))
    return _with_change(priced, bars.columns)


def _traded() -> Column:
    """Price x volume in cents, too wide for BIGINT once summed."""
    return exact.cents(F.col("close_price")).cast("decimal(11,0)") * F.col("volume").cast(
        "decimal(19,0)"
    )


def _volume() -> Column:
    return F.col("volume").cast("decimal(19,0)")


def _by_symbol(bars: DataFrame, gathered: bool = False) -> DataFrame:
    # Ordering by day and time sorts once for both windows.
    dated = (bars if gathered else by_symbol(bars)).withColumn(_DAY, F.to_date("timestamp"))
    series = Window.partitionBy("symbol").orderBy(_DAY, "timestamp")
    whole_day = Window.partitionBy("symbol", _DAY)
    return dated.select(
        "*",
        F.lag("close_price").over(series).alias("prev_close"),
        exact.weighted_price(
            F.sum(_traded()).over(whole_day), F.sum(_volume()).over(whole_day)
        ).alias("vwap"),
    )


def with_slices(bars: DataFrame, max_group: int = GROUP_ROWS) -> DataFrame:
    """Tag every bar with its time slice: ``_day`` and ``_part`` (first second of the slice).

    A slice is a whole symbol-day unless that day holds more than ``max_group`` bars; then
    it is cut into hours, and hot hours into minutes, and hot minutes into seconds. Slices
    of a symbol are disjoint and ordered by (day, part).
    """
    time = F.col("timestamp")
    second = F.hour(time) * 3600 + F.minute(time) * 60 + F.second(time)

    sliced = bars.withColumn(_DAY, F.to_date(time)).withColumn(_PART, F.lit(0))
    open_days = sliced.select(*SLICE_KEYS, "timestamp")
    for width in _WIDTHS:
        hot = hot_groups(open_days, SLICE_KEYS, max_group)
        if hot is None:
            break
        finer = F.floor(second / width).cast("int") * width
        open_days = open_days.join(hot, SLICE_KEYS).withColumn(_PART, finer)
        flagged = sliced.join(hot.withColumn("_hot", F.lit(True)), SLICE_KEYS, "left")
        sliced = flagged.withColumn(
            _PART, F.when(F.col("_hot"), finer).otherwise(F.col(_PART))
        ).drop("_hot")
    return sliced


def _slice_edges(sliced: DataFrame) -> DataFrame:
    """Per slice: the last close before it, and the VWAP of its whole day.

    Slices are summed map-side first; the windows then run over one row per slice.
    """
    earlier = Window.partitionBy("symbol").orderBy(_DAY, _PART)
    whole_day = Window.partitionBy("symbol", _DAY)
    return (
        sliced.groupBy(*SLICE_KEYS)
        .agg(
            F.max_by("close_price", "timestamp").alias("_last"),
            F.sum(_traded()).alias("_traded"),
            F.sum(_volume()).alias("_volume"),
        )
        .select(
            *SLICE_KEYS,
            F.lag("_last").over(earlier).alias("_carried"),
            exact.weighted_price(
                F.sum("_traded").over(whole_day), F.sum("_volume").over(whole_day)
            ).alias("vwap"),
        )
    )


def day_rows(bars: DataFrame, days: DataFrame, max_group: int | None = None) -> DataFrame:
    """Add previous close, change and VWAP to all bars of some symbol-days.

    ``days`` (symbol, stretch, n_bars, amount, volume, before_close) has what is known of them:
    traded totals, and the close before each. Days of over ``max_group`` bars are cut into slices;
    without it there are none.
    """
    known = days.select(
        "symbol",
        F.col("stretch").alias(_DAY),
        "n_bars",
        "before_close",
        exact.weighted_price(F.col("amount"), F.col("volume")).alias("vwap"),
    )
    dated = bars.withColumn(_DAY, F.to_date("timestamp")).join(known, ["symbol", _DAY])
    whole = Window.partitionBy("symbol", _DAY).orderBy("timestamp")
    inside = F.lag("close_price").over(whole)
    crowded = F.lit(False) if max_group is None else F.col("n_bars") > max_group
    priced = dated.filter(~crowded).withColumn("_inside", inside)
    if max_group is not None:
        sliced = with_slices(dated.filter(crowded), max_group)
        part = Window.partitionBy(*SLICE_KEYS).orderBy("timestamp")
        carried = Window.partitionBy("symbol", _DAY).orderBy(_PART)
        last = sliced.groupBy(*SLICE_KEYS).agg(F.max_by("close_price", "timestamp").alias("_last"))
        last = last.withColumn("_carried", F.lag("_last").over(carried)).drop("_last")
        cut = (
            sliced.withColumn("_inside", F.lag("close_price").over(part))
            .join(last, SLICE_KEYS)
            .withColumn("_inside", F.coalesce("_inside", "_carried"))
        )
        priced = priced.unionByName(cut.select(*priced.columns))
    return _with_change(
        priced.withColumn("prev_close", F.coalesce("_inside", "before_close")), bars.columns
    )


def first_rows(bars: DataFrame, days: DataFrame) -> DataFrame:
    """The same for the first bar of a day, whose previous close is another day's last.

    ``days`` (symbol, timestamp, amount, volume, before_close) names the bar.
    """
    known = days.select(
        "symbol",
        "timestamp",
        F.col("before_close").alias("prev_close"),
        exact.weighted_price(F.col("amount"), F.col("volume")).alias("vwap"),
    )
    return _with_change(bars.join(known, ["symbol", "timestamp"]), bars.columns)


def _with_change(priced: DataFrame, columns: list[str]) -> DataFrame:
    change = exact.pct_change(F.col("close_price"), F.col("prev_close"))
    return priced.select(*columns, "prev_close", change.alias("price_change_pct"), "vwap")


def frame_rows(bars: DataFrame) -> DataFrame:
    """Add the daily indicators to the bars of some months of a series, marking ``late`` ones.

    ``bars`` carries, from the sums of the months before its own, rows_before, amount_before and
    volume_before. A frame's sum is the running sum at the row less the one where the frame
    begins; both are looked up by row number, so that months between need not be there. Only rows
    that a late one can change are kept.
    """
    month = Window.partitionBy("symbol", "stretch").orderBy("date")
    so_far = month.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    close, volume = F.col("close_price"), F.col("volume").cast("decimal(19,0)")
    running = by_symbol(bars).select(
        "*",
        (F.col("rows_before") + F.row_number().over(month)).alias("_row"),
        (F.col("amount_before") + F.sum(exact.cents(close)).over(so_far)).alias("_closes"),
        (F.col("volume_before") + F.sum(volume).over(so_far)).alias("_volumes"),
    )
    series = Window.partitionBy("symbol").orderBy("_row")

    def at(column: str, back: int) -> Column:
        return F.first(column).over(series.rangeBetween(-back, -back))

    ever = series.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = running.select(
        "*",
        at("close_price", 1).alias("_before"),
        F.coalesce(at("_closes", SHORT), F.lit(0)).alias("_short"),
        F.coalesce(at("_closes", LONG), F.lit(0)).alias("_long"),
        F.coalesce(at("_volumes", VOLUMES), F.lit(0)).alias("_volumes_short"),
        F.max(F.when(F.col("late"), F.col("_row"))).over(ever).alias("_late"),
    ).filter(F.col("_row") - F.col("_late") < LONG)

    def rows(n: int) -> Column:
        return F.least(F.col("_row"), F.lit(n))

    def cents(total: Column) -> Column:
        return total.cast("bigint")

    closes, volumes = F.col("_closes"), F.col("_volumes")
    names = [c for c in bars.columns if c not in _FROM_SUMS]
    return placed.select(
        *names,
        exact.pct_change(close, F.col("_before")).alias("price_change_pct_daily"),
        exact.mean_price(cents(closes - F.col("_short")), rows(SHORT)).alias("moving_avg_50d"),
        exact.mean_price(cents(closes - F.col("_long")), rows(LONG)).alias("moving_avg_200d"),
        exact.mean_volume(volumes - F.col("_volumes_short"), rows(VOLUMES)).alias(
            "volume_avg_20d"
        ),
    )


_FROM_SUMS = ("stretch", "rows_before", "amount_before", "volume_before", "late")


def _by_slice(bars: DataFrame, max_group: int) -> DataFrame:
    sliced = with_slices(bars, max_group)
    edges = _slice_edges(sliced)
    inside = Window.partitionBy(*SLICE_KEYS).orderBy("timestamp")
    return (
        sliced.withColumn("_inside", F.lag("close_price").over(inside))
        .withColumn("_row", F.row_number().over(inside))
        .join(edges, SLICE_KEYS)
        .withColumn("prev_close", F.when(F.col("_row") == 1, F.col("_carried")).otherwise(F.col("_inside")))
    )


# --- analytics rows --------------------------------------------------------------------


def indicators(bars: DataFrame, cadence: Cadence, **options) -> DataFrame:
    if cadence.name == "intraday":
        return intraday_indicators(bars, **options)
    return daily_indicators(bars, **options)


GENERATED = {"daily": ("daily_range",), "intraday": ("high_low_spread", "price_change")}


def generated_columns(rows: DataFrame, cadence: Cadence) -> DataFrame:
    """Spread columns that always follow from the row's own prices."""
    spread = (F.col("high") - F.col("low")).cast(SPREAD)
    if cadence.name == "daily":
        return rows.withColumn("daily_range", spread)
    change = (F.col("close") - F.col("open")).cast(SPREAD)
    return rows.withColumn("high_low_spread", spread).withColumn("price_change", change)


def bar_columns(bars: DataFrame, cadence: Cadence) -> DataFrame:
    """Staged bars under the column names of the final table."""
    renames = {f"{name}_price": name for name in ("open", "high", "low", "close")}
    return bars.withColumnsRenamed(renames).withColumn("volume", F.col("volume").cast("bigint"))


def analytics(bars: DataFrame, cadence: Cadence, as_of: Column, **options) -> DataFrame:
    """Final-table rows for all given bars, stamped with ``as_of``."""
    return shaped(indicators(bars, cadence, **options), cadence, as_of)


def shaped(rows: DataFrame, cadence: Cadence, as_of: Column) -> DataFrame:
    """Bars with their indicators as final-table rows."""
    rows = bar_columns(rows, cadence)
    rows = generated_columns(rows, cadence).withColumn(
        "last_refreshed", as_of.cast(T.TimestampNTZType())
    )
    if cadence.name == "daily":
        # Declared in the table, never computed.
        rows = rows.withColumn("rsi_14", F.lit(None).cast(PRICE))
    return rows.select(*cadence.final_schema.fieldNames())
