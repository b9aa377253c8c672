"""Table schemas and the two cadences (intraday, daily) the package runs at."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

PRICE = T.DecimalType(10, 2)
# Wide enough for the difference of any two prices, and for any change in percent.
SPREAD = T.DecimalType(11, 2)
PERCENT = T.DecimalType(18, 2)
# Wide enough for the mean of any BIGINT volumes.
VOLUME_AVG = T.DecimalType(21, 2)

PRICE_COLUMNS = ("open_price", "high_price", "low_price", "close_price")

# Payload field name -> column it fills.
PAYLOAD_FIELDS = {
    "1. open": "open_price",
    "2. high": "high_price",
    "3. low": "low_price",
    "4. close": "close_price",
    "5. volume": "volume",
}
META_KEY = "Meta Data"
LAST_REFRESHED_KEY = "3. Last Refreshed"
ERROR_KEY = "Error Message"
RATE_LIMIT_KEY = "Note"

# Default list of tracked symbols.
DEFAULT_SYMBOLS = ("AAPL", "GOOGL", "MSFT")


@dataclass(frozen=True)
class Cadence:
    """What differs between the intraday and the daily flow."""

    name: str
    time_col: str
    time_type: T.DataType
    series_key: str
    topic: str
    bars_table: str
    analytics_table: str
    # Storage partition of a bar: its day (intraday) or the first of its month (daily).
    period_unit: str
    # Storage partition of the sums over such a day or month: its month or its year.
    sums_unit: str

    @property
    def keys(self) -> list[str]:
        return ["symbol", self.time_col]

    def period(self, time: Column | None = None) -> Column:
        """Storage partition (a DATE) of a bar time."""
        time = F.col(self.time_col) if time is None else time
        day = F.to_date(time)
        return day if self.period_unit == "day" else F.trunc(day, self.period_unit)

    def stretch(self) -> Column:
        """What bars are summed over: the period they are stored in."""
        return self.period()

    def sums_period(self, stretch: Column | None = None) -> Column:
        """Storage partition (a DATE) of the sums over a stretch."""
        return F.trunc(F.col("stretch") if stretch is None else stretch, self.sums_unit)

    def sums_period_of(self, stretch: date) -> date:
        return stretch.replace(day=1) if self.sums_unit == "month" else date(stretch.year, 1, 1)

    def _bar_fields(self, prices: tuple[str, ...]) -> list[T.StructField]:
        return [
            T.StructField("symbol", T.StringType(), False),
            T.StructField(self.time_col, self.time_type, False),
            *[T.StructField(c, PRICE, False) for c in prices],
            T.StructField("volume", T.LongType(), False),
        ]

    @property
    def staging_schema(self) -> T.StructType:
        return T.StructType(self._bar_fields(PRICE_COLUMNS))

    @property
    def sums_schema(self) -> T.StructType:
        """Sums over a symbol's stretch: price x volume (intraday) or closes (daily), in cents."""
        return T.StructType(
            [
                T.StructField("symbol", T.StringType()),
                T.StructField("stretch", T.DateType()),
                T.StructField("n_bars", T.LongType()),
                T.StructField("amount", T.DecimalType(38, 0)),
                T.StructField("volume", T.DecimalType(38, 0)),
                T.StructField("first_time", self.time_type),
                T.StructField("last_time", self.time_type),
                T.StructField("last_close", PRICE),
            ]
        )

    @property
    def raw_schema(self) -> T.StructType:
        return T.StructType(
            [*self._bar_fields(PRICE_COLUMNS), T.StructField("raw_data", T.StringType(), True)]
        )

    @property
    def indicator_fields(self) -> list[T.StructField]:
        """Columns of the final table after symbol, time, OHLC and volume."""
        if self.name == "intraday":
            types = {
                "high_low_spread": SPREAD,
                "price_change": SPREAD,
                "prev_close": PRICE,
                "price_change_pct": PERCENT,
                "vwap": PRICE,
            }
        else:
            types = {
                "daily_range": SPREAD,
                "price_change_pct_daily": PERCENT,
                "moving_avg_50d": PRICE,
                "moving_avg_200d": PRICE,
                "volume_avg_20d": VOLUME_AVG,
                "rsi_14": PRICE,
            }
        types["last_refreshed"] = T.TimestampNTZType()
        return [T.StructField(name, kind, True) for name, kind in types.items()]

    @property
    def final_schema(self) -> T.StructType:
        return T.StructType(
            [*self._bar_fields(("open", "high", "low", "close")), *self.indicator_fields]
        )


# Names of series, topics and tables.
INTRADAY = Cadence(
    name="intraday",
    time_col="timestamp",
    time_type=T.TimestampNTZType(),
    series_key="Time Series (5min)",
    topic="stock_prices_5min",
    bars_table="stock_prices_5min",
    analytics_table="intraday_analytics",
    period_unit="day",
    sums_unit="month",
)
DAILY = Cadence(
    name="daily",
    time_col="date",
    time_type=T.DateType(),
    series_key="Time Series (Daily)",
    topic="stock_prices_daily",
    bars_table="stock_prices_daily",
    analytics_table="daily_analytics",
    period_unit="month",
    sums_unit="year",
)
CADENCES = {c.name: c for c in (INTRADAY, DAILY)}


def moment(time: datetime) -> Column:
    """A zone-free time literal, whatever zone driver and session are in."""
    return F.lit(time.isoformat(sep=" ")).cast(T.TimestampNTZType())


LANDED_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("body", T.StringType()),
    ]
)

QUARANTINE_SCHEMA = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("reason", T.StringType()),
    ]
)

# Every time a rejected message was tried again: how often by then, and why it was rejected again
# (NULL: it was accepted).
ATTEMPTS_SCHEMA = T.StructType(
    [
        T.StructField("message_id", T.StringType()),
        T.StructField("attempt", T.IntegerType()),
        T.StructField("reason", T.StringType()),
    ]
)

# What a batch of messages held; seconds are NULL where the stream no longer tells them.
RUNS_SCHEMA = T.StructType(
    [
        T.StructField("ingested", T.StringType()),
        T.StructField("n_messages", T.LongType()),
        T.StructField("n_processed", T.LongType()),
        T.StructField("n_rejected", T.LongType()),
        T.StructField("n_bars", T.LongType()),
        T.StructField("seconds", T.DoubleType()),
    ]
)
