"""JSON payload expressions: classification, typing and encoding, all JVM-side.

A message as this package writes it is parsed once. The corrupt-record column of ``from_json``
tells well-formed objects apart; other shapes pay for a second look at what stands behind them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketbars.schemas import (
    ERROR_KEY,
    LAST_REFRESHED_KEY,
    META_KEY,
    PAYLOAD_FIELDS,
    PRICE,
    RATE_LIMIT_KEY,
    Cadence,
)

_CORRUPT = "_corrupt"
_SERIES_TYPE = "map<string,map<string,string>>"

MESSAGE_SCHEMA = (
    f"symbol string, timestamp string, date string, terminate string, data {_SERIES_TYPE}, "
    f"{_CORRUPT} string"
)

# JSON texts this package takes for "not set".
FALSY = ("false", "0", "0.0", "", "{}", "[]")


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add costly columns that the optimizer must not copy into later expressions.

    A filter on a plain projected column is pushed below the projection, and with it a copy
    of the column's expression, here a JSON parse, for every mention. Columns coming out of
    a one-row generator stay where they are.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(row)))


def parse_message(value: Column) -> Column:
    return F.from_json(value, MESSAGE_SCHEMA, {"columnNameOfCorruptRecord": _CORRUPT})


def parse_document(body: Column, cadence: Cadence) -> Column:
    """A quote document as ``meta``, ``series`` and the corrupt marker."""
    schema = (
        f"`{META_KEY}` map<string,string>, `{cadence.series_key}` {_SERIES_TYPE}, "
        f"{_CORRUPT} string"
    )
    return F.from_json(body, schema, {"columnNameOfCorruptRecord": _CORRUPT})


def has_key(text: Column, key: str) -> Column:
    """True when ``key`` is a top-level key, even with a JSON null as its value.

    The key list is only extracted where the raw text can hold the key at all: literally,
    or written with an escape.
    """
    possible = text.contains(f'"{key}"') | text.contains("\\")
    return F.when(
        possible, F.coalesce(F.array_contains(F.json_object_keys(text), key), F.lit(False))
    ).otherwise(F.lit(False))


def surely_single(parsed: Column, text: Column) -> Column:
    """True for a one-bar message with nothing behind it, told without a second parse.

    Such a message opens three objects: itself, ``data`` and the bar. If the text has no other
    brace, and its three closing ones stand at the end, nothing can follow them.
    """

    def braces(brace: str) -> Column:
        return F.length(text) - F.length(F.replace(text, F.lit(brace), F.lit("")))

    return F.coalesce(
        parsed[_CORRUPT].isNull()
        & (F.size(parsed["data"]) == 1)
        & F.map_values(parsed["data"])[0].isNotNull()
        & (braces("{") == 3)
        & (braces("}") == 3)
        & text.rlike(r"\}[ \t\r\n]*\}[ \t\r\n]*\}[ \t\r\n]*$"),
        F.lit(False),
    )


def shape_problem(parsed: Column, text: Column, known_single: Column | None = None) -> Column:
    """``bad_json`` / ``not_object`` for text that is no JSON object, else NULL.

    ``from_json`` stops after the first value. Read as the content of an array, the text
    must be one complete value with nothing behind it. That second pass is left out where
    ``known_single`` says so.
    """
    single = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))).eqNullSafe(1)
    if known_single is not None:
        single = F.when(known_single, F.lit(True)).otherwise(single)
    suspect = parsed.isNull() | parsed[_CORRUPT].isNotNull()
    return F.when(~single, "bad_json").when(
        suspect & F.json_object_keys(text).isNull(), "not_object"
    )


def message_problem(parsed: Column, text: Column, bars: Column, cadence: Cadence) -> Column:
    """Why a message yields no bars: ``control`` or a quarantine reason; NULL when good."""
    empty = F.coalesce(parsed["symbol"], F.lit("")) == ""
    wrong_type = parsed["data"].isNull() & parsed[_CORRUPT].isNotNull()
    no_data = F.coalesce(F.size(parsed["data"]) <= 0, F.lit(True)) & ~wrong_type
    return F.coalesce(
        shape_problem(parsed, text, surely_single(parsed, text)),
        F.when(is_truthy(parsed["terminate"]), "control"),
        F.when(has_key(text, ERROR_KEY), "api_error"),
        F.when(has_key(text, RATE_LIMIT_KEY), "rate_limit"),
        F.when(empty | no_data, "missing_field"),
        F.when(wrong_type | F.exists(bars, lambda b: incomplete(b, cadence)), "bad_value"),
    )


def document_problem(status: Column, parsed: Column, text: Column, cadence: Cadence) -> Column:
    """Why a landed response yields no messages; NULL when good."""
    meta, series = parsed[META_KEY], parsed[cadence.series_key]
    last = parse_time(meta[LAST_REFRESHED_KEY], cadence)
    return F.coalesce(
        F.when(~status.eqNullSafe(200), "http_status"),
        shape_problem(parsed, text),
        F.when(has_key(text, ERROR_KEY), "api_error"),
        F.when(has_key(text, RATE_LIMIT_KEY), "rate_limit"),
        F.when(parsed[_CORRUPT].isNotNull(), "bad_value"),
        F.when(
            F.coalesce((F.size(meta) <= 0) | (F.size(series) <= 0), F.lit(True)),
            "missing_section",
        ),
        F.when(last.isNull(), "bad_value"),
    )


def is_truthy(text: Column) -> Column:
    return F.coalesce(~text.isin(*FALSY), F.lit(False))


def parse_time(text: Column, cadence: Cadence) -> Column:
    """A typed time; NULL for text that is none, and for years outside 1..9999.

    Spark reads those too, but neither a date on the driver nor a folder name can hold them.
    """
    time = text.try_cast(cadence.time_type)
    return F.when(F.year(time).between(1, 9999), time)


def typed_bars(series: Column, cadence: Cadence) -> Column:
    """The time -> fields map as an array of typed bars, in document order.

    A value that does not fit its column becomes NULL, see :func:`incomplete`.
    """

    def typed(entry: Column) -> Column:
        fields = entry["value"]
        columns = [parse_time(entry["key"], cadence).alias(cadence.time_col)]
        for field, column in PAYLOAD_FIELDS.items():
            kind = "bigint" if column == "volume" else PRICE
            columns.append(F.try_element_at(fields, F.lit(field)).try_cast(kind).alias(column))
        audit = F.to_json(F.create_map(entry["key"], fields))
        return F.struct(*columns, audit.alias("raw_data"))

    return F.transform(F.map_entries(series), typed)


def incomplete(bar: Column, cadence: Cadence) -> Column:
    """True when a typed bar lacks its time or one of the five fields."""
    missing = bar[cadence.time_col].isNull()
    for column in PAYLOAD_FIELDS.values():
        missing = missing | bar[column].isNull()
    return missing


def encode_message(cadence: Cadence, time_text: Column, fields: Column) -> Column:
    """One bar as a topic message; the original time text and field texts are kept."""
    data = F.create_map(time_text, fields)
    return F.to_json(
        F.struct(F.col("symbol"), time_text.alias(cadence.time_col), data.alias("data"))
    )


def bar_message(cadence: Cadence) -> Column:
    """A raw-table row as the one-bar message it would come in."""
    data = F.from_json("raw_data", _SERIES_TYPE)
    return encode_message(cadence, F.map_keys(data)[0], F.map_values(data)[0])
