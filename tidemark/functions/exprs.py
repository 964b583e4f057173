"""Guarded scalar expressions.  ANSI mode stays on: nothing here divides or takes logs of what it shouldn't."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(a: Column, b: Column) -> Column:
    """a / b; null where b is null or 0."""
    return F.when(b != 0, a / b)


def log_ratio(a: Column, b: Column) -> Column:
    """ln(a / b); null unless both are positive."""
    return F.when((a > 0) & (b > 0), F.ln(a / b))


def finite(x: Column) -> Column:
    """Not null, not NaN, not infinite."""
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))


def clip_low(x: Column, low: float) -> Column:
    """At least ``low``; null stays null."""
    return F.when(x < low, F.lit(low)).otherwise(x)


def empty_to_null(x: Column) -> Column:
    return F.nullif(x, F.lit(""))


def micros(ts: Column) -> Column:
    """Microseconds since the epoch of a time stamp with or without zone (UTC)."""
    return F.unix_micros(ts.cast("timestamp"))


def from_micros(us: Column) -> Column:
    return F.timestamp_micros(us).cast("timestamp_ntz")


def floor_time(ts: Column, seconds: int) -> Column:
    """Start of the calendar bucket of ``seconds``."""
    us = seconds * 1_000_000
    return from_micros(F.floor(micros(ts) / us).cast("long") * us)


def minute(ts: Column) -> Column:
    return F.date_trunc("minute", ts).cast("timestamp_ntz")


def normal_symbol(symbol: Column) -> Column:
    """Upper case, trimmed, separators as '-'."""
    return F.upper(F.regexp_replace(F.trim(symbol), r"[/_:\s]+", "-"))


def base_asset(symbol: Column) -> Column:
    return F.split(normal_symbol(symbol), "-")[0]


#: Parts of an option's name: underlying, day, month, year, strike, type.
OPTION_NAME = r"^([A-Z0-9#]+)-(\d{1,2}[A-Z]{3}\d{2})-(\d+(?:\.\d+)?)-([CP])$"


def option_parts(name: Column) -> dict[str, Column]:
    """underlying, expiry, strike, option_type; null where the name or a part isn't valid."""
    part = lambda i: empty_to_null(F.regexp_extract(name, OPTION_NAME, i))
    return {"underlying": part(1), "expiry": F.try_to_date(part(2), "dMMMyy"), "strike": part(3).cast("double"), "option_type": part(4)}
