"""Column expressions shared by the operators (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schema import EVENT_NAMES, FLOAT_ARRAY


def to_millis(ts: Column | str) -> Column:
    """Cut a timestamp to milliseconds, as a UTC wall-clock TIMESTAMP_NTZ.

    ``date_trunc`` returns a zoned TIMESTAMP; with the session pinned to UTC
    the cast back to TIMESTAMP_NTZ keeps the same wall-clock value.
    """
    return F.date_trunc("millisecond", F.col(ts) if isinstance(ts, str) else ts).cast("timestamp_ntz")


def month_key(ts: Column | str) -> Column:
    """``yyyyMM`` text of a timestamp or date: the history partition value."""
    return F.date_format(F.col(ts) if isinstance(ts, str) else ts, "yyyyMM")


def day_key(ts: Column | str) -> Column:
    """``yyyyMMdd`` text of a timestamp or date: the optional daily partition value."""
    return F.date_format(F.col(ts) if isinstance(ts, str) else ts, "yyyyMMdd")


def day_text(d: Column | str) -> Column:
    """A date rendered as ``yyyy-MM-dd`` text."""
    return F.date_format(F.col(d) if isinstance(d, str) else d, "yyyy-MM-dd")


def has_error(error: Column | str = "error") -> Column:
    """True when the error text is non-empty; the column is never NULL in history."""
    return F.coalesce(F.col(error) if isinstance(error, str) else error, F.lit("")) != ""


def empty_floats() -> Column:
    """An empty ``ARRAY<FLOAT>`` literal."""
    return F.array().cast(FLOAT_ARRAY)


def blank_as_absent(c: Column | str) -> Column:
    """``''`` counts as not provided: turn it into NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c != "", c)


def known_event_name(c: Column | str) -> Column:
    """Membership in the allowed event names."""
    c = F.col(c) if isinstance(c, str) else c
    return c.isin(*EVENT_NAMES)


def days_before(as_of: Column, days: int) -> Column:
    """``as_of - INTERVAL days DAY`` keeping the input's timestamp type."""
    return as_of - F.make_dt_interval(F.lit(int(days)))


def as_of_literal(as_of) -> Column:
    """A TIMESTAMP_NTZ literal for ``as_of``; ``None`` means now (UTC)."""
    if as_of is None:
        return F.current_timestamp().cast("timestamp_ntz")
    if isinstance(as_of, Column):
        return as_of.cast("timestamp_ntz")
    return F.lit(str(as_of)).cast("timestamp_ntz")
