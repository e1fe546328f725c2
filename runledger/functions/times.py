"""Times.  None of these depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _epoch() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def epoch_micros(ntz: Column) -> Column:
    """Microseconds since 1970 of a zone-less timestamp that is meant as UTC."""
    return F.timestamp_diff("MICROSECOND", _epoch(), ntz)


def nanos_to_timestamp(nanos: Column) -> Column:
    """OTLP nanoseconds (64-bit integer, usually as text) to a timestamp.

    0 means "not set" and becomes NULL, as does a value beyond 64-bit signed.
    The table keeps microseconds; the rest is cut off.
    """
    n = nanos.try_cast("bigint")
    return F.timestamp_micros(F.call_function("div", F.nullif(n, F.lit(0).cast("bigint")), F.lit(1000)))


def resolve_time(event_time: Column, observed_time: Column, now: Column | None = None) -> Column:
    """Event time, else observed time, else ``now``; both times in OTLP nanoseconds.

    This is the documented chain.  Code that tests the converted time against
    the year 1 instead never falls back and stores 1970 for an unset time; that
    is not reproduced here.  ``now`` can be given to make results repeatable.
    """
    return F.coalesce(
        nanos_to_timestamp(event_time),
        nanos_to_timestamp(observed_time),
        F.current_timestamp() if now is None else now,
    )


def rfc3339(ts: Column) -> Column:
    """UTC timestamp text: a fraction only where there is one, without trailing zeros."""
    utc = F.timestamp_add("MICROSECOND", F.unix_micros(ts), _epoch())
    # A zone-less timestamp prints as 'yyyy-MM-dd HH:mm:ss[.f]' with the zeros trimmed.
    return F.concat(F.replace(utc.cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))
