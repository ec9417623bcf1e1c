"""Time arithmetic on zone-less timestamps, independent of the session's zone."""

from __future__ import annotations

import datetime as dt

from ..schemas import RAW_EPOCH

NTZ = "timestamp_ntz"
# Fixed value: the ISO 8601 forms taken as a time; anything else counts as unreadable.
ISO_FORM = (
    "^[0-9]{4}-[0-9]{2}-[0-9]{2}"
    "([T ][0-9]{2}(:[0-9]{2}(:[0-9]{2}([.][0-9]{1,6})?)?)?(Z|[+-][0-9]{2}(:?[0-9]{2})?)?)?$"
)


def ntz(moment: dt.datetime) -> str:
    """A zone-less timestamp literal."""
    return f"timestamp_ntz'{moment.strftime('%Y-%m-%d %H:%M:%S.%f')}'"


def day_of(ts: str) -> str:
    return f"cast(cast({ts} AS date) AS {NTZ})"


def hour_of(ts: str) -> str:
    return f"({day_of(ts)} + make_dt_interval(0, hour({ts})))"


def plus_seconds(ts: str, seconds: str) -> str:
    return f"({ts} + make_dt_interval(0, 0, 0, cast({seconds} AS decimal(18, 6))))"


def plus_hours(ts: str, hours: str) -> str:
    return f"({ts} + make_dt_interval(0, cast({hours} AS int)))"


def seconds_between(start: str, end: str) -> str:
    """``end - start`` in seconds as an exact decimal."""
    return f"cast(cast(({end}) - ({start}) AS interval second) AS decimal(18, 6))"


def epoch_to_time(epoch: str) -> str:
    """Seconds since 1970 as a UTC wall-clock time; NULL stays NULL."""
    return plus_seconds(ntz(RAW_EPOCH), epoch)


def iso_time(text: str) -> str:
    """ISO text as a wall-clock time, any offset ignored; unreadable text gives NULL."""
    return f"CASE WHEN {text} RLIKE '{ISO_FORM}' THEN try_cast({text} AS {NTZ}) END"


def iso_time_or(text: str, fallback: str) -> str:
    return f"coalesce({iso_time(text)}, {fallback})"


def hour_from_code(code: str) -> str:
    """Hour of a clock code: ``"300"`` and ``"1500"`` count hundreds, codes below 100 count minutes.

    Missing and unreadable codes give 0.  The result may lie outside 0..23; the caller rejects that.
    """
    number = f"coalesce(try_cast({code} AS int), 0)"
    return f"cast(floor(CASE WHEN {number} >= 100 THEN {number} / 100 ELSE {number} / 60 END) AS int)"


def date_and_code(date_text: str, code: str, fallback: str) -> str:
    """A day plus a clock code; an unreadable day gives ``fallback``, an impossible hour gives NULL."""
    day, hour = day_of(iso_time(date_text)), hour_from_code(code)
    return f"""CASE WHEN {day} IS NULL THEN {fallback}
        WHEN {hour} BETWEEN 0 AND 23 THEN {plus_hours(day, hour)} END"""
