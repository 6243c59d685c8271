"""Time columns: durations, event time, UTC wall-clock conversions, ISO text.

All helpers return JVM-side Column expressions (no Python per row).
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNIT_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}
_PART = re.compile(r"(\d+)\s*([a-z]+?)s?\b")

# Largest |epoch seconds| that timestamp_seconds accepts without overflow
# (about year 294,000); beyond it the event time is NULL instead of an error.
_MAX_EPOCH_SECONDS = 9_223_372_036_854  # Long.MaxValue microseconds / 1e6


def duration_micros(text: str) -> int:
    """Microseconds in a fixed duration such as ``"1 minute"`` or ``"1 hour 30 minutes"``.

    Accepts the unit words Spark accepts in window/watermark durations
    (microsecond … week, singular or plural). Months and years have no fixed
    length and are refused, as Spark's ``window`` refuses them.
    """
    s = text.strip().lower()
    if s.startswith("interval"):
        s = s[len("interval"):]
    total, pos = 0, 0
    for m in _PART.finditer(s):
        if s[pos:m.start()].strip():
            break
        unit = m.group(2)
        if unit not in _UNIT_MICROS:
            raise ValueError(f"unsupported duration unit {unit!r} in {text!r}")
        total += int(m.group(1)) * _UNIT_MICROS[unit]
        pos = m.end()
    if pos == 0 or s[pos:].strip():
        raise ValueError(f"cannot read duration {text!r}")
    if total <= 0:
        raise ValueError(f"duration must be positive: {text!r}")
    return total


def pane_micros(window: str, slide: str) -> int:
    """Length of the largest pane that tiles every window: gcd(window, slide)."""
    w, s = duration_micros(window), duration_micros(slide)
    if s > w:
        raise ValueError(f"slide {slide!r} is longer than window {window!r}")
    return math.gcd(w, s)


def epoch_text_to_time_sql(expr: str) -> str:
    """SQL: epoch seconds given as text (``"1724072749.98"``, ``"1.7E9"``) -> TIMESTAMP, whole seconds.

    ``expr`` is a SQL expression of the text. The fraction is cut toward zero.
    Unparsable text, NaN, infinities and values beyond the timestamp range give
    NULL instead of failing the query.
    """
    seconds = f"try_cast({expr} AS DOUBLE)"
    return (
        f"timestamp_seconds(try_cast(CASE WHEN abs({seconds}) <= {_MAX_EPOCH_SECONDS} THEN {seconds} END AS BIGINT))"
    )


def epoch_text_to_time(expr: str) -> Column:
    """TIMESTAMP column: :func:`epoch_text_to_time_sql` of the SQL expression ``expr``."""
    return F.expr(epoch_text_to_time_sql(expr))


def _epoch_ntz() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def utc_wall_micros_sql(name: str) -> str:
    """SQL: microseconds since the epoch of TIMESTAMP_NTZ column ``name`` read as UTC wall-clock time.

    Computed from the wall-clock fields (day number, time of day), so it does
    not depend on the session zone and holds for walls that do not exist in
    it; a cast through the session zone would shift those.
    """
    c = f"`{name}`"
    return (
        f"CAST(unix_date(to_date({c})) AS BIGINT) * 86400000000"
        f" + CAST(hour({c}) * 60 + minute({c}) AS BIGINT) * 60000000"
        f" + CAST(extract(SECOND FROM {c}) * 1000000 AS BIGINT)"
    )


def utc_wall_micros(name: str) -> Column:
    """BIGINT column: :func:`utc_wall_micros_sql` of column ``name``."""
    return F.expr(utc_wall_micros_sql(name))


def utc_wall_to_instant_sql(name: str, unit_micros: int = 1) -> str:
    """SQL: TIMESTAMP_NTZ column ``name`` read as UTC wall-clock time -> TIMESTAMP, whatever the session zone.

    ``unit_micros`` > 1 cuts the time down to a multiple of it (1_000_000 =
    whole seconds, toward the past).
    """
    us = f"({utc_wall_micros_sql(name)})"
    if unit_micros > 1:
        return f"timestamp_micros({us} - pmod({us}, {unit_micros}))"
    return f"timestamp_micros({us})"


def utc_wall_to_instant(name: str, unit_micros: int = 1) -> Column:
    """TIMESTAMP column: :func:`utc_wall_to_instant_sql` of column ``name``."""
    return F.expr(utc_wall_to_instant_sql(name, unit_micros))


def instant_to_utc_wall_sql(expr: str) -> str:
    """SQL: TIMESTAMP expression -> its UTC wall-clock time as TIMESTAMP_NTZ, whatever the session zone."""
    return f"timestampadd(MICROSECOND, unix_micros({expr}), TIMESTAMP_NTZ'1970-01-01 00:00:00')"


def instant_to_utc_wall(ts: Column) -> Column:
    """TIMESTAMP -> its UTC wall-clock time as TIMESTAMP_NTZ, whatever the session zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), _epoch_ntz())


def wall_time(ts: Column, time_zone: str | None) -> Column:
    """Wall-clock time of an instant in ``time_zone`` (None = session zone)."""
    if time_zone is None:
        return ts
    return F.convert_timezone(F.lit("UTC"), F.lit(time_zone), instant_to_utc_wall(ts))


def iso_text(ts: Column, time_zone: str | None = None) -> Column:
    """ISO-8601 text like Python's ``datetime.isoformat()`` of a naive time.

    ``YYYY-MM-DDTHH:MM:SS`` when the microseconds are zero, else with a
    six-digit fraction.
    """
    wall = wall_time(ts, time_zone)
    whole = F.unix_micros(ts) % F.lit(1_000_000) == 0
    return F.when(whole, F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss")).otherwise(
        F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    )
