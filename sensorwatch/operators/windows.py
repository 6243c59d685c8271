"""Sliding event-time window averages of each measure.

Batch plan (pane pre-aggregation): every reading falls into exactly one pane
of length gcd(window, slide); sums and counts are aggregated per pane first
(map-side partial aggregation, one shuffle on the pane key), and only then
each pane is expanded into the ``window / slide`` windows that contain it and
re-aggregated (a second shuffle over pane partials, which are few). The
per-reading ``Expand`` of a plain ``groupBy(window(...))`` is thus replaced by
an expansion of pane rows, and a hot pane (one instant holding a large share
of all readings) is reduced map-side before it is shuffled.

Streaming plan: ``groupBy(window(...))`` with sums and counts per measure (the
state of a window, see ``streaming.monitor.state_rows``), then the division.

Both give the same rows: integer readings are summed exactly (BIGINT, longs as
DECIMAL) and become a double only at the division, so the order in which
partial sums meet plays no part. Readings with fractions are summed as doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT, AlertSettings
from ..functions.timecols import duration_micros, instant_to_utc_wall_sql, pane_micros


def _keys(by_sensor: bool) -> list[Column]:
    return [F.col("id").alias("sensor_id")] if by_sensor else []


def sum_type(value: T.DataType) -> str:
    """The type in which readings are summed: exact for whole numbers (of 2^32 readings of any INT, 10^10 of any BIGINT)."""
    if isinstance(value, (T.ByteType, T.ShortType, T.IntegerType)):
        return "BIGINT"
    if isinstance(value, T.LongType):
        return "DECIMAL(20, 0)"
    return value.simpleString() if isinstance(value, T.DecimalType) else "DOUBLE"


def window_averages(
    readings: DataFrame,
    settings: AlertSettings = DEFAULT,
    by_sensor: bool = False,
    time_col: str = "timestamp",
) -> DataFrame:
    """Readings -> ``window STRUCT<start, end>, [sensor_id], avg_<measure>...``.

    ``avg_<m>`` is the mean ``value`` of the readings whose ``sensor`` equals
    ``m`` (case-sensitive) in the window, NULL if there is none. A window that
    holds only other sensors still appears, with NULL averages. Readings with a
    NULL time are in no window. ``by_sensor`` adds the reading's ``id`` as
    ``sensor_id`` to the grouping.
    """
    measures, keys = settings.measures, ["sensor_id"] if by_sensor else []
    kind = sum_type(readings.schema["value"].dataType)
    partial = []
    for m in measures:
        hit = f"sensor = {_quote(m)}"
        partial.append(F.expr(f"sum(CASE WHEN {hit} THEN CAST(value AS {kind}) END) AS `_s_{m}`"))
        partial.append(F.expr(f"count(CASE WHEN {hit} THEN value END) AS `_n_{m}`"))
    if readings.isStreaming:
        grouped = readings.groupBy(F.window(time_col, settings.window, settings.slide).alias("window"), *_keys(by_sensor))
        averages = [f"try_divide(CAST(`_s_{m}` AS DOUBLE), `_n_{m}`) AS `avg_{m}`" for m in measures]
        return grouped.agg(*partial).selectExpr("window", *keys, *averages)

    length, slide = duration_micros(settings.window), duration_micros(settings.slide)
    pane = pane_micros(settings.window, settings.slide)

    # stage 1, per reading: sums and counts per pane (BIGINT start, microseconds)
    us = f"unix_micros(`{time_col}`)"
    panes = readings.groupBy(F.expr(f"{us} - pmod({us}, {pane}) AS _pane"), *_keys(by_sensor)).agg(*partial)

    # stage 2, per pane: the windows that hold it. Window starts are multiples
    # of the slide; those in (pane - length, pane] contain the whole pane,
    # because pane boundaries divide both length and slide. Rows of a NULL pane
    # (NULL time) or with a start outside that range are marked and their group
    # is dropped by a flag aggregated alongside: a filter on the pane itself
    # would be pushed below stage 1 by the optimizer and evaluate the time
    # expression a second time for every reading.
    n = -(-length // slide)
    start = f"(_pane - pmod(_pane, {slide}) - _k * {slide})"
    keep = "_pane IS NOT NULL" + (f" AND {start} + {length} > _pane" if length % slide else "")
    window = (
        f"CASE WHEN {keep} THEN named_struct('start', timestamp_micros({start}),"
        f" 'end', timestamp_micros({start} + {length})) END AS window"
    )
    expanded = panes.selectExpr("*", f"explode(sequence(0, {n - 1})) AS _k")
    out = expanded.groupBy(F.expr(window), *keys).agg(
        *[F.expr(f"try_divide(CAST(sum(`_s_{m}`) AS DOUBLE), sum(`_n_{m}`)) AS `avg_{m}`") for m in measures],
        F.expr(f"max(CASE WHEN {keep} THEN 1 ELSE 0 END) AS _ok"),
    )
    return out.where("_ok = 1").select("window", *keys, *[f"avg_{m}" for m in measures])


def _quote(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def flatten_window(df: DataFrame, wall: bool = True) -> DataFrame:
    """Replace ``window`` by ``window_start``, ``window_end`` (UTC wall-clock TIMESTAMP_NTZ when ``wall``)."""
    conv = instant_to_utc_wall_sql if wall else (lambda e: e)
    cols = []
    for name in df.columns:
        if name == "window":
            cols += [f"{conv('window.start')} AS window_start", f"{conv('window.end')} AS window_end"]
        else:
            cols.append(f"`{name}`")
    return df.selectExpr(*cols)
