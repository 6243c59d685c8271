"""Alert messages: JSON value and destination topic per alert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, SENSOR_HUMIDITY, SENSOR_TEMPERATURE, AlertSettings
from .timecols import iso_text

# Message keys of the two averages.
_AVG_KEYS = {SENSOR_TEMPERATURE: "t_avg", SENSOR_HUMIDITY: "h_avg"}


def route_topic(code: Column, settings: AlertSettings = DEFAULT) -> Column:
    """Temperature topic for the temperature codes, humidity topic for every other code (NULL too)."""
    return F.when(code.isin(*settings.temperature_codes), F.lit(settings.topics.temperature_alerts)).otherwise(
        F.lit(settings.topics.humidity_alerts)
    )


def message_value(settings: AlertSettings = DEFAULT, sent_at: str | Column | None = None) -> Column:
    """JSON text ``{"window":{"start","end"}, "t_avg", "h_avg", "code", "message", "timestamp"}``.

    Window bounds are ISO text of wall-clock time in ``settings.message_time_zone``
    (session zone when None). ``timestamp`` is the send time: the batch's
    ``current_timestamp()`` unless ``sent_at`` pins it (text is used as given).
    NULL averages are written as JSON ``null``.
    """
    tz = settings.message_time_zone
    if sent_at is None:
        stamp = iso_text(F.current_timestamp(), tz)
    elif isinstance(sent_at, str):
        stamp = F.lit(sent_at)
    else:
        stamp = iso_text(sent_at, tz)
    fields = [
        F.struct(iso_text(F.col("window.start"), tz).alias("start"), iso_text(F.col("window.end"), tz).alias("end")).alias(
            "window"
        )
    ]
    fields += [F.col(f"avg_{m}").alias(_AVG_KEYS.get(m, f"{m}_avg")) for m in settings.measures]
    fields += [F.col("code").alias("code"), F.col("message").alias("message"), stamp.alias("timestamp")]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def alert_messages(alerts: DataFrame, settings: AlertSettings = DEFAULT, sent_at: str | Column | None = None) -> DataFrame:
    """Alerts -> ``topic STRING, value STRING``, the columns the Kafka sink writes (no key)."""
    return alerts.select(
        route_topic(F.col("code"), settings).alias("topic"),
        message_value(settings, sent_at).alias("value"),
    )
