"""Settings of an alerting job.

Every transform takes its parameters from :class:`AlertSettings`; the defaults
are the values the original sensor-alert job runs with.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- Fixed values -----------------------------------------------------------
# These must equal the original job's settings for identical results.
# Window length, slide and watermark delay of the sliding averages.
WINDOW_DURATION = "1 minute"
SLIDE_DURATION = "30 seconds"
WATERMARK_DELAY = "10 seconds"
# A rule bound equal to this value is "not used".
UNUSED_BOUND = -999
# Sensor names carried in the `sensor` field of a reading.
SENSOR_TEMPERATURE = "temperature"
SENSOR_HUMIDITY = "humidity"
# Alert codes published to the temperature topic; every other code goes to
# the humidity topic.
TEMPERATURE_CODES = (103, 104)
# Topic base names: readings, temperature alerts, humidity alerts.
TOPIC_READINGS = "building_sensors"
TOPIC_TEMPERATURE_ALERTS = "temperature_alerts"
TOPIC_HUMIDITY_ALERTS = "humidity_alerts"
# Value ranges of the simulated sensors, inclusive.
TEMPERATURE_RANGE = (25, 45)
HUMIDITY_RANGE = (15, 85)
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Topics:
    readings: str = TOPIC_READINGS
    temperature_alerts: str = TOPIC_TEMPERATURE_ALERTS
    humidity_alerts: str = TOPIC_HUMIDITY_ALERTS

    @classmethod
    def with_prefix(cls, prefix: str) -> "Topics":
        """Topics named ``<prefix>_<base>``, so that several users can share a broker."""
        return cls(
            readings=f"{prefix}_{TOPIC_READINGS}",
            temperature_alerts=f"{prefix}_{TOPIC_TEMPERATURE_ALERTS}",
            humidity_alerts=f"{prefix}_{TOPIC_HUMIDITY_ALERTS}",
        )


@dataclass(frozen=True)
class AlertSettings:
    window: str = WINDOW_DURATION
    slide: str = SLIDE_DURATION
    watermark: str = WATERMARK_DELAY
    unused_bound: int = UNUSED_BOUND
    measures: tuple[str, ...] = (SENSOR_TEMPERATURE, SENSOR_HUMIDITY)
    temperature_codes: tuple[int, ...] = TEMPERATURE_CODES
    topics: Topics = field(default_factory=Topics)
    # Cuts of a measure axis by the rule join (quantiles of the rules' bounds), and children of a tree node.
    rule_bins: int = 63
    rule_fanout: int = 12
    # Time zone of the text timestamps in alert messages; None = session zone.
    message_time_zone: str | None = None


DEFAULT = AlertSettings()
HOURLY = AlertSettings(window="1 hour", slide="30 minutes")
