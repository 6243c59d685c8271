"""sensorwatch: sliding-window alerting on sensor readings, built on Spark.

Pipeline (each step a DataFrame -> DataFrame function, batch or stream):

    readings (Kafka JSON or files) -> decode_readings -> window_averages
        -> match_rules(rules) -> alert_messages -> Kafka / table sinks
"""

from .config import DEFAULT, HOURLY, AlertSettings, Topics
from .functions.decode import decode_readings, encode_readings
from .functions.messages import alert_messages, message_value, route_topic
from .functions.predicates import optional_max, optional_min, rule_predicate
from .operators.rule_join import match_rules
from .operators.windows import flatten_window, window_averages
from .sources.events import readings_from_events
from .sources.rules import RULE_SCHEMA, read_rules

__all__ = [
    "DEFAULT",
    "HOURLY",
    "AlertSettings",
    "Topics",
    "decode_readings",
    "encode_readings",
    "alert_messages",
    "message_value",
    "route_topic",
    "optional_min",
    "optional_max",
    "rule_predicate",
    "match_rules",
    "window_averages",
    "flatten_window",
    "readings_from_events",
    "RULE_SCHEMA",
    "read_rules",
]
