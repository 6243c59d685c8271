"""Console and Kafka sink starters."""

import pytest

from sensorwatch.config import DEFAULT
from sensorwatch.functions.messages import alert_messages
from sensorwatch.session import run_dir
from sensorwatch.sources.kafka import KafkaSettings
from sensorwatch.sources.rules import read_rules
from sensorwatch.streaming import jobs, sinks

from .test_streaming_golden import FILES, _write_inputs


def test_console_sink_runs(spark, tmp_path):
    src = str(tmp_path / "in")
    _write_inputs(src, list(FILES.items())[:1])
    q = sinks.start_console(jobs.averages_stream(jobs.json_file_readings(spark, src, 1), DEFAULT), run_dir(spark, "console"))
    q.awaitTermination()
    assert q.exception() is None and q.lastProgress["numInputRows"] == 0  # last batch: the eviction batch


def test_kafka_sink_needs_the_connector(spark, tmp_path):
    src = str(tmp_path / "in")
    _write_inputs(src, list(FILES.items())[:1])
    alerts = jobs.alerts_stream(jobs.json_file_readings(spark, src, 1), read_rules(spark), DEFAULT)
    messages = alert_messages(alerts)
    assert messages.columns == ["topic", "value"]
    with pytest.raises(Exception, match="(?i)kafka"):
        sinks.start_kafka(messages, KafkaSettings("localhost:9"), run_dir(spark, "kafka") + "/ckpt", available_now=True)
