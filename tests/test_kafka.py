import pytest

from sensorwatch.sources.kafka import KafkaSettings, source_options


def test_options_plaintext():
    assert KafkaSettings("h:9092").options() == {"kafka.bootstrap.servers": "h:9092"}


def test_options_sasl_and_source():
    k = KafkaSettings("h:9092", "SASL_PLAINTEXT", "PLAIN", "user", 'pa"ss')
    opts = source_options(k, "me_building_sensors", max_offsets_per_trigger=5, min_partitions=64)
    assert opts["kafka.security.protocol"] == "SASL_PLAINTEXT"
    assert opts["kafka.sasl.mechanism"] == "PLAIN"
    assert opts["kafka.sasl.jaas.config"] == (
        'org.apache.kafka.common.security.plain.PlainLoginModule required username="user" password="pa\\"ss";'
    )
    assert opts["subscribe"] == "me_building_sensors"
    assert opts["startingOffsets"] == "earliest"
    assert opts["failOnDataLoss"] == "false"
    assert opts["maxOffsetsPerTrigger"] == "5"
    assert opts["minPartitions"] == "64"


def test_from_env(monkeypatch):
    monkeypatch.setenv("X_BOOTSTRAP_SERVERS", "b:1")
    monkeypatch.setenv("X_USERNAME", "u")
    monkeypatch.setenv("X_PASSWORD", "p")
    k = KafkaSettings.from_env("X_")
    assert (k.bootstrap_servers, k.username, k.password) == ("b:1", "u", "p")
    monkeypatch.delenv("X_BOOTSTRAP_SERVERS")
    with pytest.raises(KeyError):
        KafkaSettings.from_env("X_")


def test_login_is_escaped_and_hidden():
    k = KafkaSettings("h:1", username='u"x', password="ab\\")
    assert k.options()["kafka.sasl.jaas.config"].endswith('username="u\\"x" password="ab\\\\";')
    assert "ab" not in repr(k)
