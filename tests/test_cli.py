import json

from sensorwatch.streaming import cli

from .test_streaming_golden import FILES, _write_inputs


def test_publish_to_table_once(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    _write_inputs(src, list(FILES.items()))
    cli.main(["publish", "--source", "json", "--max-files-per-trigger", "1", "--path", src, "--sink", "table", "--out", out, "--once",
              "--topic-prefix", "me", "--message-time-zone", "UTC"], spark=spark)
    rows = spark.read.parquet(out).collect()
    got = sorted((r.topic, json.loads(r.value)["window"]["start"][11:], json.loads(r.value)["code"]) for r in rows)
    assert got == sorted(
        [
            ("me_humidity_alerts", "13:04:30", 101), ("me_temperature_alerts", "13:04:30", 104),
            ("me_humidity_alerts", "13:05:00", 101), ("me_temperature_alerts", "13:05:00", 103),
            ("me_humidity_alerts", "13:05:30", 101), ("me_temperature_alerts", "13:05:30", 104),
            ("me_humidity_alerts", "13:06:00", 102), ("me_temperature_alerts", "13:06:00", 103),
            ("me_humidity_alerts", "13:06:30", 102), ("me_temperature_alerts", "13:06:30", 103),
        ]
    )


def test_averages_changelog_once(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    _write_inputs(src, list(FILES.items()))
    q = cli.main(["averages", "--source", "json", "--max-files-per-trigger", "1", "--path", src, "--sink", "changelog", "--out", out, "--once"], spark=spark)
    assert q.exception() is None
    assert spark.read.parquet(out).count() == 10  # update-mode rows of the golden run


def test_by_sensor_with_rocksdb_state(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    _write_inputs(src, list(FILES.items()))
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    try:
        cli.main(["alerts", "--source", "json", "--max-files-per-trigger", "1", "--path", src, "--sink", "changelog", "--out", out, "--once",
                  "--by-sensor", "--state-store", "rocksdb"], spark=spark)
    finally:
        if before:
            spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
        else:
            spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    rows = spark.read.parquet(out).collect()
    assert {r.sensor_id for r in rows} == {1}
    assert len(rows) == 12  # the update-mode alerts of the golden run, all from sensor 1


def test_rules_and_readings_jobs(spark, tmp_path, capsys):
    rules = cli.main(["rules"], spark=spark)
    assert rules.count() == 4
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    _write_inputs(src, list(FILES.items()))
    cli.main(["readings", "--source", "json", "--max-files-per-trigger", "1", "--path", src, "--sink", "table", "--out", out, "--once"], spark=spark)
    rows = spark.read.parquet(out).collect()
    assert len(rows) == sum(len(v) for v in FILES.values())
    assert {r.sensor for r in rows} == {"temperature", "humidity"}


def test_produce_then_consume_round_trip(spark, tmp_path):
    from .conftest import SF_SMALL

    out, json_dir = str(tmp_path / "msgs"), str(tmp_path / "json")
    cli.main(["produce", "--path", SF_SMALL, "--sink", "table", "--out", out, "--topic-prefix", "me"], spark=spark)
    msgs = spark.read.parquet(out)
    assert msgs.count() == spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    assert {r.topic for r in msgs.select("topic").distinct().collect()} == {"me_building_sensors"}
    # the produced values are what the stream jobs decode
    msgs.select("value").write.text(json_dir)
    avg_out = str(tmp_path / "avg")
    cli.main(["averages", "--source", "json", "--max-files-per-trigger", "1", "--path", json_dir, "--sink", "changelog", "--out", avg_out, "--once",
              "--max-files-per-trigger", "100"], spark=spark)
    assert spark.read.parquet(avg_out).count() == 1975  # every window of sf0.001 (FIXTURES section 2)
