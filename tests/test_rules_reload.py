"""A rules file replaced while a stream runs is used from the next micro-batch on."""

import json
import os
import time

from sensorwatch.config import DEFAULT
from sensorwatch.session import run_dir
from sensorwatch.sources.rules import default_rules_path, read_rules
from sensorwatch.streaming import jobs, sinks

BASE = 1724072700.25


def _write(path, name, rows, when):
    f = os.path.join(path, name)
    with open(f, "w") as fh:
        for off, sensor, value in rows:
            fh.write(json.dumps({"timestamp": BASE + off, "id": 1, "sensor": sensor, "value": value}) + "\n")
    os.utime(f, (when, when))


def test_replaced_rules_file_reaches_next_batch(spark, tmp_path):
    # the cuts are those of the rules at start; the edited bound (1000) lies outside them
    rules_path = str(tmp_path / "rules.csv")
    with open(default_rules_path()) as src, open(rules_path, "w") as dst:
        dst.write(src.read())
    inp = str(tmp_path / "in")
    os.makedirs(inp)
    now = time.time() - 100
    readings = jobs.json_file_readings(spark, inp, 1)
    alerts = jobs.alerts_stream(readings, read_rules(spark, rules_path), DEFAULT)
    base = run_dir(spark, "rules_reload")
    q = sinks.start_changelog(alerts, f"{base}/log", f"{base}/ckpt", "update", available_now=False, processing_time="1 second")
    try:
        _write(inp, "a.json", [(0, "temperature", 44), (29, "humidity", 70)], now)
        q.processAllAvailable()
        # "too wet" now starts at 75 instead of 60, and the file gets longer: write aside, then rename over
        text = open(rules_path).read().replace("2,60,100,", "2,75,1000,")
        with open(rules_path + ".tmp", "w") as fh:
            fh.write(text)
        os.replace(rules_path + ".tmp", rules_path)
        _write(inp, "b.json", [(100, "temperature", 25), (100, "humidity", 70)], now + 1)
        q.processAllAvailable()
    finally:
        q.stop()
    log = sinks.read_changelog(spark, f"{base}/log", alerts.schema).collect()
    first = {r.code for r in log if r.window.start.minute == 4 and r.window.start.second == 30}
    later = {r.code for r in log if r.window.start.minute == 6}
    assert first == {102, 104}  # 44 °C, 70 % under the original rules
    assert later == {103}  # 70 % no longer "too wet" once the new file is in
