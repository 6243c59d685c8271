"""The operators take their measures from the settings: a third measure needs no code change."""

from pyspark.sql import functions as F

from sensorwatch.config import AlertSettings
from sensorwatch.functions.messages import alert_messages
from sensorwatch.operators.rule_join import match_rules
from sensorwatch.operators.windows import window_averages


def test_three_measures(spark):
    s = AlertSettings(measures=("temperature", "humidity", "co2"))
    readings = spark.sql(
        "SELECT * FROM VALUES"
        " (TIMESTAMP'2024-01-01 00:00:05', 1, 'temperature', 20),"
        " (TIMESTAMP'2024-01-01 00:00:06', 1, 'co2', 900),"
        " (TIMESTAMP'2024-01-01 00:00:07', 2, 'co2', 1100)"
        " AS t(timestamp, id, sensor, value)"
    )
    avgs = window_averages(readings, s)
    assert avgs.columns == ["window", "avg_temperature", "avg_humidity", "avg_co2"]
    assert sorted(r.avg_co2 for r in avgs.collect()) == [1000.0, 1000.0]
    rules = spark.createDataFrame(
        [(1, -999, -999, -999, -999, 950, 5000, 201, "stale air"), (2, -999, -999, -999, -999, 0, 500, 202, "fresh")],
        "id int, humidity_min int, humidity_max int, temperature_min int, temperature_max int,"
        " co2_min int, co2_max int, code int, message string",
    )
    assert sorted(r.code for r in match_rules(avgs, rules, s).collect()) == [201, 201]
    msg = alert_messages(match_rules(avgs, rules, s), s, sent_at="x").select(F.get_json_object("value", "$.co2_avg").alias("c"))
    assert {r.c for r in msg.collect()} == {"1000.0"}
