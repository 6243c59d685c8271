import json

from pyspark.sql import functions as F

from sensorwatch.config import AlertSettings, Topics
from sensorwatch.functions.messages import alert_messages, route_topic

ALERT_SCHEMA = (
    "id int, humidity_min int, humidity_max int, temperature_min int, temperature_max int, code int, message string,"
    " window struct<start: timestamp, end: timestamp>, avg_temperature double, avg_humidity double"
)


def _alerts(spark, rows):
    return spark.createDataFrame(rows, ALERT_SCHEMA)


def test_message_shape_and_null_average(spark):
    import datetime as dt

    w = (dt.datetime(2025, 6, 11, 7, 41, 30), dt.datetime(2025, 6, 11, 7, 42, 30))
    df = _alerts(spark, [(4, -999, -999, 40, 300, 104, "It's too hot", w, 41.25, None)])
    r = alert_messages(df, sent_at="2025-06-11T07:42:19.030405").first()
    assert r.topic == "temperature_alerts"
    assert r.value == (
        '{"window":{"start":"2025-06-11T07:41:30","end":"2025-06-11T07:42:30"},"t_avg":41.25,"h_avg":null,'
        '"code":104,"message":"It\'s too hot","timestamp":"2025-06-11T07:42:19.030405"}'
    )
    assert list(json.loads(r.value)) == ["window", "t_avg", "h_avg", "code", "message", "timestamp"]


def test_send_time_defaults_to_now(spark):
    import datetime as dt

    w = (dt.datetime(2025, 6, 11, 7, 41, 30), dt.datetime(2025, 6, 11, 7, 42, 30))
    df = _alerts(spark, [(1, 0, 40, -999, -999, 101, "It's too dry", w, None, 20.0)])
    v = json.loads(alert_messages(df).first().value)
    sent = dt.datetime.fromisoformat(v["timestamp"])
    assert abs((sent - dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)).total_seconds()) < 120
    assert v["t_avg"] is None and v["h_avg"] == 20.0 and v["code"] == 101


def test_routing(spark):
    df = spark.createDataFrame([(101,), (102,), (103,), (104,), (None,), (999,)], "code int")
    got = [r.t for r in df.select(route_topic(F.col("code")).alias("t")).collect()]
    assert got == ["humidity_alerts", "humidity_alerts", "temperature_alerts", "temperature_alerts", "humidity_alerts", "humidity_alerts"]
    s = AlertSettings(topics=Topics.with_prefix("me"))
    assert df.select(route_topic(F.col("code"), s).alias("t")).first().t == "me_humidity_alerts"
