import datetime as dt

from pyspark.sql import functions as F

from sensorwatch.functions.decode import decode_readings, encode_readings
from sensorwatch.functions.timecols import instant_to_utc_wall
from sensorwatch.sources.events import read_events, readings_from_events

from .conftest import SF_SMALL


def _decode(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "value string")
    out = decode_readings(df)
    return [
        (r.t, r.id, r.sensor, r.value)
        for r in out.select(instant_to_utc_wall(F.col("timestamp")).alias("t"), "id", "sensor", "value").collect()
    ]


def test_decode_edge_cases(spark):
    got = _decode(
        spark,
        [
            '{"timestamp": 1724072749.987654, "id": 3, "sensor": "temperature", "value": 41}',
            '{"timestamp": "1724072749.5", "id": 3, "sensor": "humidity", "value": 25.5}',
            '{"timestamp": "abc", "id": 3, "sensor": "humidity", "value": 25}',
            "not json",
            None,
            '{"id": 9}',
            '{"timestamp":1.5,"id":99999999999,"sensor":"temperature","value":3000000000}',
            '{"timestamp":1.5,"id":"7","sensor":5,"value":"41"}',
        ],
    )
    t = dt.datetime(2024, 8, 19, 13, 5, 49)
    epoch1 = dt.datetime(1970, 1, 1, 0, 0, 1)
    assert got == [
        (t, 3, "temperature", 41),
        (t, 3, "humidity", None),
        (None, 3, "humidity", 25),
        (None, None, None, None),
        (None, None, None, None),
        (None, 9, None, None),
        (epoch1, None, "temperature", None),
        (epoch1, None, "5", None),
    ]


def test_decode_binary_value(spark):
    df = spark.createDataFrame([(bytearray(b'{"timestamp": 1724072749.2, "id": 1, "sensor": "humidity", "value": 30}'),)], "value binary")
    r = decode_readings(df).first()
    assert (r.id, r.sensor, r.value) == (1, "humidity", 30)


def test_encode_then_decode_is_identity_up_to_seconds(spark):
    fine = readings_from_events(read_events(spark, SF_SMALL), keep_fraction=True)
    coarse = readings_from_events(read_events(spark, SF_SMALL))
    enc = encode_readings(fine)
    assert enc.columns == ["key", "value"]
    k = enc.first().key
    assert k.startswith('"') and k.endswith('"') and len(k) == 38
    back = decode_readings(enc)
    assert back.exceptAll(coarse).count() == 0 and coarse.exceptAll(back).count() == 0


def test_encode_writes_null_fields(spark):
    df = spark.sql("SELECT TIMESTAMP'2024-08-19 13:05:00.25' AS timestamp, CAST(NULL AS INT) AS id, 'humidity' AS sensor, 20 AS value")
    v = encode_readings(df).first().value
    assert v == '{"timestamp":1724072700.250000,"id":null,"sensor":"humidity","value":20}'


def test_decode_keeps_instant_in_repeated_hour(spark):
    """2024-10-27 01:30 UTC is 03:30 local time in Kyiv, a wall time that occurs twice; no shift by an hour."""
    spark.conf.set("spark.sql.session.timeZone", "Europe/Kyiv")
    try:
        epoch = 1729992600  # 2024-10-27 01:30:00 UTC, second pass through 03:30 local
        df = spark.createDataFrame(
            [(f'{{"timestamp": {epoch}.75, "id": 1, "sensor": "humidity", "value": 50}}',),
             (f'{{"timestamp": {epoch - 3600}.75, "id": 1, "sensor": "humidity", "value": 50}}',)],
            "value string",
        )
        got = [r.s for r in decode_readings(df).select(F.unix_seconds("timestamp").alias("s")).collect()]
        assert got == [epoch, epoch - 3600]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
