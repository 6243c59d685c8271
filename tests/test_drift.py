"""Messages and rules whose shape drifts: causes, rescued cells, malformed lines."""

import os

import pytest

from sensorwatch.functions.decode import decode_readings
from sensorwatch.functions.quarantine import decode_checked, write_quarantined
from sensorwatch.operators.rule_join import match_rules
from sensorwatch.sources.rules import inferred_differences, read_rules, read_rules_rescued

MESSAGES = {
    '{"timestamp": 1724072749.987654, "id": 3, "sensor": "temperature", "value": 41}': [],
    '{"timestamp": "1724072749.5", "id": 3, "sensor": "humidity", "value": 25.5}': ["value number"],
    '{"timestamp": "abc", "id": 3, "sensor": "humidity", "value": 25}': ["timestamp text"],
    "not json": ["no JSON"],
    '{"id": 9}': ["timestamp absent", "sensor absent", "value absent"],
    '{"timestamp":1.5,"id":99999999999,"sensor":"temperature","value":3000000000}': ["id whole", "value whole"],
    '{"timestamp":1.5,"id":"7","sensor":"s","value":"41"}': ["id text", "value text"],
    '{"timestamp":null,"id":1,"sensor":null,"value":true}': ["timestamp absent", "sensor absent", "value other"],
    "[1, 2]": ["no object"],
    "12": ["no object"],
    "": ["no JSON"],
    '{"timestamp":1.5,"id":1,"sensor":"a","value":2,"more":{"x":[1]}}': [],
}


def test_causes_and_values(spark, tmp_path):
    rows = [(i, m) for i, m in enumerate([*MESSAGES, None])]
    df = spark.createDataFrame(rows, "n int, value string")
    got = {r.n: r for r in decode_checked(df).collect()}
    for (n, m), causes in zip(rows, [*MESSAGES.values(), ["no message"]], strict=True):
        assert got[n].causes == causes, m
        assert got[n].message == (m if causes else None)
    # JSON objects decode to the same fields either way, but for text in a number's place
    plain = decode_readings(df).collect()
    for n, m in rows:
        if m and m.startswith("{"):
            assert (got[n].timestamp, got[n].id, got[n].sensor, got[n].value) == tuple(plain[n])
    accepted, dead = write_quarantined(decode_checked(df), str(tmp_path / "out"))
    assert sorted(r.n for r in accepted.collect()) == [0, 11] and accepted.columns == ["n", "timestamp", "id", "sensor", "value"]
    assert dead.count() == len(rows) - 2
    assert sorted(os.listdir(tmp_path / "out"))[:1] != [] and "accepted=true" in os.listdir(tmp_path / "out")


HEADER = "id,humidity_min,humidity_max,temperature_min,temperature_max,code,message\n"


def test_rescued_cells_and_malformed_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER + "1,0,40,-999,-999,101,dry\n2,low,40,-999,-999,10x,wet\n3,0,40\n")
    (tmp_path / "b.csv").write_text(HEADER + "4,,40,-999,-999,104,blank\n5,0,40,-999,-999,105,hot,extra\n6, ,7.5,-999,-999,106,\n")
    rows = {r.id: r for r in read_rules_rescued(spark, str(tmp_path)).collect()}
    assert (rows[1].humidity_max, rows[1].code, rows[1].rescued, rows[1].malformed) == (40.0, 101, None, None)
    assert rows[2].rescued == {"humidity_min": "low", "code": "10x"} and rows[2].humidity_min is None and rows[2].humidity_max == 40.0
    assert rows[3].malformed == "3,0,40" and rows[5].malformed.startswith("5,0,40") and rows[3].rescued is None
    assert rows[4].humidity_min is None and rows[4].rescued is None and rows[6].humidity_max == 7.5 and rows[6].rescued is None
    # a rule with a rescued or missing bound does not fire, the others do
    window = "named_struct('start', TIMESTAMP'2024-01-01', 'end', TIMESTAMP'2024-01-02') AS window"
    averages = spark.range(1).selectExpr(window, "20D AS avg_temperature", "20D AS avg_humidity")
    assert sorted(r.id for r in match_rules(averages, read_rules_rescued(spark, str(tmp_path))).collect()) in ([1], [1, 5])


def test_types_by_inference(spark, tmp_path):
    assert inferred_differences(spark, _file(tmp_path, "a", "1,0,40,-999,-999,101,dry\n")) == {}
    assert inferred_differences(spark, _file(tmp_path, "b", "1,0,40.5,-999,-999,101.5,dry\n2,x,1,1,1,2,y\n")) == {
        "humidity_min": "string", "code": "double",
    }
    assert [r.id for r in read_rules(spark, _file(tmp_path, "c", "7,0,1,2,3,4,m\n")).collect()] == [7]


def test_other_headers_fail(spark, tmp_path):
    _file(tmp_path, "a", "1,0,40,-999,-999,101,dry\n")
    (tmp_path / "b.csv").write_text("id,code,message\n1,2,x\n")
    with pytest.raises(Exception):
        read_rules_rescued(spark, str(tmp_path)).collect()


def _file(tmp_path, name, lines):
    path = tmp_path / f"{name}.csv"
    path.write_text(HEADER + lines)
    return str(path)
