"""DuckDB SQL equal in result to each query of ``plans.queries``.

Run against the test tables registered as views (``events`` …). Durations,
codes, ranges, topics and rules are stated here once more, by hand, so that a
wrong constant of the package shows. Sliding windows are built the usual SQL way: floor the time to
the slide and list the ``window / slide`` window starts that contain it.
"""

from __future__ import annotations

import math

# (window, slide) in microseconds
MINUTE = (60_000_000, 30_000_000)
HOUR = (3_600_000_000, 1_800_000_000)
TEN_DAYS = (864_000_000_000, 432_000_000_000)
WATERMARK = 10_000_000
MEASURES = ("temperature", "humidity")
RULE_COLUMNS = ("id", "humidity_min", "humidity_max", "temperature_min", "temperature_max", "code", "message")


def _readings_cte(truncate: bool = True) -> str:
    t = "date_trunc('second', ts)" if truncate else "ts"
    return f"""
readings0 AS (
  SELECT {t} AS t,
         CAST(user_id AS INTEGER) AS id,
         CASE WHEN event_type IN ('click', 'view') THEN 'temperature'
              WHEN event_type IN ('purchase', 'signup') THEN 'humidity'
              ELSE 'other' END AS sensor,
         CAST(floor(value) AS BIGINT) AS v
  FROM events
),
readings AS (
  SELECT t, id, sensor,
         CAST(CASE sensor WHEN 'temperature' THEN 25 + v % 21
                          WHEN 'humidity' THEN 15 + v % 71
                          ELSE v END AS INTEGER) AS value
  FROM readings0
)"""


def _rules_cte() -> str:
    return f"""
rules({", ".join(RULE_COLUMNS)}) AS (
  VALUES
    (1, 0e0, 40e0, -999e0, -999e0, 101, 'It''s too dry'),
    (2, 60e0, 100e0, -999e0, -999e0, 102, 'It''s too wet'),
    (3, -999e0, -999e0, -300e0, 30e0, 103, 'It''s too cold'),
    (4, -999e0, -999e0, 40e0, 300e0, 104, 'It''s too hot')
)"""


def _windows_cte(size: tuple[int, int], by_sensor: bool) -> str:
    length, slide = size
    n = math.ceil(length / slide)
    key = ", id AS sensor_id" if by_sensor else ""
    group = ", id" if by_sensor else ""
    avgs = ",\n         ".join(
        f"avg(CASE WHEN sensor = '{m}' THEN value END) AS avg_{m}" for m in MEASURES
    )
    return f"""
expanded AS (
  SELECT (epoch_us(t) // {slide}) * {slide} - g.k * {slide} AS ws, epoch_us(t) AS tu, id, sensor, value
  FROM readings CROSS JOIN range({n}) AS g(k)
  WHERE t IS NOT NULL
),
averages AS (
  SELECT make_timestamp(ws) AS window_start, make_timestamp(ws + {length}) AS window_end{key},
         {avgs}
  FROM expanded
  WHERE ws + {length} > tu
  GROUP BY ws{group}
)"""


def _predicate() -> str:
    parts = []
    for m in MEASURES:
        parts.append(f"({m}_min = -999 OR avg_{m} >= {m}_min)")
        parts.append(f"({m}_max = -999 OR avg_{m} <= {m}_max)")
    return " AND ".join(parts)


def _alerts_cte(by_sensor: bool) -> str:
    key = "a.sensor_id, " if by_sensor else ""
    rule_cols = ", ".join(f"r.{c}" for c in RULE_COLUMNS)
    avgs = ", ".join(f"a.avg_{m}" for m in MEASURES)
    return f"""
alerts AS (
  SELECT {rule_cols}, a.window_start, a.window_end, {key}{avgs}
  FROM rules r JOIN averages a ON {_predicate()}
)"""


def window_avg_sql(size: tuple[int, int] = MINUTE, by_sensor: bool = False) -> str:
    return f"WITH {_readings_cte()},{_windows_cte(size, by_sensor)}\nSELECT * FROM averages"


def alerts_sql(size: tuple[int, int] = MINUTE, by_sensor: bool = False, where: str = "") -> str:
    ctes = f"{_readings_cte()},{_windows_cte(size, by_sensor)},{_rules_cte()},{_alerts_cte(by_sensor)}"
    return f"WITH {ctes}\nSELECT * FROM alerts {where}"


def _topic_case() -> str:
    return "CASE WHEN code IN (103, 104) THEN 'temperature_alerts' ELSE 'humidity_alerts' END"


def alert_routing_sql() -> str:
    return alerts_sql().replace(
        "SELECT * FROM alerts", f"SELECT window_start, window_end, id, code, {_topic_case()} AS topic FROM alerts"
    )


def alert_messages_sql(where: str = "") -> str:
    def num(c: str) -> str:
        return f"coalesce(CAST({c} AS VARCHAR), 'null')"

    def iso(c: str) -> str:
        return f"strftime({c}, '%Y-%m-%dT%H:%M:%S')"

    value = (
        """'{"window":{"start":"' || """ + iso("window_start") + """ || '","end":"' || """ + iso("window_end")
        + """ || '"},"t_avg":' || """ + num("avg_temperature") + """ || ',"h_avg":' || """ + num("avg_humidity")
        + """ || ',"code":' || """ + num("code") + """ || ',"message":"' || message || '","timestamp":"""
        + '"2025-03-04T05:06:07.089012"' + """}'"""
    )
    return alerts_sql(where=where).replace("SELECT * FROM alerts", f"SELECT {_topic_case()} AS topic, {value} AS value FROM alerts")


def decode_readings_sql() -> str:
    return f'WITH {_readings_cte()}\nSELECT t AS "timestamp", id, sensor, value FROM readings'


def decode_event_time_sql() -> str:
    return "SELECT event_id, date_trunc('second', ts) AS event_time FROM events"


def encode_readings_sql() -> str:
    def num(c: str) -> str:
        return f"coalesce(CAST({c} AS VARCHAR), 'null')"

    seconds = "CAST(epoch_us(t) // 1000000 AS VARCHAR) || '.' || lpad(CAST(epoch_us(t) % 1000000 AS VARCHAR), 6, '0')"
    value = (
        """'{"timestamp":' || """ + seconds + """ || ',"id":' || """ + num("id")
        + """ || ',"sensor":"' || sensor || '","value":' || """ + num("value") + """ || '}'"""
    )
    return f"WITH {_readings_cte(truncate=False)}\nSELECT 'building_sensors' AS topic, {value} AS value, 38 AS key_length, true AS key_quoted FROM readings"


# append mode emits a window once the watermark (max event time - delay) reaches its end
_CLOSED = f"WHERE epoch_us(window_end) <= (SELECT max(epoch_us(t)) FROM readings) - {WATERMARK}"


def stream_alerts_append_sql(by_sensor: bool = False) -> str:
    return alerts_sql(by_sensor=by_sensor, where=_CLOSED)


def _late_ctes() -> str:
    # per delivery period: the watermark in force is the newest event time of
    # all earlier periods minus the delay; a (reading, window) pair is late when
    # the window ends at or before it
    length, slide = MINUTE
    n = math.ceil(length / slide)
    arrival = (
        f"floor(CAST(epoch_us(ts) + CAST(floor(coalesce(value, 0)) AS BIGINT) * 60000000 AS DOUBLE)"
        f" / CAST(432000000000 AS DOUBLE))"
    )
    readings = _readings_cte().replace("FROM events\n", f", {arrival} AS period\n  FROM events\n").replace(
        "SELECT t, id, sensor,", "SELECT t, id, sensor, period,"
    )
    return f"""WITH {readings},
periods AS (SELECT period, max(epoch_us(t)) AS newest FROM readings GROUP BY period),
marks AS (
  SELECT period, max(newest) OVER (ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {WATERMARK} AS wm
  FROM periods
),
expanded AS (
  SELECT (epoch_us(t) // {slide}) * {slide} - g.k * {slide} AS ws, epoch_us(t) AS tu, sensor, value, m.wm, period
  FROM readings JOIN marks m USING (period) CROSS JOIN range({n}) AS g(k)
  WHERE t IS NOT NULL
)"""


def stream_late_data_sql() -> str:
    avgs = ",\n       ".join(f"avg(CASE WHEN sensor = '{m}' THEN value END) AS avg_{m}" for m in MEASURES)
    length = MINUTE[0]
    return f"""{_late_ctes()}
SELECT make_timestamp(ws) AS window_start, make_timestamp(ws + {length}) AS window_end,
       {avgs}
FROM expanded
WHERE ws + {length} > tu AND (wm IS NULL OR ws + {length} > wm)
GROUP BY ws"""


def stream_late_audit_sql() -> str:
    # a late window counts once a run; before the first run the watermark is the epoch
    length = MINUTE[0]
    return f"""{_late_ctes()},
late AS (
  SELECT period, count(DISTINCT ws) AS n FROM expanded
  WHERE ws + {length} > tu AND ws + {length} <= wm GROUP BY period
),
sizes AS (SELECT period, count(*) AS n FROM readings WHERE t IS NOT NULL GROUP BY period)
SELECT CAST(row_number() OVER (ORDER BY period) - 1 AS INTEGER) AS run, CAST(period AS BIGINT) AS period,
       make_timestamp(coalesce(wm, 0)) AS watermark, coalesce(late.n, 0) AS windows_dropped, sizes.n AS readings
FROM marks JOIN sizes USING (period) LEFT JOIN late USING (period)"""


def _emitted_ctes() -> str:
    # one run per 5 days of event time, in order: a run emits the windows of the sensors it has
    # readings for, with the sums over this and all earlier runs
    length, slide = TEN_DAYS
    sums = ", ".join(f"sum(CASE WHEN sensor = '{m}' THEN value END) AS s_{m}, count(CASE WHEN sensor = '{m}' THEN value END) AS n_{m}" for m in MEASURES)
    avgs = ", ".join(f"CASE WHEN sum(n_{m}) OVER w > 0 THEN CAST(sum(s_{m}) OVER w AS DOUBLE) / sum(n_{m}) OVER w END AS avg_{m}" for m in MEASURES)
    return f"""WITH {_readings_cte()},
runs AS (SELECT t, epoch_us(t) // 432000000000 AS period, id, sensor, value FROM readings WHERE t IS NOT NULL),
numbered AS (SELECT *, CAST(dense_rank() OVER (ORDER BY period) - 1 AS INTEGER) AS emission FROM runs),
cells AS (
  SELECT (epoch_us(t) // {slide}) * {slide} - g.k * {slide} AS ws, id, emission, {sums}
  FROM numbered CROSS JOIN range(2) AS g(k)
  GROUP BY ALL
),
emitted AS (
  SELECT make_timestamp(ws) AS window_start, make_timestamp(ws + {length}) AS window_end, id AS sensor_id, emission, {avgs}
  FROM cells WINDOW w AS (PARTITION BY ws, id ORDER BY emission ROWS UNBOUNDED PRECEDING)
),{_rules_cte()}"""


def stream_alerts_emitted_sql() -> str:
    return f"""{_emitted_ctes()}
SELECT window_start, window_end, sensor_id, r.id, r.code, avg_temperature, avg_humidity, emission
FROM rules r JOIN emitted ON {_predicate()}"""


def stream_alert_transitions_sql() -> str:
    # a rule's verdict per emission of a window against the one before it
    return f"""{_emitted_ctes()},
verdicts AS (
  SELECT emitted.*, r.id, r.code, coalesce({_predicate()}, false) AS fires FROM emitted CROSS JOIN rules r
),
changes AS (
  SELECT *, coalesce(lag(fires) OVER (PARTITION BY window_start, sensor_id, id ORDER BY emission), false) AS fired FROM verdicts
)
SELECT window_start, window_end, sensor_id, id, code, CASE WHEN fires THEN 'raised' ELSE 'cleared' END AS change,
       avg_temperature, avg_humidity, emission
FROM changes WHERE fires <> fired"""


def stream_state_rows_sql() -> str:
    length, slide = TEN_DAYS
    sums = ", ".join(
        f"CAST(sum(CASE WHEN sensor = '{m}' THEN value END) AS BIGINT) AS sum_{m}, count(CASE WHEN sensor = '{m}' THEN value END) AS count_{m}"
        for m in MEASURES
    )
    return f"""WITH {_readings_cte()},
expanded AS (
  SELECT (epoch_us(t) // {slide}) * {slide} - g.k * {slide} AS ws, id, sensor, value
  FROM readings CROSS JOIN range(2) AS g(k) WHERE t IS NOT NULL
)
SELECT make_timestamp(ws) AS window_start, make_timestamp(ws + {length}) AS window_end, id AS sensor_id, {sums}
FROM expanded
WHERE ws + {length} > (SELECT max(epoch_us(t)) FROM readings) - {WATERMARK}
GROUP BY ws, id"""


def supplier_rule_hits_sql() -> str:
    return f"""WITH {_readings_cte()},{_windows_cte(MINUTE, False)},
rules AS (
  SELECT CAST(s_suppkey AS INTEGER) AS id, 100 + s_nationkey AS code,
         CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE 15 + s_suppkey * 13 % 71 END AS h_lo,
         CASE WHEN s_suppkey % 3 = 0 THEN NULL WHEN s_suppkey % 10 = 7 THEN 1000000 ELSE 18.5 + s_suppkey * 13 % 71 END AS h_hi,
         CASE WHEN s_suppkey % 3 = 1 OR s_suppkey % 50 = 0 THEN NULL ELSE 25 + s_suppkey * 7 % 21 END AS t_lo,
         CASE WHEN s_suppkey % 3 = 1 OR s_suppkey % 50 = 0 THEN NULL ELSE 26.5 + s_suppkey * 7 % 21 END AS t_hi
  FROM supplier
)
SELECT id, code, count(*) AS n_windows, min(window_start) AS first_start, max(window_start) AS last_start
FROM rules JOIN averages
  ON (h_lo IS NULL OR avg_humidity >= h_lo) AND (h_hi IS NULL OR avg_humidity <= h_hi)
 AND (t_lo IS NULL OR avg_temperature >= t_lo) AND (t_hi IS NULL OR avg_temperature <= t_hi)
GROUP BY id, code"""


def part_rule_hits_sql() -> str:
    return f"""WITH {_readings_cte()},{_windows_cte(HOUR, False)},
rules AS (
  SELECT CAST(p_partkey AS INTEGER) AS id, 100 + p_size AS code, p_name AS message,
         15 + (p_partkey * 37 % 7000) / 100e0 AS h_lo, 15 + (p_partkey * 37 % 7000) / 100e0 + 2 + p_size / 10e0 AS h_hi,
         25 + (p_partkey * 53 % 2000) / 100e0 AS t_lo, 25 + (p_partkey * 53 % 2000) / 100e0 + 1 + p_size / 20e0 AS t_hi
  FROM part
)
SELECT id, code, message, count(*) AS n_windows, min(window_start) AS first_start,
       max(avg_humidity) AS max_humidity, max(avg_temperature) AS max_temperature
FROM rules JOIN averages ON avg_humidity BETWEEN h_lo AND h_hi AND avg_temperature BETWEEN t_lo AND t_hi
GROUP BY id, code, message"""


def supplier_rules_csv_sql() -> str:
    k = "s_suppkey"
    low = f"CASE WHEN {k} % 3 = 0 THEN -999 ELSE 15 + {k} * 13 % 71 END"
    text = f"CASE WHEN {k} % 17 = 3 THEN 'n/a' ELSE CAST(CAST({low} AS DOUBLE) AS VARCHAR) END"
    return f"""SELECT CAST({k} AS INTEGER) AS id,
       CASE WHEN {k} % 17 = 3 THEN NULL ELSE CAST({low} AS DOUBLE) END AS humidity_min,
       CAST(CASE WHEN {k} % 3 = 0 THEN -999 WHEN {k} % 10 = 7 THEN 1000000 ELSE 18.5 + {k} * 13 % 71 END AS DOUBLE) AS humidity_max,
       CAST(CASE WHEN {k} % 3 = 1 OR {k} % 50 = 0 THEN -999 ELSE 25 + {k} * 7 % 21 END AS DOUBLE) AS temperature_min,
       CAST(CASE WHEN {k} % 3 = 1 OR {k} % 50 = 0 THEN -999 ELSE 26.5 + {k} * 7 % 21 END AS DOUBLE) AS temperature_max,
       CASE WHEN {k} % 23 = 5 THEN NULL ELSE 100 + s_nationkey END AS code,
       s_name AS message,
       concat_ws(', ', CASE WHEN {k} % 17 = 3 THEN 'humidity_min=n/a' END,
                       CASE WHEN {k} % 23 = 5 THEN 'code=' || CAST(100 + s_nationkey AS VARCHAR) || '.5' END) AS rescued,
       {text} AS inferred_humidity_min,
       'code double, humidity_min string' AS inferred_types
FROM supplier"""


def decode_quarantine_sql() -> str:
    return f"""WITH {_readings_cte(truncate=False).replace("CAST(user_id AS INTEGER) AS id", "CAST(event_id AS INTEGER) AS id")},
kinds AS (
  SELECT *, CASE WHEN id % 13 = 5 THEN 'cut' WHEN id % 11 = 3 THEN 'fraction' WHEN id % 7 = 1 THEN 'quoted'
                 WHEN id % 17 = 2 THEN 'time' WHEN id % 19 = 4 THEN 'other' WHEN id % 101 = 7 THEN 'list' ELSE 'whole' END AS kind
  FROM readings WHERE id IS NOT NULL
),
causes AS (
  SELECT id, CASE WHEN kind IN ('whole', 'time') THEN value END AS value,
         unnest(CASE kind WHEN 'cut' THEN ['no JSON'] WHEN 'list' THEN ['no object'] WHEN 'fraction' THEN ['value number']
                WHEN 'quoted' THEN ['value text'] WHEN 'time' THEN ['timestamp text']
                WHEN 'other' THEN ['timestamp absent', 'id absent', 'sensor absent', 'value absent']
                ELSE ['accepted'] END) AS cause
  FROM kinds
)
SELECT cause, count(*) AS messages, CAST(sum(id) AS BIGINT) AS event_ids, CAST(sum(value) AS BIGINT) AS "values", max(CAST(id AS BIGINT)) AS newest
FROM causes GROUP BY cause"""


ORACLE: dict[str, str] = {
    "decode_readings": decode_readings_sql(),
    "decode_event_time": decode_event_time_sql(),
    "encode_readings": encode_readings_sql(),
    "window_avg": window_avg_sql(MINUTE),
    "window_avg_hourly": window_avg_sql(HOUR),
    "window_avg_by_sensor": window_avg_sql(MINUTE, by_sensor=True),
    "alerts": alerts_sql(MINUTE),
    "alerts_hourly": alerts_sql(HOUR),
    "alerts_by_sensor": alerts_sql(MINUTE, by_sensor=True),
    "alert_routing": alert_routing_sql(),
    "alert_messages": alert_messages_sql(),
    "stream_window_avg_update": window_avg_sql(MINUTE),
    "stream_alerts_update": alerts_sql(MINUTE),
    "stream_alerts_append": stream_alerts_append_sql(),
    "stream_alerts_by_sensor": stream_alerts_append_sql(by_sensor=True),
    "stream_late_data": stream_late_data_sql(),
    "stream_alerts_emitted": stream_alerts_emitted_sql(),
    "stream_late_audit": stream_late_audit_sql(),
    "stream_alert_transitions": stream_alert_transitions_sql(),
    "stream_state_rows": stream_state_rows_sql(),
    "stream_publish_once": alert_messages_sql(_CLOSED),
    "supplier_rule_hits": supplier_rule_hits_sql(),
    "supplier_rules_csv": supplier_rules_csv_sql(),
    "decode_quarantine": decode_quarantine_sql(),
    "part_rule_hits": part_rule_hits_sql(),
}
