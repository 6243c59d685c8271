import random

import pytest
from pyspark.sql import functions as F

from sensorwatch.config import AlertSettings
from sensorwatch.operators.rule_join import _list_rules, _salted, hot_nodes, list_windows, match_rules, rule_axes, rule_candidates
from sensorwatch.sources.rules import RULE_COLUMNS, RULE_SCHEMA, read_rules

AVG_SCHEMA = "window struct<start: timestamp, end: timestamp>, avg_temperature double, avg_humidity double"


def _averages(spark, pairs):
    rows = [((None, None), t, h) for t, h in pairs]
    df = spark.createDataFrame(rows, AVG_SCHEMA)
    return df.withColumn("window", F.struct(F.current_timestamp().alias("start"), F.current_timestamp().alias("end")))


def _rules(spark, rows):
    rows = [(r[0], *[None if b is None else float(b) for b in r[1:5]], *r[5:]) for r in rows]
    return spark.createDataFrame(rows, RULE_SCHEMA)


def test_read_rules_explicit_and_inferred(spark):
    a = read_rules(spark)
    b = read_rules(spark, infer_schema=True)
    assert a.schema == RULE_SCHEMA
    assert [f.dataType.simpleString() for f in b.schema.fields] == ["int"] * 6 + ["string"]
    assert sorted(a.collect()) == sorted(b.collect())
    assert [tuple(r) for r in a.orderBy("id").collect()] == [
        (1, 0, 40, -999, -999, 101, "It's too dry"),
        (2, 60, 100, -999, -999, 102, "It's too wet"),
        (3, -999, -999, -300, 30, 103, "It's too cold"),
        (4, -999, -999, 40, 300, 104, "It's too hot"),
    ]


def test_fractional_bound_fires(spark, tmp_path):
    p = tmp_path / "rules.csv"
    p.write_text("id,humidity_min,humidity_max,temperature_min,temperature_max,code,message\n1,0,40.5,-999,-999,101,dry\n")
    r = read_rules(spark, str(p)).first()
    assert r.humidity_max == 40.5 and r.humidity_min == 0
    hits = match_rules(_averages(spark, [(20.0, 40.25), (20.0, 40.75)]), read_rules(spark, str(p))).collect()
    assert [h.avg_humidity for h in hits] == [40.25]


def test_columns_are_found_by_name(spark, tmp_path):
    p = tmp_path / "rules.csv"
    p.write_text("message,code,temperature_max,temperature_min,humidity_max,humidity_min,id,note\ncold,103,30,-300,-999,,3,x\n")
    assert tuple(read_rules(spark, str(p)).first()) == (3, None, -999.0, -300.0, 30.0, 103, "cold")


def test_missing_column_and_bad_cell_fail(spark, tmp_path):
    p = tmp_path / "rules.csv"
    p.write_text("id,humidity_min,humidity_max,temperature_min,code,message\n1,0,40,-999,101,dry\n")
    with pytest.raises(ValueError, match="temperature_max"):
        read_rules(spark, str(p))
    p.write_text("id,humidity_min,humidity_max,temperature_min,temperature_max,code,message\n1,low,40,-999,-999,101,dry\n")
    with pytest.raises(Exception, match="humidity_min is not a number"):
        read_rules(spark, str(p)).collect()


def test_inclusive_bounds_and_nulls(spark):
    rules = read_rules(spark)
    avgs = _averages(spark, [(44.0, 20.0), (30.0, 40.0), (40.0, 60.0), (None, 50.0), (36.0, None), (None, None)])
    got = sorted(
        (r.avg_temperature, r.avg_humidity, r.code)
        for r in match_rules(avgs, rules).collect()
    )
    key = lambda x: tuple((v is None, v) for v in x)
    assert sorted(got, key=key) == sorted(
        [
            (44.0, 20.0, 101), (44.0, 20.0, 104),
            (30.0, 40.0, 101), (30.0, 40.0, 103),  # upper bounds inclusive
            (40.0, 60.0, 102), (40.0, 60.0, 104),  # lower bounds inclusive
        ],
        key=key,
    )


def test_rule_edge_cases(spark):
    u = -999
    rules = _rules(
        spark,
        [
            (1, u, u, u, u, 900, "always"),
            (2, None, 40, u, u, 901, "blank bound"),
            (3, 0, 40, u, u, None, "no code"),
        ],
    )
    avgs = _averages(spark, [(None, None), (25.0, 20.0)])
    got = sorted((r.id, r.avg_temperature) for r in match_rules(avgs, rules).collect() if r.avg_temperature)
    nulls = [r.id for r in match_rules(avgs, rules).collect() if r.avg_temperature is None]
    assert nulls == [1]  # all bounds unused fires even on NULL averages
    assert got == [(1, 25.0), (3, 25.0)]  # the blank bound never fires


def _brute(avgs, rules, u=-999):
    def ok(v, lo, hi):
        if lo is None or hi is None:
            return False
        a = lo == u or (v is not None and v >= lo)
        b = hi == u or (v is not None and v <= hi)
        return a and b

    out = []
    for i, (t, h) in enumerate(avgs):
        for r in rules:
            if ok(h, r[1], r[2]) and ok(t, r[3], r[4]):
                out.append((r[0], i))
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(spark, seed):
    rnd = random.Random(seed)
    u = -999

    def bound():
        x = rnd.random()
        if x < 0.25:
            return u
        if x < 0.3:
            return None
        return rnd.randint(-20, 120)

    rules = [(i, bound(), bound(), bound(), bound(), 100 + i % 7, f"r{i}") for i in range(300)]
    avgs = [
        (None if rnd.random() < 0.1 else rnd.uniform(-30, 130), None if rnd.random() < 0.1 else rnd.choice([rnd.uniform(0, 100), 40.0, 60.0]))
        for _ in range(400)
    ]
    rows = [((None, None), t, h, i) for i, (t, h) in enumerate(avgs)]
    adf = spark.createDataFrame(rows, AVG_SCHEMA + ", n int")
    rdf = _rules(spark, rules)
    want = _brute(avgs, rules)
    for bins in (1, 8, 32):
        got = sorted((r.id, r.n) for r in match_rules(adf, rdf, AlertSettings(rule_bins=bins)).collect())
        assert got == want, bins


def _grid(spark, side=60):
    # averages over the whole of both ranges, some of one sensor only
    return spark.range(side * side).selectExpr(
        "named_struct('start', timestamp_seconds(id * 60), 'end', timestamp_seconds(id * 60 + 60)) AS window",
        f"IF(id % 17 = 0, NULL, 25 + id % {side} / 3D) AS avg_temperature",
        f"IF(id % 13 = 0, NULL, 15 + id DIV {side} * 7 / 6D) AS avg_humidity",
    )


def _pairs(spark, rows):
    avgs, rules = _grid(spark), _rules(spark, rows)
    alerts = match_rules(avgs, rules).count()
    return rule_candidates(avgs, rules).count(), alerts, avgs.count() * len(rows)


U = -999
NARROW = [(i, 15 + i * 7 % 65, 16.5 + i * 7 % 65, 25 + i * 3 % 19, 26 + i * 3 % 19, 100, "both") for i in range(500)]


def test_pairs_of_rules_on_one_axis(spark):
    rows = [(i, U, U, 25 + i * 7 % 190 / 10, 26.5 + i * 7 % 190 / 10, 100, "warm") for i in range(500)]
    pairs, alerts, every = _pairs(spark, rows)
    assert 0 < alerts <= pairs <= 2 * alerts and pairs < every / 4


def test_pairs_with_a_far_off_rule(spark):
    narrow, alerts, every = _pairs(spark, NARROW)
    wide, _, _ = _pairs(spark, NARROW + [(999, -1_000_000, 1_000_000, -1_000_000, 1_000_000, 101, "wide")])
    assert 0 < alerts and narrow < every / 8
    assert wide <= 1.1 * narrow + 3_600  # the far-off rule meets each window once, the others' cells stay narrow


def test_pairs_with_unused_rules(spark):
    free = [(1000 + i, U, U, U, U, 102, "always") for i in range(20)]
    narrow, _, _ = _pairs(spark, NARROW)
    both, alerts, _ = _pairs(spark, NARROW + free)
    assert both == narrow + 20 * 3_600 and alerts > 20 * 3_600


def test_pairs_of_rules_on_both_axes(spark):
    pairs, alerts, every = _pairs(spark, NARROW)
    assert 0 < alerts <= pairs <= 2 * alerts and pairs < every / 50
    # more bounds than cuts: a cell at a range's end is shared
    many = [(i, 15 + i * 37 % 6400 / 100, 17 + i * 37 % 6400 / 100, 25 + i * 53 % 1800 / 100, 26.5 + i * 53 % 1800 / 100, 100, "x") for i in range(2_000)]
    pairs, alerts, every = _pairs(spark, many)
    assert 0 < alerts <= pairs <= 2 * alerts and pairs < every / 50


@pytest.mark.parametrize("fanout,bins", [(2, 16), (3, 128), (16, 400)])
def test_trees_of_any_depth(spark, fanout, bins):
    settings = AlertSettings(rule_bins=bins, rule_fanout=fanout)
    rnd = random.Random(fanout)
    rules = [(i, rnd.choice([U, rnd.uniform(10, 90)]), rnd.choice([U, rnd.uniform(10, 90)]), rnd.uniform(20, 45), rnd.choice([U, 50, 33.0]), 1, "r") for i in range(150)]
    rules += [(200, -1e9, 1e9, -1e9, 1e9, 2, "wide"), (201, 40.0, 40.0, 30.0, 30.0, 3, "point"), (202, 50, 10, U, U, 4, "none")]
    avgs = [(rnd.choice([None, 30.0, rnd.uniform(20, 50)]), rnd.choice([None, 40.0, rnd.uniform(0, 100)])) for _ in range(300)]
    adf = spark.createDataFrame([((None, None), t, h, i) for i, (t, h) in enumerate(avgs)], AVG_SCHEMA + ", n int")
    got = match_rules(adf, _rules(spark, rules), settings)
    assert sorted((r.id, r.n) for r in got.select("id", "n").collect()) == _brute(avgs, rules)


def test_a_rule_is_listed_at_few_nodes(spark):
    rules = _rules(spark, NARROW + [(999, -500, 500, -500, 500, 1, "wide")])
    axes = rule_axes(rules)
    assert [axes.levels(i) for i in range(2)] == [2, 2]
    listed = {r.id: r["count"] for r in _list_rules(rules, axes, AlertSettings()).groupBy("id").count().collect()}
    most = 2 * (axes.fanout - 1) * 2
    assert max(listed.values()) <= most**2 and sum(listed.values()) < 120 * len(listed) and len(listed) == 501
    assert len(axes.combinations()) == 4  # levels of one axis times those of the other


def test_hot_nodes_are_dealt_over_salts(spark):
    avgs = _grid(spark).withColumn("avg_humidity", F.expr("IF(unix_seconds(window.start) % 180 = 0, 50.0, avg_humidity)"))
    rules = _rules(spark, [(i, 49.5 - i % 40, 50.5 + i % 40, U, U, 100, "h") for i in range(400)])
    axes = rule_axes(rules)
    hot = hot_nodes(avgs, axes)
    assert hot
    plain, dealt = match_rules(avgs, rules, axes=axes), match_rules(avgs, rules, axes=axes, hot=hot)
    assert plain.count() == dealt.count() > 0 and plain.exceptAll(dealt).count() == 0

    def largest(found):
        listed = _salted(list_windows(avgs, axes), found, False)
        keys = [c for c in listed.columns if c.startswith("_rj_")]
        sizes = sorted(r["count"] for r in listed.groupBy(F.pmod(F.hash(*keys), F.lit(32))).count().collect())
        return sizes[-1] / sizes[len(sizes) // 2]

    assert largest(hot) < 5 < largest([])


def test_one_plan_for_every_size(spark):
    def joins(n):
        plan = match_rules(_grid(spark), _rules(spark, NARROW[:1] * n))._jdf.queryExecution().executedPlan().toString()
        return [w for w in ("BroadcastNestedLoopJoin", "CartesianProduct", "BroadcastHashJoin") if w in plan]

    assert joins(1_024) == joins(1_025) == joins(4) == ["BroadcastHashJoin"]


def test_shuffled_form_is_exact(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        avgs, rules = _grid(spark), _rules(spark, NARROW)
        got = match_rules(avgs, rules)
        assert "BroadcastHashJoin" not in got._jdf.queryExecution().executedPlan().toString()
        shuffled = got.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert shuffled == match_rules(avgs, rules).count()


def test_no_rules_and_other_columns(spark):
    avgs = _averages(spark, [(44.0, 20.0)])
    assert match_rules(avgs, _rules(spark, [])).count() == 0
    out = match_rules(avgs, read_rules(spark).withColumn("_owner", F.lit("x"))).collect()
    assert [r["_owner"] for r in out] == ["x", "x"]
    with pytest.raises(ValueError, match="_rj_x"):
        match_rules(avgs, read_rules(spark).withColumn("_rj_x", F.lit(1)))


def test_output_columns(spark):
    avgs = _averages(spark, [(44.0, 20.0)])
    out = match_rules(avgs, read_rules(spark))
    assert out.columns == list(RULE_COLUMNS) + ["window", "avg_temperature", "avg_humidity"]


def test_rules_that_are_many_only_as_listed_are_not_broadcast(spark, tmp_path):
    bounds = "15 + id * 37 % 7000 / 100D AS humidity_min, 20 + id * 37 % 7000 / 100D AS humidity_max"
    bounds += ", 25 + id * 53 % 2000 / 100D AS temperature_min, 28 + id * 53 % 2000 / 100D AS temperature_max"
    path = str(tmp_path / "rules")
    spark.range(4_000).selectExpr("CAST(id AS INT) AS id", *bounds.split(", "), "100 AS code", "'r' AS message").coalesce(1).write.parquet(path)
    rules = spark.read.parquet(path)
    rows = [tuple(r) for r in rules.collect()]
    values = [(25.0 + i % 20, 15.0 + i * 7 % 71) for i in range(30)] + [(None, 40.0), (30.0, None)]
    _averages(spark, values).write.parquet(str(tmp_path / "averages"))
    avgs = spark.read.schema(AVG_SCHEMA).parquet(str(tmp_path / "averages"))

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    def hits(df):
        return sorted((r.id, r.avg_temperature, r.avg_humidity) for r in df.collect())

    want = sorted((i, *values[w]) for i, w in _brute(values, rows))
    axes = rule_axes(rules)
    assert _list_rules(rules, axes, AlertSettings()).count() * 50 < axes.listed  # bytes a listed row
    few = match_rules(avgs, rules)  # few windows: these are broadcast
    assert plan(few).count("BroadcastExchange") == 1 and "BuildLeft" in plan(few)
    assert hits(few) == want
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "2000")
    try:
        many = match_rules(avgs, rules)  # neither side is small
        assert "BroadcastExchange" not in plan(many) and "SortMergeJoin" in plan(many)
        assert hits(many) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_high_threshold_does_not_broadcast_listed_rules(spark, tmp_path):
    bounds = ["15 + id * 37 % 7000 / 100D AS humidity_min", "20 + id * 37 % 7000 / 100D AS humidity_max"]
    bounds += ["25 + id * 53 % 2000 / 100D AS temperature_min", "28 + id * 53 % 2000 / 100D AS temperature_max"]
    path = str(tmp_path / "rules")
    spark.range(4_000).selectExpr("CAST(id AS INT) AS id", *bounds, "100 AS code", "'r' AS message").coalesce(1).write.parquet(path)
    rules = spark.read.parquet(path)
    values = [(25.0 + i % 20, 15.0 + i * 7 % 71) for i in range(30)] + [(None, 40.0), (30.0, None)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1g")
    try:
        assert rule_axes(rules).listed > 10 << 20
        fired = match_rules(_averages(spark, values), rules)
        plan = fired._jdf.queryExecution().executedPlan().toString()
        assert "BuildRight" not in plan and "BuildLeft" in plan  # the few windows, not the rules
        got = sorted((r.id, r.avg_temperature, r.avg_humidity) for r in fired.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == sorted((i, *values[w]) for i, w in _brute(values, [tuple(r) for r in rules.collect()]))
