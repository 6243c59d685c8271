"""Match window averages against alert rules (a range join on every measure axis).

A rule fires for a window when every used bound holds (section 1.4.6-7 of the
survey). One form for rules tables of any size, in batch and in streams: an
equi-join on nodes of a tree over each axis, with the exact predicate as
residual.

* Each axis is cut at the rules' used bounds, or at quantiles of them where there
  are more than ``rule_bins``. A cut value is a cell of its own, the open range
  between two cuts another: a bound that is a cut costs no false candidates.
* The cells are the leaves of a tree with ``rule_fanout`` children a node. A rule
  is listed, on every axis at once, at the fewest nodes that make up its range
  (at most ``2 * (rule_fanout - 1)`` a level, and the root where the axis is not
  bounded); a window is listed once for each combination of levels that some rule
  can use, and not below the root where its average is NULL (a used bound fails on
  NULL). A window and a rule meet at most once.
* A node that holds a large share of the windows can be dealt over salts
  (``hot``): its windows go to one salt each, its rules to all of them.

Spark's statistics count neither the listing nor, in a stream's batch without
input, the windows that come from its state. So the join's form is given by a
hint (:func:`_hinted`), from sizes that are counted: what is broadcast stays
below ``spark.sql.autoBroadcastJoinThreshold`` as listed, and below ``BROADCAST``
however high that is set, all else is shuffled.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT, AlertSettings
from ..functions.predicates import rule_predicate
from ..sources.rules import RULE_COLUMNS

#: Salts over which a hot node's windows are dealt, and the share of all listed windows that makes a node hot.
SALTS, HOT_SHARE = 16, 1 / 50
#: Comparisons written out in one expression; more separators are looked up in blocks of this many.
_TREE = 16
_OWN = "_rj_"
#: Bytes that are broadcast at the most: the driver holds such a table several times over, whatever threshold a session sets.
BROADCAST = 10 << 20
#: Size of listed rules that need not be counted.
_TOO_LARGE = 1 << 62


@dataclass(frozen=True)
class Axes:
    """Where each axis is cut, how many levels its tree has, and on which sets of axes rules are bounded.

    ``separators[i]`` ascends; a value's cell is the number of separators below
    it. ``uses`` holds bit masks of bounded axes; None stands for all.
    ``listed`` is the size in bytes of the listed rules (None: not counted yet).
    """

    separators: tuple[tuple[float, ...], ...]
    fanout: int
    uses: frozenset[int] | None
    listed: int | None = None

    def fan(self, i: int) -> int:
        """Children of a node of an axis: of few cells the root is the only parent."""
        cells = len(self.separators[i]) + 1
        return cells if 1 < cells <= _TREE else self.fanout

    def levels(self, i: int) -> int:
        """Levels below the root: the leaves are level 0."""
        n, out = len(self.separators[i]) + 1, 0
        while n > 1:
            n, out = -(-n // self.fan(i)), out + 1
        return max(out, 1)

    def combinations(self) -> list[tuple[int, ...]]:
        """Levels per axis at which a window is listed; the root only where no rule of a set is bounded."""
        axes = range(len(self.separators))
        every = range(1 << len(self.separators)) if self.uses is None else sorted(self.uses)
        return [c for use in every for c in product(*[range(self.levels(i)) if use >> i & 1 else [self.levels(i)] for i in axes])]


def match_rules(
    averages: DataFrame, rules: DataFrame, settings: AlertSettings = DEFAULT, axes: Axes | None = None, hot=()
) -> DataFrame:
    """Window averages x rules -> one row per (rule, window) where the rule fires.

    Columns: the rule columns (``id, humidity_min, …, code, message`` and any
    others), then the columns of ``averages`` (``window``, optional
    ``sensor_id``, ``avg_*``). ``averages`` may be a stream (stream-static
    join): the cuts are those of the rules at its start, and rules that change
    later still match exactly, as cells keep the order of the values. ``axes``
    (from :func:`rule_axes`) saves finding the cuts again for the same rules,
    ``hot`` (from :func:`hot_nodes`) names nodes to deal over salts; neither
    changes the result.
    """
    candidates = rule_candidates(averages, rules, settings, axes, hot)
    fired = candidates.where(rule_predicate(settings.measures, settings.unused_bound))
    return fired.select(*rules.columns, *averages.columns)


def rule_candidates(
    averages: DataFrame, rules: DataFrame, settings: AlertSettings = DEFAULT, axes: Axes | None = None, hot=()
) -> DataFrame:
    """The (rule, window) pairs that share a node, before the predicate; each pair at most once."""
    for name in (*averages.columns, *rules.columns):
        if name.startswith(_OWN):
            raise ValueError(f"column {name}: names with {_OWN} are used by the rule join")
    live = _live(rules, settings)
    axes = rule_axes(live, settings) if axes is None else axes
    if axes.listed is None:
        axes = replace(axes, listed=_listed_bytes(live, axes, settings))
    if averages.isStreaming:  # rules that change later may be bounded on other axes
        axes = replace(axes, uses=None)
    windows = _salted(list_windows(averages, axes, settings), hot, False)
    if axes.listed > _most(live):  # the listing is far larger than the rules' files, whose splits may be few
        live = live.repartition(int(live.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    listed = _salted(_list_rules(live, axes, settings), hot, True)
    keys = [f"{_OWN}{i}" for i in range(len(settings.measures))] + ([f"{_OWN}salt"] if hot else [])
    return _hinted(averages, windows, listed, keys, axes, SALTS if hot else 1)


def _hinted(averages: DataFrame, windows: DataFrame, listed: DataFrame, keys: list[str], axes: Axes, times: int) -> DataFrame:
    """The join in the form that the counted sizes allow.

    Rules are broadcast if they are below :func:`_most` as listed
    (``times`` for salts). If not, the windows of a batch are counted, a pass more
    over the averages, and broadcast if they are. Otherwise both sides are sorted
    and merged, which takes bounded memory. A stream keeps the form that its
    rules had at its start; its windows are never broadcast.
    """
    most = _most(averages)
    if axes.listed * times <= most:
        return windows.join(F.broadcast(listed), on=keys, how="inner")
    if not averages.isStreaming and most > 0:
        rows, width = averages.agg(F.count("*"), F.sum(F.expr(_width(averages)))).first()
        if ((width or 0) + rows * 8 * len(keys)) * len(axes.combinations()) <= most:
            return F.broadcast(windows).join(listed, on=keys, how="inner")
    return windows.hint("merge").join(listed.hint("merge"), on=keys, how="inner")


def _most(df: DataFrame) -> int:
    """Bytes that may be broadcast: the session's threshold, up to ``BROADCAST``."""
    return min(BROADCAST, df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def _width(df: DataFrame) -> str:
    """SQL: a row's size in bytes, about as a hash table of a broadcast holds it."""
    fixed = [f for f in df.schema.fields if not isinstance(f.dataType, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.VariantType))]
    other = [f"coalesce(octet_length(CAST(`{f.name}` AS STRING)), 0)" for f in df.schema.fields if f not in fixed]
    return " + ".join([f"CAST({32 + 8 * len(df.columns) + sum(_nested(f.dataType) for f in fixed)} AS BIGINT)", *other])


def _nested(kind: T.DataType) -> int:
    return sum(8 + _nested(f.dataType) for f in kind.fields) if isinstance(kind, T.StructType) else 0


def _live(rules: DataFrame, settings: AlertSettings) -> DataFrame:
    """A rule with a blank bound never fires."""
    bounds = [f"{m}_{e}" for m in settings.measures for e in ("min", "max")]
    return rules.where(" AND ".join(f"`{b}` IS NOT NULL" for b in bounds))


def _listed_bytes(live: DataFrame, axes: Axes, settings: AlertSettings) -> int:
    """The size of all listed rules, counted without listing them; of rules that are too large as they are, ``_TOO_LARGE``."""
    if (live.agg(F.expr(f"sum({_width(live)})")).first()[0] or 0) > _most(live):
        return _TOO_LARGE
    nodes = " * ".join(f"CAST(size({_OWN}n{i}) AS BIGINT)" for i in range(len(settings.measures)))
    width = f"({_width(live)} + {8 * len(settings.measures)})"
    return _rule_nodes(live, axes, settings).agg(F.expr(f"coalesce(sum({nodes} * {width}), 0)")).first()[0]


def rule_axes(rules: DataFrame, settings: AlertSettings = DEFAULT) -> Axes:
    """Cuts of each axis, the sets of axes that rules bound, and the size of the listed rules: aggregate jobs on the rules.

    At most ``rule_bins + 1`` numbers an axis and ``2 ^ axes`` masks come to the driver.
    """
    n, measures = settings.rule_bins, settings.measures
    used = [[f"IF(`{m}_{e}` = {settings.unused_bound}, NULL, CAST(`{m}_{e}` AS DOUBLE))" for e in ("min", "max")] for m in measures]
    mask = " + ".join(f"IF(coalesce({lo}, {hi}) IS NULL, 0, {1 << i})" for i, (lo, hi) in enumerate(used))
    points = ", ".join(f"named_struct('axis', {i}, 'at', {b})" for i, pair in enumerate(used) for b in pair)
    steps = ", ".join(f"{k / n!r}D" for k in range(n + 1))
    # one row a rule and axis end, the mask as an axis of its own
    points = f"explode(array({points}, named_struct('axis', -1, 'at', CAST({mask} AS DOUBLE)))) AS p"
    rows = (
        rules.selectExpr(points)
        .where("p.at IS NOT NULL")
        .groupBy("p.axis")
        .agg(
            F.expr(f"percentile_approx(p.at, array({steps}), 10000) AS at"),
            F.expr("collect_set(IF(p.axis = -1, p.at, NULL)) AS masks"),
        )
        .collect()
    )
    found = {r["axis"]: r for r in rows}
    cuts = [sorted(set(found[i]["at"])) if i in found else [] for i in range(len(measures))]
    # v > the next number below c means v >= c
    separators = tuple(tuple(s for c in own for s in (math.nextafter(c, -math.inf), c)) for own in cuts)
    axes = Axes(separators, settings.rule_fanout, frozenset(int(m) for m in found[-1]["masks"]) if found else frozenset())
    return replace(axes, listed=_listed_bytes(_live(rules, settings), axes, settings))


def _number(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


def _cell(value: str, separators: tuple[float, ...]) -> str:
    """The number of separators below a value: a search tree of comparisons, so the code is generated, no loop or lambda."""

    def tree(lo: int, hi: int) -> str:
        if lo == hi:
            return str(lo)
        mid = (lo + hi) // 2
        return f"IF({value} > {_number(separators[mid])}, {tree(mid + 1, hi)}, {tree(lo, mid)})"

    return tree(0, len(separators))


def _cells(df: DataFrame, values: dict[str, tuple[str, tuple[float, ...]]]) -> DataFrame:
    """Adds columns ``name``: the cell of ``value`` on an axis, for each ``name: (value, separators)``.

    Up to ``_TREE`` separators are one search tree. Beyond that a tree finds the
    block and the block's separators, taken from a constant array, are compared
    one by one, so the generated code does not grow with the rules.
    """

    def block(separators: tuple[float, ...]) -> int:
        return max(_TREE, -(-len(separators) // _TREE))

    first, second = [], []
    for name, (value, separators) in values.items():
        if len(separators) <= _TREE:
            first.append(f"{_cell(value, separators)} AS `{name}`")
            second.append(f"`{name}`")
            continue
        size = block(separators)
        first.append(f"{_cell(value, separators[size::size])} AS `{name}`")
        array = "array(" + ", ".join(map(_number, separators)) + ")"
        if size <= _TREE:
            ones = [f"IF({value} > coalesce(get({array}, `{name}` * {size} + {k}), DOUBLE('NaN')), 1, 0)" for k in range(size)]
            inside = " + ".join(ones)
        else:  # more than _TREE ^ 2 separators: one loop over the block
            inside = f"size(filter(slice({array}, `{name}` * {size} + 1, {size}), s -> {value} > s))"
        second.append(f"`{name}` * {size} + {inside} AS `{name}`")
    out = df.selectExpr("*", *first)
    if any(len(separators) > _TREE for _, separators in values.values()):
        out = out.selectExpr(*[f"`{c}`" for c in df.columns], *second)
    return out


def list_windows(averages: DataFrame, axes: Axes, settings: AlertSettings = DEFAULT) -> DataFrame:
    """Each window once for each combination of levels in use, with its node on every axis."""
    measures = settings.measures
    roots = [axes.levels(i) for i in range(len(measures))]
    out = _cells(averages, {f"{_OWN}c{i}": (f"`avg_{m}`", axes.separators[i]) for i, m in enumerate(measures)})
    combinations = axes.combinations()
    entries = []
    for levels in combinations:
        nodes = [_node(axes, i, level, f"(`{_OWN}c{i}` DIV {axes.fan(i) ** level})" if level < roots[i] else "0") for i, level in enumerate(levels)]
        bounded = [f"`avg_{measures[i]}` IS NOT NULL" for i, level in enumerate(levels) if level < roots[i]]
        entry = "named_struct(" + ", ".join(f"'n{i}', CAST({n} AS INT)" for i, n in enumerate(nodes)) + ")"
        entries.append(f"IF({' AND '.join(bounded)}, {entry}, NULL)" if bounded else entry)
    if not entries:
        entries = ["CAST(NULL AS STRUCT<" + ", ".join(f"n{i}: INT" for i in range(len(measures))) + ">)"]
    listed = out.selectExpr(*[f"`{c}`" for c in averages.columns], f"explode(array({', '.join(entries)})) AS {_OWN}")
    keys = [f"{_OWN}.n{i} AS {_OWN}{i}" for i in range(len(measures))]
    return listed.where(f"{_OWN} IS NOT NULL").selectExpr(*[f"`{c}`" for c in averages.columns], *keys)


def _node(axes: Axes, i: int, level: int, place: str) -> str:
    """A node's number on its axis: levels follow each other, leaves first."""
    n, before = len(axes.separators[i]) + 1, 0
    for _ in range(level):
        before, n = before + n, -(-n // axes.fan(i))
    return f"{before} + {place}"


def _rule_nodes(live: DataFrame, axes: Axes, settings: AlertSettings) -> DataFrame:
    """Adds, per axis, the array of nodes that make up a rule's range.

    Level by level from the leaves: of the range ``a`` to ``b`` of a level's
    nodes, those that are no whole set of siblings are listed, and their parents
    make the range of the next level (empty: 0 to -1).
    """
    measures, unused = settings.measures, settings.unused_bound
    none = "CAST(array() AS ARRAY<INT>)"
    bounds = {f"{_OWN}{e}{i}": (f"CAST(`{m}_{e}` AS DOUBLE)", axes.separators[i]) for i, m in enumerate(measures) for e in ("min", "max")}
    out = _cells(live, bounds)
    kept = [f"`{c}`" for c in live.columns]
    ranges, counts, lists = [], [], []
    for i, m in enumerate(measures):
        counts.append(len(axes.separators[i]) + 1)
        ranges.append(f"IF(`{m}_min` = {unused}, 0, {_OWN}min{i}) AS {_OWN}a{i}")
        ranges.append(f"IF(`{m}_max` = {unused}, {counts[i] - 1}, {_OWN}max{i}) AS {_OWN}b{i}")
        lists.append([])
    out = out.selectExpr(*kept, *ranges)
    for level in range(max(axes.levels(i) for i in range(len(measures)))):
        step = []
        for i in range(len(measures)):
            a, b, count, fanout = f"{_OWN}a{i}", f"{_OWN}b{i}", counts[i], axes.fan(i)
            if level >= axes.levels(i):
                step += [a, b]
                continue
            parents = -(-count // fanout)
            # the last parent counts as whole without all its children
            up, to = f"(({a} + {fanout - 1}) DIV {fanout})", f"(IF({b} = {count - 1}, {parents}, ({b} + 1) DIV {fanout}) - 1)"
            left = f"IF({up} <= {to}, least({b}, {up} * {fanout} - 1), {b})"
            right = f"IF({up} <= {to}, ({to} + 1) * {fanout}, {b} + 1)"
            parts = f"IF({a} <= {left}, sequence({a}, {left}), {none}), IF({right} <= {b}, sequence({right}, {b}), {none})"
            name = f"{_OWN}l{i}_{level}"
            step.append(f"transform(concat({parts}), x -> CAST({_node(axes, i, level, 'x')} AS INT)) AS {name}")
            step += [f"CAST(IF({up} <= {to}, {up}, 0) AS INT) AS {a}", f"CAST(IF({up} <= {to}, {to}, -1) AS INT) AS {b}"]
            counts[i] = parents
        out = out.selectExpr(*kept, *[n for own in lists for n in own], *step)
        for i in range(len(measures)):
            if level < axes.levels(i):
                lists[i].append(f"{_OWN}l{i}_{level}")
    nodes = []
    for i, own in enumerate(lists):
        root = f"array(CAST({_node(axes, i, axes.levels(i), '0')} AS INT))"
        nodes.append(f"concat({', '.join(own)}, IF({_OWN}a{i} <= {_OWN}b{i}, {root}, {none}))")
    return out.selectExpr(*kept, *[f"{n} AS {_OWN}n{i}" for i, n in enumerate(nodes)])


def _list_rules(live: DataFrame, axes: Axes, settings: AlertSettings) -> DataFrame:
    """Each rule at the nodes that make up its range, on all axes at once."""
    out, kept = _rule_nodes(live, axes, settings), [f"`{c}`" for c in live.columns]
    # not explode: the filter that Spark derives from it would be pushed down and repeat the whole cover per reference
    n = len(settings.measures)
    for i in range(n):
        rest = [f"{_OWN}{k}" for k in range(i)] + [f"{_OWN}n{k}" for k in range(i + 1, n)]
        out = out.selectExpr(*kept, *rest, f"explode_outer({_OWN}n{i}) AS {_OWN}{i}")
    return out.where(" AND ".join(f"{_OWN}{i} IS NOT NULL" for i in range(n)))


def hot_nodes(averages: DataFrame, axes: Axes, settings: AlertSettings = DEFAULT) -> list[tuple[int, ...]]:
    """Nodes that hold more than ``HOT_SHARE`` of all listed windows: a count per node, at most ``1 / HOT_SHARE`` come back."""
    keys = [f"{_OWN}{i}" for i in range(len(settings.measures))]
    counts = list_windows(averages, axes, settings).groupBy(*keys).agg(F.count("*").alias("n"))
    top = counts.orderBy(F.desc("n"), *keys).limit(int(1 / HOT_SHARE)).collect()
    if not top:
        return []
    total = counts.agg(F.sum("n")).first()[0]
    return [tuple(r[k] for k in keys) for r in top if r["n"] > HOT_SHARE * total]


def _salted(listed: DataFrame, hot, rules: bool) -> DataFrame:
    """Adds the salt: one of a hot node's for a window (by its values), all of them for a rule; 0 elsewhere."""
    if not hot:
        return listed
    own = [c for c in listed.columns if c.startswith(_OWN)]
    is_hot = reduce(
        lambda a, b: a | b, [reduce(lambda a, b: a & b, [F.col(c) == v for c, v in zip(own, node, strict=True)]) for node in hot]
    )
    if rules:
        salts = F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
        return listed.withColumn(f"{_OWN}salt", F.explode(salts))
    values: list[Column] = [F.col(f"`{c}`") for c in listed.columns if not c.startswith(_OWN)]
    return listed.withColumn(f"{_OWN}salt", F.when(is_hot, F.pmod(F.xxhash64(*values), F.lit(SALTS)).cast("int")).otherwise(0))


__all__ = ["RULE_COLUMNS", "Axes", "hot_nodes", "match_rules", "rule_axes", "rule_candidates"]
