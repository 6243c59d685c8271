"""Alert rules: a small CSV table of optional, inclusive bounds per measure.

Fixed values: the packaged file ``data/alert_rules.csv`` holds the four rules
the original job runs with (too dry, too wet, too cold, too hot; codes
101-104), unchanged, so that the alerts match.
"""

from __future__ import annotations

from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import run_dir

RULE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.IntegerType(), True),
        T.StructField("humidity_min", T.DoubleType(), True),
        T.StructField("humidity_max", T.DoubleType(), True),
        T.StructField("temperature_min", T.DoubleType(), True),
        T.StructField("temperature_max", T.DoubleType(), True),
        T.StructField("code", T.IntegerType(), True),
        T.StructField("message", T.StringType(), True),
    ]
)
RULE_COLUMNS = tuple(f.name for f in RULE_SCHEMA.fields)


def default_rules_path() -> str:
    """The rules file shipped with the package (four rules)."""
    return str(resources.files("sensorwatch.sources").joinpath("data/alert_rules.csv"))


def read_rules(spark: SparkSession, path: str | None = None, infer_schema: bool = False) -> DataFrame:
    """Read a rules CSV with a header line; columns are found by name, in any order.

    ``path`` should be on storage every executor can read (a running stream
    re-reads it each micro-batch, so edits take effect); ``None`` reads the
    packaged four rules. Bounds are numbers, fractions included; ids and codes
    are integers; an empty cell is NULL (a rule with a NULL bound never fires).
    A missing column fails here, a cell that is no number of its kind fails the
    query that reads it. ``infer_schema=True`` reads the file the way a plain
    ``spark.read.csv(header, inferSchema)`` does, at the cost of one extra
    pass over the file when the plan is built.
    """
    own = path is None
    path = path or _packaged_rules_path(spark)
    reader = spark.read.option("header", "true")
    if infer_schema:
        return reader.option("inferSchema", "true").csv(path)
    if own:  # its header is known, so no job reads it
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in RULE_COLUMNS]))
    cells = reader.csv(path)
    missing = [c for c in RULE_COLUMNS if c not in cells.columns]
    if missing:
        raise ValueError(f"rules file without column {', '.join(missing)}")
    return cells.select(*[_cell(f).alias(f.name) for f in RULE_SCHEMA.fields])


RESCUED, MALFORMED = "rescued", "malformed"


def read_rules_rescued(spark: SparkSession, path: str) -> DataFrame:
    """Rules CSV files of any number: as :func:`read_rules`, but a bad cell or line costs no other row.

    Beside the rule columns: ``rescued MAP<STRING, STRING>``, the text of cells
    that are no number of their kind (NULL in their own column, so the rule does
    not fire), and ``malformed STRING``, the whole line where it has too few or
    too many cells. Both are NULL for a good row. One pass over the files; all
    must have the header of the first (another one fails the read).
    """
    reader = spark.read.option("header", "true")
    names = reader.csv(path).columns
    missing = [c for c in RULE_COLUMNS if c not in names]
    if missing:
        raise ValueError(f"rules file without column {', '.join(missing)}")
    if MALFORMED in names:
        raise ValueError(f"rules file with a column {MALFORMED}")
    texts = T.StructType([T.StructField(c, T.StringType()) for c in (*names, MALFORMED)])
    reader = reader.option("columnNameOfCorruptRecord", MALFORMED).option("enforceSchema", "false")
    cells = reader.schema(texts).csv(path)
    numbers = [f for f in RULE_SCHEMA.fields if not isinstance(f.dataType, T.StringType)]
    entries = [F.struct(F.lit(f.name).alias("key"), F.col(f.name).alias("value")) for f in numbers if f.name in names]
    wrong = [
        F.when((F.trim(f.name) != "") & F.col(f.name).try_cast(f.dataType).isNull(), e) for f, e in zip(numbers, entries, strict=True)
    ]
    bad = F.filter(F.array(*wrong), lambda e: e.isNotNull())
    values = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in RULE_SCHEMA.fields]
    rescued = F.when(F.col(MALFORMED).isNull() & (F.size(bad) > 0), F.map_from_entries(bad)).alias(RESCUED)
    return cells.select(*values, rescued, F.col(MALFORMED))


def inferred_differences(spark: SparkSession, path: str) -> dict[str, str]:
    """Rule columns that inference reads as another type than the explicit one, with that type (a whole pass over the files)."""
    inferred = {f.name: f.dataType for f in read_rules(spark, path, infer_schema=True).schema.fields}
    # whole numbers are numbers: an inferred INT bound is no difference
    numeric = (T.IntegerType, T.DoubleType)
    return {
        f.name: inferred[f.name].simpleString()
        for f in RULE_SCHEMA.fields
        if f.name in inferred
        and inferred[f.name] != f.dataType
        and not (isinstance(f.dataType, T.DoubleType) and isinstance(inferred[f.name], numeric))
    }


def _cell(field: T.StructField) -> Column:
    text = F.col(field.name)
    if isinstance(field.dataType, T.StringType):
        return text
    wrong = F.raise_error(F.concat(F.lit(f"rules file: {field.name} is not a number of its kind: "), text))
    empty = text.isNull() | (F.trim(text) == "")
    value = text.try_cast(field.dataType)
    return F.when(~empty, F.coalesce(value, wrong.cast(field.dataType)))


def _packaged_rules_path(spark: SparkSession) -> str:
    """The packaged file on storage that executors read: copied once per application to the shared folder.

    The file itself lies next to the driver's copy of the library, which
    executors on other hosts may not have.
    """
    app = spark.sparkContext.applicationId
    if app not in _COPIES:
        with open(default_rules_path(), encoding="utf-8", newline="") as fh:
            lines = [ln for ln in fh.read().splitlines() if ln.strip()]
        path = run_dir(spark, "rules")
        spark.createDataFrame([(ln,) for ln in lines], "value string").coalesce(1).write.text(path)
        _COPIES[app] = path
    return _COPIES[app]


_COPIES: dict[str, str] = {}
