"""Decoding of messages whose shape drifts: each is parsed once, to a VARIANT, and either accepted or kept with its causes.

:func:`decode_checked` says of every message what :func:`decode_readings`
would make of it and why it is not a whole reading; :func:`write_quarantined`
writes accepted readings and dead letters in one pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from .timecols import epoch_text_to_time_sql

#: Causes of a dead letter: of the whole message, then of its fields.
NO_MESSAGE, NO_JSON, NO_OBJECT = "no message", "no JSON", "no object"
_INT = (-(2**31), 2**31 - 1)
#: What a field's value may be in JSON.
_KINDS = {"timestamp": ("number", "text"), "id": ("whole",), "sensor": ("text",), "value": ("whole",)}


def _kind(field: str) -> str:
    kind = f"schema_of_variant(variant_get(_v, '$.{field}', 'variant'))"
    return (
        f"CASE WHEN {kind} IS NULL OR {kind} = 'VOID' THEN 'absent' WHEN {kind} = 'STRING' THEN 'text'"
        f" WHEN {kind} = 'BIGINT' THEN 'whole' WHEN {kind} LIKE 'DECIMAL%' OR {kind} IN ('DOUBLE', 'FLOAT') THEN 'number' ELSE 'other' END"
    )


def decode_checked(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """Messages -> ``timestamp, id, sensor, value`` (as ``decode_readings`` for JSON objects), ``causes``, ``message``.

    ``causes`` is empty for a whole reading; else it names what is wrong: the
    message as a whole, or ``<field> absent`` / ``<field> <kind>`` (a value of
    another kind, or out of range) for each bad field. ``message`` is the text
    of a message with causes. A field that is absent or wrong is NULL in its
    column only. Other columns of ``messages`` stay.
    """
    kept = [f"`{c}`" for c in messages.columns if c != value_col]
    text = messages.selectExpr(*kept, f"CAST(`{value_col}` AS STRING) AS _m")
    parsed = text.selectExpr(*kept, "_m", "try_parse_json(_m) AS _v")
    kinds = parsed.selectExpr(*kept, "_m", "_v", "schema_of_variant(_v) AS _shape", *[f"{_kind(f)} AS _k_{f}" for f in _KINDS])
    fields = []
    for field, kinds_ok in _KINDS.items():
        allowed = ("whole", "number", "text") if field == "timestamp" else kinds_ok
        ok = f"_k_{field} IN ({', '.join(repr(k) for k in allowed)})"
        if kinds_ok == ("whole",):
            number = f"try_variant_get(_v, '$.{field}', 'bigint')"
            value = f"IF({ok} AND {number} BETWEEN {_INT[0]} AND {_INT[1]}, CAST({number} AS INT), NULL)"
        else:
            value = f"IF({ok}, try_variant_get(_v, '$.{field}', 'string'), NULL)"
        fields.append(f"{value} AS `_f_{field}`")
    typed = kinds.selectExpr(*kept, "_m", "_v", "_shape", *[f"_k_{f}" for f in _KINDS], *fields)
    typed = typed.selectExpr("*", f"{epoch_text_to_time_sql('`_f_timestamp`')} AS `timestamp`")
    wrong = [f"IF({'`timestamp`' if f == 'timestamp' else f'`_f_{f}`'} IS NULL, concat('{f} ', `_k_{f}`), NULL)" for f in _KINDS]
    causes = (
        f"CASE WHEN _m IS NULL THEN array('{NO_MESSAGE}') WHEN _v IS NULL THEN array('{NO_JSON}')"
        f" WHEN _shape NOT LIKE 'OBJECT%' THEN array('{NO_OBJECT}')"
        f" ELSE array_compact(array({', '.join(wrong)})) END"
    )
    out = typed.selectExpr(*kept, "`timestamp`", *[f"`_f_{f}` AS `{f}`" for f in ("id", "sensor", "value")], f"{causes} AS causes", "_m")
    return out.selectExpr(*kept, "`timestamp`", "id", "sensor", "value", "causes", "IF(size(causes) > 0, _m, NULL) AS message")


def write_quarantined(decoded: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Write checked messages once, parted into accepted readings and dead letters; both as tables."""
    decoded.selectExpr("*", "size(causes) = 0 AS accepted").write.partitionBy("accepted").parquet(path)
    table = decoded.sparkSession.read.schema(decoded.selectExpr("*", "true AS accepted").schema).parquet(path)
    # the folder names part them: each read touches its own files only
    return table.where("accepted").drop("accepted", "causes", "message"), table.where("NOT accepted").drop("accepted")
