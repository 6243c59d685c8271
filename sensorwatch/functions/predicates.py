"""Rule predicates: optional, inclusive bounds on window averages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def optional_min(value: Column, bound: Column, unused: int) -> Column:
    """``bound == unused OR value >= bound`` (three-valued: NULL value with a used bound does not pass)."""
    return (bound == F.lit(unused)) | (value >= bound)


def optional_max(value: Column, bound: Column, unused: int) -> Column:
    """``bound == unused OR value <= bound``."""
    return (bound == F.lit(unused)) | (value <= bound)


def rule_predicate(measures: Sequence[str], unused: int) -> Column:
    """AND over measures ``m`` of the bounds ``<m>_min`` / ``<m>_max`` applied to ``avg_<m>``.

    A NULL bound never passes, so a rule with a blank bound never fires; a rule
    with every bound unused always fires, even on NULL averages.
    """
    cond = None
    for m in measures:
        avg = F.col(f"avg_{m}")
        part = optional_min(avg, F.col(f"{m}_min"), unused) & optional_max(avg, F.col(f"{m}_max"), unused)
        cond = part if cond is None else cond & part
    return cond
