"""Dashboard levels as expressions: a fixed map of six entries needs no join."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelog.schema import DASHBOARD_LEVELS, LEVEL_COLORS


def _lookup(level: Column, values: dict[str, object], kind: str) -> Column:
    out = F.lit(None)
    for name, value in values.items():
        out = F.when(level == name, F.lit(value)).otherwise(out)
    return out.cast(kind)


def level_color(level: Column) -> Column:
    return _lookup(level, LEVEL_COLORS, "string")


def level_order(level: Column) -> Column:
    return _lookup(level, {name: i for i, name in enumerate(DASHBOARD_LEVELS)}, "int")
