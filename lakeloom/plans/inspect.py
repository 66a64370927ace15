"""Read Catalyst's decisions back out of a DataFrame's physical plan."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` prints, returned instead of printed."""
    jvm = df.sparkSession.sparkContext._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def pushed_filters(df: DataFrame) -> list[str]:
    """``PushedFilters: [...]`` entries of every scan in the plan."""
    found = []
    for match in re.finditer(r"PushedFilters: \[([^\]]*)\]", plan_text(df)):
        found.extend(p.strip() for p in match.group(1).split(", ") if p.strip())
    return found


def read_schema(df: DataFrame) -> list[str]:
    """``ReadSchema`` of every file scan: the columns Parquet actually decodes."""
    return re.findall(r"ReadSchema: (struct<[^\n]*>)", plan_text(df))


def has_broadcast(df: DataFrame) -> bool:
    text = plan_text(df)
    return "BroadcastHashJoin" in text or "BroadcastExchange" in text


def has_python_udf(df: DataFrame) -> bool:
    """True when a row-at-a-time or Arrow Python evaluation sits in the plan."""
    text = plan_text(df)
    return any(tok in text for tok in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF"))
