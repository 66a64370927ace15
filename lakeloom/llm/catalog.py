"""The queries of this subpackage and their oracle statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    decontaminate, language, lexical, license_scan, line_dedup, minhash, mixing, phrases, quality,
    separator_scan, sharding, substring_dedup, suffix_dedup,
)

_MODULES = (
    separator_scan, substring_dedup, sharding, mixing, decontaminate, minhash, quality, line_dedup,
    license_scan, suffix_dedup, language, phrases, lexical,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {m.NAME: m.query for m in _MODULES}


def oracle_sql() -> dict[str, str]:
    return {m.NAME: m.ORACLE for m in _MODULES if m.ORACLE}
