"""Data contract on sales lines with injected faults."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import query
from ..operators import contract
from ..sources.tables import inline_rows, register_tables


def _source(spark, d):
    """Lines from the table plus the known-bad rows, cast to the table's schema first."""
    register_tables(spark, d, ["lineitem", "part"])
    lines = spark.sql(contract.SOURCE_SQL)
    faults = inline_rows(spark, contract.FAULT_ROWS, contract.SOURCE_COLUMNS, contract.SOURCE_DDL)
    return lines.unionByName(faults)


def _tagged(spark, d):
    return contract.tag(_source(spark, d))


_RULES = contract.rules()
_FATAL = [r.name for r in _RULES if r.severity == contract.FATAL]
_TYPES = [t.split()[1].replace("STRING", "VARCHAR").replace("TIMESTAMP_NTZ", "TIMESTAMP") for t in contract.SOURCE_DDL.split(", ")]
_COLS = ", ".join(contract.SOURCE_COLUMNS)
_SRC_SQL = f"""
WITH src AS (
  {contract.SOURCE_SQL}
  UNION ALL
  SELECT {", ".join(f"CAST({c} AS {t})" for c, t in zip(contract.SOURCE_COLUMNS, _TYPES))}
  FROM (VALUES {contract.FAULT_ROWS.replace("TIMESTAMP_NTZ", "TIMESTAMP")}) v({_COLS})),
tagged AS (
  SELECT *, list_filter([
      {", ".join(f"CASE WHEN ({r.holds}) IS NOT TRUE THEN '{r.name}' END" for r in _RULES)}
  ], lambda x: x IS NOT NULL) AS broken_rules FROM src)
"""


@query("inline_values", _SRC_SQL + f"SELECT {_COLS} FROM src")
def inline_values(spark, d):
    return _source(spark, d)


@query("contract_tag", _SRC_SQL + f"""
SELECT l_orderkey, l_linenumber, broken_rules,
       list_filter(broken_rules, lambda x: list_contains({_FATAL}, x)) AS fatal_rules
FROM tagged""")
def contract_tag(spark, d):
    return _tagged(spark, d).select("l_orderkey", "l_linenumber", "broken_rules",
                                    contract.fatal_of().alias("fatal_rules"))


@query("contract_split", _SRC_SQL + f"SELECT {_COLS}, broken_rules AS reasons FROM tagged WHERE len(broken_rules) > 0")
def contract_split(spark, d):
    """The quarantine table: rows that break any rule, with every reason."""
    return contract.split(_tagged(spark, d))[1]


@query("contract_clean", _SRC_SQL + f"SELECT {_COLS} FROM tagged WHERE len(broken_rules) = 0")
def contract_clean(spark, d):
    return contract.split(_tagged(spark, d))[0]


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


@query("contract_report", _SRC_SQL + f"""
, rules(rule, severity, description) AS (VALUES {", ".join(
    f"({_quoted(r.name)}, {_quoted(r.severity)}, {_quoted(r.description)})" for r in _RULES)}),
total AS (SELECT count(*) AS total_rows FROM tagged),
fails AS (SELECT rule, count(*) AS failed_rows FROM (SELECT unnest(broken_rules) AS rule FROM tagged) GROUP BY rule)
SELECT r.rule, r.severity, r.description, CAST(coalesce(f.failed_rows, 0) AS BIGINT) AS failed_rows, total.total_rows,
       round(coalesce(f.failed_rows, 0) / total.total_rows, 6) AS failure_rate, coalesce(f.failed_rows, 0) = 0 AS passed
FROM rules r LEFT JOIN fails f ON f.rule = r.rule CROSS JOIN total
""")
def contract_report(spark, d):
    return contract.report(_tagged(spark, d))


@query("contract_verdict", _SRC_SQL + f"""
, a AS (SELECT count(*) AS total_rows, count(*) FILTER (WHERE len(broken_rules) > 0) AS quarantined_rows FROM tagged),
f AS (SELECT x, count(*) AS n FROM (SELECT unnest(broken_rules) AS x FROM tagged) WHERE x IN {tuple(_FATAL)} GROUP BY x),
b AS (SELECT *, round(quarantined_rows / total_rows, 6) AS quarantine_rate,
             coalesce((SELECT list(x ORDER BY list_position({_FATAL}, x)) FROM f), CAST([] AS VARCHAR[])) AS fatal_broken,
             (SELECT string_agg(x || ' (' || n || ' rows)', ', ' ORDER BY list_position({_FATAL}, x)) FROM f) AS named FROM a)
SELECT total_rows, quarantined_rows, total_rows - quarantined_rows AS clean_rows, quarantine_rate, fatal_broken,
       CASE WHEN len(fatal_broken) > 0 THEN 'stop_fatal' WHEN quarantine_rate > {contract.MAX_QUARANTINE_RATE} THEN 'stop_rate'
            ELSE 'ok' END AS status,
       CASE WHEN len(fatal_broken) > 0 THEN 'fatal rules broken: ' || named
            WHEN quarantine_rate > {contract.MAX_QUARANTINE_RATE} THEN 'quarantine rate above {contract.MAX_QUARANTINE_RATE}'
            ELSE 'within contract' END AS reason
FROM b
""")
def contract_verdict(spark, d):
    return contract.verdict(_tagged(spark, d))


@query("contract_faults", _SRC_SQL + f"""
, faults(k, expected) AS (VALUES {", ".join(str(x) for x in contract.FAULT_EXPECTED.items())})
SELECT count(*) AS n_faults,
       count(*) FILTER (WHERE list_contains(t.broken_rules, f.expected)) AS caught,
       count(*) FILTER (WHERE len(t.broken_rules) = 0) AS leaked
FROM faults f JOIN tagged t ON t.l_orderkey = f.k
""")
def contract_faults(spark, d):
    """Every injected fault must be caught by the rule it breaks; none may reach the clean table."""
    expected = spark.createDataFrame(list(contract.FAULT_EXPECTED.items()), "l_orderkey bigint, expected string")
    t = _tagged(spark, d).join(F.broadcast(expected), "l_orderkey")
    return t.agg(
        F.count("*").alias("n_faults"),
        F.count(F.when(F.array_contains("broken_rules", F.col("expected")), 1)).alias("caught"),
        F.count(F.when(F.size("broken_rules") == 0, 1)).alias("leaked"))
