"""Table, SQL, parameterised-SQL and inline-row sources (catalog side of a task)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The tables a data directory holds, one parquet file (or folder) each.
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """Whole-table scan; Catalyst prunes columns and pushes filters into the reader."""
    return spark.read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")


def register_tables(spark: SparkSession, data_dir: str, names=TABLES) -> dict[str, DataFrame]:
    """Expose tables as temp views so SQL sources can name them."""
    frames = {}
    for name in names:
        df = read_table(spark, data_dir, name)
        df.createOrReplaceTempView(name)
        frames[name] = df
    return frames


def sql_source(spark: SparkSession, sql: str, params: dict | None = None, views: dict | None = None) -> DataFrame:
    """Run a SQL source. Values travel as named markers (``:factor``), never by string
    formatting, so a parameter cannot change the statement's shape."""
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    if params:
        return spark.sql(sql, args=params)
    return spark.sql(sql)


def inline_rows(spark: SparkSession, rows_sql: str, columns: list[str], schema_ddl: str | None = None) -> DataFrame:
    """``SELECT * FROM VALUES ...`` rows, cast to a declared schema when one is given
    (so a loose literal cannot widen or break the target's column types)."""
    df = spark.sql(f"SELECT * FROM VALUES {rows_sql} AS t({', '.join(columns)})")
    if schema_ddl:
        df = df.selectExpr(*[f"CAST({c} AS {t}) AS {c}" for c, t in _ddl_pairs(schema_ddl)])
    return df


def _ddl_pairs(schema_ddl: str) -> list[tuple[str, str]]:
    pairs = []
    depth, start = 0, 0
    for i, ch in enumerate(schema_ddl + ","):
        if ch in "<(":
            depth += 1
        elif ch in ">)":
            depth -= 1
        elif ch == "," and depth == 0:
            part = schema_ddl[start:i].strip()
            if part:
                name, typ = part.split(None, 1)
                pairs.append((name, typ))
            start = i + 1
    return pairs
