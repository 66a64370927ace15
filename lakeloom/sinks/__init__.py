"""Writers: append, overwrite, partition overwrite and key merge, to a path or a table.

Merge is written without a transactional table format. The batch is staged once; the
new state is ``target ⋉̸ batch-keys ∪ batch`` (a left-anti join on the keys, then a
union by name). Where the target is partitioned, the partitions to rewrite are those
the batch carries and those that hold its keys now (a key may have moved), found by a
join over keys and partition columns; a partition that loses its last row is dropped.

Everything that replaces data in a path, and every merge into an existing table, writes the
new folders beside the target and swaps them in behind a marker (:mod:`.swap`): a stop at any
step leaves the old state or, once the marker is there, the new one, which the
next read or write through a sink puts in place. (Overwriting a table is left to
Spark's own table writer.) Staged folders are removed when the write ends.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.sizing import broadcast_if_small
from ..session import scratch_path
from .swap import Swap

MODES = ("append", "overwrite", "overwrite_partitions", "merge")


class SinkError(RuntimeError):
    pass


@dataclass
class Sink:
    """One output: a ``path`` or a ``table`` (the environment picks which), a mode,
    optional partition columns, merge keys, writer options and a table comment."""

    mode: str = "overwrite"
    path: str | None = None
    table: str | None = None
    partition_by: list[str] = field(default_factory=list)
    merge_keys: list[str] = field(default_factory=list)
    options: dict = field(default_factory=dict)
    comment: str | None = None
    fmt: str = "parquet"
    require_rows: bool = False

    def __post_init__(self):
        if self.mode not in MODES:
            raise SinkError(f"unknown mode {self.mode!r}; expected one of {MODES}")
        if (self.path is None) == (self.table is None):
            raise SinkError("give exactly one of path or table")
        if self.mode == "merge" and not self.merge_keys:
            raise SinkError("merge needs merge_keys")
        if self.mode == "overwrite_partitions" and not self.partition_by:
            raise SinkError("overwrite_partitions needs partition_by")

    @classmethod
    def pick(cls, block: dict, use_tables: bool) -> "Sink":
        """One output block may name both a ``path`` and a ``table``; the environment
        (``use_tables``: a catalog is available) decides which one is written."""
        block = dict(block)
        path, table = block.pop("path", None), block.pop("table", None)
        if use_tables and table:
            return cls(table=table, **block)
        if path:
            return cls(path=path, **block)
        raise SinkError("block has no usable target for this environment")

    # -- reading the current state ------------------------------------------
    def exists(self, spark: SparkSession) -> bool:
        if self.table:
            return spark.catalog.tableExists(self.table)
        _swap(spark, self).recover()
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(p):
            return False
        # A committed dataset has data files or partition folders (a dynamic
        # partition overwrite does not leave a top-level _SUCCESS marker).
        return any(not st.getPath().getName().startswith(("_", ".")) for st in fs.listStatus(p))

    def read(self, spark: SparkSession) -> DataFrame:
        if self.table:
            _swap(spark, self).recover()
            return spark.table(self.table)
        _swap(spark, self).recover()
        reader = spark.read.format(self.fmt)
        if self.options.get("mergeSchema"):
            reader = reader.option("mergeSchema", "true")
        return reader.load(self.path)


def check_merge_source(df: DataFrame, keys: list[str]) -> None:
    """Merge guard: keys present and unique in the batch (one distributed aggregate)."""
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise SinkError(f"merge keys missing from batch: {missing}")
    null_any = F.lit(False)
    for k in keys:
        null_any = null_any | F.col(k).isNull()
    dup = df.groupBy(*keys).agg(F.count("*").alias("_n"), F.max(null_any.cast("int")).alias("_null"))
    bad = dup.agg(F.sum((F.col("_n") > 1).cast("int")).alias("dups"), F.sum("_null").alias("nulls")).first()
    if bad["nulls"]:
        raise SinkError(f"merge keys {keys} contain NULL in the batch")
    if bad["dups"]:
        raise SinkError(f"batch is not unique on merge keys {keys}: {bad['dups']} duplicated keys")


def _write(df: DataFrame, sink: Sink, mode: str, dynamic: bool = False) -> None:
    if sink.partition_by:
        # Cluster rows by the partition columns so each partition value is written by
        # few tasks (not one small file per task per value); AQE splits a hot value
        # over several tasks and merges small ones.
        df = df.hint("rebalance", *sink.partition_by)
    writer = df.write.format(sink.fmt).mode(mode)
    for k, v in sink.options.items():
        if k not in ("comment",):
            writer = writer.option(k, v)
    if mode == "overwrite" and sink.partition_by:
        # Stated per write, never inherited from the session: a plain overwrite
        # replaces the whole target, a partition overwrite only what it carries.
        writer = writer.option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    if sink.partition_by:
        writer = writer.partitionBy(*sink.partition_by)
    if sink.table:
        spark = df.sparkSession
        if dynamic and spark.catalog.tableExists(sink.table):
            _evolve(spark, df, sink)
            df.select(*spark.table(sink.table).columns).write.mode("overwrite") \
                .option("partitionOverwriteMode", "dynamic").insertInto(sink.table, overwrite=True)
        else:
            writer.saveAsTable(sink.table)
        if sink.comment:
            text = sink.comment.replace("\\", "\\\\").replace("'", "\\'")
            spark.sql(f"COMMENT ON TABLE {sink.table} IS '{text}'")
    else:
        writer.save(sink.path)


def _evolve(spark: SparkSession, df: DataFrame, sink: Sink) -> None:
    """Add the batch's new columns to the table where schema merge is on; else they are an error."""
    known = {c.lower() for c in spark.table(sink.table).columns}
    new = [f for f in df.schema if f.name.lower() not in known]
    if new and not sink.options.get("mergeSchema"):
        raise SinkError(f"columns {[f.name for f in new]} are not in {sink.table}; set mergeSchema to add them")
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {sink.table} ADD COLUMNS ({columns})")


def _remove(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _location(spark: SparkSession, table: str) -> str:
    """The folder of a table."""
    rows = spark.sql(f"DESCRIBE FORMATTED {table}").where(F.col("col_name") == "Location").collect()
    return rows[-1]["data_type"]


def _synchronise(spark: SparkSession, sink: Sink) -> None:
    """Tell the catalog what the folders of a table hold now."""
    spark.catalog.refreshTable(sink.table)
    if sink.partition_by:
        spark.sql(f"MSCK REPAIR TABLE {sink.table} SYNC PARTITIONS")


def _swap(spark: SparkSession, sink: Sink) -> Swap:
    if sink.table:
        return Swap(spark, _location(spark, sink.table), lambda: _synchronise(spark, sink))
    return Swap(spark, sink.path)


def _swap_in(rows: DataFrame, sink: Sink, emptied=lambda new: (), whole: bool = True) -> None:
    """Write ``rows`` beside the folder of ``sink`` and swap them in: the whole folder, or the partitions that they have.
    ``emptied`` gives, for the partitions written, those to remove."""
    swap = _swap(rows.sparkSession, sink)
    swap.recover(writer=True)
    try:
        _write(rows, replace(sink, table=None, path=swap.data, mode="overwrite", merge_keys=[]), "overwrite")
        new = [""] if whole else swap.folders(len(sink.partition_by))
        removed = emptied(new)
    except BaseException:
        swap.recover(writer=True)  # there is no marker yet: clears the new folder away
        raise
    swap.commit(new, removed)


def _semi(rows: DataFrame, keys: DataFrame, on: list[str], how: str = "left_semi") -> DataFrame:
    """Rows whose ``on`` columns are (not) among ``keys``; NULL equals NULL."""
    other = broadcast_if_small(keys.select(*[F.col(c).alias(f"_key_{c}") for c in on]).distinct())
    same = F.lit(True)
    for c in on:
        same = same & rows[c].eqNullSafe(other[f"_key_{c}"])
    return rows.join(other, same, how)


def merge_state(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """New state: target rows whose keys the batch does not carry, plus the whole batch."""
    batch_keys = broadcast_if_small(batch.select(*keys).distinct())
    kept = target.join(batch_keys, on=keys, how="left_anti")
    return kept.unionByName(batch, allowMissingColumns=True)


def _partition_folders(touched: DataFrame, parts: list[str]) -> list[str]:
    """The folders of partitions as the writer names them (one row per partition is collected)."""
    name = touched.sparkSession.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils \
        .getPartitionPathString
    rows = touched.select(*[F.col(c).cast("string") for c in parts]).collect()
    return ["/".join(name(c, row[c]) for c in parts) for row in rows]


def _merge(spark: SparkSession, batch: DataFrame, sink: Sink, stage) -> None:
    check_merge_source(batch, sink.merge_keys)
    if not sink.exists(spark):
        if sink.table:
            _write(batch, sink, "overwrite")
        else:
            _swap_in(batch, sink)
        return
    target = sink.read(spark)
    if sink.table:
        _evolve(spark, batch, sink)
        target = spark.table(sink.table)
    if not sink.partition_by:
        _swap_in(merge_state(target, batch, sink.merge_keys), sink)
    else:
        parts = sink.partition_by
        own = target.select(*dict.fromkeys([*sink.merge_keys, *parts]))
        touched = stage(batch.select(*parts).unionByName(_semi(own, batch, sink.merge_keys).select(*parts)).distinct())
        state = merge_state(_semi(target, touched, parts), batch, sink.merge_keys)
        # Touched partitions for which nothing was written have lost their last row.
        _swap_in(state, sink, lambda new: sorted(set(_partition_folders(touched, parts)) - set(new)), whole=False)


def _first_merge(batch: DataFrame, sink: Sink) -> None:
    """The first batch of a folder: written once, beside the target, checked there and swapped in."""
    data = _swap(batch.sparkSession, sink).data

    def checked(_) -> tuple:
        check_merge_source(batch.sparkSession.read.schema(batch.schema).format(sink.fmt).load(data), sink.merge_keys)
        return ()

    _swap_in(batch, sink, checked)


def write(df: DataFrame, sink: Sink) -> int | None:
    """Write ``df`` to ``sink``.

    A merge, or a sink that requires rows, stages the batch first, so its plan runs once (the first merge
    into a folder without partitions is checked where it was written, before it counts). With
    ``require_rows`` an empty batch fails before the target is touched, and the number of rows
    of the batch is returned; otherwise ``None`` is returned.
    """
    spark = df.sparkSession
    if sink.mode == "merge" and not (sink.table or sink.partition_by or sink.require_rows or sink.exists(spark)):
        _first_merge(df, sink)
        return None
    staged: list[str] = []

    def stage(rows: DataFrame) -> DataFrame:
        path = scratch_path(spark, "stage")
        staged.append(path)
        rows.write.parquet(path)
        return spark.read.schema(rows.schema).parquet(path)

    try:
        batch = stage(df) if sink.mode == "merge" or sink.require_rows else df
        landed = batch.count() if sink.require_rows else None
        if landed == 0:
            raise SinkError(f"no rows to land in {sink.table or sink.path}")
        if sink.mode == "merge":
            _merge(spark, batch, sink, stage)
        elif sink.path and sink.mode != "append":
            _swap_in(batch, sink, whole=sink.mode == "overwrite")
        else:
            if sink.path:
                _swap(spark, sink).recover(writer=True)
            _write(batch, sink, "append" if sink.mode == "append" else "overwrite",
                   dynamic=sink.mode == "overwrite_partitions")
        return landed
    finally:
        for path in staged:
            _remove(spark, path)


def create_schema(spark: SparkSession, schema: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
