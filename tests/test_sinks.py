import pytest
from pyspark.sql import functions as F

from lakeloom.session import scratch_path
from lakeloom.sinks import Sink, SinkError, check_merge_source, write
from lakeloom.sinks.swap import Swap


def test_merge_guard(spark):
    with pytest.raises(SinkError, match="not unique"):
        check_merge_source(spark.createDataFrame([(1, "a"), (1, "b")], "k long, v string"), ["k"])
    with pytest.raises(SinkError, match="NULL"):
        check_merge_source(spark.createDataFrame([(None, "a")], "k long, v string"), ["k"])
    with pytest.raises(SinkError, match="missing"):
        check_merge_source(spark.createDataFrame([(1, "a")], "k long, v string"), ["z"])


def test_merge_upsert_and_idempotence(spark):
    sink = Sink(mode="merge", path=scratch_path(spark, "t-merge"), merge_keys=["k"], require_rows=True)
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    assert write(base, sink) == 2
    batch = spark.createDataFrame([(2, "B"), (3, "C")], "k long, v string")
    write(batch, sink)
    once = sorted(tuple(r) for r in sink.read(spark).collect())
    write(batch, sink)
    twice = sorted(tuple(r) for r in sink.read(spark).collect())
    assert once == twice == [(1, "a"), (2, "B"), (3, "C")]


def test_partitioned_merge_touches_only_batch_partitions(spark):
    sink = Sink(mode="merge", path=scratch_path(spark, "t-pmerge"), merge_keys=["k"], partition_by=["p"])
    write(spark.createDataFrame([(1, "x", "a"), (2, "y", "b")], "k long, p string, v string"), sink)
    write(spark.createDataFrame([(1, "x", "A"), (3, "x", "C")], "k long, p string, v string"), sink)
    got = sorted((r["k"], r["p"], r["v"]) for r in sink.read(spark).collect())
    assert got == [(1, "x", "A"), (2, "y", "b"), (3, "x", "C")]


def test_overwrite_partitions_keeps_others(spark):
    path = scratch_path(spark, "t-dyn")
    write(spark.createDataFrame([(1, "m1"), (2, "m2")], "v long, month string"),
          Sink(mode="overwrite", path=path, partition_by=["month"]))
    write(spark.createDataFrame([(9, "m2")], "v long, month string"),
          Sink(mode="overwrite_partitions", path=path, partition_by=["month"]))
    got = sorted((r["v"], r["month"]) for r in spark.read.parquet(path).collect())
    assert got == [(1, "m1"), (9, "m2")]


def test_append_and_schema_evolution(spark):
    sink = Sink(mode="append", path=scratch_path(spark, "t-evo"), options={"mergeSchema": "true"})
    write(spark.createDataFrame([(1,)], "a long"), sink)
    write(spark.createDataFrame([(2, "x")], "a long, b string"), sink)
    got = sorted((r["a"], r["b"]) for r in sink.read(spark).collect())
    assert got == [(1, None), (2, "x")]


def test_landed_rows_check(spark):
    empty = spark.createDataFrame([], "a long")
    with pytest.raises(SinkError, match="no rows to land"):
        write(empty, Sink(mode="overwrite", path=scratch_path(spark, "t-empty"), require_rows=True))


def test_table_target_and_schema(spark):
    from lakeloom.sinks import create_schema

    create_schema(spark, "lakeloom_test")
    sink = Sink(mode="overwrite", table="lakeloom_test.t1", comment="test table")
    write(spark.createDataFrame([(1,)], "a long"), sink)
    assert sink.read(spark).count() == 1
    with pytest.raises(SinkError):
        Sink(mode="overwrite", path="/x", table="y")
    with pytest.raises(SinkError):
        Sink(mode="merge", path="/x")


def test_plain_overwrite_replaces_all_partitions(spark):
    path = scratch_path(spark, "t-static")
    write(spark.createDataFrame([(1, "m1"), (2, "m2")], "v long, month string"),
          Sink(mode="overwrite", path=path, partition_by=["month"]))
    write(spark.createDataFrame([(9, "m2")], "v long, month string"),
          Sink(mode="overwrite", path=path, partition_by=["month"]))
    assert sorted((r["v"], r["month"]) for r in spark.read.parquet(path).collect()) == [(9, "m2")]


def test_pick_target_by_environment():
    block = {"mode": "merge", "path": "/data/x", "table": "db.x", "merge_keys": ["k"]}
    assert Sink.pick(block, use_tables=True).table == "db.x"
    assert Sink.pick(block, use_tables=False).path == "/data/x"
    with pytest.raises(SinkError):
        Sink.pick({"mode": "append", "table": "db.x"}, use_tables=False)


def test_partitioned_merge_moves_a_key(spark):
    sink = Sink(mode="merge", path=scratch_path(spark, "t-move"), merge_keys=["k"], partition_by=["p"])
    write(spark.createDataFrame([(1, "x", "a"), (2, "z", "b")], "k long, p string, v string"), sink)
    write(spark.createDataFrame([(1, "y", "A"), (3, None, "C")], "k long, p string, v string"), sink)
    got = sorted((r["k"], r["p"], r["v"]) for r in sink.read(spark).collect())
    assert got == [(1, "y", "A"), (2, "z", "b"), (3, None, "C")]


def test_empty_batch_fails_on_an_existing_target(spark):
    path = scratch_path(spark, "t-landed")
    full, empty = spark.createDataFrame([(1, "x")], "k long, p string"), spark.createDataFrame([], "k long, p string")
    for sink in (Sink(mode="merge", path=path, merge_keys=["k"], partition_by=["p"], require_rows=True),
                 Sink(mode="overwrite_partitions", path=path, partition_by=["p"], require_rows=True),
                 Sink(mode="append", path=path, partition_by=["p"], require_rows=True)):
        assert write(full, sink) == 1
        with pytest.raises(SinkError, match="no rows to land"):
            write(empty, sink)
        assert sink.read(spark).count() >= 1


def test_table_gains_columns_only_with_schema_merge(spark):
    from lakeloom.sinks import create_schema

    create_schema(spark, "lakeloom_test")
    base = Sink(mode="overwrite_partitions", table="lakeloom_test.evo", partition_by=["p"], comment="it's a \\ table")
    write(spark.createDataFrame([(1, "x")], "a long, p string"), base)
    batch = spark.createDataFrame([(2, 5, "y")], "a long, extra int, p string")
    with pytest.raises(SinkError, match="extra"):
        write(batch, base)
    write(batch, Sink(mode="overwrite_partitions", table="lakeloom_test.evo", partition_by=["p"],
                      options={"mergeSchema": "true"}))
    assert sorted((r["a"], r["extra"]) for r in base.read(spark).collect()) == [(1, None), (2, 5)]
    info = {r[0]: r[1] for r in spark.sql("DESCRIBE EXTENDED lakeloom_test.evo").collect()}
    assert info["Comment"] == "it's a \\ table"


class Stopped(BaseException):
    """Stands for the death of the driver."""


def _stop_at(monkeypatch, step):
    """Let the driver die before the ``step``-th change to the file system (from 1); counts the changes."""
    done = []

    def guarded(method):
        def run(self, *args):
            done.append(method.__name__)
            if len(done) == step:
                raise Stopped(method.__name__)
            return method(self, *args)
        return run

    for name in ("_delete", "_rename", "_save"):
        monkeypatch.setattr(Swap, name, guarded(getattr(Swap, name)))
    return done


def _rows(spark, sink):
    return sorted(tuple(r) for r in sink.read(spark).select("k", "p", "v").collect())


@pytest.mark.parametrize("parts, table", [([], False), (["p"], False), (["p"], True)])
def test_a_merge_stopped_at_any_step_loses_nothing(spark, monkeypatch, parts, table):
    """After every step: a reader sees the old or the new state, and the next merge finds all rows."""
    schema = "k long, p string, v string"
    old = [(i, f"p{i % 3}", "old") for i in range(10)]
    batch = [(1, "p1", "new"), (2, "p9", "new"), (5, "p9", "new"), (8, "p9", "new"), (50, "p0", "new")]
    after = sorted([r for r in old if r[0] not in (1, 2, 5, 8)] + batch)
    last = [(50, "p0", "last"), (77, "p1", "last")]
    seen, step = set(), 0
    while True:
        step += 1
        name = f"swap_{'p' if parts else 'u'}_{step}"
        where = {"table": name} if table else {"path": scratch_path(spark, name)}
        sink = Sink(mode="merge", merge_keys=["k"], partition_by=parts, **where)
        write(spark.createDataFrame(old, schema).coalesce(1), sink)
        with monkeypatch.context() as patch:
            done = _stop_at(patch, step)
            try:
                write(spark.createDataFrame(batch, schema).coalesce(1), sink)
                stopped = False
            except Stopped:
                stopped = True
        if step % 2:  # with and without a reader in between
            state = _rows(spark, sink)
            assert state in (sorted(old), after)
            seen.add(state == after)
        write(spark.createDataFrame(last, schema).coalesce(1), sink)
        final = _rows(spark, sink)
        assert final in [sorted([r for r in base if r[0] != 50] + last) for base in (sorted(old), after)]
        if not stopped:
            assert final == sorted([r for r in after if r[0] != 50] + last)
            break
    assert seen == {True, False} and len(done) >= 5


def test_an_overwrite_stopped_at_any_step_leaves_one_of_both_states(spark, monkeypatch):
    schema, step = "k long, p string, v string", 0
    old, new = [(1, "a", "x"), (2, "b", "x")], [(3, "b", "y")]
    for mode, after in (("overwrite", new), ("overwrite_partitions", [old[0], new[0]])):
        step, stopped = 0, True
        while stopped:
            step += 1
            sink = Sink(mode=mode, path=scratch_path(spark, "swap-over"), partition_by=["p"])
            write(spark.createDataFrame(old, schema), sink)
            with monkeypatch.context() as patch:
                _stop_at(patch, step)
                try:
                    write(spark.createDataFrame(new, schema), sink)
                    stopped = False
                except Stopped:
                    pass
            assert _rows(spark, sink) in ([after] if not stopped else [old, after])


def test_a_failing_write_leaves_the_target_and_no_folders(spark):
    sink = Sink(mode="overwrite", path=scratch_path(spark, "swap-fail"))
    write(spark.createDataFrame([(1, "a", "x")], "k long, p string, v string"), sink)
    bad = spark.range(3).select("id", F.assert_true(F.col("id") < 2).alias("v"))
    with pytest.raises(Exception):
        write(bad, sink)
    assert _rows(spark, sink) == [(1, "a", "x")]
    assert not Swap(spark, sink.path)._exists(Swap(spark, sink.path).root)


def test_merge_with_date_null_and_odd_partition_values(spark):
    schema = "k long, p string, d date, v string"
    import datetime
    day = datetime.date(2024, 2, 29)
    for table in (None, "merge_odd"):
        where = {"table": table} if table else {"path": scratch_path(spark, "odd")}
        sink = Sink(mode="merge", merge_keys=["k"], partition_by=["p", "d"], **where)
        write(spark.createDataFrame([(1, "a=b/c %", day, "x"), (2, None, None, "x"), (3, "z", day, "x")], schema), sink)
        write(spark.createDataFrame([(1, "z", day, "y"), (2, "z", None, "y")], schema), sink)
        got = sorted(tuple(r) for r in sink.read(spark).select("k", "p", "d", "v").collect())
        assert got == [(1, "z", day, "y"), (2, "z", None, "y"), (3, "z", day, "x")]
