"""Files of any size, read in byte ranges by many tasks.

Spark lists the files (paths and lengths only, no content), every file is cut into ranges of
bounded bytes, and each task opens the files of its ranges and reads just those bytes. A file may
so be larger than a row or a task could hold. Tasks open files through Arrow: local or mounted
paths, ``hdfs``, ``s3`` and ``gs``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RANGE_BYTES = 32 << 20
MAX_TASKS = 100_000


def listed(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = True) -> DataFrame:
    """(path, length) of files; their contents are not read."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.load(path).select("path", "length")


def _ranges(files: DataFrame, range_bytes: int) -> DataFrame:
    """(path, length, offset, size), dealt over as many tasks as there are ranges (within a bound)."""
    cut = files.where("length > 0").select("path", "length", F.explode(F.expr(
        f"sequence(0L, (length - 1) DIV {range_bytes})")).alias("n")).select(
        "path", "length", (F.col("n") * range_bytes).alias("offset"),
        F.least(F.lit(range_bytes).cast("long"), F.col("length") - F.col("n") * range_bytes).alias("size"))
    total = files.agg(F.sum(F.ceil(F.col("length") / range_bytes)).alias("n")).first()["n"] or 1
    return cut.repartition(min(int(total), MAX_TASKS), "path", "offset")


def _open(path: str):
    from pyarrow import fs

    local = re.match(r"^(?:file:/*(?=/))?(/.*)$", path)
    if local:
        return fs.LocalFileSystem().open_input_file(local[1])
    store, name = fs.FileSystem.from_uri(path)
    return store.open_input_file(name)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            with _open(row["path"]) as file:
                content = file.read_at(row["size"], row["offset"])
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["path"]]), pa.array([row["length"]], pa.int64()), pa.array([row["offset"]], pa.int64()),
                 pa.array([content], pa.binary())], ["path", "length", "offset", "content"])


def byte_ranges(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, length, offset, content) of ``files`` (:func:`listed`) in ranges of ``range_bytes``."""
    return _ranges(files, range_bytes).mapInArrow(_read, "path string, length long, offset long, content binary")


def _own_lines(file, length: int, offset: int, size: int) -> tuple[int, bytes] | None:
    """(place, bytes) of the lines that begin in a range, without the last line end."""
    before = 1 if offset else 0  # the byte before says whether a line begins with the range
    data = file.read_at(size + before, offset - before)
    start = data.find(b"\n") + 1 if before else 0
    if before and not start or start >= len(data):
        return None
    end, parts = offset + size, [data[start:]]
    while end < length and not parts[-1].endswith(b"\n"):  # the last line goes on
        more = file.read_at(min(64 << 10, length - end), end)
        found = more.find(b"\n") + 1
        parts.append(more[:found] if found else more)
        end += len(parts[-1])
    body = b"".join(parts)
    return offset - before + start, body[:-1] if body.endswith(b"\n") else body


def _read_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            with _open(row["path"]) as file:
                own = _own_lines(file, row["length"], row["offset"], row["size"])
            if own is None:
                continue
            found = own[1].split(b"\n")
            places, at = [], own[0]
            for line in found:
                places.append(at)
                at += len(line) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["path"]] * len(found)), pa.array(places, pa.int64()),
                 pa.array([line.decode(errors="replace") for line in found])], ["path", "offset", "line"])


def lines(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, offset, line) of all lines of text ``files``. A line belongs to the range in which it begins;
    the last line of a file needs no line end. Bytes that are not UTF-8 become U+FFFD."""
    return _ranges(files, range_bytes).mapInArrow(_read_lines, "path string, offset long, line string")
