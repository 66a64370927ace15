"""Token counts: separator scan over flat, unindexed token files.

A token file is one stream of 16-bit ids in which an end-of-document id closes each
document; there is no index. The stream is stored and read in fixed blocks, and a
document may span any number of them. ``scan_blocks`` looks at each
block on its own: one vectorised search gives the places of the end-of-document id, hence
the lengths of all documents that lie inside the block, and a summary of the block
(separators, tokens before the first, tokens after the last). A prefix scan over the
summaries alone gives each block the number of documents and the open tokens before it,
which stitches the documents that cross block boundaries. The scan has two levels, so that
a file of any length is not one task: runs of ``RUN_BLOCKS`` blocks are scanned on their own, each
has a summary of the same form, and only these are scanned along the whole file.

Null and empty texts are documents of no tokens; an empty table gives no rows. Very long
texts span many blocks, no task holds more than a block's tokens beside the text being
encoded. Repeated rows and rows with equal or null ids are counted each on its own. Columns
other than ``doc_id`` and ``text`` are not read, whatever their names. Tokens after a file's last
separator belong to no document and are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import ranges
from . import common

NAME = "op1_separator_scan"
EOD = 0
BLOCK_TOKENS = 1 << 16
FILE_BLOCK_TOKENS = 1 << 22  # read of a raw file by one task at a time
RUN_BLOCKS = 4096
DTYPE = "<u2"

ORACLE = r"""
SELECT doc_id, length(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_tokens
FROM documents
"""

# ASCII whitespace other than the plain space; \x1c-\x1f are word characters here.
_SPACES = bytes(32 if c in (9, 10, 11, 12, 13) else c for c in range(256))


def word_ids(text: bytes) -> np.ndarray:
    """Hashed vocabulary: the words of a text as ids from 1 to 65535 (never the separator)."""
    import zlib

    words = [w for w in text.translate(_SPACES).split(b" ") if w]
    ids = np.fromiter((zlib.crc32(w) for w in words), dtype=np.uint32, count=len(words))
    return (ids % 65535 + 1).astype(DTYPE)


def write_token_files(docs: DataFrame, path: str, encode=word_ids, block_tokens: int = BLOCK_TOKENS) -> None:
    """Write ``docs`` (doc_id, text) as token files: under ``kind=tokens`` the streams in
    blocks (file, block, data), under ``kind=order`` which document was written when.

    One pass, no shuffle: each task writes a stream of its own. ``encode`` maps a text's
    bytes to 16-bit ids other than the separator.
    """
    common.small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        schema = pa.schema([("file", pa.int64()), ("n", pa.int64()), ("doc_id", pa.int64()),
                            ("data", pa.binary()), ("kind", pa.string())])
        file, n_docs, n_blocks, held, size = TaskContext.get().partitionId(), 0, 0, [], 0
        end = np.array([EOD], dtype=DTYPE)

        def blocks(stream: np.ndarray) -> pa.RecordBatch:
            data = [stream[i:i + block_tokens].tobytes() for i in range(0, len(stream), block_tokens)]
            return pa.RecordBatch.from_pydict(
                {"file": [file] * len(data), "n": range(n_blocks, n_blocks + len(data)),
                 "doc_id": [None] * len(data), "data": data, "kind": ["tokens"] * len(data)}, schema=schema)

        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).cast(pa.binary())
            for t in texts:
                ids_of = encode(t.as_py() or b"")
                held += [ids_of, end]
                size += len(ids_of) + 1
            if len(ids):
                yield pa.RecordBatch.from_pydict(
                    {"file": [file] * len(ids), "n": range(n_docs, n_docs + len(ids)), "doc_id": ids,
                     "data": [None] * len(ids), "kind": ["order"] * len(ids)}, schema=schema)
                n_docs += len(ids)
            if size >= block_tokens:
                stream = np.concatenate(held)
                whole = size // block_tokens * block_tokens
                out = blocks(stream[:whole])
                yield out
                n_blocks += out.num_rows
                held, size = [stream[whole:]], size - whole
        if size:
            yield blocks(np.concatenate(held))

    docs.selectExpr("cast(doc_id as long) AS doc_id", "text").mapInArrow(
        run, "file long, n long, doc_id long, data binary, kind string",
    ).write.partitionBy("kind").parquet(path)


def _written(spark: SparkSession, path: str, kind: str) -> DataFrame:
    schema = "file long, n long, doc_id long, data binary, kind string"
    return spark.read.schema(schema).parquet(path).where(F.col("kind") == kind)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Blocks (file, block, data) of the files written by :func:`write_token_files`."""
    return _written(spark, path, "tokens").select("file", F.col("n").alias("block"), "data")


def read_flat_files(spark: SparkSession, path: str, block_tokens: int = FILE_BLOCK_TOKENS) -> DataFrame:
    """Blocks of raw token files of any size; ``file`` is a file's path.

    Files are listed without their content and read in byte ranges, one block at a time, by
    as many tasks as there are blocks (within a bound).
    """
    size = block_tokens * np.dtype(DTYPE).itemsize
    return ranges.byte_ranges(ranges.listed(spark, path), size).select(
        F.col("path").alias("file"), F.expr(f"offset DIV {size}").alias("block"), F.col("content").alias("data"))


def _before(summaries: DataFrame, keys: list[str], order: str) -> DataFrame:
    """``summaries`` (n_ends, head, tail) plus what lies before each within its ``keys``: ``ordinal``, the
    documents closed, and ``open``, the tokens since the last separator (or the beginning).

    A summary without separators only adds its ``head`` to the open tokens; one with separators starts anew.
    """
    line = Window.partitionBy(*keys).orderBy(order)
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    closing = F.col("n_ends") > 0
    total = F.sum(F.when(closing, F.col("tail")).otherwise(F.col("head"))).over(
        line.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        summaries.withColumn("_total", total)
        .withColumn("ordinal", F.coalesce(F.sum("n_ends").over(before), F.lit(0)))
        .withColumn("_last", F.max(F.when(closing, F.struct(order, (F.col("_total") - F.col("tail")).alias("at")))).over(before))
        .withColumn("open", F.coalesce(F.lag("_total").over(line), F.lit(0)) - F.coalesce("_last.at", F.lit(0)))
        .drop("_total", "_last")
    )


def _carried(summaries: DataFrame, run_blocks: int) -> DataFrame:
    """(file, block, ordinal, open) before each of ``summaries`` (file, block, n_ends, head, tail)."""
    inside = _before(summaries.withColumn("run", F.expr(f"block DIV {run_blocks}")), ["file", "run"], "block")
    first = F.when(F.col("n_ends") > 0, F.col("open") + F.col("head"))
    after = F.when(F.col("n_ends") > 0, F.col("tail")).otherwise(F.col("open") + F.col("head"))
    runs = inside.groupBy("file", "run").agg(
        F.sum("n_ends").alias("n_ends"), F.max_by(after, "block").alias("tail"),
        F.coalesce(F.min_by(first, F.when(first.isNotNull(), F.col("block"))), F.max_by(after, "block")).alias("head"))
    outside = _before(runs, ["file"], "run").select(
        "file", "run", F.col("ordinal").alias("run_ordinal"), F.col("open").alias("run_open"))
    return inside.join(outside, ["file", "run"]).select(
        "file", "block", (F.col("run_ordinal") + F.col("ordinal")).alias("ordinal"),
        (F.col("open") + F.when(F.col("ordinal") == 0, F.col("run_open")).otherwise(0)).alias("open"))


def scan_blocks(blocks: DataFrame, eod: int = EOD, run_blocks: int = RUN_BLOCKS) -> DataFrame:
    """(file, ordinal, n_tokens) of every closed document in ``blocks`` (file, block, data).

    What the search found is written once; the lengths inside a block meet only the block's place.
    """
    file_type = blocks.schema["file"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, heads, tails, inner = [], [], [], []
            for data in batch.column(2):
                tokens = np.frombuffer(data.as_py(), dtype=DTYPE)
                ends = np.flatnonzero(tokens == eod)
                counts.append(len(ends))
                heads.append(int(ends[0]) if len(ends) else len(tokens))
                tails.append(len(tokens) - 1 - int(ends[-1]) if len(ends) else 0)
                inner.append(np.diff(ends) - 1 if len(ends) > 1 else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(heads, pa.int64()),
                 pa.array(tails, pa.int64()), pa.array(inner, pa.list_(pa.int64()))],
                names=["file", "block", "n_ends", "head", "tail", "inner"])

    seen = common.staged(blocks.select("file", "block", "data").mapInArrow(
        run, f"file {file_type}, block long, n_ends long, head long, tail long, inner array<long>"), "separators")
    places = _carried(seen.select("file", "block", "n_ends", "head", "tail"), run_blocks)
    return seen.where("n_ends > 0").join(places, ["file", "block"]).select(
        "file", F.col("ordinal").alias("first"),
        F.posexplode(F.concat(F.array(F.col("open") + F.col("head")), "inner")).alias("k", "n_tokens"),
    ).select("file", (F.col("first") + F.col("k")).alias("ordinal"), "n_tokens")


def count_documents(spark: SparkSession, path: str, eod: int = EOD) -> DataFrame:
    """(doc_id, n_tokens): scanned lengths under the ids of the written order."""
    order = _written(spark, path, "order").select("file", F.col("n").alias("ordinal"), "doc_id")
    return order.join(scan_blocks(read_blocks(spark, path), eod), ["file", "ordinal"], "left").select(
        "doc_id", F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents, found by scanning their token files for separators."""
    path = scratch_path(spark, "token-files")
    write_token_files(common.documents(spark, sf_dir), path)
    return count_documents(spark, path)
