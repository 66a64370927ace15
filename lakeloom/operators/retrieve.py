"""Exact top-k cosine retrieval and cited-context assembly.

* Questions are taken in blocks of bounded bytes, however many there are. A block is sent to all tasks; each
  corpus partition scores its rows against it with one matrix product per Arrow batch and keeps its own
  best ``k`` per question, ties by the smaller corpus id, so a task emits at most ``k × questions`` rows,
  whatever the corpus size.
* The partial winners are merged with ``row_number() <= k`` per question; Catalyst adds a
  group limit before that shuffle.
* For a corpus that is searched often, :func:`pivot_index` writes it in order of (nearest pivot, angle to it).
  The angle between a question and a row is at least the difference of their angles to the pivot, so
  with a lower bound for the ``k``-th score only a range of angles per pivot can matter. That range
  is a filter on sorted Parquet columns, and inside it questions are left out batch by batch. The result is
  exact; :func:`needed_share` says what part of the corpus had to be read.

Ids may be numbers or strings. Vectors are L2-normalised on both sides; a zero vector keeps
norm 1 (score 0).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import landed

DEFAULT_K = 4
QUESTION_BLOCK_BYTES = 64 * 1024 * 1024
SCORE_CELLS = 2 * 1024 * 1024  # scores that a task holds at once
PIVOTS = 64
PROBE_SHARE = 64  # one row in so many gives the first bounds
ANGLE_SLACK = 1e-6  # for rounding, far above it


def _normalise(m: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(m, axis=1)
    norms[norms == 0] = 1.0
    return m / norms[:, None]


def _matrix(col: pd.Series, dim: int) -> np.ndarray:
    """Stack vectors; every vector must have the question side's dimension."""
    if len(col) == 0:
        return np.zeros((0, dim))
    m = np.vstack(col.to_numpy()).astype(np.float64, copy=False)
    if m.shape[1] != dim:
        raise ValueError(f"corpus vectors have dimension {m.shape[1]}, questions {dim}")
    return m


def _partial_topk(q_ids: np.ndarray, q_mat: np.ndarray, k: int, exclude_self: bool):
    """Per-partition scorer for ``mapInPandas`` over (did, dvec): best ``k`` rows per question.

    A slice of rows has at most ``SCORE_CELLS`` scores. Once a question has ``k`` rows, only those are looked at
    that score as high as its last one.
    """

    def run(batches):
        best = [(np.empty(0), None)] * len(q_ids)
        bars = np.full(len(q_ids), -np.inf)
        for pdf in batches:
            all_ids, m = np.asarray(pdf["did"].tolist()), _matrix(pdf["dvec"], q_mat.shape[1])
            step = max(1, SCORE_CELLS // max(1, len(q_ids)))
            for at in range(0, len(all_ids), step):
                ids, scores = all_ids[at:at + step], q_mat @ _normalise(m[at:at + step]).T
                for i in np.flatnonzero(~(scores < bars[:, None]).all(1)).tolist():
                    s = scores[i]
                    rows = np.flatnonzero(~(s < bars[i]))
                    if exclude_self:
                        rows = rows[ids[rows] != q_ids[i]]
                    if len(rows) > k:  # all rows that tie with the k-th best stay
                        rows = rows[s[rows] >= np.partition(s[rows], -k)[-k]]
                    own_s, own_i = best[i]
                    s_all = np.concatenate([own_s, s[rows]])
                    i_all = ids[rows] if own_i is None else np.concatenate([own_i, ids[rows]])
                    order = np.lexsort((i_all, -s_all))[:k]
                    best[i] = s_all[order], i_all[order]
                    if len(order) == k:
                        bars[i] = s_all[order[-1]]
        found = [(q, i, s) for q, (ss, ii) in zip(q_ids.tolist(), best) for s, i in zip(ss.tolist(), [] if ii is None else ii.tolist())]
        if found:
            yield pd.DataFrame(found, columns=["query_id", "doc_id", "score"])

    return run


def _sides(questions: DataFrame, corpus: DataFrame, q_id: str, q_vec: str, d_id: str, d_vec: str):
    """(questions, corpus, schema of partial results) under fixed names."""
    q = questions.select(F.col(q_id).alias("qid"), F.col(q_vec).alias("qvec"))
    docs = corpus.select(F.col(d_id).alias("did"), F.col(d_vec).alias("dvec"))
    return q, docs, f"query_id {q.dtypes[0][1]}, doc_id {docs.dtypes[0][1]}, score double"


def _question_blocks(q: DataFrame, block_bytes: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, normalised vectors) of the questions, about ``block_bytes`` of vectors at a time."""
    size = q.agg(F.coalesce(F.sum(F.size("qvec")), F.lit(0)).alias("n")).first()["n"] * 8
    blocks = max(1, math.ceil(size / block_bytes))
    if blocks > 1:
        q = landed(q.withColumn("_block", F.pmod(F.xxhash64("qid"), F.lit(blocks))), "questions")
    for i in range(blocks):
        rows = (q.where(F.col("_block") == i) if blocks > 1 else q).collect()
        if rows:
            yield (np.array([r["qid"] for r in rows]),
                   _normalise(np.vstack([np.asarray(r["qvec"], dtype=np.float64) for r in rows])))


def _merged(partials: list[DataFrame], k: int, empty: DataFrame) -> DataFrame:
    union = empty
    for part in partials:
        union = union.unionByName(part)
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("doc_id").asc())
    return (union.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "doc_id", "score"))


def topk_similar(questions: DataFrame, corpus: DataFrame, k: int = DEFAULT_K, q_id: str = "query_id",
                 q_vec: str = "embedding", d_id: str = "doc_id", d_vec: str = "embedding",
                 exclude_self: bool = False, block_bytes: int = QUESTION_BLOCK_BYTES) -> DataFrame:
    """``(query_id, rank, doc_id, score)``: the exact ``k`` most similar corpus rows per question.

    With several blocks of questions, the winners of each are written before the next block is taken,
    so neither the driver nor a task ever holds two.
    """
    q, docs, schema = _sides(questions, corpus, q_id, q_vec, d_id, d_vec)
    partials: list[DataFrame] = []
    waiting = None
    for ids, mat in _question_blocks(q, block_bytes):
        if waiting is not None:
            partials.append(landed(waiting, "top-k"))
        waiting = docs.mapInPandas(_partial_topk(ids, mat, k, exclude_self), schema)
    if waiting is not None:
        partials.append(landed(waiting, "top-k") if partials else waiting)
    return _merged(partials, k, questions.sparkSession.createDataFrame([], schema))


@dataclass
class PivotIndex:
    """Corpus rows (did, dvec, pivot, angle), written in order of (pivot, angle), and the pivots."""

    rows: DataFrame
    pivots: np.ndarray


def _angles(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(vectors @ pivots.T, -1.0, 1.0))


def _assigner(pivots: np.ndarray):
    def run(batches):
        for pdf in batches:
            if len(pdf):
                angles = _angles(_normalise(_matrix(pdf["dvec"], pivots.shape[1])), pivots)
                near = angles.argmin(1)
                yield pdf.assign(pivot=near.astype("int32"), angle=angles[np.arange(len(near)), near])
    return run


def pivot_index(corpus: DataFrame, d_id: str = "doc_id", d_vec: str = "embedding", pivots: int = PIVOTS) -> PivotIndex:
    """Index all corpus rows around ``pivots`` of them, chosen by a hash of their ids (that many rows are collected).
    Zero vectors are at right angles to everything, as their score of 0 says."""
    docs = corpus.select(F.col(d_id).alias("did"), F.col(d_vec).alias("dvec"))
    chosen = docs.where(F.exists("dvec", lambda x: x != 0)).orderBy(F.xxhash64("did"), "did").limit(pivots).collect()
    if not chosen:
        return PivotIndex(docs.withColumns({"pivot": F.lit(0), "angle": F.lit(math.pi / 2)}), np.zeros((0, 0)))
    centres = _normalise(np.vstack([np.asarray(r["dvec"], dtype=np.float64) for r in chosen]))
    types = dict(docs.dtypes)
    placed = docs.mapInPandas(_assigner(centres), f"did {types['did']}, dvec {types['dvec']}, pivot int, angle double")
    ordered = placed.repartitionByRange("pivot", "angle", "did").sortWithinPartitions("pivot", "angle")
    return PivotIndex(landed(ordered, "pivot-index"), centres)


def _pruned_topk(q_ids: np.ndarray, q_mat: np.ndarray, reach: np.ndarray, to_pivots: np.ndarray, k: int, exclude_self: bool):
    """Like :func:`_partial_topk`, over (did, dvec, pivot, angle): a run of rows of one pivot is scored against those
    questions alone whose ``reach`` (the angle of their k-th best so far) gets there."""
    def run(batches):
        for pdf in batches:
            for pivot, part in pdf.groupby("pivot", sort=False):
                low, high = part["angle"].min(), part["angle"].max()
                own = to_pivots[:, pivot]
                needed = np.flatnonzero((own - reach <= high) & (own + reach >= low))
                if len(needed):
                    yield from _partial_topk(q_ids[needed], q_mat[needed], k, exclude_self)(iter([part]))
    return run


def _reaches(index: PivotIndex, ids, mat, k, exclude_self, schema) -> np.ndarray:
    """Per question an angle within which its ``k`` best rows lie, from a share of the rows."""
    probe = index.rows.where(F.pmod(F.xxhash64("did"), F.lit(PROBE_SHARE)) == 0).select("did", "dvec")
    found = _merged([probe.mapInPandas(_partial_topk(ids, mat, k, exclude_self), schema)], k,
                    index.rows.sparkSession.createDataFrame([], schema)).where(F.col("rank") == k).collect()
    score = {r["query_id"]: r["score"] for r in found}
    return np.array([math.acos(min(1.0, max(-1.0, score.get(i, -1.0)))) + ANGLE_SLACK for i in ids.tolist()])


def _needed(index: PivotIndex, reach: np.ndarray, to_pivots: np.ndarray) -> DataFrame:
    """Index rows in the range of angles that some question reaches, pivot by pivot: a filter for the files."""
    low, high = (to_pivots - reach[:, None]).min(0), (to_pivots + reach[:, None]).max(0)
    inside = F.lit(False)
    for p, (a, b) in enumerate(zip(low.tolist(), high.tolist())):
        inside = inside | ((F.col("pivot") == p) & F.col("angle").between(a, b))
    return index.rows.where(inside)


def topk_indexed(questions: DataFrame, index: PivotIndex, k: int = DEFAULT_K, q_id: str = "query_id",
                 q_vec: str = "embedding", exclude_self: bool = False,
                 block_bytes: int = QUESTION_BLOCK_BYTES) -> DataFrame:
    """The result of :func:`topk_similar` from an index, reading the rows that may matter."""
    q, _, schema = _sides(questions, index.rows, q_id, q_vec, "did", "dvec")
    partials = []
    for ids, mat in _question_blocks(q, block_bytes):
        reach = _reaches(index, ids, mat, k, exclude_self, schema)
        angles = _angles(mat, index.pivots) if len(index.pivots) else np.full((len(ids), 1), math.pi / 2)
        rows = _needed(index, reach, angles)
        partials.append(landed(rows.mapInPandas(_pruned_topk(ids, mat, reach, angles, k, exclude_self), schema), "top-k"))
    return _merged(partials, k, questions.sparkSession.createDataFrame([], schema))


def needed_share(questions: DataFrame, index: PivotIndex, k: int = DEFAULT_K, q_id: str = "query_id",
                 q_vec: str = "embedding", block_bytes: int = QUESTION_BLOCK_BYTES) -> float:
    """The part of the index rows that :func:`topk_indexed` reads for these questions, averaged over their blocks."""
    q, _, schema = _sides(questions, index.rows, q_id, q_vec, "did", "dvec")
    total, shares = index.rows.count(), []
    for ids, mat in _question_blocks(q, block_bytes):
        if not total or not len(index.pivots):
            return 1.0
        reach = _reaches(index, ids, mat, k, False, schema)
        shares.append(_needed(index, reach, _angles(mat, index.pivots)).count() / total)
    return sum(shares) / len(shares) if shares else 0.0


def mean_vectors(rows: DataFrame, group: str, vec: str) -> DataFrame:
    """(group, embedding): the mean vector of each group, one small aggregate per component."""
    parts = rows.select(group, F.posexplode(vec).alias("k", "x")).groupBy(group, "k").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return parts.groupBy(group).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("k", "x"))), lambda p: p["x"]).alias("embedding"))


def cited_context(hits: DataFrame, labels: DataFrame, label_col: str) -> DataFrame:
    """Per question: numbered hits joined by blank lines, cited ids in rank order, top score."""
    joined = labels.join(hits, "doc_id", "right")
    entry = F.struct("rank", "doc_id", label_col, "score")
    per_q = joined.groupBy("query_id").agg(F.array_sort(F.collect_list(entry)).alias("hits"))
    line = lambda h: F.format_string("[%d] vec %d (label %s, score %.6f)", h["rank"], h["doc_id"],
                                     F.coalesce(h[label_col].cast("string"), F.lit("none")), h["score"])
    return per_q.select(
        "query_id",
        F.array_join(F.transform("hits", line), "\n\n").alias("context"),
        F.transform("hits", lambda h: h["doc_id"]).alias("cited_ids"),
        F.element_at("hits", 1)["score"].alias("top_score"),
        F.size("hits").alias("n_hits"),
    )
