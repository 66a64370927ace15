"""Ranked lexical search: NRA over impact-sorted lists.

Every document has, for each of its terms, an impact: the whole number that the term adds to its score.
For a query, the lists of its terms are read from the highest impact down, all to the same
depth. A document's lower bound is the sum of the impacts read; its upper bound adds, for each
list in which it was not met, the next impact of that list. A document not met at all is bounded by
the sum of all next impacts. Reading goes on until the first ``k`` are fixed (nothing else can
reach the last of them, equal scores included) and their scores are complete.

Spark. One pass over the texts counts documents, terms and, per query term, the documents that
hold it; partial counts are added up by a shuffle. In a second pass every task takes its documents in
blocks of bounded bytes, builds the lists of a block in arrays and answers all queries of a query block
on it. The scores of the ``k`` best so far stay with the task, so later blocks stop as soon as their
bounds fall below them; tasks give ``k`` rows per query, and a window with a limit merges those. A
document's score needs nothing outside its own row and the counts, so blocks may be cut anywhere
and results don't depend on them.

Queries are taken in blocks of at most ``QUERY_BYTES`` bytes of text, each over all documents; the terms
of one block, with their weights, are what is broadcast.

Null and empty texts have no terms: such items give no rows, such documents are never found and
don't count. Repeated documents are ranked each; equal scores go by doc_id, null doc_ids last.
Equal item rows count once; items that share an id but not the text are answered each. A very
long text is a block of its own. Empty tables give no rows. Other columns are ignored,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common, tokens

NAME = "op13_lexical"
K = 50
QUERY_BYTES = 4 << 20
FIRST_DEPTH = 64
MATRIX = 64 << 20  # lists times documents that are looked at together
LAST = np.iinfo(np.int64).max  # stands for a null doc_id, which comes last

# Everything in ASCII that is no letter and no digit parts terms.
TABLE = tokens.byte_table(c for c in range(128) if not chr(c).isalnum())


def _blocks(batches: Iterator[pa.RecordBatch], block_bytes: int = tokens.BLOCK_BYTES) -> Iterator[tuple[np.ndarray, tokens.Words]]:
    """(doc_ids, words) of blocks of documents."""
    def rows():
        for batch in batches:
            yield from zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist())

    for ids, texts in tokens.blocks(rows(), block_bytes):
        yield np.array([LAST if i is None else i for i in ids], np.int64), tokens.words(texts, TABLE)


def _postings(words: tokens.Words, terms: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(term, text, occurrences) of the words of a block that are among ``terms``, by term, then text."""
    known = pc.index_in(words.vocabulary.cast(pa.binary()), value_set=terms)
    known = pc.fill_null(known, -1).to_numpy().astype(np.int64)[words.code]
    held = known >= 0
    n_texts = int(words.text[-1]) + 1 if len(words.text) else 1
    key, tf = np.unique(known[held] * n_texts + words.text[held], return_counts=True)
    return key // n_texts, key % n_texts, tf


def _counter(terms):
    """Per task: (null, documents with a term, all terms), and (term number, documents that hold it, 0)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = pa.array(terms.value, pa.binary())
        df = np.zeros(len(wanted), np.int64)
        docs = total = 0
        for _, words in _blocks(batches):
            docs += len(np.unique(words.text))
            total += len(words.code)
            term, _, _ = _postings(words, wanted)
            df += np.bincount(term, minlength=len(wanted))
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array([None, *held.tolist()], pa.int32()), pa.array([docs, *df[held].tolist()], pa.int64()),
             pa.array([total] + [0] * len(held), pa.int64())], ["term", "docs", "words"])
    return count


def impacts(weight: np.ndarray, tf: np.ndarray, length: np.ndarray, docs: int, total: int) -> np.ndarray:
    """What a term adds to a document's score, in whole numbers (Python's own where 64 bits are too few)."""
    if len(length) and 50 * int(length.max()) * docs >= 1 << 63:
        m = 50 + np.array([50 * int(n) * docs // total for n in length], np.int64)
    else:
        m = 50 + 50 * length * docs // total
    return weight * (1000000000 * tf // (1000 * tf + 20 * m))


def nra(lists: list[tuple[np.ndarray, np.ndarray]], ids: np.ndarray, k: int,
        least: tuple[int, int] | None = None, first_depth: int = FIRST_DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """(places, scores) of the ``k`` best documents: highest score first, then lowest id; scores of 0 don't count.

    ``lists`` holds (places of documents, impacts) with impacts falling; ``ids[place]`` is a document's id.
    With ``least``, a (score, id) that ``k`` documents known elsewhere reach, documents behind it may be left out.
    """
    lower = np.zeros(len(ids), np.int64)
    met = np.zeros((len(lists), len(ids)), bool)
    depth, step = 0, first_depth
    if not lists:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    while True:
        for j, (place, impact) in enumerate(lists):
            part = slice(depth, depth + step)
            lower[place[part]] += impact[part]
            met[j, place[part]] = True
        depth, step = depth + step, step * 2
        ahead = np.array([impact[depth] if depth < len(impact) else 0 for _, impact in lists], np.int64)
        upper = lower + ahead.sum() - ahead @ met
        seen = np.flatnonzero(lower)
        # The k-th best by lower bounds is a score that k documents reach.
        bar = int(least[0]) if least else 0
        if len(seen) >= k:
            bar = max(bar, int(np.partition(lower[seen], len(seen) - k)[len(seen) - k]))
        hopeful = np.flatnonzero((upper >= bar) & (upper > 0))
        unresolved = upper[hopeful] > lower[hopeful]
        if ahead.sum() == 0 or not unresolved.any():
            # All that can reach the bar is complete, ties with it included.
            hopeful = hopeful[lower[hopeful] > 0]
            first = hopeful[np.lexsort((ids[hopeful], -lower[hopeful]))[:k]]
            return first, lower[first]


def _ranges(lists: list, n_docs: int, matrix: int) -> Iterator[tuple[slice, list]]:
    """The lists by ranges of documents, so that lists times documents stays within ``matrix``."""
    span = matrix // len(lists) + 1
    if span >= n_docs:
        yield slice(0, n_docs), lists
        return
    for low in range(0, n_docs, span):
        inside = [(place >= low) & (place < low + span) for place, _ in lists]
        yield slice(low, low + span), [(place[m] - low, impact[m])
                                       for m, (place, impact) in zip(inside, lists) if m.any()]


def _searcher(query_block, k: int, docs: int, total: int, block_bytes: int = tokens.BLOCK_BYTES,
              matrix: int = MATRIX, first_depth: int = FIRST_DEPTH):
    """The ``k`` best of a task's documents for every item: (item, doc_id, score)."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, weights, items = query_block.value
        wanted = pa.array(names, pa.binary())
        best = [(np.zeros(0, np.int64),) * 2 for _ in items]  # (scores, ids) per item
        for ids, words in _blocks(batches, block_bytes):
            if not len(words.code):
                continue
            length = np.bincount(words.text, minlength=len(ids))
            term, text, tf = _postings(words, wanted)
            impact = impacts(weights[term], tf, length[text], docs, total)
            order = np.lexsort((text, -impact, term))
            term, text, impact = term[order], text[order], impact[order]
            start = np.searchsorted(term, np.arange(len(wanted) + 1))
            for n, own in enumerate(items):
                lists = [(text[a:b], impact[a:b]) for a, b in zip(start[own], start[own + 1]) if a < b]
                if not lists:
                    continue
                for own_range, part in _ranges(lists, len(ids), matrix):
                    scores, doc_ids = best[n]
                    least = (scores[-1], doc_ids[-1]) if len(scores) >= k else None
                    place, found = nra(part, ids[own_range], k, least, first_depth)
                    scores = np.concatenate((scores, found))
                    doc_ids = np.concatenate((doc_ids, ids[own_range][place]))
                    keep = np.lexsort((doc_ids, -scores))[:k]
                    best[n] = scores[keep], doc_ids[keep]
        for n, (scores, doc_ids) in enumerate(best):
            if len(scores):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(scores), n), pa.int32()), pa.array(doc_ids, mask=doc_ids == LAST),
                     pa.array(scores)], ["item", "doc_id", "score"])
    return search


def _query_blocks(items: DataFrame, block_bytes: int) -> Iterator[list]:
    """Distinct items in blocks whose texts have at most about ``block_bytes`` bytes, one block at a time."""
    held, size = [], 0
    rows = items.select("item_id", F.coalesce("text", F.lit("")).alias("text")).distinct()
    for row in common.staged(rows, "lexical-items").toLocalIterator():
        held.append((row["item_id"], row["text"].encode()))
        size += len(held[-1][1]) + 1
        if size >= block_bytes:
            yield held
            held, size = [], 0
    if held:
        yield held


def _search_block(docs: DataFrame, block: list, k: int) -> DataFrame | None:
    """(item_id, rank, doc_id, score) for the items of one block."""
    spark = docs.sparkSession
    words = tokens.words([text for _, text in block], TABLE)
    if not len(words.code):
        return None
    terms = words.vocabulary.to_pylist()
    shared = spark.sparkContext.broadcast(terms)
    counts = common.staged(docs.mapInArrow(_counter(shared), "term int, docs long, words long").groupBy("term").agg(
        F.sum("docs").alias("docs"), F.sum("words").alias("words")), "lexical-counts")
    all_docs, total = counts.where(F.col("term").isNull()).select("docs", "words").first() or (0, 0)
    if not total:
        return None
    weights = np.zeros(len(terms), np.int64)
    weighed = counts.where(F.col("term").isNotNull()).select("term", F.floor(
        F.lit(1000) * F.log((2 * F.lit(all_docs) + 2).cast("double") / (2 * F.col("docs") + 1).cast("double"))
    ).cast("long").alias("w"))
    for row in weighed.toLocalIterator():  # at most one row per term of the block
        weights[row["term"]] = row["w"]
    held = [np.unique(words.code[words.text == n]) for n in range(len(block))]
    held = [own[weights[own] > 0] for own in held]
    query_block = spark.sparkContext.broadcast((terms, weights, held))
    found = docs.mapInArrow(_searcher(query_block, k, all_docs, total), "item int, doc_id long, score long")
    first = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
    # As many names as items in the block, so their bytes are bounded, too.
    names = spark.createDataFrame([(n, item) for n, (item, _) in enumerate(block)], "item int, item_id long")
    return common.staged(ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"),
                         "lexical-found")


def search(docs: DataFrame, items: DataFrame, k: int = K, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` highest-scoring documents (``doc_id``, ``text``) for each item
    (``item_id``, ``text``)."""
    common.small_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    out = None
    for block in _query_blocks(items.select(F.col("item_id").cast("long").alias("item_id"), "text"), query_bytes):
        found = _search_block(texts, block, k)
        if found is not None:
            out = found if out is None else out.unionByName(found)
    if out is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return out


ORACLE = rf"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS d, regexp_extract_all(
    translate(coalesce(text, ''), '{common.UPPER}', '{common.LOWER}'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
q AS (
  SELECT DISTINCT item_id, text, unnest(regexp_extract_all(
    translate(coalesce(text, ''), '{common.UPPER}', '{common.LOWER}'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
a AS (SELECT count(*) AS n_docs, sum(len(t)) AS n_terms FROM d WHERE len(t) > 0),
post AS (
  SELECT d, any_value(doc_id) AS doc_id, term, count(*) AS tf, any_value(n) AS n
  FROM (SELECT d, doc_id, len(t) AS n, unnest(t) AS term FROM d) SEMI JOIN q USING (term) GROUP BY d, term),
w AS (
  SELECT term, cast(floor(1000 * ln((2 * any_value(n_docs) + 2)::double / (2 * count(*) + 1)::double)) AS bigint) AS w
  FROM post, a GROUP BY term),
imp AS (
  SELECT d, doc_id, term, cast(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms)))
    AS bigint) AS impact FROM post JOIN w USING (term), a),
s AS (
  SELECT item_id, text, d, any_value(doc_id) AS doc_id, cast(sum(impact) AS bigint) AS score
  FROM q JOIN imp USING (term) GROUP BY item_id, text, d HAVING sum(impact) > 0)
SELECT item_id, cast(rank AS integer) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s)
WHERE rank <= {K}
"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fifty best documents for every benchmark item."""
    return search(common.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
