"""Sparse retrieval over posting lists: the exact ``k`` best texts by TF-IDF cosine, without reading every list.

* A text's terms are its runs of letters and digits (A-Z lower-cased). An occurrence weighs
  ``floor(1000 * ln((n + 1) / df))``; the weights of a text are scaled to length :data:`UNIT` and rounded down to whole
  numbers, so that scores are exact sums that depend on no order. A score over ``UNIT * UNIT`` is the cosine.
* :func:`build` numbers the texts, counts terms in blocks of :data:`BLOCK_BYTES` of text and writes a list per block and
  term: no table or shuffle has a row per text and term. Rarities are joined to the terms of each block. The posting
  lists are written in order of (term, part), so that a long list lies in many files, and per term its length and
  greatest weight. Ids of any length appear in results alone.
* :func:`topk` takes three steps. The rarest terms of a question give ``k`` texts whose scores are a lower bound of the
  ``k``-th best. Frequent terms whose greatest contributions together stay below that bound are left out, as a text that
  holds no other term of the question can't be among the best; from the lists that remain only those postings are
  taken whose text could still reach the bound. The sums over them raise the bound, and the texts that can still reach
  it get what the lists left out add to them.
* Lists are joined on (term, part), :data:`PARTS` parts a term, so a word that every text holds fills no task; the terms of
  few questions are broadcast once instead. Rarities reach the counts by a shuffle on the term, those of the at most
  :data:`FREQUENT` most frequent terms by a broadcast: what the driver holds does not grow with the vocabulary, whatever the
  session's bound for broadcasts is.

Rows without an id or without terms are neither indexed nor asked. Texts that share an id stay apart; question
rows that share one are one question. A question gets fewer than ``k`` rows where fewer texts share a term with it that weighs anything. Ties go to the
smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import LOWER, UPPER, terms
from ..plans.sizing import estimated_bytes
from ..session import landed

UNIT = 1_000_000
PARTS = 32
FREQUENT = 4096  # at most so many terms hold more than that part of all counts
ASKED_BYTES = 4 * 1024 * 1024  # of a (compressed) table of questions' terms that is broadcast
WANTED_ROWS = 65536  # of lookups by (term, text) that are broadcast
BLOCK_BYTES = 8 * 1024 * 1024  # of text whose terms are counted together
PROBE_ROWS = 2048  # postings of its rarest terms that give a question its first bound


@dataclass
class PostingIndex:
    """Ids (did, the text's number; id), postings (term, part, base, places, weights; did is base + place), lists (term, df,
    idf, top)."""

    ids: DataFrame
    postings: DataFrame
    lists: DataFrame


def _counted(rows: DataFrame, id_col: str, text_col: str, name: str) -> DataFrame:
    """(name, term, tf)"""
    own = rows.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias(name), F.explode(terms(F.col(text_col))).alias("term"))
    return own.groupBy(name, "term").agg(F.count(F.lit(1)).alias("tf"))


def _part(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(PARTS)).cast("int")


def _in_all_parts(rows: DataFrame) -> DataFrame:
    return rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))


def _rarities(counted: DataFrame, lists: DataFrame) -> DataFrame:
    """``counted`` plus idf, for the terms that ``lists`` has."""
    share = (lists.agg(F.sum("df").alias("n")).first()["n"] or 0) / FREQUENT
    frequent = F.broadcast(lists.where(F.col("df") > share).select("term", "idf"))
    rare = lists.where(F.col("df") <= share).select("term", "idf")
    others = counted.join(frequent.select("term"), "term", "left_anti")
    return counted.join(frequent, "term").unionByName(others.join(rare.hint("merge"), "term"))


def _weighed(counted: DataFrame, lists: DataFrame, name: str) -> DataFrame:
    """(name, entries): whole weights of the terms of each text, those of 0 left out."""
    raw = _rarities(counted, lists).withColumn("raw", F.col("tf") * F.col("idf")).where("raw > 0")
    square = F.col("raw").cast("decimal(18,0)") * F.col("raw").cast("decimal(18,0)")
    per_text = raw.groupBy(name).agg(F.sqrt(F.sum(square).cast("double")).alias("length"),
                                     F.collect_list(F.struct("term", "raw")).alias("found"))
    weight = lambda e: F.floor((e["raw"] * UNIT).cast("double") / F.col("length"))
    entries = F.transform("found", lambda e: F.struct(e["term"].alias("term"), weight(e).alias("weight")))
    return per_text.select(name, F.filter(entries, lambda e: e["weight"] > 0).alias("entries"))


_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())
_IN_TERM = np.array([b >= 0x80 or chr(b).isdigit() or chr(b).islower() for b in range(256)])  # TERM_PATTERN, byte by byte


def _term_counts(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct terms, and by (term, text): number of the term, place of the text, count), as :func:`terms` parts them."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    edges = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    folded = data[edges[0]:edges[-1]].to_pybytes().translate(_FOLD) if data is not None else b""
    raw, edges = np.frombuffer(folded, np.uint8), edges - edges[0]
    held = _IN_TERM[raw]
    apart = np.zeros(len(raw) + 1, bool)  # no term goes on from the byte before
    apart[1:-1] = ~held[:-1]
    apart[edges] = True
    starts = np.flatnonzero(held & apart[:-1])
    apart[:-2] = ~held[1:]
    apart[-2:] = True
    apart[edges[edges > 0] - 1] = True
    sizes = np.flatnonzero(held & apart[:-1]) + 1 - starts
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    every = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(raw[held]))
    coded = every.dictionary_encode()
    place = np.searchsorted(edges, starts, "right") - 1
    key, tf = np.unique(coded.indices.to_numpy().astype(np.int64) * max(1, len(texts)) + place, return_counts=True)
    term, place = np.divmod(key, max(1, len(texts)))
    return coded.dictionary.cast(pa.string()), term, place, tf


def _lists(counts: np.ndarray, values: np.ndarray) -> pa.Array:
    """The ``values`` in lists of so many."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(values, pa.int32()))


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in runs of at most :data:`BLOCK_BYTES` of text, or of one text."""
    waiting, size = [], 0
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < len(ends):
            done = int(ends[at - 1]) if at else 0
            to = int(np.searchsorted(ends, done + BLOCK_BYTES - size, "right"))
            if to > at or not waiting:
                to = max(at + 1, to)
                waiting.append(batch.slice(at, to - at))
                size, at = size + int(ends[to - 1]) - done, to
            else:
                yield pa.concat_batches(waiting)
                waiting, size = [], 0
    if waiting:
        yield pa.concat_batches(waiting)


def _inverted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(base, term, n, places, tfs, id): a row per block and term, and one without a term per text, with its id."""
    base = TaskContext.get().partitionId() << 40
    names = ["base", "term", "n", "places", "tfs", "id"]
    for block in _sliced(batches):
        ids, size = block.column(0), block.num_rows
        found, term, place, tf = _term_counts(block.column(1))
        df = np.bincount(term, minlength=len(found))
        listed = [pa.array(np.full(len(found), base)), found, pa.array(df, pa.int32()), _lists(df, place), _lists(df, tf),
                  pa.nulls(len(found), ids.type)]
        each, own = np.ones(size, np.int64), np.bincount(place, minlength=size)
        texts = [pa.array(np.full(size, base)), pa.nulls(size, pa.string()), pa.array(own, pa.int32()),
                 _lists(each, np.arange(size)), _lists(each, own), ids]
        yield pa.RecordBatch.from_arrays(listed, names)
        yield pa.RecordBatch.from_arrays(texts, names)
        base += size


def _squares(raw: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Sums of squares by place, each rounded once."""
    most = int(raw.max(initial=0)) ** 2 * int(np.bincount(place).max(initial=0))
    raw = raw if most < 1 << 62 else raw.astype(object)
    sums = np.zeros(int(place.max(initial=-1)) + 1, raw.dtype)
    np.add.at(sums, place, raw * raw)
    return sums.astype(np.float64)


def _block_weights(counts: pa.Table, rarities: pa.Table) -> pa.Table:
    """(term, base, places, weights, top) of a block from (base, term, places, tfs) and (block, word, idf)."""
    counts, rarities = counts.combine_chunks(), rarities.combine_chunks()
    idf = pc.take(rarities["idf"], pc.index_in(counts["term"], rarities["word"])).to_numpy()
    flat = lambda name: np.concatenate([c.flatten().to_numpy() for c in counts[name].chunks]).astype(np.int64)
    row = np.repeat(np.arange(len(idf)), pc.list_value_length(counts["places"]).to_numpy())
    place, raw = flat("places"), flat("tfs") * idf[row]
    weight = np.zeros(len(raw), np.int64)
    some = raw > 0
    weight[some] = np.floor((raw[some] * UNIT).astype(np.float64) / np.sqrt(_squares(raw[some], place[some])[place[some]]))
    row, place, weight = row[weight > 0], place[weight > 0], weight[weight > 0]
    held, at, df = np.unique(row, return_index=True, return_counts=True)
    tops = np.maximum.reduceat(weight, at) if len(at) else weight
    return pa.table([counts["term"].take(pa.array(held)), counts["base"].take(pa.array(held)), _lists(df, place), _lists(df, weight),
                     pa.array(tops, pa.int32())], ["term", "base", "places", "weights", "top"])


def build(corpus: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> PostingIndex:
    """Index every text of ``corpus``; all tables are written to the shared folder."""
    named = corpus.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    inverted = landed(named.mapInArrow(  # numbers are fixed by being written
        _inverted, f"base long, term string, n int, places array<int>, tfs array<int>, id {named.dtypes[0][1]}"), "term-counts")
    counted, texts = inverted.where("term IS NOT NULL"), inverted.where("term IS NULL")
    n = texts.where("n > 0").count()
    idf = F.floor(F.lit(1000.0) * F.log(F.lit(float(n + 1)) / F.col("df")))
    lists = landed(counted.groupBy("term").agg(F.sum("n").alias("df")).withColumn("idf", idf), "terms")
    rarities = _rarities(counted.select("base", "term"), lists).select(F.col("base").alias("block"), F.col("term").alias("word"), "idf")
    weighed = counted.select("base", "term", "places", "tfs").groupBy("base").cogroup(rarities.groupBy("block")).applyInArrow(
        _block_weights, "term string, base long, places array<int>, weights array<int>, top int")
    postings = landed(weighed.withColumn("part", _part("base")).repartition("term", "part").sortWithinPartitions("term", "part"),
                      "postings")
    tops = postings.groupBy("term").agg(F.max("top").cast("long").alias("top"))
    ids = texts.select((F.col("base") + F.get("places", F.lit(0))).alias("did"), "id")
    return PostingIndex(ids, postings.drop("top"), landed(lists.hint("merge").join(tops, "term"), "lists"))


def _unpacked(packed: DataFrame) -> DataFrame:
    """A row (did, weight and the other columns) per text of the posting lists in ``packed``."""
    others = [c for c in packed.columns if c not in ("base", "places", "weights")]
    each = packed.select(*others, "base", "weights", F.posexplode("places").alias("at", "place"))
    return each.select(*others, (F.col("base") + F.col("place")).alias("did"), F.get("weights", "at").cast("long").alias("weight"))


def _asked(questions: DataFrame, index: PostingIndex, q_id: str, q_text: str) -> DataFrame:
    """(qid, term, own, df, bound): the weighty terms of each question, with the most a text can get by each."""
    entries = _weighed(_counted(questions, q_id, q_text, "qid"), index.lists, "qid").select("qid", F.inline("entries"))
    asked = entries.join(index.lists.select("term", "df", "top").hint("merge"), "term").select(
        "qid", "term", F.col("weight").alias("own"), "df", (F.col("weight") * F.col("top")).alias("bound"))
    return landed(asked, "asked")


def _found(asked: DataFrame, index: PostingIndex, within: Column | None = None) -> DataFrame:
    """(qid, did, partial) over the lists of ``asked``; ``within`` picks postings."""
    if estimated_bytes(asked) <= ASKED_BYTES:
        pairs = index.postings.join(F.broadcast(asked), "term")
    else:
        pairs = index.postings.join(_in_all_parts(asked).hint("merge"), ["term", "part"])
    pairs = _unpacked(pairs)
    if within is not None:
        pairs = pairs.where(within)
    return pairs.groupBy("qid", "did").agg(F.sum(F.col("own") * F.col("weight")).alias("partial"))


def _best(scored: DataFrame, k: int, by: str) -> DataFrame:
    w = Window.partitionBy("qid").orderBy(F.col(by).desc(), F.col("did").asc())
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _completed(pairs: DataFrame, light: DataFrame, index: PostingIndex) -> DataFrame:
    """(qid, did, points) of pairs (qid, did, partial): the lists of ``light`` (qid, term, own) add their share, looked up by
    (term, text). How many lookups there are is counted: the planner's estimate knows nothing of the terms of a pair."""
    light = light.select("qid", "term", "own")
    per_q = light.groupBy("qid").agg(F.collect_list(F.struct("term", "own")).alias("rest"))
    wanted = pairs.select("qid", "did").join(per_q, "qid").select("qid", "did", F.inline("rest"))
    sizes = light.groupBy("qid").agg(F.count(F.lit(1)).alias("terms"))
    lookups = pairs.groupBy("qid").agg(F.count(F.lit(1)).alias("texts")).join(sizes, "qid").agg(F.sum(F.col("texts") * F.col("terms")).alias("n"))
    wanted = wanted.hint("broadcast" if (lookups.first()["n"] or 0) <= WANTED_ROWS else "merge")
    lists = index.postings.join(light.select("term").distinct(), "term", "left_semi")
    more = wanted.join(_unpacked(lists.select("term", "base", "places", "weights")), ["term", "did"]).select("qid", "did", (F.col("own") * F.col("weight")).alias("points"))
    return pairs.select("qid", "did", F.col("partial").alias("points")).unionByName(more).groupBy("qid", "did").agg(
        F.sum("points").alias("points"))


def _plan(asked: DataFrame, index: PostingIndex, k: int, probe_rows: int) -> DataFrame:
    """``asked`` plus least (a lower bound of the ``k``-th best score; 0 if unknown), total (of all
    bounds), below (the most that a text can get by this term and all more frequent ones) and light (the most by the lists left out)."""
    rarest = Window.partitionBy("qid").orderBy("df", "term").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = asked.withColumn("before", F.sum("df").over(rarest) - F.col("df"))
    first = _best(_found(ranked.where(F.col("before") < probe_rows).drop("before"), index), k, "partial").select("qid", "did", "partial")
    least = _completed(landed(first, "probe"), ranked.where(F.col("before") >= probe_rows), index).groupBy("qid").agg(
        F.when(F.count(F.lit(1)) == k, F.min("points")).otherwise(0).alias("least"))
    frequent = Window.partitionBy("qid").orderBy(F.col("df").desc(), F.col("term").desc())
    so_far = frequent.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # By Cauchy and Schwarz, no text (of length UNIT at most) gets more by some terms than UNIT times their length.
    length = F.sqrt(F.sum((F.col("own") * F.col("own")).cast("decimal(20,0)")).over(so_far).cast("double"))
    below = F.least(F.sum("bound").over(so_far), F.ceil(length * (UNIT + 1)))
    every = Window.partitionBy("qid")
    planned = asked.join(least, "qid", "left").withColumns({
        "least": F.coalesce("least", F.lit(0)), "below": below, "total": F.sum("bound").over(every)})
    light = F.coalesce(F.max(F.when(F.col("below") < F.col("least"), F.col("below"))).over(every), F.lit(0))
    return landed(planned.withColumn("light", light), "search-plan")


def _read(planned: DataFrame) -> DataFrame:
    return planned.where("below >= least")


def topk(questions: DataFrame, index: PostingIndex, k: int = 4, q_id: str = "query_id", q_text: str = "text",
         probe_rows: int = PROBE_ROWS) -> DataFrame:
    """``(query_id, rank, doc_id, points, score)``: the exact ``k`` best texts per question; ``points`` is the whole
    number behind the cosine ``score``."""
    asked = _asked(questions, index, q_id, q_text)
    planned = _plan(asked, index, k, probe_rows)
    # A text of the best has no posting that fails this, so what it gets here is all that these lists give it.
    within = F.col("own") * F.col("weight") + F.col("total") - F.col("bound") >= F.col("least")
    limits = planned.groupBy("qid").agg(F.first("least").alias("least"), F.first("light").alias("light"))
    pairs = landed(_found(_read(planned), index, within), "search-pairs")
    # Sums over a part of the terms are lower bounds too, mostly better ones.
    raised = _best(pairs, k, "partial").groupBy("qid").agg(F.when(F.count(F.lit(1)) == k, F.min("partial")).alias("reached"))
    limits = limits.join(raised, "qid", "left").withColumn("least", F.greatest("least", F.coalesce("reached", F.lit(0))))
    open_pairs = landed(pairs.join(limits, "qid").where(F.col("partial") + F.col("light") >= F.col("least")).select(
        "qid", "did", "partial"), "open-pairs")
    points = _completed(open_pairs, planned.where("below < least"), index)
    ties = points.withColumn("place", F.rank().over(Window.partitionBy("qid").orderBy(F.col("points").desc()))).where(F.col("place") <= k)
    best = _best(ties.join(index.ids, "did").drop("did").withColumnRenamed("id", "did"), k, "points")
    return best.select(F.col("qid").alias("query_id"), "rank", F.col("did").alias("doc_id"), "points",
                       (F.col("points") / F.lit(float(UNIT) * UNIT)).alias("score"))


def read_share(questions: DataFrame, index: PostingIndex, k: int = 4, q_id: str = "query_id", q_text: str = "text",
               probe_rows: int = PROBE_ROWS) -> float:
    """The part of the postings of all terms asked for that lie in lists which :func:`topk` reads after its probe."""
    planned = _plan(_asked(questions, index, q_id, q_text), index, k, probe_rows)
    row = planned.agg(F.sum(F.when(F.col("below") >= F.col("least"), F.col("df"))).alias("read"), F.sum("df").alias("all")).first()
    return (row["read"] or 0) / row["all"] if row["all"] else 0.0
