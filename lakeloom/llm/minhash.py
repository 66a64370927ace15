"""MinHash near-dedup: improved consistent weighted sampling over TF-IDF shingles.

Documents are weighted sets of five-word shingles. A shingle's weight is (1 + ln tf) * idf,
rounded to a geometric grid; idf goes from 1 to 1 + ``IDF_GAIN``, a damped form that lets
boilerplate count less while the similarity of two texts stays close to that of their plain
shingle sets. Document frequencies are counted over the whole corpus in hashed bins.

Each text is sampled by improved consistent weighted sampling: for a sample, every shingle
draws r, c ~ Gamma(2, 1) and b ~ U(0, 1) as functions of the shingle, quantises its weight to
t = floor(ln w / r + b) and scores ln c - r (t - b) - r; the least score wins, and two texts
win with the same (shingle, t) with the probability of their weighted Jaccard similarity. The
draws come from tables addressed by a hash per sample. Samples are banded; texts that agree
in a band are candidates.

Candidates are joined to components first, over links to each band bucket's first text, so
that every candidate's text travels once. Within a component the texts are verified by
weighted Jaccard similarity: all pairs that share a bucket, apart from those already known
to be in one class. A component of more than ``CHUNK`` texts or ``CHUNK_BYTES`` is split: chunks are verified
with common pivots, and texts that do not end up in the main class are held against all
chunks, so no link between different texts is lost.

Equal texts are one text throughout (found by digest), so large groups of copies cost one
row each in narrow tables. Texts of fewer than five words are one shingle; blank, empty and
null texts have none and only equal texts share a class (null counts as empty). Null ids
come first in their class. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .components import components
from .fragments import BYTE_HASH, MULT, NO_ID, gram_hashes, mix

NAME = "op6_minhash"
ORACLE = None  # weighted sampling has no SQL form; tests hold the classes against brute force

SHINGLE = 5
SIMILAR = 0.8
BANDS, ROWS = 20, 4
BINS = 1 << 18
SLICES = 64
IDF_GAIN = 0.25
GRID = 32  # weight steps per factor e
POOL_BITS = 16
CHUNK = 4096  # texts of a component verified together, and
CHUNK_BYTES = 32 << 20  # their bytes (a longer text alone)
PIVOTS = 64
PIECE = 1 << 20  # bytes of text worked on at a time

INVERSE = np.uint64(pow(int(MULT), -1, 1 << 64))
IS_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])


def word_hashes(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of the words of a text, by prefix sums of a polynomial."""
    space = IS_SPACE[text]
    inner = ~space
    starts = np.flatnonzero(inner & np.append(True, space[:-1]))
    ends = np.flatnonzero(inner & np.append(space[1:], True)) + 1
    powers = np.cumprod(np.full(len(text), MULT, np.uint64))
    sums = np.append(np.uint64(0), np.cumsum(BYTE_HASH[text] * powers))
    back = np.cumprod(np.full(len(text), INVERSE, np.uint64))
    return starts, mix((sums[ends] - sums[starts]) * back[starts])


def shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, shingle, times) of the texts' distinct shingles (48-bit hashes), sorted."""
    line = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    bounds = np.cumsum([0, *[len(t) + 1 for t in texts]])
    if len(line) < 2:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64)
    starts, words = word_hashes(line)
    doc = np.searchsorted(bounds, starts, side="right") - 1
    grams = gram_hashes(words, SHINGLE)
    inside = doc[:len(grams)] == doc[SHINGLE - 1:][:len(grams)]
    keys = (doc[:len(grams)][inside].astype(np.uint64) << np.uint64(48)) | (grams[inside] >> np.uint64(16))
    n_words = np.bincount(doc, minlength=len(texts))
    first = np.append(0, np.cumsum(n_words)[:-1])
    short = np.flatnonzero((n_words > 0) & (n_words < SHINGLE))
    few = [(int(i) << 48) | int(gram_hashes(words[first[i]:first[i] + n_words[i]], int(n_words[i]))[0] >> np.uint64(16))
           for i in short]
    keys, times = np.unique(np.concatenate([keys, np.array(few, np.uint64)]), return_counts=True)
    return (keys >> np.uint64(48)).astype(np.int64), keys & np.uint64((1 << 48) - 1), times


def pieces(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about a piece each (a longer text alone; at most 2 ** 16 texts)."""
    a, size = 0, 0
    for i, t in enumerate(texts):
        if i > a and (size + len(t) > PIECE or i - a >= 1 << 16):
            yield a, i
            a, size = i, 0
        size += len(t)
    if a < len(texts):
        yield a, len(texts)


def bin_of(shingle: np.ndarray) -> np.ndarray:
    return (shingle & np.uint64(BINS - 1)).astype(np.int64)


def idf_of_bins(counts: np.ndarray, n_docs: int) -> np.ndarray:
    """idf per bin. A bin's expected share of other shingles is taken off its count."""
    own = np.maximum(counts - (counts.sum() - counts) / (len(counts) - 1), 1)
    return 1 + IDF_GAIN * np.log((n_docs + 1) / (np.minimum(own, n_docs) + 1)) / np.log(n_docs + 1 if n_docs else 2)


def levels(shingle: np.ndarray, times: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Weights as steps of the grid: round(GRID * ln w)."""
    return np.rint(GRID * np.log((1 + np.log(times)) * idf[bin_of(shingle)])).astype(np.int64)


@lru_cache(1)
def _draws() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(11)
    n = 1 << POOL_BITS
    return rng.gamma(2, 1, n), np.log(rng.gamma(2, 1, n)), rng.random(n)


@lru_cache(256)
def _scores(level: int) -> np.ndarray:
    """Scores of all table entries for a weight, as integers of the same order, shifted up."""
    r, ln_c, b = _draws()
    t = np.floor(level / GRID / r + b)
    bits = (ln_c - r * (t - b) - r).astype(np.float32).view(np.uint32)
    ordered = np.where(bits >> 31, ~bits, bits | np.uint32(1 << 31))
    return ordered.astype(np.uint64) << np.uint64(32)


def signatures(doc: np.ndarray, shingle: np.ndarray, level: np.ndarray) -> np.ndarray:
    """Band hashes, one row per distinct text number in ``doc`` (sorted)."""
    starts = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
    used, row = np.unique(level, return_inverse=True)
    table = np.concatenate([_scores(int(x)) for x in used])
    offset = row.astype(np.int64) << POOL_BITS
    low = shingle & np.uint64(0xFFFFFFFF)
    steps = np.random.default_rng(12).integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
    out = np.empty((len(starts), BANDS), np.uint64)
    spread = mix(shingle * MULT)
    for band in range(BANDS):
        acc = np.full(len(starts), band + 1, np.uint64)
        for s in steps[band * ROWS:(band + 1) * ROWS]:
            entry = (spread * s >> np.uint64(64 - POOL_BITS)).astype(np.int64) + offset
            best = np.minimum.reduceat(table[entry] | low, starts)
            acc = mix((acc ^ best) * MULT)
        out[:, band] = acc
    return out


def idf_table(docs: DataFrame) -> np.ndarray:
    """idf per bin, from counts over all documents; the driver gets ``BINS`` numbers."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, n = np.zeros(BINS, np.int64), 0
        for batch in batches:
            texts = [t or b"" for t in batch.column(0).cast(pa.binary()).to_pylist()]
            n += len(texts)
            for a, b in pieces(texts):
                bins += np.bincount(bin_of(shingles(texts[a:b])[1]), minlength=BINS)
        if n:
            width = BINS // SLICES
            yield pa.RecordBatch.from_pydict({
                "slice": list(range(SLICES)), "n": [n] * SLICES,
                "bins": [bins[i * width:(i + 1) * width].astype(np.uint32).tobytes() for i in range(SLICES)]})

    def add(table: pa.Table) -> pa.Table:
        bins = sum(np.frombuffer(x, np.uint32).astype(np.int64) for x in table.column("bins").to_pylist())
        return pa.table({"slice": [table.column("slice")[0].as_py()], "n": [sum(table.column("n").to_pylist())],
                         "bins": [bins.tobytes()]})

    rows = docs.select("text").mapInArrow(count, "slice long, n long, bins binary").groupBy("slice").applyInArrow(
        add, "slice long, n long, bins binary").collect()  # SLICES rows at most
    if not rows:
        return np.ones(BINS)
    bins = np.concatenate([np.frombuffer(r.bins, np.int64) for r in sorted(rows, key=lambda r: r.slice)])
    return idf_of_bins(bins, rows[0].n)


def sign(docs: DataFrame, idf: np.ndarray) -> DataFrame:
    """(doc_id, h, size, bands): digest, bytes and band hashes of each text (none without words)."""
    shared = docs.sparkSession.sparkContext.broadcast(idf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            bands: list = [None] * len(texts)
            for a, b in pieces(texts):
                doc, shingle, times = shingles(texts[a:b])
                if len(doc):
                    found = signatures(doc, shingle, levels(shingle, times, shared.value)).view(np.int64)
                    for i, row in zip(np.unique(doc).tolist(), found):
                        bands[a + i] = row
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "h", "size", "bands"])

    text = F.coalesce("text", F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"),
                       F.md5(text.cast("binary")).alias("h"), text.alias("text")).mapInArrow(
        run, "doc_id long, h string, size long, bands array<long>")


class Texts:
    """Weighted sets of some texts, ready for comparing one with many."""

    def __init__(self, names: list[str], texts: list[bytes], bands: np.ndarray, idf: np.ndarray):
        doc, shingle, level = [], [], []
        for a, b in pieces(texts):
            d, s, times = shingles(texts[a:b])
            doc.append(d + a)
            shingle.append(s)
            level.append(levels(s, times, idf))
        self.names, self.bands = names, bands
        doc = np.concatenate(doc)
        self.weight = np.exp(np.concatenate(level) / GRID)
        own, self.element = np.unique(np.concatenate(shingle), return_inverse=True)
        self.bounds = np.searchsorted(doc, np.arange(len(names) + 1))
        self.total = np.add.reduceat(self.weight, self.bounds[:-1])
        self.dense = np.zeros(len(own))

    def similar(self, i: int, others: np.ndarray) -> np.ndarray:
        """Which of ``others`` have a weighted Jaccard similarity to ``i`` of SIMILAR or more."""
        mine = slice(self.bounds[i], self.bounds[i + 1])
        self.dense[self.element[mine]] = self.weight[mine]
        sizes = self.bounds[others + 1] - self.bounds[others]
        ends = np.cumsum(sizes)
        rows = np.arange(ends[-1]) + np.repeat(self.bounds[others] - ends + sizes, sizes)
        common_ = np.add.reduceat(np.minimum(self.weight[rows], self.dense[self.element[rows]]), ends - sizes)
        self.dense[self.element[mine]] = 0
        return others[common_ >= (SIMILAR - 1e-9) * (self.total[i] + self.total[others] - common_)]


def link_all(texts: Texts) -> Iterator[tuple[int, int]]:
    """Links that join all similar texts sharing a bucket: from each text reached, to those not
    reached yet. Pairs known to be in one class are not compared again."""
    free = np.ones(len(texts.names), bool)
    for seed in range(len(texts.names)):
        if not free[seed]:
            continue
        free[seed] = False
        queue = [seed]
        while queue:
            i = queue.pop()
            open_ = np.flatnonzero(free)
            others = open_[(texts.bands[open_] == texts.bands[i]).any(1)]
            if len(others):
                for j in texts.similar(i, others).tolist():
                    free[j] = False
                    queue.append(j)
                    yield i, j


def link_rest(texts: Texts, rest: np.ndarray, known: np.ndarray) -> Iterator[tuple[int, int]]:
    """Links between ``rest`` texts and all texts of other classes that share a bucket."""
    for i in np.flatnonzero(rest).tolist():
        others = np.flatnonzero((known != known[i]) & (texts.bands == texts.bands[i]).any(1))
        if len(others):
            yield from ((i, j) for j in texts.similar(i, others).tolist())


LINKS = pa.schema([("a", pa.string()), ("b", pa.string())])


def _table_of(table: pa.Table, idf: np.ndarray) -> Texts:
    rows = sorted(zip(table.column("h").to_pylist(), table.column("text").cast(pa.binary()).to_pylist(),
                      table.column("bands").to_pylist()))
    rows = [r for r, p in zip(rows, [None, *rows]) if p is None or p[0] != r[0]]
    return Texts([r[0] for r in rows], [r[1] for r in rows], np.array([r[2] for r in rows], np.int64), idf)


def _as_links(texts: Texts, links) -> pa.Table:
    pairs = [(texts.names[i], texts.names[j]) for i, j in links]
    return pa.table({"a": [p[0] for p in pairs], "b": [p[1] for p in pairs]}, schema=LINKS)


def verified_links(docs: DataFrame, signed: DataFrame, idf: np.ndarray, chunk: int = CHUNK) -> DataFrame:
    """(a, b): digests of similar texts, enough of them to join every class."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(idf)
    texts = signed.where("bands IS NOT NULL").groupBy("h").agg(F.min("doc_id").alias("rep"), F.first("size").alias("size"), F.first("bands").alias("bands"))
    texts = common.staged(texts, "texts")
    buckets = texts.select("h", F.explode("bands").alias("band"))
    heads = buckets.groupBy("band").agg(F.min("h").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1")
    links = buckets.join(heads.hint("merge"), "band").where("h <> head").select(F.col("h").alias("a"), F.col("head").alias("b"))
    stars = components(links)
    roots = stars.select(F.col("root").alias("node"), "root").distinct()
    members = stars.unionByName(roots).select(F.col("node").alias("h"), "root")
    members = members.join(texts.hint("merge"), "h")
    sizes = members.groupBy("root").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / chunk), F.ceil(F.sum("size") / CHUNK_BYTES)).cast("long").alias("chunks"))
    members = common.staged(members.join(sizes.hint("merge"), "root").drop("size").withColumn(
        "chunk", F.expr("pmod(xxhash64(h), chunks)")), "candidates")

    text = F.coalesce("text", F.lit(""))
    own = docs.select(text.alias("text"), F.md5(text.cast("binary")).alias("h"),
                      F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("rep"))

    def with_text(rows: DataFrame) -> DataFrame:
        return common.match(own, rows, ["h", "rep"])

    def inside(table: pa.Table) -> pa.Table:
        found = _table_of(table, shared.value)
        return _as_links(found, link_all(found))

    # Chunks of a large component share some of its texts, about PIVOTS, as pivots.
    large = members.where("chunks > 1")
    copies = large.where(f"pmod(xxhash64(h, 1), greatest(chunks * {chunk} DIV {PIVOTS}, 1)) = 0").withColumn(
        "chunk", F.explode(F.expr("sequence(0L, chunks - 1)")))
    spread = common.staged(copies.select(members.columns), "pivots")
    groups = with_text(members).unionByName(with_text(spread))
    first = common.staged(groups.select("root", "chunk", "h", "text", "bands").groupBy("root", "chunk").applyInArrow(
        inside, "a string, b string"), "links-1")

    if large.limit(1).count() == 0:
        return first
    # Texts outside the main class of a large component meet all chunks.
    stars = components(first)
    known = large.join(stars.select(F.col("node").alias("h"), F.col("root").alias("cls")).hint("merge"), "h", "left").withColumn(
        "cls", F.coalesce("cls", "h"))
    main = known.groupBy("root", "cls").agg(F.count(F.lit(1)).alias("size")).groupBy("root").agg(
        F.max(F.struct("size", "cls")).alias("main"))
    known = common.staged(known.join(main.hint("merge"), "root").withColumn(
        "rest", F.col("cls") != F.col("main.cls")).drop("main"), "known")
    rest = known.where("rest").withColumn("with", F.explode(F.expr("sequence(0L, chunks - 1)")))
    rest_chunks = known.where("rest").select("root", F.col("chunk").alias("of")).distinct()
    every = known.join(rest_chunks.hint("merge"), "root").withColumn("with", F.col("chunk")).withColumn("rest", F.lit(False))
    rest = rest.withColumn("of", F.col("chunk"))
    both = common.staged(rest.unionByName(every.select(rest.columns)), "rest")

    def across(table: pa.Table) -> pa.Table:
        h = table.column("h").to_pylist()
        rest_of = {x for x, r in zip(h, table.column("rest").to_pylist()) if r}
        classes = dict(zip(h, table.column("cls").to_pylist()))
        found = _table_of(table, shared.value)
        codes = np.unique([classes[x] for x in found.names], return_inverse=True)[1]
        return _as_links(found, link_rest(found, np.array([x in rest_of for x in found.names]), codes))

    second = with_text(both).select("root", "of", "with", "h", "text", "bands", "cls", "rest").groupBy(
        "root", "of", "with").applyInArrow(across, "a string, b string")
    return first.unionByName(common.staged(second, "links-2"))


def classes(docs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, h, class_id, stays): the class of every row of ``docs`` (doc_id, text), named by
    its least doc_id; ``stays`` marks the text that represents it."""
    common.small_batches(docs.sparkSession)
    idf = idf_table(docs)
    signed = common.staged(sign(docs, idf), "signed")
    stars = components(verified_links(docs, signed, idf, chunk))
    rows = signed.select("doc_id", "h").join(stars.withColumnRenamed("node", "h").hint("merge"), "h", "left").withColumn(
        "root", F.coalesce("root", "h"))
    least = rows.groupBy("root").agg(F.min(F.struct("doc_id", "h")).alias("least"))
    named = rows.join(least.hint("merge"), "root")
    null_id = lambda c: F.when(c != NO_ID, c)
    return named.select(
        null_id(F.col("doc_id")).alias("doc_id"), "h", null_id(F.col("least.doc_id")).alias("class_id"),
        ((F.col("doc_id") == F.col("least.doc_id")) & (F.col("h") == F.col("least.h"))).alias("stays"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return classes(common.documents(spark, sf_dir)).select("doc_id", "class_id", "stays")


def keep_one(docs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """One row of ``docs`` per class: the row with its least doc_id, once."""
    found = common.staged(classes(docs, chunk).where("stays").groupBy("doc_id", "h").agg(
        F.count(F.lit(1)).alias("n")).select(F.coalesce("doc_id", F.lit(NO_ID)).alias("__id"), F.col("h").alias("__h"), "n"),
        "staying")
    own = docs.withColumn("__id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))).withColumn(
        "__h", F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    once = common.match(own, found.where("n = 1").drop("n"), ["__id", "__h"], "left_semi")
    # Repeated rows meet to leave one.
    again = common.match(own, found.where("n > 1").drop("n"), ["__id", "__h"], "left_semi").dropDuplicates(["__id", "__h"])
    return once.unionByName(again).drop("__id", "__h")
