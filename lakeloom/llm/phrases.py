"""Phrase collocation mining: best-first growth of phrases under admissible score bounds.

Texts fall into pieces at punctuation and pieces into words. A phrase of two to
``MAX_WORDS`` words that occurs ``min_count`` times in its language is a candidate. Cutting
it after its first k words gives the counts l and r of both parts, and the score
floor(2000000 * a / (l + r)); its lowest cut counts. A candidate is dropped if a longer one
holds it with at least ``COVER_PERCENT`` of its occurrences. (A longer one that does so
holds one with just one more word that does, so extensions by one word decide.)

Growth. Whatever grows from a phrase p as its first words has at most p's count, and each
cut inside p keeps its l, so 2000000 * a / (l + a) of p bounds all that grows from it; the same
with r for what grows to the left. A bar per language, the score of its best pairs at some
rank, says which phrases of the frontier are expanded: those whose bound reaches it, and
those whose own score does, because their extensions decide whether they stay. All phrases at
or above the bar are then known with their fate. If at least ``top`` of them survive,
the language is settled, ties included; the others go on with a lower bar, at last with none.
Single words have no bound below the greatest score, so pairs of frequent words are all
counted.

Spark. A round is a scan of the texts per phrase length: tasks count phrases in blocks of
bounded bytes, a shuffle adds the counts up by (language, phrase). Which occurrences
are worth counting is looked up in a sieve, one byte per hash slot of all phrases to be grown, whose
size is bounded (``SIEVE_BITS``); a slot shared by chance costs a count that the exact counts afterwards
discard, never a result. Counts, scores and drops are joins and aggregates over exact phrases.
Scores are whole-number division of decimals.

Null texts are empty; a null language counts as ``und``. Repeated rows count each. An empty table,
or a language without candidates, gives no rows. A very long text is a block of its
own. Other columns are ignored, whatever their names. Equal scores are ordered by count, then
by the phrase's UTF-8 bytes.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common, tokens

NAME = "op12_phrases"
TOP = 2000
MIN_COUNT = 30
MAX_WORDS = 4
COVER_PERCENT = 80
SCALE = 2000000
UNKNOWN = "und"
# Ranks, as multiples of ``top``, whose scores are the bars in turn; after them no bar.
BAR_RANKS = (4, 64)
SIEVE_BITS = (16, 26)  # least and most slots, as powers of two; one byte each
CHUNK_BITS = 16  # slots per row while a sieve is put together
GROWS_RIGHT, GROWS_LEFT, STANDS, KNOWN = 1, 2, 4, 8
COUNTS = "lang string, phrase string, a long"

# Spaces and tabs part words; punctuation and line ends part pieces.
TABLE = tokens.byte_table([0x09], [*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D])
_FACTORS = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3], np.uint64)


def _phrase_hashes(words: list[np.ndarray], lang: np.ndarray) -> np.ndarray:
    total = lang.copy()
    for h, factor in zip(words, _FACTORS):
        total = total + h * factor
    return tokens.mix(total)


def _lang_hash(lang: str) -> np.uint64:
    return np.uint64(zlib.crc32(lang.encode()))


# ---- counting ---------------------------------------------------------------------------

def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """(language, texts) in blocks of bounded bytes."""
    held: dict[str, list[bytes]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
            held.setdefault(lang, []).append(text)
            size += len(text) + 1
            if size >= tokens.BLOCK_BYTES:
                yield from held.items()
                held, size = {}, 0
    yield from held.items()


def _distinct(columns: list[np.ndarray], n_words: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of word numbers, column by column, and how often each occurs."""
    key, seen = columns[0], []
    for column in columns[1:-1]:
        found, key = np.unique(key * n_words + column, return_inverse=True)
        seen.append(found)
    found, counts = np.unique(key * n_words + columns[-1], return_counts=True)
    out = []
    for before in [*reversed(seen), None]:
        found, own = np.divmod(found, n_words)
        out.append(own)
        found = before[found] if before is not None else found
    return [found, *reversed(out)], counts


def _wanted(words: tokens.Words, size: int, sieve: np.ndarray, lang: str) -> np.ndarray:
    """First places of the occurrences of ``size`` words that are worth counting."""
    place = np.arange(max(len(words.code) - size + 1, 0))
    place = place[words.piece[place] == words.piece[place + size - 1]]
    if not len(place):
        return place
    own = tokens.hashes(words.vocabulary)
    shift = np.uint64(64 - int(sieve.size).bit_length() + 1)
    short = size - 1
    if short == 1:
        by_word = sieve[_phrase_hashes([own], np.full(len(own), _lang_hash(lang))) >> shift]
        return place[(by_word[words.code[place]] != 0) & (by_word[words.code[place + 1]] != 0)]
    # Parts of one word less, at the places where they begin.
    starts = np.unique(np.concatenate((place, place + 1)))
    found = np.zeros(len(words.code), np.uint8)
    found[starts] = sieve[_phrase_hashes(
        [own[words.code[starts + i]] for i in range(short)], np.full(len(starts), _lang_hash(lang))) >> shift]
    left, right = found[place], found[place + 1]
    both = (left != 0) & (right != 0)
    forward, backward = (left & GROWS_RIGHT) != 0, (right & GROWS_LEFT) != 0
    # What holds a phrase that stands decides its fate, even if its other part was below the bar and not counted.
    stands = ((left | right) & STANDS) != 0
    return place[both & (forward & backward if size == MAX_WORDS else forward | backward) | stands]


def _counter(size: int, sieve):
    """Counts of phrases of ``size`` words per block; for single words also, with a null phrase, all words."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = sieve.value if sieve is not None else None
        for lang, texts in _rows(batches):
            words = tokens.words(texts, TABLE)
            if not len(words.code):
                continue
            names = words.vocabulary.cast(pa.string())
            if size == 1:
                counts = np.bincount(words.code, minlength=len(names))
                phrases = pa.concat_arrays([names, pa.array([None], pa.string())])
                counts = np.append(counts, len(words.code))
            else:
                place = _wanted(words, size, slots, lang)
                if not len(place):
                    continue
                parts, counts = _distinct([words.code[place + i] for i in range(size)], len(names))
                phrases = pc.binary_join_element_wise(*[names.take(pa.array(p)) for p in parts], " ")
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang]).take(pa.array(np.zeros(len(counts), np.int64))), phrases,
                 pa.array(counts, pa.int64())], ["lang", "phrase", "a"])
    return count


def _count(texts: DataFrame, size: int, sieve, min_count: int) -> DataFrame:
    found = texts.mapInArrow(_counter(size, sieve), COUNTS).groupBy("lang", "phrase").agg(F.sum("a").alias("a"))
    return common.staged(found.where(F.col("phrase").isNull() | (F.col("a") >= min_count)), f"phrases-{size}")


# ---- sieve ------------------------------------------------------------------------------

def _slots(bits: int):
    def slot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            words = tokens.words(batch.column(1).cast(pa.binary()).to_pylist(), bytes(range(256)))
            own = tokens.hashes(words.vocabulary)[words.code]
            first = np.searchsorted(words.text, np.arange(batch.num_rows))
            n = len(own) // batch.num_rows  # one length per table
            langs = batch.column(0).dictionary_encode()
            lang = np.array([_lang_hash(x) for x in langs.dictionary.to_pylist()], np.uint64)[langs.indices.to_numpy()]
            at = _phrase_hashes([own[first + i] for i in range(n)], lang) >> np.uint64(64 - bits)
            yield pa.RecordBatch.from_arrays(
                [pa.array((at >> np.uint64(CHUNK_BITS)).astype(np.int32)),
                 pa.array((at & np.uint64((1 << CHUNK_BITS) - 1)).astype(np.int32)), batch.column(2)],
                ["chunk", "slot", "flags"])
    return slot


def _pack(table: pa.Table) -> pa.Table:
    chunk = np.zeros(1 << CHUNK_BITS, np.uint8)
    chunk[table["slot"].to_numpy()] = table["flags"].to_numpy()
    return pa.table({"chunk": table["chunk"][:1], "data": pa.array([zlib.compress(chunk.tobytes(), 1)], pa.binary())})


def _sieve(phrases: DataFrame, flags: Column):
    """A broadcast array of at most 2 ** SIEVE_BITS[1] bytes: the flags of all ``phrases`` of a hash slot."""
    spark = phrases.sparkSession
    rows = phrases.select("lang", "phrase", flags.cast("int").alias("flags"))
    bits = min(max(math.ceil(math.log2(8 * phrases.count() + 1)), SIEVE_BITS[0]), SIEVE_BITS[1])
    packed = (rows.mapInArrow(_slots(bits), "chunk int, slot int, flags int")
              .groupBy("chunk", "slot").agg(F.bit_or("flags").alias("flags"))
              .groupBy("chunk").applyInArrow(_pack, "chunk int, data binary"))
    whole = np.zeros(1 << bits, np.uint8)
    for row in packed.toLocalIterator():
        start = row["chunk"] << CHUNK_BITS
        whole[start:start + (1 << CHUNK_BITS)] = np.frombuffer(zlib.decompress(row["data"]), np.uint8)
    return spark.sparkContext.broadcast(whole)


# ---- scores and drops -------------------------------------------------------------------

def _whole(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("decimal(19,0)")


def _at_least(a: Column, parts: Column, bar: Column) -> Column:
    """Whether SCALE * a / parts reaches the bar."""
    return _whole(a) * F.lit(SCALE).cast("decimal(7,0)") >= _whole(parts) * bar.cast("decimal(8,0)")


def _scored(phrases: DataFrame, shorter: dict[int, DataFrame], size: int, bars: DataFrame | None = None) -> DataFrame:
    """Phrases of ``size`` words with l, r and score of their lowest cut; with ``bars``, also whether what
    grows to the right or left of them may reach the bar. Phrases with a part that was not counted
    (its bound lies below the bar, so theirs does) are left out."""
    rows = phrases if bars is None else common.match(phrases, bars, ["lang"])
    own = rows.columns
    for k in range(1, size):
        for name, part, n in (("l", F.substring_index("phrase", " ", k), k),
                              ("r", F.substring_index("phrase", " ", k - size), size - k)):
            side = shorter[n].select("lang", F.col("phrase").alias("__part"), F.col("a").alias(f"{name}{k}"))
            rows = common.match(rows.withColumn("__part", part), side, ["lang", "__part"]).drop("__part")
    cuts = F.array(*[F.struct(
        F.expr(f"(cast({SCALE} as decimal(7,0)) * cast(a as decimal(19,0))) div "
               f"(cast(l{k} as decimal(19,0)) + cast(r{k} as decimal(19,0)))").alias("score"),
        F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")) for k in range(1, size)])
    rows = rows.withColumn("__cut", F.array_min(cuts))
    found = [*own, "__cut.l", "__cut.r", "__cut.score"]
    if bars is None:
        return rows.select(*found)
    bounds = {"grows_right": "l", "grows_left": "r"}
    for flag, side in bounds.items():
        reach = F.lit(True)
        for k in range(1, size):
            reach = reach & _at_least(F.col("a"), F.col(f"{side}{k}") + F.col("a"), F.col("bar"))
        rows = rows.withColumn(flag, reach)
    return rows.select(*found, *bounds)


def _flags() -> Column:
    return (F.lit(KNOWN) + F.when(F.col("grows_right"), GROWS_RIGHT).otherwise(0)
            + F.when(F.col("grows_left"), GROWS_LEFT).otherwise(0)
            + F.when(F.col("score") >= F.col("bar"), STANDS).otherwise(0))


def _covering(longer: DataFrame, size: int) -> DataFrame:
    """(lang, phrase, most): for all parts with one word less, the count of the most frequent phrase around them."""
    parts = longer.select("lang", "a", F.explode(F.array(
        F.substring_index("phrase", " ", size - 1), F.substring_index("phrase", " ", 1 - size))).alias("phrase"))
    return parts.groupBy("lang", "phrase").agg(F.max("a").alias("most"))


def _order() -> Column:
    return F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase")))


def _bars(pairs: DataFrame, rank: int | None) -> DataFrame:
    """(lang, bar): the score of the pair at ``rank``, 0 where there are fewer or ``rank`` is None."""
    langs = pairs.groupBy("lang").agg(F.lit(0).cast("long").alias("none"))
    if rank is None:
        return common.staged(langs.withColumnRenamed("none", "bar"), "phrase-bars")
    best = pairs.select("lang", "score", "a", "phrase", _order().alias("at")).where(F.col("at") <= rank)
    at = best.where(F.col("at") == rank).select("lang", "score")
    return common.staged(langs.join(at, "lang", "left").select(
        "lang", F.coalesce("score", "none").alias("bar")), "phrase-bars")


def _round(texts: DataFrame, counts: dict[int, DataFrame], bars: DataFrame, top: int, min_count: int) -> DataFrame:
    """The first ``top`` survivors per language among phrases that reach the bar, with the bar."""
    counts, held, known = dict(counts), [], []
    for size in range(2, MAX_WORDS + 1):
        if size > 2:
            sieve = _sieve(held[-1], _flags())
            counts[size] = _count(texts, size, sieve, min_count)
            sieve.unpersist()
        held.append(common.staged(_scored(counts[size].select(*COUNT_COLUMNS), counts, size, bars),
                                  f"phrases-scored-{size}"))
        standing = held[-1].where(F.col("score") >= F.col("bar"))
        known.append((size, standing))
    survivors = None
    for size, standing in known:
        if size < MAX_WORDS:
            around = common.staged(_covering(counts[size + 1], size + 1), "phrases-around")
            standing = common.match(standing, around, ["lang", "phrase"], "left").where(
                F.col("most").isNull() | (_whole("most") * 100 < _whole("a") * COVER_PERCENT))
        standing = standing.select("lang", "bar", "phrase", "a", "l", "r", "score")
        survivors = standing if survivors is None else survivors.unionByName(standing)
    return common.staged(survivors.withColumn("rank", _order()).where(F.col("rank") <= top), "phrases-best")


COUNT_COLUMNS = ("lang", "phrase", "a")


def mine(docs: DataFrame, top: int = TOP, min_count: int = MIN_COUNT) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best surviving phrases of every language."""
    texts = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    common.small_batches(docs.sparkSession)
    words = _count(texts, 1, None, min_count)
    totals = words.where(F.col("phrase").isNull()).select("lang", F.col("a").alias("n"))
    words = words.where(F.col("phrase").isNotNull())
    sieve = _sieve(words, F.lit(KNOWN))
    pairs = _count(texts, 2, sieve, min_count)
    sieve.unpersist()
    counts = {1: words, 2: pairs}
    open_pairs, done = common.staged(_scored(pairs, counts, 2), "phrases-pairs"), None
    for share in (*BAR_RANKS, None):
        bars = _bars(open_pairs, share and share * top)
        if done is not None:
            texts = common.match(texts, bars.select("lang"), ["lang"], "left_semi")
            counts[2] = open_pairs.select(*COUNT_COLUMNS)
        best = _round(texts, counts, bars, top, min_count)
        # Settled: no bar, or enough survivors at or above it.
        ended = common.staged(bars.join(best.where(F.col("rank") == top).select("lang", "rank"), "lang", "left").where(
            (F.col("bar") == 0) | F.col("rank").isNotNull()).select("lang"), "phrases-settled")
        settled = common.match(best, ended, ["lang"], "left_semi")
        done = settled if done is None else done.unionByName(settled)
        left = common.match(open_pairs, ended, ["lang"], "left_anti")
        if left.isEmpty():
            break
        open_pairs = common.staged(left, "phrases-pairs")
    return done.join(totals, "lang").select(
        "lang", F.col("rank").cast("int").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE = rf"""
WITH x AS (
  SELECT coalesce(lang, '{UNKNOWN}') AS lang, row_number() OVER () AS doc,
         string_split_regex(translate(coalesce(text, ''), '{common.UPPER}', '{common.LOWER}'),
                            '[.,;:!?\x0A-\x0D]') AS pieces FROM documents),
p AS (SELECT lang, regexp_extract_all(unnest(pieces), '[^\x20\x09]+') AS w FROM x),
total AS (SELECT lang, sum(len(w)) AS n FROM p GROUP BY lang),
g AS (
  SELECT lang, k, unnest(list_transform(generate_series(1, len(w) - k + 1),
                                        lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM p, (SELECT unnest([1, 2, 3, {MAX_WORDS}]) AS k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY lang, k, phrase),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND a >= {MIN_COUNT}),
cut AS (SELECT lang, phrase, k, a, w, unnest(generate_series(1, k - 1)) AS j FROM c),
s AS (
  SELECT cut.lang, cut.phrase, cut.k, cut.a, cut.j, l.a AS l, r.a AS r,
         cast({SCALE} AS hugeint) * cut.a // (l.a + r.a) AS score
  FROM cut JOIN f l ON l.lang = cut.lang AND l.phrase = array_to_string(w[1:j], ' ')
           JOIN f r ON r.lang = cut.lang AND r.phrase = array_to_string(w[j + 1:], ' ')),
low AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inner_parts AS (
  SELECT lang, a, k, unnest(flatten(list_transform(generate_series(2, k - 1), lambda m:
    list_transform(generate_series(1, k - m + 1), lambda i: array_to_string(w[i:i + m - 1], ' '))))) AS part
  FROM c WHERE k > 2),
covered AS (SELECT lang, part, max(a) AS most FROM inner_parts GROUP BY lang, part),
kept AS (
  SELECT low.* FROM low LEFT JOIN covered ON covered.lang = low.lang AND covered.part = low.phrase
  WHERE covered.most IS NULL OR 100 * covered.most < {COVER_PERCENT} * low.a),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT lang, cast(rank AS integer) AS rank, phrase, cast(a AS bigint) AS a, cast(l AS bigint) AS l,
  cast(r AS bigint) AS r, cast(n AS bigint) AS n, cast(score AS bigint) AS score
FROM ranked JOIN total USING (lang) WHERE rank <= {TOP}
"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of every language of ``documents``."""
    return mine(common.documents(spark, sf_dir))
