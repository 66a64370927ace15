"""Benchmark decontamination: prefix-filtered set join.

An item's windows are its runs of ten words (an item of fewer words is one window); a window
is the set of its positioned shingles. Containment of the whole set in a document is asked
for, so by the prefix-filter principle one necessary shingle per window is enough to find
every candidate: the rarest one in the corpus. The steps:

1. One pass over the texts finds where shingles of the benchmark occur; the words around
   each place go along, nothing else leaves the pass.
2. Shingles are ordered by their corpus counts; each window keeps its rarest as prefix.
3. Places of the prefix shingles are joined with the windows; the length and positional
   bounds (the window must start and end inside the document) leave candidates.
4. Candidates are verified word by word.

Only DataFrame functions are used. The benchmark's shingles are broadcast when their
estimated size is small. Else the places of all shingles are joined with them by shuffle, as
(row, place, hash) alone, and the places found go back to their texts, which move once; results
are the same. A phrase
that a third of all documents share is counted by partial aggregates and joined to a small
table; places of one document meet in one group, which is bounded by the text's length.

Null and empty texts (documents or items) have no words, hence no windows and no hits; the
items digest is then that of the empty string. Equal rows give equal result rows, one each.
Items with equal texts all count; an item without an id marks words as hit, but is not counted
or named. Empty tables give no rows (documents) or no hits (items). A very long text is one row
in the pass, and its places meet in one group. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

NAME = "op5_decontaminate"
WINDOW = 10
SHINGLE = 5

ORACLE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS u, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{common.UPPER}', '{common.LOWER}'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{common.UPPER}', '{common.LOWER}'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
g AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + least({WINDOW}, len(w)) - 1], ' ') AS t,
         least({WINDOW}, len(w)) AS n
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - {WINDOW - 1}, 1))) AS i FROM b WHERE len(w) > 0)),
x AS (
  SELECT u, i, n, array_to_string(w[i:i + n - 1], ' ') AS t
  FROM (SELECT u, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i
        FROM d, (SELECT DISTINCT n FROM g) WHERE len(w) >= n)),
hits AS (SELECT x.u, x.i, x.n, g.item_id FROM x JOIN g ON x.t = g.t AND x.n = g.n),
c AS (SELECT u, count(DISTINCT p) AS n_hit
      FROM (SELECT u, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY u),
m AS (SELECT u, count(s) AS n_items, string_agg(s, ',' ORDER BY s) AS items
      FROM (SELECT DISTINCT u, cast(item_id AS varchar) AS s FROM hits) GROUP BY u)
SELECT d.doc_id, cast(len(d.w) AS bigint) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (u) LEFT JOIN m USING (u)
"""


# Keys of the documents' own rows: even numbers, spread so that they fill no single partition.
OWN_KEYS = 256


def _shingle(words: Column, at: Column, width: int) -> Column:
    """Hash of ``width`` words from position ``at`` (0-based); always odd."""
    return F.xxhash64(*[F.get(words, at + k) for k in range(width)], F.lit(width)).bitwiseOR(F.lit(1))


def windows(benchmark: DataFrame, window: int = WINDOW, item: str = "item_id") -> DataFrame:
    """Distinct windows: (win, words, n, items), ``items`` the ids that have the window."""
    words = benchmark.select(
        F.col(item).cast("string").alias("item"),
        common.split_words(common.fold_ascii(F.coalesce("text", F.lit(""))), common.NOT_ALNUM).alias("all"),
    ).where("size(all) > 0")
    runs = words.select("item", "all", F.explode(
        F.expr(f"sequence(1, greatest(size(all) - {window - 1}, 1))")).alias("i")).select(
        "item", F.expr(f"slice(all, i, {window})").alias("words"))
    return runs.groupBy("words").agg(F.array_sort(F.collect_set("item")).alias("items")).select(
        F.md5(F.concat_ws(" ", "words").cast("binary")).alias("win"), "words",
        F.size("words").alias("n"), "items")


def _spread(base: DataFrame, widths: list[int], *kept: str) -> list[tuple[int, DataFrame]]:
    """Per width k, the places of a document (row, ``kept``, at, hash), ``hash`` that of the shingle there. Place -1,
    with the first width, is the document's own row; its key always finds a partner."""
    spread = base.select("row", *kept, F.size("w").alias("n_words"), "w",
                         F.explode(F.expr("sequence(-1, size(w) - 1)")).alias("at"))
    out = []
    for k in widths:
        keyed = spread.where(f"at + {k} <= n_words" + (" OR at = -1" if k == widths[0] else " AND at >= 0"))
        out.append((k, keyed.withColumn("hash", F.when(F.col("at") >= 0, _shingle(F.col("w"), F.col("at"), k))
                                        .otherwise(2 * F.pmod(F.col("row"), F.lit(OWN_KEYS))))))
    return out


def _with_words_around(found: DataFrame, k, reach: int) -> DataFrame:
    """(row, doc_id, n_words, at, hash, from, around): the words of each place and ``reach`` on both sides."""
    return found.select(
        "row", "doc_id", "n_words", "at", "hash",
        F.when(F.col("at") >= 0, F.greatest(F.col("at") - reach, F.lit(0))).alias("from"),
        F.expr(f"if(at >= 0, slice(w, greatest(at - {reach}, 0) + 1, at - greatest(at - {reach}, 0) + {k} + {reach}), null)")
        .alias("around"))


def _found_by_broadcast(base: DataFrame, wanted: DataFrame, widths: list[int], reach: int, name: str) -> DataFrame:
    places = None
    for k, keyed in _spread(base, widths, "doc_id"):
        found = _with_words_around(common.match(keyed, wanted, ["hash"]), k, reach)
        places = found if places is None else places.unionByName(found)
    return places


def _found_by_shuffle(base: DataFrame, wanted: DataFrame, widths: list[int], reach: int, name: str) -> DataFrame:
    """Only (row, k, at, hash) is joined with the keys; the words come from the written texts afterwards."""
    base = common.staged(base, f"{name}-texts")
    keys = wanted.where("hash % 2 != 0")  # own rows need no partner here
    places = None
    for k, keyed in _spread(base, widths):
        found = common.match(keyed.where("at >= 0").select("row", F.lit(k).alias("k"), "at", "hash"), keys, ["hash"])
        places = found if places is None else places.unionByName(found)
    per_row = places.groupBy("row").agg(F.collect_list(F.struct("k", "at", "hash")).alias("places"))
    none = F.struct(F.lit(widths[0]).alias("k"), F.lit(-1).alias("at"), F.lit(0).cast("long").alias("hash"))
    joined = base.join(per_row, "row", "left").select(
        "row", "doc_id", F.size("w").alias("n_words"), "w",
        F.explode(F.concat(F.array(none), F.coalesce("places", F.array()))).alias("p"))
    return _with_words_around(joined.select("row", "doc_id", "n_words", "w", "p.*"), "k", reach)


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE,
         item: str = "item_id", name: str = "decontaminate", key_type: str = "long") -> DataFrame:
    """Per row of ``docs`` (doc_id, text): (row, doc_id, n_words, spans, items), where ``spans``
    are the (first, past) word positions of window occurrences and ``items`` their item ids."""
    wins = common.staged(windows(benchmark, window, item), f"{name}-windows")
    # Windows shorter than a shingle are shingles of their own width; at most ``shingle`` widths.
    widths = sorted(r[0] for r in wins.select(F.least("n", F.lit(shingle)).alias("k")).distinct().collect())
    if not widths:
        widths = [shingle]
    parts = None
    for k in widths:
        own = wins.where(F.least("n", F.lit(shingle)) == k).select("win", "words", "n", F.explode(
            F.expr(f"sequence(0, n - {k})")).alias("offset")).select(
            "win", "n", "offset", _shingle(F.col("words"), F.col("offset"), k).alias("hash"))
        parts = own if parts is None else parts.unionByName(own)
    grams = common.staged(parts, f"{name}-shingles")
    own_keys = docs.sparkSession.range(OWN_KEYS).select((F.col("id") * 2).alias("hash"))
    wanted = common.staged(grams.select("hash").distinct().unionByName(own_keys), f"{name}-keys")

    base = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast(key_type).alias("doc_id"),
        common.split_words(common.fold_ascii(F.coalesce("text", F.lit(""))), common.NOT_ALNUM).alias("w"))
    find = _found_by_broadcast if common.is_small(wanted) else _found_by_shuffle
    places = find(base, wanted, widths, max(window - 1, 0), name)
    places = common.staged(places, f"{name}-places")

    counts = places.where("at >= 0").groupBy("hash").agg(F.count(F.lit(1)).alias("freq"))
    # The rarest shingle of each window; one that the corpus lacks proves the window absent.
    prefix = grams.join(counts, "hash", "left").groupBy("win").agg(
        F.min(F.struct(F.coalesce("freq", F.lit(0)).alias("freq"), "hash", "offset")).alias("p"))
    probe = common.staged(wins.join(prefix.where("p.freq > 0"), "win").select(
        F.col("p.hash").alias("hash"), F.col("p.offset").alias("offset"), "words", "n", "items"), f"{name}-probe")
    start = F.col("at") - F.col("offset")
    verified = common.match(places.where("at >= 0"), probe, ["hash"]).where(
        (start >= 0) & (start + F.col("n") <= F.col("n_words"))
    ).where(F.expr("slice(around, at - offset - `from` + 1, n) = words")).select(
        "row", "doc_id", F.struct(start.alias("first"), (start + F.col("n")).alias("past")).alias("span"), "items")
    per_doc = verified.groupBy("row").agg(
        F.array_sort(F.collect_set("span")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    return places.where("at = -1").select("row", "doc_id", "n_words").join(per_doc, "row", "left")


def mark(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Per document: words, words hit, items and their digest, contaminated or not."""
    # Spans come sorted: each adds what lies past the furthest end so far.
    n_hit = F.expr("""
        coalesce(aggregate(spans, named_struct('sum', 0, 'past', 0),
            (s, x) -> named_struct('sum', s.sum + greatest(x.past - greatest(x.first, s.past), 0),
                                   'past', greatest(s.past, x.past)), s -> s.sum), 0)""")
    return hits(docs, benchmark, **options).select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), n_hit.cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
    ).withColumn("contaminated", F.col("n_hit") > 0).withColumn(
        "n_items", F.when(F.col("contaminated"), F.col("n_items")).otherwise(F.lit(0).cast("long")))


def remove(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows that hold a window of the benchmark."""
    text = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    # Contamination is a property of the text, so rows are found again by its digest.
    bad = hits(docs.select(text.alias("doc_id"), "text"), benchmark, key_type="string", **options).where(
        "spans IS NOT NULL").select(F.col("doc_id").alias("__bad")).distinct()
    return docs.join(bad, text == F.col("__bad"), "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and items of the benchmark found in every document."""
    return mark(common.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
