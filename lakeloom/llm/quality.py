"""Quality rules: line-first cleaning.

Rules judge lines, not documents: a line fails when it has no word of two letters or digits,
when symbols make up too much of it, when it is mostly punctuation, when it is a navigation
strip (several short cells between separators), or when it holds a stock phrase of web pages
(cookie notice, script warning, ...) in any case. Failing lines are removed, and a document that
would lose more than ``MAX_LOST`` of its word characters is rejected. On top, two document rules
hold: too few words, or too many words in repeated eight-word windows.

Only DataFrame functions are used, row by row, without a shuffle; a long text costs n log n.
Null texts count as empty (no words: rejected). Repeated rows are judged alike. An empty table
gives no rows. Extra columns are kept by ``clean``, whatever their names, and ignored by the query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

NAME = "op7_quality"
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
MAX_LOST = 0.5  # of the word characters, by removed lines
SYMBOLS = "#*$%&|<>"
MAX_SYMBOL_SHARE = 0.15  # of a line's characters
BLANKS = " \t\x0b\x0c\r"  # within a line
MAX_PUNCT_SHARE = 0.5  # of a line's characters other than blanks, by ASCII punctuation
PUNCTUATION = r"[!-/:-@\[-`{-~]+"
# A navigation strip: at least this many cells, all short, between the separators.
NAV_CELLS = 4
NAV_CELL_CHARS = 24
NAV_SEPARATORS = "|»›•"
NAV_ARROWS = (">>", " > ")
# Stock phrases of web pages, in lower case.
STOCK_PHRASES = (
    "accept all cookies", "this site uses cookies", "this website uses cookies", "we use cookies", "enable javascript",
    "javascript is disabled", "click here to subscribe", "subscribe to our newsletter", "skip to content",
    "skip to main content", "back to top", "share this page", "share this article", "lorem ipsum",
)
ORACLE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS u, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         string_split(coalesce(text, ''), chr(10)) AS l
  FROM documents),
wins AS (
  SELECT u, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS x
  FROM (SELECT u, w, unnest(generate_series(1, len(w) - {WINDOW - 1})) AS i FROM d WHERE len(w) >= {WINDOW})),
rep AS (
  SELECT u, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT u, unnest(generate_series(i, i + {WINDOW - 1})) AS p
        FROM (SELECT u, i, count(*) OVER (PARTITION BY u, x) AS c FROM wins) WHERE c > 1) GROUP BY u),
lines AS (
  SELECT u, unnest(l) AS line FROM d),
judged AS (
  SELECT u, line,
    length(array_to_string(regexp_extract_all(line, '[^\x20\x09-\x0D]+'), '')) AS chars,
    length(line) - length(translate(line, '{SYMBOLS}', '')) > {MAX_SYMBOL_SHARE} * length(line) AS symbols,
    NOT regexp_matches(line, '[A-Za-z0-9\x{{80}}-\x{{10FFFF}}]{{2}}') AS no_word,
    length(line) - length(regexp_replace(line, '{PUNCTUATION}', '', 'g'))
      > {MAX_PUNCT_SHARE} * length(regexp_replace(line, '{common.SPACES}', '', 'g')) AS punctuation,
    len(list_filter({list(STOCK_PHRASES)}, lambda p: contains(
      translate(line, '{common.UPPER}', '{common.LOWER}'), p))) > 0 AS stock,
    string_split(translate(replace(replace(line, '{NAV_ARROWS[0]}', '{NAV_SEPARATORS[0]}'), '{NAV_ARROWS[1]}',
      '{NAV_SEPARATORS[0]}'), '{NAV_SEPARATORS}', '{NAV_SEPARATORS[0] * len(NAV_SEPARATORS)}'), '{NAV_SEPARATORS[0]}') AS cells
  FROM lines),
verdicts AS (
  SELECT u, sum(chars) AS chars, sum(CASE WHEN
      chars > 0 AND (symbols OR no_word OR punctuation OR stock
        OR (len(cells) >= {NAV_CELLS} AND len(list_filter(cells, lambda c: length(trim(c, ' ')) > {NAV_CELL_CHARS})) = 0))
      THEN chars ELSE 0 END) AS lost,
    count(*) FILTER (chars > 0) - count(DISTINCT line) FILTER (chars > 0) AS n_dup_lines
  FROM judged GROUP BY u),
o AS (
  SELECT doc_id, cast(len(w) AS bigint) AS n_words, cast(length(array_to_string(w, '')) AS bigint) AS word_chars,
    cast(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS bigint) AS n_symbols,
    n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, lost, v.chars
  FROM d JOIN verdicts v USING (u) LEFT JOIN rep USING (u))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) AS base_failed,
  NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words)
    AND lost <= {MAX_LOST} * chars AS kept
FROM o
"""


def _symbols(text: Column) -> Column:
    """Number of symbols in ``text`` (plain replacing costs far less than a pattern)."""
    rest = text
    for c in SYMBOLS:
        rest = F.replace(rest, F.lit(c), F.lit(""))
    return F.length(text) - F.length(rest)


def _has_word(line: Column) -> Column:
    return F.length(F.trim(line, F.lit(BLANKS))) > 0


def _any_of(line: Column, parts) -> Column:
    found = F.lit(False)
    for part in parts:
        found = found | F.contains(line, F.lit(part))
    return found


def _suspicion(text: Column, lowered: Column, n_symbols: Column) -> Column:
    """What a whole text holds at all, so that its lines are spared the other rules."""
    return F.struct((n_symbols > 0).alias("symbols"), _any_of(text, (*NAV_SEPARATORS, *NAV_ARROWS)).alias("nav"),
                    _any_of(lowered, STOCK_PHRASES).alias("stock"))


def line_fails(line: Column, suspicion: Column) -> Column:
    """Whether a line with at least one word is to be removed."""
    unified = line
    for c in (*NAV_ARROWS, *NAV_SEPARATORS[1:]):
        unified = F.replace(unified, F.lit(c), F.lit(NAV_SEPARATORS[0]))
    cells = F.split(unified, "[" + NAV_SEPARATORS[0] + "]")
    strip = (F.size(cells) >= NAV_CELLS) & F.forall(cells, lambda c: F.length(F.trim(c)) <= NAV_CELL_CHARS)
    many = _symbols(line) > MAX_SYMBOL_SHARE * F.length(line)
    no_word = ~line.rlike(r"[A-Za-z0-9[^\x00-\x7F]]{2}")
    solid = F.length(F.regexp_replace(line, common.SPACES, ""))
    punct = F.length(line) - F.length(F.regexp_replace(line, PUNCTUATION, ""))
    stock = common.fold_ascii(line).rlike("|".join(STOCK_PHRASES))
    return (no_word | F.when(suspicion["symbols"], many).otherwise(False)
            | (punct > MAX_PUNCT_SHARE * solid)
            | F.when(suspicion["nav"], strip).otherwise(False)
            | F.when(suspicion["stock"], stock).otherwise(False))


def _next(words: str, n: int) -> str:
    return ", ".join(f"{words}[i + {k}]" for k in range(n))


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with the base counts, ``lost`` (word characters in failing lines) and the verdicts."""
    text = F.coalesce("text", F.lit(""))
    own = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lost", "base_failed", "kept")
    rows = docs.drop(*[c for c in docs.columns if c.lower() in own])
    lines = F.filter(F.split(text, "\n"), _has_word)
    rows = rows.withColumn("__words", common.split_words(F.col("text"), common.SPACES)).withColumn("__lines", lines)
    rows = rows.withColumn("n_symbols", _symbols(text).cast("long"))
    rows = rows.withColumn("__lowered", common.fold_ascii(text))
    rows = rows.withColumn("__suspicion", _suspicion(text, F.col("__lowered"), F.col("n_symbols")))
    # Windows are compared by 64-bit hashes within one text. A window found twice repeats each of
    # its runs of half its length, so most texts are done after counting those. In the others,
    # places of windows that occur again have an equal neighbour in the sorted (hash, place) list.
    half = WINDOW // 2
    rows = rows.withColumn("__codes", F.transform("__words", lambda w: F.xxhash64(w)))
    rows = rows.withColumn("__halves", F.expr(
        f"if(size(__codes) > {WINDOW}, transform(sequence(0, size(__codes) - {half}), i -> "
        f"xxhash64({_next('__codes', half)})), cast(array() AS array<bigint>))"))
    rows = rows.withColumn("__hashes", F.expr(
        f"if(size(__halves) - size(array_distinct(__halves)) > {half}, transform(sequence(0, size(__codes) - {WINDOW}),"
        f" i -> xxhash64({_next('__codes', WINDOW)})), cast(array() AS array<bigint>))"))
    rows = rows.withColumn("__sorted", F.expr(
        "if(size(array_distinct(__hashes)) < size(__hashes),"
        " array_sort(transform(__hashes, (h, i) -> named_struct('h', h, 'i', i))),"
        " cast(array() AS array<struct<h:bigint,i:int>>))"))
    rows = rows.withColumn("__places", F.expr(
        "array_sort(transform(filter(__sorted, (x, k) -> x.h = __sorted[greatest(k - 1, 0)].h AND k > 0"
        " OR x.h = __sorted[least(k + 1, size(__sorted) - 1)].h AND k < size(__sorted) - 1), x -> x.i))"))
    covered = F.expr(
        f"aggregate(__places, named_struct('sum', 0L, 'past', 0), (s, p) -> named_struct("
        f"'sum', s.sum + p + {WINDOW} - greatest(p, s.past), 'past', p + {WINDOW}), s -> s.sum)")
    chars = F.length(F.array_join("__words", "")).cast("long")
    lost = F.aggregate(F.filter("__lines", lambda x: line_fails(x, F.col("__suspicion"))), F.lit(0).cast("long"),
                       lambda s, x: s + F.length(F.regexp_replace(x, common.SPACES, "")))
    n_words = F.size("__words").cast("long")
    out = rows.withColumns({
        "n_words": n_words, "word_chars": chars,
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "n_repeat_words": covered.cast("long"), "lost": lost,
    })
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("lost") <= MAX_LOST * F.col("word_chars"))
    ).drop("__words", "__lines", "__lowered", "__codes", "__suspicion", "__halves", "__hashes", "__sorted", "__places")


def clean(docs: DataFrame) -> DataFrame:
    """``docs`` without rejected documents and without the failing lines of the others."""
    rows = measured(docs.select(F.col("text"), F.struct("*").alias("__row")))
    # Rows leave by a generator: a filter would be pushed below the steps that compute its input,
    # each repeated wherever it is used.
    kept = rows.select(F.explode(F.when(F.col("kept"), F.array(
        F.struct("__row", "lost", _suspicion(
            F.col("text"), common.fold_ascii(F.col("text")), F.col("n_symbols")).alias("suspicion")))
    ).otherwise(F.array())).alias("x")).select("x.*")
    passing = F.filter(F.split("__row.text", "\n"), lambda x: ~_has_word(x) | ~line_fails(x, F.col("suspicion")))
    text = F.when(F.col("lost") > 0, F.array_join(passing, "\n")).otherwise(F.col("__row.text"))
    return kept.withColumn("__text", text).select(
        *[(F.col("__text") if c == "text" else F.col(f"__row.`{c}`")).alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdicts of every document."""
    return measured(common.documents(spark, sf_dir)).select(
        F.col("doc_id").cast("long").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "kept")
