"""Line dedup: a log-template tree over all lines of the corpus.

The tree has fixed depth: a line goes by its number of tokens, then by its leading tokens
(a token with a digit counts as a variable), and so reaches a leaf. Within a leaf the other
positions are generalised: a token that few documents have at that position is a variable
field. Lines that agree in the rest share a template; a template that enough documents have,
and of which at least half the tokens are fixed, is recurring, and its lines are dropped.

Only DataFrame functions are used. Leading tokens are counted first, over one hash per document and
combination; only lines whose leading tokens recur are looked at further (a leaf is not more frequent). Counts are partial
aggregates, so a line that a third of all documents hold costs no task more than others.
The set of recurring leaves or forms is broadcast when its files are small, else joined by
shuffle.

Lines of one or two tokens ("Read more") are parsed alike if they hold a letter, but recur only
when ``SHORT_SHARE`` of all documents have them, too. Other short lines (blank ones, braces) are
kept. Null texts are empty: one line, nothing dropped. Equal rows are cleaned alike and count as one
document. An empty table gives no rows. A very long text is one row, like any other; its lines are
rows of their own from the first step on. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

NAME = "op8_line_dedup"
DEPTH = 3
MIN_TOKENS = 3
MIN_DOCS = 10
SHORT_SHARE = 0.001  # of the documents, for lines with fewer than MIN_TOKENS tokens
VARIABLE = "<*>"
BLANKS = " \t\x0b\x0c\r"  # within a line

ORACLE = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, md5(coalesce(text, '')) AS h FROM documents),
u AS (SELECT DISTINCT doc_id, h, t FROM d),
l AS (
  SELECT doc_id, h, i, list_transform(regexp_extract_all(x, '[^\x20\x09-\x0D]+'),
           lambda w: CASE WHEN regexp_matches(w, '[0-9]') THEN '{VARIABLE}' ELSE w END) AS k,
         regexp_matches(x, '\p{{L}}') AS letter
  FROM (SELECT doc_id, h, unnest(string_split(t, chr(10))) AS x,
               unnest(generate_series(1, len(string_split(t, chr(10))))) AS i FROM u)),
f AS (SELECT *, k[1:{DEPTH}] AS lead, len(k) AS n FROM l
      WHERE len(k) >= {MIN_TOKENS} OR (len(k) > 0 AND letter)),
leaf AS (SELECT n, lead FROM f GROUP BY n, lead HAVING count(DISTINCT (doc_id, h)) >= {MIN_DOCS}),
forms AS (SELECT n, lead, k, count(DISTINCT (doc_id, h)) AS docs FROM f JOIN leaf USING (n, lead) GROUP BY n, lead, k),
tok AS (SELECT n, lead, k, docs, unnest(k) AS w, unnest(generate_series(1, len(k))) AS p FROM forms),
fixed AS (SELECT n, lead, p, w FROM tok GROUP BY n, lead, p, w HAVING sum(docs) >= {MIN_DOCS}),
tpl AS (
  SELECT tok.n, tok.lead, tok.k,
         list(CASE WHEN fixed.w IS NULL AND tok.p > {DEPTH} THEN '{VARIABLE}' ELSE tok.w END ORDER BY tok.p) AS template
  FROM tok LEFT JOIN fixed ON tok.n = fixed.n AND tok.lead = fixed.lead AND tok.p = fixed.p AND tok.w = fixed.w
  GROUP BY tok.n, tok.lead, tok.k),
rec AS (
  SELECT n, template FROM f JOIN tpl USING (n, lead, k)
  GROUP BY n, template
  HAVING count(DISTINCT (doc_id, h)) >= {MIN_DOCS}
     AND (n >= {MIN_TOKENS} OR count(DISTINCT (doc_id, h)) >= {SHORT_SHARE} * (SELECT count(*) FROM u))
     AND 2 * len(list_filter(template, lambda w: w <> '{VARIABLE}')) >= len(template)),
gone AS (
  SELECT doc_id, h, list(i) AS gone FROM f JOIN tpl USING (n, lead, k) SEMI JOIN rec USING (n, template)
  GROUP BY doc_id, h)
SELECT d.doc_id, cast(len(string_split(t, chr(10))) AS bigint) AS n_lines, coalesce(len(gone), 0) AS n_dropped,
  sha256(coalesce(array_to_string(list_filter(string_split(t, chr(10)),
    lambda x, i: NOT list_contains(coalesce(gone, []), i)), chr(10)), '')) AS kept_sha256
FROM d LEFT JOIN gone ON d.doc_id IS NOT DISTINCT FROM gone.doc_id AND d.h = gone.h
"""


def _masked(words: Column) -> Column:
    """Words of a line as tokens; those with a digit are variables."""
    return F.transform(words, lambda w: F.when(w.rlike("[0-9]"), F.lit(VARIABLE)).otherwise(w))


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once per row, by a generator: a plain one would be computed
    anew wherever it is referred to."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def _lead(line: str, words: str) -> Column:
    """A hash of the leading tokens of a line, null for lines that are kept anyway. All lines of a leaf share it, and
    it needs no more of the line than those ``words``."""
    word = [F.get(words, F.lit(i)) for i in range(DEPTH)]
    tokens = [F.when(w.rlike("[0-9]"), F.lit(VARIABLE)).otherwise(w) for w in word]
    return F.when((F.size(words) >= MIN_TOKENS) | F.col(line).rlike(r"\p{L}"), F.xxhash64(*tokens))


def recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS, short_share: float = SHORT_SHARE) -> DataFrame:
    """(doc_id, h, gone): numbers (from 0) of the lines to drop, per distinct (doc_id, text)
    with ``h`` a hash of the text, which tells apart rows that share their doc_id."""
    text = F.coalesce("text", F.lit(""))
    lines = docs.select("doc_id", F.xxhash64(text).alias("h"), F.posexplode(F.split(text, "\n")).alias("i", "line"))
    lines = _once(lines, "words", F.split(F.btrim("line", F.lit(BLANKS)), common.SPACES, DEPTH + 1))
    lines = lines.select("doc_id", "h", "i", "line", _lead("line", "words").alias("lead"))
    # No filter on ``lead`` before this aggregate: the optimizer would compute it twice.
    per_doc = lines.groupBy("doc_id", "h", "lead").agg(F.lit(1).alias("one"))
    leads = common.staged(per_doc.groupBy("lead").agg(F.count(F.lit(1)).alias("docs")).where(
        F.col("lead").isNotNull() & (F.col("docs") >= min_docs)).select("lead"), "line-leads")
    # All tokens are looked at only in lines whose leading tokens recur.
    held = _once(common.match(lines, leads, ["lead"]), "tokens",
                 _masked(common.split_words(F.col("line"), common.SPACES)))
    held = common.staged(held.select(
        "doc_id", "h", "i", F.xxhash64(F.size("tokens"), F.slice("tokens", 1, DEPTH)).alias("leaf"), "tokens",
        F.md5(F.to_json("tokens").cast("binary")).alias("form")), "lines")
    n_docs = docs.select("doc_id", F.xxhash64(text).alias("t")).distinct().count()

    forms = held.select("doc_id", "h", "leaf", "form").distinct().groupBy("leaf", "form").agg(
        F.count(F.lit(1)).alias("docs")).join(
        held.groupBy("leaf", "form").agg(F.min("tokens").alias("tokens")), ["leaf", "form"])
    fields = forms.select("leaf", "form", "docs", F.posexplode("tokens").alias("p", "token"))
    fixed = fields.groupBy("leaf", "p", "token").agg(F.sum("docs").alias("docs")).where(
        F.col("docs") >= min_docs).select("leaf", "p", "token", F.lit(True).alias("fixed"))
    field = F.when((F.col("p") >= DEPTH) & F.col("fixed").isNull(), F.lit(VARIABLE)).otherwise(F.col("token"))
    templates = fields.join(fixed, ["leaf", "p", "token"], "left").groupBy("leaf", "form").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("p", field.alias("t")))), lambda x: x["t"]).alias("template"))
    templates = common.staged(templates.where(
        2 * F.size(F.filter("template", lambda t: t != VARIABLE)) >= F.size("template")
    ).select("form", F.md5(F.to_json("template").cast("binary")).alias("template"),
             (F.size("template") < MIN_TOKENS).alias("short")), "line-templates")

    own = common.match(held.select("doc_id", "h", "i", "form"), templates, ["form"])
    enough = F.when(F.col("short"), F.col("docs") >= short_share * n_docs).otherwise(F.lit(True))
    recurring = own.select("doc_id", "h", "template", "short").distinct().groupBy("template", "short").agg(
        F.count(F.lit(1)).alias("docs")).where((F.col("docs") >= min_docs) & enough).select("template")
    recurring = common.staged(recurring, "line-recurring")
    return common.match(own, recurring, ["template"], "left_semi").groupBy("doc_id", "h").agg(
        F.collect_set("i").alias("gone"))


def drop_recurring(docs: DataFrame, min_docs: int = MIN_DOCS, short_share: float = SHORT_SHARE) -> DataFrame:
    """(doc_id, n_lines, n_dropped, text): every document without its recurring lines."""
    gone = recurring_lines(docs, min_docs, short_share).select(F.col("doc_id").alias("of"), F.col("h").alias("of_h"), "gone")
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("h"))
    joined = rows.join(gone, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("h") == F.col("of_h")), "left")
    lines = F.split("text", "\n")
    kept = F.filter(lines, lambda x, i: ~F.array_contains("gone", i))
    return joined.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_gone"), "gone",
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
    ).select("doc_id", "n_lines", F.when(F.col("gone").isNull(), 0).otherwise(F.col("n_gone")).cast("long")
             .alias("n_dropped"), "text")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines, dropped lines and the digest of what is left, for every document."""
    out = drop_recurring(common.documents(spark, sf_dir))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
