"""Cited retrieval over posting lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import query
from ..functions.text import LOWER, TERM_PATTERN, UPPER
from ..operators import postings
from ..session import landed
from ..sources.tables import read_table
from .ml import chunk_table
from .text import _id_sql, _pieces_sql, _stop_at_end_sql

_TEXTS = f"""
SELECT {_id_sql("document", "doc_id")} AS text_id, 'doc ' || doc_id AS caption, text FROM documents WHERE length(text) > 0
UNION ALL
SELECT {_id_sql("conversation", "conv_id", "turn")}, role || ' in ' || conv_id, text FROM conversations WHERE length(text) > 0
"""


def _weights(counts: str, key: str) -> str:
    return f"""(
SELECT r.{key}, r.term, CAST(floor(CAST(r.raw * {postings.UNIT} AS DOUBLE) / s.length) AS BIGINT) AS weight
FROM (SELECT c.{key}, c.term, c.tf * i.idf AS raw FROM {counts} c JOIN i USING (term) WHERE i.idf > 0) r
JOIN (SELECT c.{key}, sqrt(CAST(sum(CAST(c.tf * i.idf AS HUGEINT) * (c.tf * i.idf)) AS DOUBLE)) AS length
      FROM {counts} c JOIN i USING (term) WHERE i.idf > 0 GROUP BY c.{key}) s USING ({key}))"""


def _counts(table: str, key: str, text: str) -> str:
    return (f"SELECT {key}, term, count(*) AS tf FROM (SELECT {key}, unnest(regexp_extract_all("
            f"translate({text}, '{UPPER}', '{LOWER}'), '{TERM_PATTERN}')) AS term FROM {table}) GROUP BY ALL")


@query("retrieve_postings", f"""
WITH pieces AS ({_pieces_sql(_stop_at_end_sql(_TEXTS, "text_id, caption"))}),
c AS MATERIALIZED ({_counts("pieces", "piece_id", "piece")}),
q AS ({_counts("benchmark", "item_id", "text")}),
i AS MATERIALIZED (SELECT term, CAST(floor(1000 * ln(CAST((SELECT count(DISTINCT piece_id) FROM c) + 1 AS DOUBLE) / count(*))) AS BIGINT) AS idf
      FROM c GROUP BY term),
d AS MATERIALIZED {_weights("c", "piece_id")},
a AS MATERIALIZED {_weights("q", "item_id")},
s AS (SELECT a.item_id, d.piece_id, CAST(sum(a.weight * d.weight) AS BIGINT) AS points FROM a JOIN d USING (term)
      GROUP BY ALL HAVING sum(a.weight * d.weight) > 0),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY points DESC, piece_id) AS rank FROM s),
h AS (SELECT r.*, p.caption FROM r JOIN pieces p USING (piece_id) WHERE rank <= 4)
SELECT item_id, string_agg('[' || rank || '] ' || caption || ' (' || piece_id || ', ' || points || ')', chr(10) || chr(10) ORDER BY rank) AS context,
       list(piece_id ORDER BY rank) AS sources, max(points) / {float(postings.UNIT) * postings.UNIT!r} AS top_score
FROM h GROUP BY item_id
""")
def retrieve_postings(spark, d):
    """Benchmark items as questions against chunks of documents and turns: exact top-4 by TF-IDF over posting lists."""
    chunks = landed(chunk_table(spark, d), "chunks")
    index = postings.build(chunks, "chunk_id", "text")
    hits = postings.topk(read_table(spark, d, "benchmark"), index, 4, "item_id")
    titled = chunks.select(F.col("chunk_id").alias("doc_id"), "title").join(hits, "doc_id")
    per_q = titled.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", "doc_id", "title", "points", "score"))).alias("h"))
    line = lambda h: F.format_string("[%d] %s (%s, %d)", h["rank"], h["title"], h["doc_id"], h["points"])
    return per_q.select(F.col("query_id").alias("item_id"), F.array_join(F.transform("h", line), "\n\n").alias("context"),
                        F.transform("h", lambda h: h["doc_id"]).alias("sources"), F.element_at("h", 1)["score"].alias("top_score"))
