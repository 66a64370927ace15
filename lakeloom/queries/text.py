"""Documents, chunks, labels, fan-out, files, JSON, fingerprints, retrieval."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import query
from ..functions.text import WHITESPACE_CLASS as WS
from ..operators import chunk, documents, fingerprint, label, retrieve
from ..session import scratch_path
from ..sources import files, json_docs, ranges
from ..sources.tables import read_table

_WORDS = f"list_filter(string_split_regex(coalesce(text, ''), '{WS}'), lambda x: x <> '')"


def _stop_at_end_sql(docs_sql: str, keep: str) -> str:
    return f"""
WITH w AS (SELECT {keep}, {_WORDS} AS ws FROM ({docs_sql})),
c AS (SELECT *, CASE WHEN len(ws) = 0 THEN 0
                     ELSE 1 + greatest(0, CAST(ceil((len(ws) - 120) / 90.0) AS BIGINT)) END AS n FROM w),
e AS (SELECT {keep}, ws, unnest(range(n)) AS i FROM c)
SELECT {keep}, CAST(i AS INTEGER) AS chunk_index,
       array_to_string(list_slice(ws, i * 90 + 1, i * 90 + 120), ' ') AS chunk_text,
       CAST(len(list_slice(ws, i * 90 + 1, i * 90 + 120)) AS INTEGER) AS word_count
FROM e"""


def _fixed_step_sql(docs_sql: str, keep: str) -> str:
    return f"""
WITH w AS (SELECT {keep}, {_WORDS} AS ws FROM ({docs_sql})),
e AS (SELECT {keep}, ws, unnest(range(CASE WHEN len(ws) = 0 THEN 0 ELSE (len(ws) - 1) // 90 + 1 END)) AS i FROM w)
SELECT {keep}, CAST(i AS INTEGER) AS chunk_index,
       array_to_string(list_slice(ws, i * 90 + 1, i * 90 + 120), ' ') AS chunk_text
FROM e"""


# ---------------------------------------------------------------- chunkers

@query("chunk_stop_at_end", _stop_at_end_sql("SELECT doc_id, text FROM documents", "doc_id"))
def chunk_stop_at_end(spark, d):
    docs = read_table(spark, d, "documents")
    return chunk.explode_chunks(docs, keep=["doc_id"], policy="stop_at_end")


@query("chunk_fixed_step", f"""
SELECT doc_id, chunk_index, sha256(concat_ws('#', CAST(doc_id AS VARCHAR), CAST(chunk_index AS VARCHAR))) AS chunk_id,
       chunk_text
FROM ({_fixed_step_sql("SELECT doc_id, text FROM documents", "doc_id")}) WHERE length(chunk_text) > 0
""")
def chunk_fixed_step(spark, d):
    docs = read_table(spark, d, "documents")
    out = chunk.explode_chunks(docs, keep=["doc_id"], policy="fixed_step")
    return out.select("doc_id", "chunk_index", chunk.content_chunk_id(F.col("doc_id"), F.col("chunk_index")).alias("chunk_id"),
                      "chunk_text").filter(F.length("chunk_text") > 0)


@query("text_head", f"""
SELECT doc_id, array_to_string(list_slice({_WORDS}, 1, 220), ' ') AS head FROM documents
""")
def text_head(spark, d):
    docs = read_table(spark, d, "documents")
    return docs.select("doc_id", label.text_head(F.col("text")).alias("head"))


# ---------------------------------------------------------------- document indexes (K4, K5)

def _id_sql(origin: str, *keys: str) -> str:
    fields = ",".join(f"\"{k}\":\"' || {k} || '\"" for k in keys)
    return f"sha256('{{\"origin\":\"{origin}\",{fields}}}')"


_TEXTS_SQL = f"""
SELECT {_id_sql("document", "doc_id")} AS text_id, 'document' AS origin,
       'doc ' || doc_id || ' from ' || source AS caption, text AS body FROM documents WHERE length(text) > 0
UNION ALL
SELECT {_id_sql("conversation", "conv_id", "turn")}, 'conversation', role || ' in ' || conv_id, text
FROM conversations WHERE length(text) > 0
UNION ALL
SELECT {_id_sql("file", "folder")}, 'file', folder, body FROM (
  SELECT 'region=' || n_regionkey AS folder, string_agg(n_name, ' ' ORDER BY n_name) AS body FROM nation GROUP BY n_regionkey)
"""


def _pieces_sql(chunks: str) -> str:
    return f"""
SELECT sha256(text_id || '/' || chunk_index) AS piece_id, * RENAME (chunk_index AS piece_no, chunk_text AS piece, word_count AS n_words)
FROM ({chunks}) WHERE word_count > 0"""


def all_texts(spark, d):
    """Texts of two tables and of files: nation names land as one file per region and are read
    back through the binary-file source."""
    path = scratch_path(spark, "region-files")
    names = read_table(spark, d, "nation").groupBy(F.col("n_regionkey").alias("region")).agg(
        F.array_join(F.array_sort(F.collect_list("n_name")), " ").alias("line"))
    files.write_text_files(names, path, "line", partition_by=["region"])
    found = files.file_texts(files.binary_files(spark, path, glob="*.txt", recursive=True))
    docs, turns = read_table(spark, d, "documents"), read_table(spark, d, "conversations")
    return documents.text_rows(
        docs, "document", ["doc_id"], "text", F.concat(F.lit("doc "), "doc_id", F.lit(" from "), "source")).unionByName(
        documents.text_rows(turns, "conversation", ["conv_id", "turn"], "text", F.concat("role", F.lit(" in "), "conv_id"))
    ).unionByName(documents.text_rows(found, "file", ["folder"], "body", F.col("folder")))


@query("document_index", _pieces_sql(_stop_at_end_sql(f"SELECT * RENAME (body AS text) FROM ({_TEXTS_SQL})",
                                                      "text_id, origin, caption")))
def document_index(spark, d):
    return documents.pieces(all_texts(spark, d), "stop_at_end")


_CONTENT_SQL = """
SELECT sha256(text) AS text_id, 'content' AS origin, 'text ' || substr(sha256(text), 1, 12) AS caption,
       min(doc_id) AS first_key, count(*) AS copies, any_value(text) AS text
FROM documents WHERE text IS NOT NULL GROUP BY sha256(text)
"""


def _contents(spark, d):
    return documents.distinct_texts(read_table(spark, d, "documents"), "doc_id", "text", "content")


@query("content_dedupe", f"SELECT * EXCLUDE (text) FROM ({_CONTENT_SQL})")
def content_dedupe(spark, d):
    return _contents(spark, d).drop("body")


@query("document_index_content", f"""
SELECT sha256(text_id || '/' || chunk_index) AS piece_id, text_id, origin, caption, first_key, copies,
       chunk_index AS piece_no, chunk_text AS piece, CAST(len(string_split(chunk_text, ' ')) AS INTEGER) AS n_words
FROM ({_fixed_step_sql(_CONTENT_SQL, "text_id, origin, caption, first_key, copies")}) WHERE length(chunk_text) > 0
""")
def document_index_content(spark, d):
    return documents.pieces(_contents(spark, d), "fixed_step")


# ---------------------------------------------------------------- fan-out (K3), JSON (A10), labels

@query("array_fanout", """
SELECT user_id, event_id, date_trunc('minute', ts) AS minute_at, CAST(ts AS DATE) AS day, hour(ts) AS hour,
       value AS reading, event_type AS kind,
       CASE WHEN event_type = 'error' THEN 'fault' WHEN value >= 75 THEN 'peak' WHEN value >= 25 THEN 'active'
            WHEN value > 0 THEN 'quiet' ELSE 'idle' END AS state
FROM events WHERE ts IS NOT NULL
""")
def array_fanout(spark, d):
    return documents.unroll(documents.nested_readings(read_table(spark, d, "events")))


@query("json_props", """
SELECT event_id, (CAST(props AS JSON)->>'k')::INTEGER AS k FROM events
""")
def json_props(spark, d):
    e = read_table(spark, d, "events")
    return e.select("event_id", json_docs.parse_json(F.col("props"), "k INT")["k"].alias("k"))


@query("label_rule", """
WITH a AS (
  SELECT d.doc_id, CASE WHEN l.quality = 1 THEN 'POSITIVE: ' WHEN l.quality = 0 THEN 'Rather negative. ' ELSE '' END || d.text AS answer
  FROM documents d LEFT JOIN labels l USING (doc_id) WHERE d.text IS NOT NULL)
SELECT doc_id,
       CASE WHEN contains(lower(answer), 'positive') THEN 'positive'
            WHEN contains(lower(answer), 'negative') THEN 'negative' ELSE 'neutral' END AS label
FROM a
""")
def label_rule(spark, d):
    """Labels read from answers; an answer is a text under its rater's judgement, if it has one."""
    docs = read_table(spark, d, "documents").select("doc_id", "text").where("text IS NOT NULL")
    rated = docs.join(read_table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    judged = F.when(F.col("quality") == 1, "POSITIVE: ").when(F.col("quality") == 0, "Rather negative. ").otherwise("")
    return rated.select("doc_id", label.label_from_answer(F.concat(judged, "text")).alias("label"))


# ---------------------------------------------------------------- binary files (A5)

@query("binary_files", "SELECT doc_id, text FROM documents")
def binary_files(spark, d):
    """Documents land as text files (one JSON record per line), then come back as the lines of byte
    ranges: glob filter, recursive listing, UTF-8 decode."""
    docs = read_table(spark, d, "documents")
    path = scratch_path(spark, "binary-docs")
    files.write_text_files(docs.select("lang", F.to_json(F.struct("doc_id", "text")).alias("line")), path, "line",
                           partition_by=["lang"])
    lines = ranges.lines(ranges.listed(spark, path, glob="*.txt")).where(F.length("line") > 0)
    parsed = lines.select(json_docs.parse_json(F.col("line"), "doc_id BIGINT, text STRING").alias("r"))
    return parsed.select("r.doc_id", "r.text")


# ---------------------------------------------------------------- fingerprints

_FP_COLS = ["c_acctbal", "c_custkey", "c_mktsegment", "c_name", "c_nationkey"]
_FP_SIG = "c_acctbal:double,c_custkey:bigint,c_mktsegment:string,c_name:string,c_nationkey:int"
_FP_SQL = f"""
WITH h AS (
  SELECT CAST(('0x' || substr(sha256(to_json(struct_pack(
           c_acctbal := CAST(CAST(c_acctbal AS DECIMAL(38,10)) AS VARCHAR), c_custkey := c_custkey, c_mktsegment := c_mktsegment, c_name := c_name, c_nationkey := c_nationkey))),
           1, 15)) AS UBIGINT) AS h
  FROM customer),
a AS (SELECT count(*) AS n_rows, CAST(coalesce(sum(CAST(h AS DECIMAL(20,0))), 0) AS DECIMAL(38,0)) AS row_hash_sum FROM h)
SELECT n_rows, row_hash_sum,
       sha256(concat_ws(':', '{_FP_SIG}', CAST(n_rows AS VARCHAR), CAST(row_hash_sum AS VARCHAR))) AS fingerprint
FROM a
"""


@query("fingerprint", _FP_SQL)
def fingerprint_q(spark, d):
    return fingerprint.fingerprint(read_table(spark, d, "customer").select(*_FP_COLS))


@query("layout_independence", f"""
SELECT CAST(3 AS BIGINT) AS n_layouts, CAST(1 AS BIGINT) AS n_distinct, fingerprint, n_rows FROM ({_FP_SQL})
""")
def layout_independence(spark, d):
    return fingerprint.layout_check(read_table(spark, d, "customer").select(*_FP_COLS))


# ---------------------------------------------------------------- vectors

@query("vector_checks", """
SELECT count(*) AS n_vectors, count(DISTINCT len(embedding)) AS n_dims, max(len(embedding)) AS dim,
       count(*) FILTER (WHERE list_sum(list_transform(embedding, lambda x: abs(CAST(x AS DOUBLE)))) = 0) AS zero_vectors,
       count(*) FILTER (WHERE abs(sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) - 1) > 0.001)
         AS non_unit
FROM embeddings
""")
def vector_checks(spark, d):
    e = read_table(spark, d, "embeddings")
    dbl = F.transform("embedding", lambda x: x.cast("double"))
    abs_sum = F.aggregate(dbl, F.lit(0.0), lambda acc, x: acc + F.abs(x))
    sq_sum = F.aggregate(dbl, F.lit(0.0), lambda acc, x: acc + x * x)
    return e.agg(
        F.count("*").alias("n_vectors"), F.count_distinct(F.size("embedding")).alias("n_dims"),
        F.max(F.size("embedding")).alias("dim"),
        F.count(F.when(abs_sum == 0, 1)).alias("zero_vectors"),
        F.count(F.when(F.abs(F.sqrt(sq_sum) - 1) > 0.001, 1)).alias("non_unit"))


_TOPK_SQL = """
WITH q AS (
  SELECT label AS query_id, list(x ORDER BY k) AS v FROM (
    SELECT label, k, avg(CAST(x AS DOUBLE)) AS x
    FROM (SELECT label, unnest(embedding) AS x, unnest(generate_series(1, len(embedding))) AS k FROM embeddings)
    GROUP BY label, k) GROUP BY label),
s AS (SELECT query_id, vec_id AS doc_id, list_cosine_similarity(v, CAST(embedding AS DOUBLE[])) AS score FROM q, embeddings),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM s)
SELECT query_id, rank, doc_id, round(score, 6) AS score FROM r WHERE rank <= 4
"""


def _knn(spark, d):
    e = read_table(spark, d, "embeddings")
    return retrieve.topk_similar(retrieve.mean_vectors(e, "label", "embedding"), e, k=4, q_id="label", d_id="vec_id")


@query("topk_cosine", _TOPK_SQL)
def topk_cosine(spark, d):
    """The four vectors nearest to the mean vector of each label (exact, cosine)."""
    return _knn(spark, d).withColumn("score", F.round("score", 6))


@query("topk_indexed", _TOPK_SQL)
def topk_indexed(spark, d):
    """The same neighbours from a pivot index of the vectors."""
    e = read_table(spark, d, "embeddings")
    found = retrieve.topk_indexed(retrieve.mean_vectors(e, "label", "embedding"),
                                  retrieve.pivot_index(e, d_id="vec_id"), k=4, q_id="label")
    return found.withColumn("score", F.round("score", 6))


@query("cited_context", f"""
WITH h AS ({_TOPK_SQL}),
j AS (SELECT h.*, e.label FROM h LEFT JOIN embeddings e ON e.vec_id = h.doc_id)
SELECT query_id,
       string_agg(printf('[%d] vec %d (label %s, score %.6f)', rank, doc_id, coalesce(CAST(label AS VARCHAR), 'none'), score),
                  chr(10) || chr(10) ORDER BY rank) AS context,
       list(doc_id ORDER BY rank) AS cited_ids,
       max(score) AS top_score, count(*) AS n_hits
FROM j GROUP BY query_id
""")
def cited_context(spark, d):
    hits = _knn(spark, d).withColumn("score", F.round("score", 6))
    labels = read_table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), "label")
    return retrieve.cited_context(hits, labels, "label")
