"""Features, splits, metrics, scaling, gates, registry, MLlib training and scoring, embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import query
from ..operators import documents, embed, features, gate, metrics, registry, retrieve, scale, train
from ..operators.split import TWO_WAY, split_label
from ..session import landed, scratch_path
from ..sinks import Sink, write
from ..sources.tables import read_table, register_tables

_KEY = ("concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR), "
        "CAST(l_suppkey AS VARCHAR))")
_BUCKET = f"CAST(('0x' || substr(sha256({_KEY}), 1, 8)) AS UBIGINT) % 100"
_SPLIT3 = f"CASE WHEN {_BUCKET} < 70 THEN 'train' WHEN {_BUCKET} < 85 THEN 'test' ELSE 'score' END"


def feature_table(spark, d):
    register_tables(spark, d, ["lineitem", "orders", "part", "customer", "supplier"])
    return features.with_split(features.engineer(features.source(spark)))


# ---------------------------------------------------------------- K6, K7

_FEATURES = f"""
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, CAST(l.l_shipdate AS DATE) AS shipped_on,
       CAST(l.l_quantity AS DOUBLE) AS quantity,
       CAST(date_diff('day', o.o_orderdate, l.l_shipdate) AS DOUBLE) AS days_to_ship,
       hour(o.o_orderdate) AS order_hour, dayofweek(o.o_orderdate) + 1 AS order_dow,
       c.c_nationkey AS customer_nation, s.s_nationkey AS supplier_nation, p.p_size AS part_size,
       l.l_quantity * p.p_retailprice * (1 - l.l_discount) * (1 + l.l_tax) AS list_charge,
       {_SPLIT3.replace('l_', 'l.l_')} AS split, 'v2' AS feature_set_version
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey LEFT JOIN part p ON p.p_partkey = l.l_partkey
LEFT JOIN customer c ON c.c_custkey = o.o_custkey LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey
WHERE l.l_shipdate BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '2001-12-31'
  AND date_diff('day', o.o_orderdate, l.l_shipdate) BETWEEN 1 AND 180
  AND c.c_nationkey IS NOT NULL AND s.s_nationkey IS NOT NULL AND p.p_size IS NOT NULL
  AND l.l_quantity * p.p_retailprice * (1 - l.l_discount) * (1 + l.l_tax) IS NOT NULL
"""


@query("feature_engineering", _FEATURES)
def feature_engineering(spark, d):
    return feature_table(spark, d)


@query("split_three_way", f"SELECT l_orderkey, l_linenumber, {_SPLIT3} AS split FROM lineitem")
def split_three_way(spark, d):
    li = read_table(spark, d, "lineitem")
    cols = [F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")]
    return li.select("l_orderkey", "l_linenumber", split_label(cols).alias("split"))


@query("split_two_way", """
SELECT d.doc_id, l.quality AS label,
       CASE WHEN CAST(('0x' || substr(sha256(CAST(d.doc_id AS VARCHAR)), 1, 8)) AS UBIGINT) % 100 < 80
            THEN 'train' ELSE 'test' END AS split
FROM documents d JOIN labels l ON l.doc_id = d.doc_id
""")
def split_two_way(spark, d):
    """Labelled examples split 80/20 by a hash of their id."""
    lab = _labelled(spark, d)
    return lab.select("doc_id", "label", "split")


def _labelled(spark, d):
    docs = read_table(spark, d, "documents").select("doc_id", "text", "n_chars")
    lab = read_table(spark, d, "labels").select("doc_id", F.col("quality").alias("label"))
    return docs.join(lab, "doc_id").withColumn("split", split_label([F.col("doc_id")], TWO_WAY))


# ---------------------------------------------------------------- E14, E15, E16

_LIST_PRICE = """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice AS y,
       l.l_quantity * p.p_retailprice AS p
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
"""


def _list_price(spark, d):
    li = read_table(spark, d, "lineitem")
    part = read_table(spark, d, "part").select("p_partkey", "p_retailprice")
    return li.join(part, li.l_partkey == part.p_partkey).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_extendedprice").alias("y"),
        (F.col("l_quantity") * F.col("p_retailprice")).alias("p"))


@query("regression_metrics", f"""
SELECT round(sqrt(avg((p - y) * (p - y))), 6) AS rmse, round(avg(abs(p - y)), 6) AS mae,
       round(CASE WHEN var_pop(y) > 0 THEN 1 - avg((p - y) * (p - y)) / var_pop(y) ELSE 0 END, 6) AS r2,
       count(*) AS rows
FROM ({_LIST_PRICE})
""")
def regression_metrics(spark, d):
    """Quality of the list-price predictor (quantity × retail price) against the line price."""
    m = metrics.regression_metrics(_list_price(spark, d), "y", "p")
    return m.select(metrics.rounded("rmse"), metrics.rounded("mae"), metrics.rounded("r2"), "rows")


@query("classification_metrics", """
WITH j AS (SELECT l.quality AS label, CASE WHEN d.n_chars >= 2000 THEN 1 ELSE 0 END AS pred
           FROM documents d JOIN labels l ON l.doc_id = d.doc_id)
SELECT 'accuracy' AS metric, CAST(NULL AS INTEGER) AS class_label, round(avg(CASE WHEN pred = label THEN 1.0 ELSE 0.0 END), 6) AS value,
       count(*) AS support FROM j
UNION ALL
SELECT 'recall', label, round(avg(CASE WHEN pred = label THEN 1.0 ELSE 0.0 END), 6), count(*) FROM j GROUP BY label
""")
def classification_metrics(spark, d):
    """Accuracy and per-class recall of a length rule predicting quality; absent classes give no row."""
    j = _labelled(spark, d).withColumn("pred", (F.col("n_chars") >= 2000).cast("int"))
    m = metrics.classification_metrics(j, "label", "pred")
    return m.select("metric", "class_label", F.round("value", 6).alias("value"), "support")


_SCALE_COLS = ["l_quantity", "l_discount", "l_tax"]


@query("standardise", f"""
WITH t AS (SELECT * FROM lineitem WHERE {_BUCKET} < 70),
s AS (SELECT avg(l_quantity) AS mq, CASE WHEN coalesce(stddev_pop(l_quantity), 0) < 1e-8 THEN 1 ELSE stddev_pop(l_quantity) END AS sq,
             avg(l_discount) AS md, CASE WHEN coalesce(stddev_pop(l_discount), 0) < 1e-8 THEN 1 ELSE stddev_pop(l_discount) END AS sd,
             avg(l_tax) AS mt, CASE WHEN coalesce(stddev_pop(l_tax), 0) < 1e-8 THEN 1 ELSE stddev_pop(l_tax) END AS st FROM t)
SELECT l_orderkey, l_linenumber, round((l_quantity - mq) / sq, 6) AS l_quantity_z,
       round((l_discount - md) / sd, 6) AS l_discount_z, round((l_tax - mt) / st, 6) AS l_tax_z
FROM lineitem, s
""")
def standardise(spark, d):
    """Fit mean/population std on the train split only, apply to every row."""
    li = read_table(spark, d, "lineitem")
    cols = [F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")]
    train_rows = li.filter(split_label(cols) == "train")
    stats = scale.fit(train_rows, _SCALE_COLS)
    z = scale.transform(li, stats, _SCALE_COLS)
    return z.select("l_orderkey", "l_linenumber", *[F.round(f"{c}_z", 6).alias(f"{c}_z") for c in _SCALE_COLS])


# ---------------------------------------------------------------- K9, F6

# Bars for the list-price predictor on the held-out split.
LIST_PRICE_BARS = {"max_test_rmse": 60000.0, "min_test_r2": 0.0, "max_test_mae": 40000.0}


@query("promotion_gate", f"""
WITH j AS ({_LIST_PRICE}),
t AS (SELECT * FROM j WHERE {_BUCKET} >= 70 AND {_BUCKET} < 85),
m AS (SELECT sqrt(avg((p - y) * (p - y))) AS rmse, avg(abs(p - y)) AS mae,
             CASE WHEN var_pop(y) > 0 THEN 1 - avg((p - y) * (p - y)) / var_pop(y) ELSE 0 END AS r2 FROM t),
b(bar, kind, metric, threshold) AS (VALUES ('max_test_rmse', 'max', 'test_rmse', 60000.0),
    ('min_test_r2', 'min', 'test_r2', 0.0), ('max_test_mae', 'max', 'test_mae', 40000.0)),
v AS (SELECT 'test_rmse' AS metric, rmse AS value FROM m UNION ALL SELECT 'test_mae', mae FROM m
      UNION ALL SELECT 'test_r2', r2 FROM m)
SELECT b.bar, b.metric, round(v.value, 6) AS value, CAST(b.threshold AS DOUBLE) AS threshold,
       coalesce(CASE WHEN b.kind = 'max' THEN v.value <= b.threshold ELSE v.value >= b.threshold END, false) AS passed
FROM b LEFT JOIN v ON v.metric = b.metric
""")
def promotion_gate(spark, d):
    """One row per bar: value, bar, passed (inclusive bounds), judged on the test split only."""
    j = _list_price(spark, d)
    cols = [F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")]
    test = j.filter(split_label(cols) == "test")
    m = metrics.regression_metrics(test, "y", "p")
    long = metrics.long_form(m, [], ["rmse", "mae", "r2"], prefix="test_")
    g = gate.evaluate(long, gate.bars_frame(spark, LIST_PRICE_BARS))
    return g.select("bar", "metric", F.round("value", 6).alias("value"), "threshold", "passed")


def stage_log(spark, d):
    """Stage events derived from orders: one model per priority, one version per order."""
    o = read_table(spark, d, "orders")
    stage = (F.when(F.col("o_orderstatus") == "F", F.lit(registry.PRODUCTION))
             .when(F.col("o_orderstatus") == "O", F.lit(registry.ARCHIVED)).otherwise(F.lit(registry.STAGING)))
    return o.select(F.col("o_orderpriority").alias("model_name"), F.col("o_orderkey").alias("version"),
                    stage.alias("stage"), F.col("o_orderdate").alias("event_time"), F.lit("replay").alias("reason"))


@query("registry_current", """
SELECT model_name, version, event_time FROM (
  SELECT o_orderpriority AS model_name, o_orderkey AS version, o_orderdate AS event_time,
         row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate DESC, o_orderkey DESC) AS r
  FROM orders WHERE o_orderstatus = 'F') WHERE r = 1
""")
def registry_current(spark, d):
    return registry.current(stage_log(spark, d))


# ---------------------------------------------------------------- MLlib

def _model_store(spark) -> tuple[Sink, str]:
    """The stage log and the folder of models, both new."""
    return Sink(mode="append", path=scratch_path(spark, "stage-log")), scratch_path(spark, "models")


@query("train_metrics")
def train_metrics(spark, d):
    """Two training runs over one registry: train, validate on unseen rows, gate, register as the next version.

    Long metrics and gate outcomes of both: a linear model is version 1, boosted trees are version 2.
    """
    feats = landed(feature_table(spark, d), "features")
    log, model_dir = _model_store(spark)
    parts = None
    for kind in ("linear", "gbt"):
        out, gate_rows, version = train.train_gate_register(feats, log, model_dir, kind=kind)
        part = out.unionByName(gate_rows.select(
            F.lit(train.MODEL_NAME).alias("model_name"), F.lit(version).cast("bigint").alias("version"),
            F.lit("gate").alias("learner"), F.col("bar").alias("metric"), F.col("passed").cast("double").alias("value"),
            F.lit(None).cast("double").alias("train_seconds")))
        parts = part if parts is None else parts.unionByName(part)
    return parts


# The dates that scheduled batch-inference runs are given (their ``dt`` parameter), and the last day
# of shipments that the first of two versions has seen.
RUN_DATE, NEXT_RUN_DATE = "2024-01-31", "2024-02-29"
FIRST_WINDOW = "1998-06-30"


def _predictions(spark) -> Sink:
    return Sink(mode="overwrite_partitions", path=scratch_path(spark, "predictions"), partition_by=["scored_on"],
                require_rows=True)


@query("batch_inference")
def batch_inference(spark, d, run_date: str = RUN_DATE):
    """Score the ``score`` split with the current production version.

    Output is partitioned by the run date: a re-run of the same date replaces
    only its own partition (dynamic overwrite); other runs stay. Fails when no
    production version exists or no rows land. A training run goes before, so that there is one.
    """
    feats = landed(feature_table(spark, d), "features")
    log, model_dir = _model_store(spark)
    train.train_gate_register(feats, log, model_dir)
    out = _predictions(spark)
    train.score_in_production(feats.filter(F.col("split") == "score"), log, model_dir, out, run_date)
    return out.read(spark)


_WINDOWS = f"(VALUES (1, DATE '{FIRST_WINDOW}'), (2, DATE '9999-12-31')) w(version, until)"


@query("model_versions", f"""
WITH f AS ({_FEATURES})
SELECT CAST(w.version AS BIGINT) AS version, count(*) FILTER (WHERE f.split = 'train') AS train_rows,
       count(*) FILTER (WHERE f.split = 'test') AS test_rows, CAST({len(train.CHARGE_BARS)} AS BIGINT) AS bars_passed,
       w.version = 2 AS in_production
FROM f JOIN {_WINDOWS} ON f.shipped_on <= w.until GROUP BY w.version
""")
def model_versions(spark, d):
    """A model and its retraining on more shipments: versions grow from the log, the last one is in production."""
    feats = landed(feature_table(spark, d), "features")
    log, model_dir = _model_store(spark)
    rows = None
    for until in (FIRST_WINDOW, "9999-12-31"):
        out, gate_rows, version = train.train_gate_register(
            feats.filter(F.col("shipped_on") <= F.lit(until).cast("date")), log, model_dir, kind="linear")
        row = out.groupBy("version").agg(
            *[F.max(F.when(F.col("metric") == f"{name}_rows", F.col("value"))).cast("bigint").alias(f"{name}_rows")
              for name in ("train", "test")],
            F.lit(gate_rows.where("passed").count()).cast("bigint").alias("bars_passed"))
        rows = row if rows is None else rows.unionByName(row)
    live = registry.current(log.read(spark)).select(F.col("version").alias("live"))
    return rows.join(live, rows["version"] == live["live"], "left").select(
        *rows.columns, F.col("live").isNotNull().alias("in_production"))


@query("batch_inference_runs", f"""
WITH f AS ({_FEATURES}), n AS (SELECT count(*) AS n_rows FROM f WHERE split = 'score')
SELECT CAST(r.scored_on AS DATE) AS scored_on, CAST(r.version AS BIGINT) AS model_version, n.n_rows, n.n_rows AS n_predicted
FROM n, (VALUES ('{RUN_DATE}', 1), ('{NEXT_RUN_DATE}', 2)) r(scored_on, version)
""")
def batch_inference_runs(spark, d):
    """Scheduled scoring before and after a retraining; the second date runs twice and keeps one set of rows."""
    feats = landed(feature_table(spark, d), "features")
    log, model_dir = _model_store(spark)
    out, todo = _predictions(spark), feats.filter(F.col("split") == "score")
    train.train_gate_register(feats.filter(F.col("shipped_on") <= F.lit(FIRST_WINDOW).cast("date")), log, model_dir,
                              kind="linear")
    train.score_in_production(todo, log, model_dir, out, RUN_DATE)
    train.train_gate_register(feats, log, model_dir, kind="linear")
    for _ in range(2):
        train.score_in_production(todo, log, model_dir, out, NEXT_RUN_DATE)
    return out.read(spark).groupBy("scored_on", "model_version").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("predicted_charge").alias("n_predicted"))


def _by_language(spark, d):
    """Texts with a known language; the label says whether it is English."""
    docs = read_table(spark, d, "documents").where("lang IS NOT NULL")
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"),
                       (F.col("lang") == "en").cast("int").alias("label"),
                       split_label([F.col("doc_id")], TWO_WAY).alias("split"))


@query("text_classifier")
def text_classifier(spark, d):
    """Hashed-term logistic regression, equal class weights; the gate on accuracy and minority recall is enforced."""
    _, m, gate_rows, _ = train.fit_text_classifier(landed(_by_language(spark, d), "labelled"))
    return m.select("metric", "class_label", "value", "support", F.lit(None).cast("boolean").alias("passed")) \
        .unionByName(gate_rows.select(F.col("bar").alias("metric"), F.lit(None).cast("int").alias("class_label"), "value",
                                      F.lit(None).cast("bigint").alias("support"), "passed"))


_HALVES = """
SELECT CASE WHEN lang = 'en' THEN 1 ELSE 0 END AS label,
       CAST(('0x' || substr(sha256(CAST(doc_id AS VARCHAR)), 1, 8)) AS UBIGINT) % 100 < 80 AS trained
FROM documents WHERE lang IS NOT NULL
"""


@query("text_classifier_gate", f"""
WITH h AS ({_HALVES}),
n AS (SELECT count(*) FILTER (WHERE trained) AS train_rows, count(*) FILTER (WHERE NOT trained) AS test_rows FROM h),
m AS (SELECT label AS minority FROM h GROUP BY label ORDER BY count(*), label LIMIT 1)
SELECT b.bar, CAST(b.threshold AS DOUBLE) AS threshold, true AS passed, n.train_rows, n.test_rows, m.minority
FROM n, m, (VALUES {", ".join(str(x) for x in train.TEXT_BARS.items())}) b(bar, threshold)
""")
def text_classifier_gate(spark, d):
    """The gate rows of a classifier that was let through, with the rows it learnt from and was judged on."""
    _, _, gate_rows, facts = train.fit_text_classifier(landed(_by_language(spark, d), "labelled"))
    return gate_rows.select("bar", "threshold", "passed", F.lit(facts["train_rows"]).cast("bigint").alias("train_rows"),
                            F.lit(facts["test_rows"]).cast("bigint").alias("test_rows"),
                            F.lit(facts["minority"]).alias("minority"))


# Learners compared on identical splits.
LEARNERS = ["gbt", "random_forest", "linear"]


@query("bakeoff_metrics")
def bakeoff_metrics(spark, d):
    """Several learners, one split table, common long-form metrics incl. the third split."""
    feats = landed(feature_table(spark, d), "features")
    tr = feats.filter(F.col("split") == "train")
    parts = None
    for kind in LEARNERS:
        _, long, seconds = train.fit_and_score(kind, tr, {"test": feats.filter(F.col("split") == "test"),
                                                          "score": feats.filter(F.col("split") == "score")})
        part = long.select(F.lit(kind).alias("framework"), F.lit(f"{train.MODEL_NAME}_{kind}").alias("model_name"),
                           F.lit(1).cast("bigint").alias("version"), "metric", "value",
                           F.lit(seconds).alias("train_seconds"))
        parts = part if parts is None else parts.unionByName(part)
    return parts


@query("bakeoff_rows", f"""
WITH f AS ({_FEATURES})
SELECT k.framework, f.split, count(*) AS n_rows, true AS learnt
FROM f, (VALUES {", ".join(f"('{k}')" for k in LEARNERS)}) k(framework) GROUP BY k.framework, f.split
""")
def bakeoff_rows(spark, d):
    """Rows that each learner was fitted and judged on, and whether it explains at least nine tenths of the variance."""
    name = F.split("metric", "_")
    wide = bakeoff_metrics(spark, d).withColumn("split", name[0]).withColumn("kind", name[1])
    value = lambda kind: F.max(F.when(F.col("kind") == kind, F.col("value")))
    return wide.groupBy("framework", "split").agg(value("rows").cast("bigint").alias("n_rows"),
                                                  (value("r2") >= 0.9).alias("learnt"))


@query("bakeoff_leaderboard")
def bakeoff_leaderboard(spark, d):
    """The bake-off's long metrics log ranked on the third (score) split, with the margin verdict."""
    from ..operators import leaderboard

    log = bakeoff_metrics(spark, d).withColumn("recorded_at", F.lit(RUN_DATE).cast("timestamp_ntz"))
    return leaderboard.board(log)


# ---------------------------------------------------------------- embeddings and retrieval

EMBED_DIM = 256
EMBED_MODEL = f"hashed-tfidf-{EMBED_DIM}"


def chunk_table(spark, d):
    docs, turns = read_table(spark, d, "documents"), read_table(spark, d, "conversations")
    texts = documents.text_rows(docs, "document", ["doc_id"], "text", F.concat(F.lit("doc "), "doc_id")).unionByName(
        documents.text_rows(turns, "conversation", ["conv_id", "turn"], "text", F.concat("role", F.lit(" in "), "conv_id")))
    return documents.pieces(texts, "stop_at_end").withColumnsRenamed(
        {"piece_id": "chunk_id", "text_id": "doc_id", "origin": "source", "caption": "title", "piece": "text"})


@query("embed_chunks")
def embed_chunks(spark, d):
    """Embed only chunks that have no vector yet (key anti-join) through the batch hook, then merge on chunk_id."""
    chunks = landed(chunk_table(spark, d), "chunks")
    model = embed.fit_hashed_tfidf(chunks, "text", EMBED_DIM)
    store = Sink(mode="merge", path=scratch_path(spark, "chunk-embeddings"), merge_keys=["chunk_id"])

    def vectors(rows):
        return embed.with_embedding(rows, model, "text", dim=EMBED_DIM).select(
            "chunk_id", "doc_id", "source", "title", "embedding")

    write(vectors(chunks.filter(F.col("source") == "document")), store)
    missing = chunks.join(store.read(spark).select("chunk_id"), "chunk_id", "left_anti")
    write(vectors(missing), store)
    return store.read(spark).withColumn("embedding_model", F.lit(EMBED_MODEL)) \
        .withColumn("embedding_dim", F.size("embedding"))


@query("retrieve_cited")
def retrieve_cited(spark, d):
    """Benchmark items as questions against document chunks: exact top-4 with cited context."""
    chunks = landed(chunk_table(spark, d), "chunks")
    model = embed.fit_hashed_tfidf(chunks, "text", EMBED_DIM)
    asked, known = [embed.with_embedding(rows, model, "text", dim=EMBED_DIM)
                    for rows in (read_table(spark, d, "benchmark"), chunks)]
    hits = retrieve.topk_similar(asked, known, k=4, q_id="item_id", d_id="chunk_id")
    titles = chunks.select("chunk_id", "title")
    j = titles.join(hits.withColumnRenamed("doc_id", "chunk_id"), "chunk_id")
    per_q = j.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", "chunk_id", "title", "score"))).alias("h"))
    line = lambda h: F.format_string("[%d] %s (%s, score %.4f)", h["rank"], h["title"], h["chunk_id"], h["score"])
    return per_q.select(F.col("query_id").alias("item_id"), F.array_join(F.transform("h", line), "\n\n").alias("context"),
                        F.transform("h", lambda h: h["chunk_id"]).alias("sources"),
                        F.element_at("h", 1)["score"].alias("top_score"))
