import datetime

from pyspark.sql import functions as F

from lakeloom.operators import documents, label


def test_fold_and_fan_out_round_trip(spark):
    t0 = datetime.datetime(2024, 1, 1)
    rows = [(i, t0 + datetime.timedelta(minutes=7 * i), i % 3, "error" if i % 5 == 0 else "view", float(i))
            for i in range(400)]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double")
    records = documents.nested_readings(events)
    assert records.select(F.max(F.size("times"))).first()[0] <= documents.RECORD_SLOTS
    out = documents.unroll(records)
    assert out.count() == 400  # zipped, not n² rows
    r = out.filter(F.col("event_id") == 10).first()
    assert r["kind"] == "error" and r["state"] == "fault" and r["hour"] == 1


def test_content_dedupe_counts_copies(spark):
    df = spark.createDataFrame([(1, "same text"), (2, "same text"), (3, "other")], "doc_id long, text string")
    got = {r["first_key"]: r["copies"] for r in documents.distinct_texts(df, "doc_id", "text", "x").collect()}
    assert got == {1: 2, 3: 1}


def test_label_rule_list_order_and_fallback(spark):
    df = spark.createDataFrame([("It is NEGATIVE, not positive",), ("meh",), (None,), ("Neutral.",)], "a string")
    got = [r["l"] for r in df.select(label.label_from_answer(F.col("a")).alias("l")).collect()]
    assert got == ["positive", "neutral", "neutral", "neutral"]


def test_text_head_first_words(spark):
    df = spark.createDataFrame([(" ".join(f"w{i}" for i in range(300)),)], "t string")
    head = df.select(label.text_head(F.col("t"), 220).alias("h")).first()["h"].split()
    assert len(head) == 220 and head[-1] == "w219"
