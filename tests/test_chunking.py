"""Native chunkers against a plain Python statement of the same rules."""

from pyspark.sql import functions as F

from lakeloom.operators import chunk


def loop_stop_at_end(text, size=120, overlap=30):
    words = text.split() if text else []
    out, step = [], size - overlap
    for i, start in enumerate(range(0, len(words), step)):
        window = words[start:start + size]
        out.append((i, " ".join(window), len(window)))
        if start + size >= len(words):
            break
    return out


def loop_fixed_step(text, size=120, overlap=30):
    words = text.split() if text else []
    step = size - overlap
    return [(s // step, " ".join(words[s:s + size])) for s in range(0, len(words), step)]


def chunks_of(spark, texts, policy):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    rows = chunk.explode_chunks(df, keep=["id"], policy=policy).collect()
    out = {i: [] for i in range(len(texts))}
    for r in sorted(rows, key=lambda r: (r["id"], r["chunk_index"])):
        out[r["id"]].append((r["chunk_index"], r["chunk_text"], r["word_count"]))
    return out


def test_short_text_one_chunk_blank_none(spark):
    got = chunks_of(spark, ["just a few words", "", "   \n\t ", None], "stop_at_end")
    assert got[0] == [(0, "just a few words", 4)]
    assert got[1] == [] and got[2] == [] and got[3] == []


def test_overlap_and_last_word(spark):
    text = " ".join(f"w{i}" for i in range(400))
    got = chunks_of(spark, [text], "stop_at_end")[0]
    assert got == loop_stop_at_end(text)
    first, second = got[0][1].split(), got[1][1].split()
    assert first[-30:] == second[:30]
    assert got[-1][1].split()[-1] == "w399"


def test_native_equals_loop_for_many_lengths(spark):
    texts = [" ".join(f"x{i}" for i in range(n)) for n in [0, 1, 119, 120, 121, 209, 210, 211, 300, 1000, 2999]]
    texts.append("a b c\x0bd  e\n\nf")  # Python whitespace that Java's \\s misses
    got = chunks_of(spark, texts, "stop_at_end")
    for i, t in enumerate(texts):
        assert got[i] == loop_stop_at_end(t), i


def test_fixed_step_keeps_every_start(spark):
    texts = [" ".join(f"y{i}" for i in range(n)) for n in [1, 90, 91, 181, 400]]
    got = chunks_of(spark, texts, "fixed_step")
    for i, t in enumerate(texts):
        assert [(a, b) for a, b, _ in got[i]] == loop_fixed_step(t)


def test_chunker_plan_has_no_python(spark):
    from lakeloom.plans import has_python_udf

    df = spark.createDataFrame([(1, "a b c")], "id long, text string")
    assert not has_python_udf(chunk.explode_chunks(df, keep=["id"]))


def test_stop_at_end_count_formula(spark):
    df = spark.range(0, 3000).select(F.col("id").cast("int").alias("n"))
    rows = df.select("n", chunk.stop_at_end_count(F.col("n")).alias("c")).collect()
    for r in rows:
        assert r["c"] == len(loop_stop_at_end(" ".join(["w"] * r["n"]))), r["n"]


def test_words_part_where_python_does(spark):
    from lakeloom.functions.text import SPARK_WHITESPACE, words

    texts = [f"{chr(c)}a{chr(c)}{chr(c)}b {chr(c)}" for c in range(0xFFFE) if not 0xD800 <= c < 0xE000] + ["", " ", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    for r in df.select("id", words(F.col("text")).alias("w")).collect():
        assert r["w"] == (texts[r["id"]] or "").split(), texts[r["id"]]
    # Asking ranges one by one at every character took most of the time of cutting texts.
    assert SPARK_WHITESPACE.count("-") == 1
