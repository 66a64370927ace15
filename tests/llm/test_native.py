import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from lakeloom.llm import common, decontaminate, line_dedup, mixing, quality, sharding
from tests.llm import brute

CLASH = ["shard", "slot", "size", "taken", "target", "source_size", "row", "w", "at", "hash", "lost", "kept", "n_words", "h", "i"]


def clashing(df):
    return df.withColumns({c: F.lit("mine") for c in CLASH})


def prose(n, seed=0):
    return " ".join(f"w{(i * 31 + seed * 7) % 97}" for i in range(n))


ROWS = [(i, prose(5 + i % 40, i), f"src{i % 3}") for i in range(150)] + [
    (7, prose(9), "src1"), (7, prose(9), "src1"), (8, None, None), (9, "", "src2"), (10, " \n\t", None), (None, prose(30), "tiny"),
    (500, prose(20_000), "src0")]


def test_shards_are_even_gapless_and_match_the_mixture(make):
    got = sharding.assign(make(ROWS), shards=8).collect()
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert len(got) == len(ROWS) and set(slots) == set(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    for source, n in Counter(r[2] for r in ROWS).items():
        own = Counter(r["shard"] for r in got if r["source"] == source)
        assert max(abs(own[s] - n / 8) for s in range(8)) <= 2
    again = sharding.assign(make(ROWS, parts=7), shards=8).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_sharding_edges(make):
    assert sharding.assign(make([])).count() == 0
    out = sharding.assign(clashing(make(ROWS[:5])))
    assert out.columns.count("shard") == 1 and sorted(r["slot"] for r in out.collect()) == [0] * 5


def test_targets_reshare_the_excess(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 10), ("c", 1000), (None, 50), ("", 0)], "source string, source_size long")
    got = {r["source"]: r for r in mixing.targets(sizes).collect()}
    weight = {"": 1, "a": 2, "b": 3, "c": 1, None: 2}
    left, open_, target = 1160.0, set(weight), {}
    while True:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * level > 3 * got[s]["source_size"]}
        if not over:
            break
        for s in over:
            target[s] = 3.0 * got[s]["source_size"]
            left -= target[s]
        open_ -= over
    target |= {s: weight[s] * level for s in open_}
    assert {s: pytest.approx(r["target"]) for s, r in got.items()} == target


def test_highest_quotients(spark):
    aimed = spark.createDataFrame([("a", 53000, 0, 53000.0), ("b", 24000, 1, 24000.0), ("c", 23000, 2, 23000.0)],
                                  "source string, source_size long, place int, target double").selectExpr(
        "*", "1L AS weight", "100000L AS all_size")
    got = {r["source"]: r["quota"] for r in mixing.quotas(aimed, block=1000).collect()}
    seats = Counter()
    for _ in range(100):
        best = max("abc", key=lambda s: ({"a": 53, "b": 24, "c": 23}[s] / (2 * seats[s] + 1), -ord(s)))
        seats[best] += 1
    assert got == dict(seats)
    quotas = mixing.shard_quotas(mixing.quotas(aimed, block=1000), 16).collect()
    for s in "abc":
        own = [r["quota"] for r in quotas if r["source"] == s]
        assert sum(own) == got[s] and max(own) - min(own) <= 1


def test_mix_takes_near_its_targets(make):
    rows = [(i, prose(10 + i % 90, i), f"s{min(i % 10, 4)}") for i in range(400)] + [(900, None, "s1"), (901, prose(300), None)]
    got = mixing.mix(mixing.sized(make(rows)), block=4).collect()
    by = defaultdict(list)
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"]
        by[r["source"]].append(r)
    for own in by.values():
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 16
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(mixing.sized(make(rows, parts=9)), block=4).collect()))


def test_blocks_fill_the_quotas_of_the_shards(make):
    rows = [(i, prose(30 + i % 90, i), f"s{min(i % 10, 4)}") for i in range(300)] + [(900, None, "s1"), (901, prose(3000), None)]
    docs = mixing.sized(make(rows))
    got = mixing.mix(docs, block=8, shards=4).collect()
    assert all(sum(r["shard_words"]) == r["taken"] and len(r["shard_words"]) == 4 for r in got)
    sizes = docs.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    plan = mixing.shard_quotas(mixing.quotas(mixing.targets(sizes), 8), 4).collect()
    quota = {(r["source"], r["shard"]): r["quota"] for r in plan}
    for (source, shard), blocks in quota.items():
        words = sum(r["shard_words"][shard] for r in got if r["source"] == source)
        assert 8 * blocks - 7 * 3 <= words <= 8 * blocks  # a line's last block may be a short one
    for source in {r["source"] for r in got}:
        own = [q for (s, _), q in quota.items() if s == source]
        assert max(own) - min(own) <= 1


def test_mixing_edges(make):
    assert mixing.mix(mixing.sized(make([]))).count() == 0
    assert mixing.mix(mixing.sized(make([(1, None), (2, "")]))).agg(F.sum("taken")).first()[0] == 0
    drawn = mixing.draw(clashing(make(ROWS)))
    assert drawn.columns == clashing(make([])).columns and drawn.count() > 0


def test_drawn_words_are_near_the_targets(make):
    # Sources to be taken 0.2 to 3 times, in documents of three to sixty blocks.
    rows = [(i, prose(200 + 97 * i % 3800, i), f"s{min(i % 12, 3)}") for i in range(900)]
    docs = mixing.sized(make(rows))
    target = {r["source"]: r["target"] for r in mixing.mix(docs).collect()}
    size, drawn = Counter(), Counter()
    for r in rows:
        size[r[2]] += len(r[1].split())
    for r in mixing.draw(docs).collect():
        drawn[r["source"]] += len(r["text"].split())
    assert min(target[s] / size[s] for s in size) < 0.5 < 1 < max(target[s] / size[s] for s in size)
    assert {s: drawn[s] / target[s] for s in size} == {s: pytest.approx(1, abs=0.2) for s in size}


ITEMS = [(1, prose(30, 3)), (2, "alpha BETA gamma"), (3, None), (4, "..."), (5, prose(10, 5)), (6, prose(30, 3)),
         (70, "Über naïve w1 w2"), (8, "solo")]
LEAKY = [(1, prose(60, 3)), (2, "x Alpha, beta; gamma! y alpha beta gamma"), (3, None), (4, ""), (5, "alpha beta"),
         (6, "pre " + prose(9, 5)), (7, "pre " + prose(10, 5) + " post"), (8, "über naïve w1 w2"), (9, "Über naïve w1 w2"),
         (10, "solo solo"), (2, "solo"), (2, "solo"), (None, prose(11, 5)), (11, prose(5000, 3))]


def test_contamination_matches_brute_force(make, spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontaminate.mark(clashing(make(LEAKY)), items).collect()
    assert Counter(tuple(r) for r in got) == brute.leaks(LEAKY, ITEMS)
    left = decontaminate.remove(make(LEAKY), items)
    assert Counter(r["doc_id"] for r in left.collect()) == Counter(
        k[0] for k, n in brute.leaks(LEAKY, ITEMS).items() for _ in range(n) if not k[5])


def test_contamination_by_shuffle_moves_no_texts_per_word(make, spark, monkeypatch):
    monkeypatch.setattr(common, "DEFAULT_BROADCAST_BYTES", 0)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    plans = []
    staged = common.staged
    monkeypatch.setattr(common, "staged", lambda df, name: plans.append(
        (name, df._jdf.queryExecution().executedPlan().toString())) or staged(df, name))
    rows = LEAKY + [(77, None), (78, ""), (79, prose(30_000) + " " + ITEMS[0][1])]
    got = decontaminate.mark(clashing(make(rows)), items).collect()
    assert Counter(tuple(r) for r in got) == brute.leaks(rows, ITEMS)
    plan = dict(plans)["decontaminate-places"]
    # The words cross one exchange, that of the texts by row; the other exchanges carry places alone.
    lines = plan.split("\n")
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning(hash" in line:
            assert not re.search(r"(?:\[|, )w#\d+(?:,|\])", lines[i + 1])  # not among the columns
    assert sum("Exchange hashpartitioning(hash" in line for line in lines) >= 2
    left = decontaminate.remove(make(rows), items)
    assert left.count() == sum(n for k, n in brute.leaks(rows, ITEMS).items() if not k[5])


def test_items_without_an_id_are_not_counted(make, spark, tmp_path):
    rows = [(1, "x " + prose(12, 5) + " y"), (2, "nothing here"), (3, prose(12, 5) + " " + prose(15, 9))]
    items = [(None, prose(12, 5)), (4, prose(15, 9)), (None, None), (5, "")]
    make(rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = decontaminate.query(spark, str(tmp_path)).collect()
    assert {r["doc_id"]: (r["n_hit"], r["n_items"]) for r in got} == {1: (12, 0), 2: (0, 0), 3: (27, 1)}
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    assert Counter(tuple(r) for r in got) == Counter(con.execute(decontaminate.ORACLE).fetchall())


def test_contamination_edges(make, spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.mark(make([]), items).count() == 0
    assert {r["contaminated"] for r in decontaminate.mark(make(LEAKY), none).collect()} == {False}


def test_quality_base_counts_and_lines(make):
    junk = "Home | About | Contact | Help\n$$$ %%% ***\nWe use cookies\n"
    rows = [(1, prose(40)), (2, prose(19)), (3, " ".join(["a b c d e f g h"] * 5)), (4, None), (5, junk * 5 + prose(20)),
            (6, junk + prose(80)), (7, "xx y\nxx y\n \n\n" + prose(40)), (8, prose(40) + " " + prose(40)), (1, prose(40))]
    got = {r["doc_id"]: r for r in quality.measured(clashing(make(rows))).collect()}
    assert [got[i]["kept"] for i in range(1, 9)] == [True, False, False, False, False, True, True, False]
    assert got[3]["n_repeat_words"] == 40 and got[7]["n_dup_lines"] == 1 and got[4]["n_words"] == 0
    assert got[5]["n_symbols"] == 5 * 12 and got[8]["n_repeat_words"] == 80
    out = quality.clean(clashing(make(rows)))
    assert out.columns == clashing(make([])).columns
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    assert texts == {1: prose(40), 6: prose(80), 7: "xx y\nxx y\n \n\n" + prose(40)}
    assert quality.clean(make([])).count() == 0


def test_quality_drops_punctuation_stock_phrases_and_arrow_strips(make):
    bad = ["ok ...... !!!!!! ------ ======", "ab,,,", "ACCEPT ALL COOKIES", "Accept All Cookies", "Skip to Main Content",
           "BACK TO TOP", "We Use Cookies", "Please click here to subscribe", "Click Here To Subscribe", "enable JavaScript",
           "Über uns: BACK TO TOP", "Home > Products > Contact > Help", "Home >> Products >> Contact >> Help"]
    good = ["well, well: (this) is 'fine'.", "ab,,", "People use cookies in the kitchen", "if a > b then c", "an idea >> another idea >> a third",
            "a cell of more than twenty-four characters > one > two > three"]
    rows = [(i, prose(40) + "\n" + x) for i, x in enumerate(bad + good)]
    texts = {r["doc_id"]: r["text"] for r in quality.clean(make(rows)).collect()}
    left = {x: texts[i] for i, x in enumerate(bad + good)}
    assert left == {x: prose(40) for x in bad} | {x: prose(40) + "\n" + x for x in good}


def test_quality_statement_judges_lines_alike(make, spark, tmp_path):
    """Documents made for each rule: the query and the SQL statement agree on every one."""
    lines = ["ACCEPT ALL COOKIES", "Accept All Cookies", "Click here to subscribe", "BACK TO TOP", "Skip to Main Content",
             "Home > Products > Contact > Help", "Home >> Products >> Contact >> Help", "Home | About » Contact • Help",
             "ok ...... !!!!!! ------ ======", "--- ab ---", "ab,,,", "ab,,", "a b c d", "$$ ab ** %%", "é", "éé", "if a > b then c",
             "one > two > three > a cell of more than twenty-four characters", "People use cookies in the kitchen",
             "ÜBER UNS: BACK TO TOP", "a >>> b >>> c >>> d", " > a > b > c > ", "\t\x0b  \r", "x" * 5000]
    rows = [(i, "\n".join([x] * k) + "\n" + prose(21, i)) for i, (x, k) in enumerate(
        (x, k) for x in lines for k in (1, 4, 40))]
    rows += [(900, None), (901, ""), (902, "\n\n"), (0, rows[0][1]), (903, prose(300) * 3)]
    make(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = Counter(tuple(r) for r in quality.query(spark, str(tmp_path)).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    found = con.execute(quality.ORACLE)
    assert got == Counter(found.fetchall())
    assert {r[-1] for r in got} == {True, False}


def test_short_lines_recur_by_share_and_long_texts_are_whole(make):
    rows = [(i, f"Read more\nPage {i}\n}}\nelse\n" + prose(30, i)) for i in range(60)]
    rows += [(100 + i, f"Rare {'line' if i < 12 else 'other'}\n" + prose(25, i + 99)) for i in range(40)]
    rows += [(500, "Read more\n" + "\n".join(prose(9, i) for i in range(20_000)))]
    out = {r["doc_id"]: r for r in line_dedup.drop_recurring(make(rows), short_share=0.3).collect()}
    assert {r["n_dropped"] for i, r in out.items() if i < 60} == {3}
    assert all(out[i]["text"] == "}\n" + prose(30, i) for i in range(60))
    assert {out[100 + i]["n_dropped"] for i in range(40)} == {0}
    assert out[500]["n_dropped"] == 1 and out[500]["n_lines"] == 20_001
    out = {r["doc_id"]: r for r in line_dedup.drop_recurring(make(rows), short_share=0).collect()}
    assert {out[100 + i]["n_dropped"] for i in range(40)} == {1}


def test_recurring_templates_are_dropped(make):
    rows = [(i, f"own line number of document {'abcdefghijklmnop'[i]}{i}x\nPosted on 2020-01-{i:02} by user{i}\n"
                f"the same closing words for all of us\n" + prose(30, i)) for i in range(12)]
    rows += [(20, None), (21, ""), (22, "a b"), (3, rows[3][1])]
    out = {r["doc_id"]: r for r in line_dedup.drop_recurring(clashing(make(rows))).collect()}
    assert "closing" not in "".join(r["text"] for r in out.values())
    assert "Posted" not in "".join(r["text"] for r in out.values())
    assert out[20]["n_lines"] == 1 and out[20]["n_dropped"] == 0 and out[22]["text"] == "a b"
    assert line_dedup.drop_recurring(make([])).count() == 0


def test_crc_is_that_of_zlib(make, spark, tmp_path):
    make(ROWS).write.parquet(f"{tmp_path}/documents.parquet")
    got = sharding.query(spark, str(tmp_path)).collect()
    assert Counter(r["text_crc32"] for r in got) == Counter(zlib.crc32((r[1] or "").encode()) for r in ROWS)
