from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from lakeloom.llm import license_scan, separator_scan
from tests.llm import brute

TEXTS = [
    "Licensed under CC BY-NC 4.0.", "cc by cc by", "GNU General-Public License; all rights reserved", None, "", "...",
    "Released under the MIT License.", "Releesed under the MIT Licence", "plain words only " * 50,
    "é cc by é", "ccby", "all rights\nreserved ALL RIGHTS RESERVED", "x " * 5000 + "general public license",
]


def test_base_places_match_brute_force(make):
    rows = list(enumerate(TEXTS)) + [(1, TEXTS[1])]
    df = make(rows).withColumns({"score": F.lit(9), "labels": F.lit("x")})
    got = license_scan.scan(df).collect()
    want = Counter((d, *brute.licenses(t)) for d, t in rows)
    assert Counter(tuple(r)[:6] for r in got) == want
    assert all(0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) for r in got)
    assert license_scan.scan(make([])).count() == 0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_fuzzy_places_are_those_within_the_bound():
    rnd = np.random.default_rng(5)
    finder = license_scan.NoticeFinder()
    for notice, label in license_scan.NOTICES:
        edits = len(notice) // license_scan.EDIT_SHARE
        for n in (0, edits // 2, edits):
            text = list(notice)
            for at in rnd.choice(len(text) - 2, n, replace=False) + 1:
                text[at] = "#"
            found = finder.find(" before " + "".join(text) + " after ")
            assert any(x[0] == label and x[3] <= edits for x in found)
            for _, a, b, k, _ in found:
                span = (" before " + "".join(text) + " after ")[a:b]
                assert min(distance(span, other) for other, _ in license_scan.NOTICES) <= k
    assert not finder.find(" nothing to see here at all ")


def test_counts_across_blocks_and_retries(make, spark, tmp_path):
    rows = [(i, "w " * (i * 37 % 101)) for i in range(60)] + [(3, "again"), (70, None), (71, ""), (72, "long " * 4000)]
    separator_scan.write_token_files(make(rows), f"{tmp_path}/t", block_tokens=16)
    got = separator_scan.count_documents(spark, f"{tmp_path}/t").collect()
    assert Counter(tuple(r) for r in got) == Counter((d, len((t or "").split())) for d, t in rows)
    separator_scan.write_token_files(make([]), f"{tmp_path}/none")
    assert separator_scan.count_documents(spark, f"{tmp_path}/none").count() == 0


def test_raw_files_are_scanned_by_blocks(spark, tmp_path):
    rnd = np.random.default_rng(1)
    lengths = {f"part-{k}.bin": rnd.integers(0, 70, 40).tolist() for k in range(3)}
    for name, own in lengths.items():
        stream = np.concatenate([np.append(rnd.integers(1, 9, n), 0) for n in own] + [np.array([5, 5])])
        stream.astype("<u2").tofile(tmp_path / name)
    # blocks smaller and larger than a file, one run and several
    for block_tokens, run_blocks in ((32, 4096), (37, 3), (1 << 16, 2)):
        blocks = separator_scan.read_flat_files(spark, f"{tmp_path}/*.bin", block_tokens)
        got = separator_scan.scan_blocks(blocks, run_blocks=run_blocks).collect()
        for name, own in lengths.items():
            found = sorted((r["ordinal"], r["n_tokens"]) for r in got if r["file"].endswith(name))
            assert [n for _, n in found] == own and [o for o, _ in found] == list(range(len(own)))


def test_a_raw_file_is_read_by_many_tasks(spark, tmp_path):
    np.append(np.arange(1, 5000), 0).astype("<u2").tofile(tmp_path / "one.bin")
    blocks = separator_scan.read_flat_files(spark, f"{tmp_path}/one.bin", block_tokens=100)
    tasks = blocks.select(F.spark_partition_id().alias("task"), F.length("data").alias("n")).collect()
    assert len({r["task"] for r in tasks}) > 10 and max(r["n"] for r in tasks) == 200
    assert [tuple(r)[1:] for r in separator_scan.scan_blocks(blocks, run_blocks=5).collect()] == [(0, 4999)]


def test_null_ids_repeats_and_clashing_names(make):
    from lakeloom.session import scratch_path

    rows = [(None, "a b"), (None, "a b"), (4, "c"), (4, None)]
    df = make(rows).withColumns({c: F.lit("x") for c in ("file", "block", "n", "kind", "data", "n_tokens")})
    path = scratch_path(df.sparkSession, "clash")
    separator_scan.write_token_files(df, path, block_tokens=2)
    got = separator_scan.count_documents(df.sparkSession, path).collect()
    assert Counter(tuple(r) for r in got) == Counter([(None, 2), (None, 2), (4, 1), (4, 0)])
