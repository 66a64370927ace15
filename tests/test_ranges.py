import random

import pytest

from lakeloom.sources import ranges


@pytest.mark.parametrize("range_bytes", [1, 7, 64, 1 << 20])
def test_ranges_make_up_the_whole_file(spark, tmp_path, range_bytes):
    rng = random.Random(range_bytes)
    size = 300 if range_bytes == 1 else 5000
    bodies = {"a b.bin": rng.randbytes(size), "c=d/e.bin": rng.randbytes(size // 3), "empty.bin": b"", "skip.txt": b"x"}
    for name, body in bodies.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(body)
    found = ranges.byte_ranges(ranges.listed(spark, str(tmp_path), glob="*.bin"), range_bytes)
    rows = found.collect()
    assert found.rdd.getNumPartitions() == len(rows)
    got = {}
    for r in sorted(rows, key=lambda r: (r["path"], r["offset"])):
        own = got.setdefault(r["path"].split(str(tmp_path) + "/")[1], b"")
        assert len(own) == r["offset"] and len(r["content"]) <= range_bytes
        got[r["path"].split(str(tmp_path) + "/")[1]] = own + bytes(r["content"])
    assert got == {k: v for k, v in bodies.items() if v and k.endswith(".bin")}


@pytest.mark.parametrize("range_bytes", [1, 2, 5, 33, 1 << 20])
def test_lines_of_any_range_are_those_of_the_file(spark, tmp_path, range_bytes):
    bodies = {"a": "one\ntwo\n\n\nfünf 𝔸\nlast without end", "b": "\n", "c": "only", "d": "x\n" * 20, "e": "", "f": "\n\nq"}
    for name, body in bodies.items():
        (tmp_path / name).write_bytes(body.encode())
    rows = ranges.lines(ranges.listed(spark, str(tmp_path)), range_bytes).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r["path"], r["offset"])):
        got.setdefault(r["path"][-1], []).append(r["line"])
    assert got == {k: (v[:-1] if v.endswith("\n") else v).split("\n") for k, v in bodies.items() if v}


def test_bytes_that_are_not_utf8_and_no_files(spark, tmp_path):
    (tmp_path / "x").write_bytes(b"a\xff\nb")
    assert [r["line"] for r in ranges.lines(ranges.listed(spark, str(tmp_path))).collect()] == ["a�", "b"]
    (tmp_path / "none").mkdir()
    assert ranges.lines(ranges.listed(spark, str(tmp_path / "none"))).count() == 0
