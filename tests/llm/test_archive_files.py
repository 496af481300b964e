"""Archive files are cut by records and by bytes."""

import gzip
from pathlib import Path

import pytest

from grabqc.llm import warc
from grabqc.session import scratch_path


def files(path):
    return [gzip.decompress(f.read_bytes()) for f in sorted(Path(str(path).removeprefix("file:")).rglob("part-*"))]


@pytest.mark.parametrize("per_file, file_bytes, most", [(500, 4000, 4000), (3, 1 << 20, None), (1, 1 << 20, None), (500, 1 << 24, None)])
def test_files_are_cut(spark, per_file, file_bytes, most):
    rows = [(i, f"http://x/{i}", ("é" if i % 2 else "line\n") * (i * 37 % 900)) for i in range(60)]
    rows += [(100, "http://long/", "x" * 300_000), (101, "http://long/", "x" * 300_000), (102, "http://after/", "short"), (None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(2)
    arc, out = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    warc.write_arc(df, arc, per_file=per_file, file_bytes=file_bytes)
    held = [[(fields, block) for fields, block in warc.read_arc(data)] for data in files(arc)]
    assert sum(map(len, held)) == len(rows) and all(0 < len(own) <= per_file for own in held)
    if most:  # without its last record a file is under the bound
        assert len(held) > 10 and all(sum(len(block) for _, block in own[:-1]) < most for own in held)
    warc.convert(spark, arc, out)
    assert sorted(len(list(warc.read_warc(data))) for data in files(out)) == sorted(map(len, held))
    got = {r.page_id: r for r in warc.read_back(spark, out).collect()}
    assert len(got) == len(rows)
    assert got[101].record_type == "response" and got[101].payload == b"x" * 300_000
    assert (got[100].record_type, got[100].refers_to, got[100].payload_bytes, got[100].payload) == ("revisit", 101, 300_000, None)
    assert all(got[i].payload == text.encode() for i, _, text in rows[:60] if got[i].record_type == "response")
    assert all(got[i].payload_bytes == len((text or "").encode()) for i, _, text in rows)


def test_empty_archives(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.round_trip(df).count() == 0
