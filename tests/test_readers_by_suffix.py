"""Corpus files of several kinds in one call, and numbers that hold whatever a plan does."""

import json

import pytest
from pyspark.sql import functions as F

from spindrift.sources import readers


def test_passages_by_suffix(spark, tmp_path):
    (tmp_path / "a.JSONL").write_text("\n".join(json.dumps(x) for x in ({"content": "one", "title": "T", "page_no": 3}, {"text": " "}, {"body": "two", "chapter_id": "5"})))
    (tmp_path / "b.txt").write_text("three\nlines ")
    (tmp_path / "c.md").write_text("   ")
    files = [str(tmp_path / n) for n in ("a.JSONL", "b.txt", "c.md", "b.txt")]
    got = sorted(tuple(r) for r in readers.read_passages(spark, files).fillna("-").collect())
    assert got == [("-", "-", "5", "-", "two"), ("T", "3", "-", "-", "one"), ("b.txt", "-", "-", "-", "three\nlines")]
    for bad in ([], [str(tmp_path / "x.doc")]):
        with pytest.raises(ValueError, match="no corpus files"):
            readers.read_passages(spark, bad)


def test_numbers_after_a_shuffle(spark):
    df = spark.range(5000).repartition(7, F.col("id") % 3).select("id", F.rand().alias("x"))
    got = readers.numbered(df, "n")
    assert sorted(r.n for r in got.collect()) == list(range(5000))
    assert got.filter("n = 17").first() == got.filter("n = 17").first()
