"""The pipeline's stages on odd rows and on nothing."""

import corpus_pipeline as cp
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_odd_rows_go_through_all_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(*cp.DOCUMENT_COLUMNS)
    text = docs.filter(F.col("lang").isNotNull()).orderBy(F.desc(F.length("text")), "doc_id").first().text
    odd = [(900_001, None, "en", "web"), (900_002, "", None, None), (900_003, " \n\t", "en", None), (900_004, "12 34 !?", "en", "web"), (900_005, text, None, None), (900_006, text, None, "web"), (900_006, text, None, "web"), (None, None, None, None)]
    odd = spark.createDataFrame(odd, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long"))
    rows = docs.unionByName(odd)
    found = {}
    for name, stage in cp.STAGES[:-1]:
        rows = cp.materialize(stage(spark, rows, SF), name)
        assert rows.columns == list(cp.DOCUMENT_COLUMNS)
        found[name] = [r.doc_id for r in rows.collect()]
    known = [i for i in found["language_id"] if i is None or i > 900_000]
    assert sorted(known) == [900_005, 900_006, 900_006]  # nothing without letters
    assert len(set(found["simhash_near_dedup"])) == len(found["simhash_near_dedup"])
    assert not {900_005, 900_006} & set(found["simhash_near_dedup"])  # the copy of the smaller doc_id stays
    ids = cp.STAGES[-1][1](spark, rows, SF)
    assert ids.count() == rows.count()


@pytest.mark.parametrize("name", [n for n, _ in cp.STAGES])
def test_stages_on_nothing(spark, name):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(*cp.DOCUMENT_COLUMNS).filter("false")
    out = dict(cp.STAGES)[name](spark, docs, SF)
    assert out.collect() == []
    assert out.columns == list(cp.DOCUMENT_COLUMNS) or name == cp.STAGES[-1][0]
