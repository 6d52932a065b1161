"""The stored index against brute force, and how few of its lists a block of queries opens."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from spindrift.operators import retrieval, vector_index


def brute(corpus, queries, k):
    out = set()
    for q, v in queries:
        scores = [(-(round(float(np.dot(v, x)), 9) + 0.0), i) for i, x in corpus]
        out |= {(q, i, rank) for rank, (_, i) in enumerate(sorted(scores)[:k], 1)}
    return out


@pytest.mark.parametrize("lists", [None, 1, 40])
def test_search_equals_brute_force(spark, tmp_path, monkeypatch, lists):
    monkeypatch.setattr(vector_index, "PIECE", 30)
    rng = np.random.default_rng(lists or 7)
    corpus = [(i, (rng.integers(-4, 5, 6) / 2).tolist()) for i in range(300)] + [(500 + i, [1.0] * 6) for i in range(90)] + [(700, [0.0] * 6)]
    queries = [(i, (rng.integers(-4, 5, 6) / 2).tolist()) for i in range(25)] + [(90, [0.0] * 6), (91, [1.0] * 6)]
    df = spark.createDataFrame(corpus, "chunk_id long, vector array<double>").repartition(4)
    q = spark.createDataFrame(queries, "query_id long, vector array<float>")
    place = f"file://{tmp_path}/index"
    index = vector_index.build_index(df, place, lists)
    assert index.lists.agg(F.sum("vectors")).first()[0] == len(corpus) and index.lists.filter("pieces > 1").count() > 0
    for opened in (index, vector_index.open_index(spark, place)):
        got = retrieval.dense_on(opened, q, 7).collect()
        assert {(r.query_id, r.chunk_id, r["rank"]) for r in got} == brute(corpus, queries, 7)


def test_clustered_vectors_open_few_lists(spark):
    rng = np.random.default_rng(2)
    hearts = rng.normal(0, 1, (50, 16))
    hearts /= np.linalg.norm(hearts, axis=1)[:, None]
    points = np.repeat(hearts, 60, axis=0) + rng.normal(0, 0.01, (3000, 16))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(points.tolist())], "chunk_id long, vector array<double>")
    index = vector_index.build_index(df)
    lists = vector_index.Lists(index.path, [(r.list, r.centroid, r.radius, r.pieces) for r in index.lists.collect()])
    ids, scores = lists.best(points[:20], 5)
    assert lists.opened < sum(lists.pieces) / 4
    want = np.round(points[:20] @ points.T, 9)
    assert (scores == -np.sort(-want, axis=1)[:, :5]).all()


def test_nothing_to_search(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0])], "chunk_id long, vector array<double>")
    q = df.withColumnRenamed("chunk_id", "query_id")
    assert retrieval.dense(df.filter("false"), q, 3).collect() == [] and retrieval.dense(df, q.filter("false"), 3).collect() == []
    assert [tuple(r) for r in retrieval.dense(df, q, 3).collect()] == [(1, 1, 5.0, 1)]
