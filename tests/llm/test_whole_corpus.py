"""Corpus operators where a cut would lose part of the job."""

import collections
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from spindrift.llm import language_id, quality_rules, top_k


def test_top_k_keeps_neighbours_of_a_hot_query(spark):
    """150 copies of the query's own id score above every neighbour and fill whole leaves."""
    rng = np.random.default_rng(5)
    others = [(i, [float(x) for x in rng.integers(0, 40, 4)]) for i in range(1, 401) if i != 20]
    rows = others + [(20, [50.0] * 4)] * 150
    order = sorted((-int(50 * sum(v)), i) for i, v in others)
    tree = top_k.BallTree(np.array([i for i, _ in rows]), np.array([v for _, v in rows]))
    best = [[]]
    top_k.search(tree, np.array([20]), np.array([[50.0] * 4]), best, np.array([-np.inf]))
    assert best[0] == order[: top_k.K]
    df = spark.createDataFrame(rows, "id long, vector array<double>")
    got = top_k.top_k(df, F.col("id") == 20).collect()  # each copy asks, so the best neighbour comes 150 times
    assert sorted((r["rank"], -r.score, r.vec_id) for r in got) == [(n + 1, *order[0]) for n in range(top_k.K)]


def test_all_trusted_rows_count(spark):
    """All 60,000 labelled rows are trusted, so the trusted counts are the raw ones."""
    df = spark.range(60_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), F.col("id") % 1000).alias("text"))
    labels = df.select("doc_id", F.lit(1).alias("quality"))
    ratios = quality_rules.log_ratios(df, labels)
    n = quality_rules.gram_counts(df.select("text", F.lit(True).alias("trusted"))).collect()
    assert sum(r.n_trusted for r in n) == 180_000
    total, weight = 180_000 + quality_rules.BUCKETS, float(quality_rules.BUCKETS)
    for r in n:
        x = r.n + 1.0
        assert math.isclose(ratios[r.bucket], math.log((r.n + weight * x / total) / (180_000 + weight) / (x / total)), abs_tol=1e-12)


def test_n_grams_of_words_of_any_length(spark):
    words = ["a", "ab", "z" * 61 + "qrs", "x" * 62 + "pqrstuvw", "".join(chr(97 + i * i % 23) for i in range(1000))]
    df = spark.createDataFrame([(k, w, "aa") for k, w in enumerate(words)], "doc_id long, text string, lang string")
    want = collections.Counter()
    for w in words:
        m = f"_{w}_"
        for n in range(1, language_id.MAX_GRAM + 1):
            want.update(m[i : i + n] for i in range(max(len(m) - n + 1, 1)))
    seen = []

    class Kept(language_id.LanguageModel):
        def __init__(self, words_, grams):
            seen.append({g: n for _, g, n in grams})
            super().__init__(words_, grams)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(language_id, "LanguageModel", Kept)
        language_id.fit_languages(df)
    assert seen == [dict(want)]
