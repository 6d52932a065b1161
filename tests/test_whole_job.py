"""Registered queries over whole tables and whole texts: their SQL with the cut taken out of it, and brute force."""

import glob
import hashlib
import os
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from spindrift.operators import curate, retrieval, vector_index
from test_queries import SF, plain


def same_as_sql(spark, name, *cuts, folder=SF):
    """The query against its SQL in which each (cut, whole) is replaced."""
    sql = entry.oracle_sql()[name]
    for cut, whole in cuts:
        assert cut in sql or whole in sql
        sql = sql.replace(cut, whole)
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    want = con.execute(sql)
    order = [d[0] for d in want.description]
    expected = sorted([plain(v) for v in r] for r in want.fetchall())
    found = sorted([plain(r[c]) for c in order] for r in entry.queries()[name](spark, folder).collect())
    assert found == expected and found
    return found


@pytest.mark.parametrize("name", ["concept_support", "pair_compare", "arm_summary"])
def test_support_reads_whole_turns(spark, name):
    same_as_sql(spark, name, ("left(text, 20)", "text"))


def test_support_finds_a_concept_behind_a_long_beginning(spark, tmp_path):
    rows = [(4, 0, "user", "x" * 500 + " perfusion first")]  # phrase 'nothing', evidence 'perfusion'
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = entry.queries()["concept_support"](spark, str(tmp_path)).first()
    assert (got.n_claimed, got.n_supported, got.hits, got.verdict) == (1, 1, 1, "supported_strict")


def test_hit_log_keeps_1200_characters(spark):
    same_as_sql(spark, "hit_log_explode", ("left(text, 80)", "left(text, 1200)"))


TURNS = [
    (0, 0, "user", "First line.\n* a point - and more " + "word " * 40 + "end of user"),
    (1, 1, "assistant", "Second " + "long " * 60 + "tail"),
    (2, 2, "user", "short"),
    (3, 7, "tool", "Late turn " + "x" * 300 + " last"),
    (10, 3, "assistant", "An answer of 100 mL/h " + "y" * 60),
    (45, 0, "user", "far " * 30),
    (45, 2, "user", "far " * 30),
]


@pytest.fixture(scope="module")
def few_turns(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("turns"))
    spark.createDataFrame(TURNS, "conv_id long, turn int, role string, text string").write.parquet(f"{folder}/conversations.parquet")
    return folder


def test_qa_extract_takes_every_turn_whole(spark, few_turns):
    want = {}
    for conv, turn, _, text in TURNS:
        lines = ["Q: What should be done now?", "A: 【临床推理】" + text.replace("\n", " ").replace("*", " ").replace("-", " ")]
        lines.append(f'【决策干预（Miller）】诊断依据：MAP 60；具体干预：给予 propofol {conv % 50 + 1} mL/h，5 min 复评；原文摘录："keep MAP" [M10 #1, Chapter 3, p. 12]')
        lines += [f"【决策干预（VitalDB）】：propofol {conv % 30 + 1} mL/h"] if turn < 2 else []
        want[conv, turn] = (len(lines), hashlib.md5("\n".join(lines).encode()).hexdigest(), False, turn < 2)
    got = {(r.conv_id, r.turn): (r.n_lines, r.md5, r.strict_v1, r.strict_v2) for r in entry.queries()["qa_extract"](spark, few_turns).collect()}
    assert got == want


def test_section_extract_takes_every_turn(spark, few_turns):
    got = {(r.conv_id, r.turn): (r.quote, r.place, r.action, r.concrete) for r in entry.queries()["section_extract"](spark, few_turns).collect()}
    assert got == {(c, t): ("keep MAP", "[M10 #1, Chapter 3, p. 12]", f"给予 propofol {c % 50 + 1} mL/h，5 min 复评", True) for c, t, _, _ in TURNS}


def test_unit_values_takes_every_turn(spark, few_turns):
    """A turn without a logged section is read as a whole answer, whose first value may stand anywhere in it."""
    want = {}
    for conv, turn, _, text in TURNS:
        dose, target = conv % 50 + 1.0, conv % 20 + 1.0
        logged = [conv % 30 + 1.0] if turn < 2 else [float(x) for x in re.findall(r"(\d+) mL/h", text)] + [dose]
        close = any(max(v, target) / min(v, target) <= 1.35 or abs(v - target) <= max(3.0, target * 0.2) for v in logged)
        want[conv, turn] = (dose, logged[0], any(max(v, dose) / min(v, dose) <= 3.0 for v in logged), close)
    got = {(r.conv_id, r.turn): (r.guided, r.logged, r.consistent, r.close) for r in entry.queries()["unit_values"](spark, few_turns).collect()}
    assert got == want and {True, False} == {w[3] for w in want.values()}


def test_qa_extract_on_the_table(spark):
    same_as_sql(spark, "qa_extract", ("left(text, 40)", "text"), (" WHERE turn <= 2", ""))


def test_ab_mix_takes_as_many_rows_as_the_ratio_allows(spark, monkeypatch):
    t, last = "\nt AS (SELECT", "\nk AS (SELECT"
    sql = entry.oracle_sql()["ab_mix"]
    counts = "\nt AS (SELECT least(na, round_even(n * 0.8, 0)) AS ta, least(nb, n - round_even(n * 0.8, 0)) AS tb FROM (SELECT *, least(floor(na / 0.8), floor(nb / (1.0 - 0.8))) AS n FROM n)),"
    cuts = (sql[sql.index(t) : sql.index(last)], counts), ("least(nb, 2000 - ta)", "tb")
    found = same_as_sql(spark, "ab_mix", *cuts)
    assert {b for _, b in found} == {"A", "B"}
    monkeypatch.setattr(curate, "RANGE_DIGITS", 1)
    assert same_as_sql(spark, "ab_mix", *cuts) == found


def test_smallest_by_ranges(spark, monkeypatch):
    rows = spark.range(500).select("id", F.md5((F.col("id") % 300).cast("string")).alias("k")).persist()
    keys = sorted(r.k for r in rows.collect())
    monkeypatch.setattr(curate, "RANGE_DIGITS", 1)
    for n in (1, 7, 250, 499, 500, 600):
        assert sorted(r.k for r in curate._smallest(rows, n, "k").collect()) == keys[:n]


@pytest.mark.parametrize("block", [1000, 3])
def test_dense_answers_any_number_of_queries(spark, monkeypatch, block):
    monkeypatch.setattr(vector_index, "BLOCK", block)
    monkeypatch.setattr(vector_index, "LEAST_BLOCK", 4)
    monkeypatch.setattr(vector_index, "PIECE", 25)
    rng = np.random.default_rng(3)
    vectors = rng.integers(-3, 4, (120, 5)).astype(float)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "chunk_id long, vector array<double>").repartition(3)
    queries = df.filter("chunk_id % 6 = 0").select(F.col("chunk_id").alias("query_id"), "vector")
    want = sorted((q, c, float(vectors[q] @ vectors[c]), n + 1) for q in range(0, 120, 6) for n, c in enumerate(sorted(range(120), key=lambda c: (-(vectors[q] @ vectors[c]), c))[:7]))
    got = sorted((r.query_id, r.chunk_id, r.score, r["rank"]) for r in retrieval.dense(df, queries, 7).collect())
    assert got == want
    assert retrieval.dense(df.filter("false"), queries, 7).collect() == [] and retrieval.dense(df, queries.filter("false"), 7).collect() == []
