"""Every registered query with SQL against that SQL, on the smallest tables."""

import glob
import math
import os

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, (bool, np.bool_)):
        return str(bool(v))
    if isinstance(v, (int, float, np.integer, np.floating)):
        return repr(round(float(v), 6) + 0.0)
    return str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    want = duck.execute(entry.oracle_sql()[name])
    columns = sorted(d[0] for d in want.description)
    assert sorted(df.columns) == columns
    found = [[plain(r[c]) for c in columns] for r in df.collect()]
    order = [d[0] for d in want.description]
    expected = [[plain(dict(zip(order, r))[c]) for c in columns] for r in want.fetchall()]
    assert sorted(found) == sorted(expected)


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_nothing_else_imports_the_corpus_operators():
    root = os.path.dirname(os.path.abspath(entry.__file__))
    for path in glob.glob(f"{root}/spindrift/**/*.py", recursive=True):
        if f"{os.sep}llm{os.sep}" not in path:
            with open(path) as f:
                assert "llm" not in [w for line in f if line.lstrip().startswith(("import", "from")) for w in line.replace(".", " ").split()], path


def test_a_slope_that_rounds_to_zero_keeps_its_sign(spark, tmp_path):
    """Twenty points that fall by next to nothing: the SQL says -0.0."""
    points = [("error", 1000.0), ("purchase", 0.0), *[("view", 1.01 if k == 10 else 1.0) for k in range(3, 19)], ("view", 0.0), ("purchase", 1000.0)]
    rows = [(k, 7, kind, value) for k, (kind, value) in enumerate(points)]
    events = spark.createDataFrame(rows, "event_id long, user_id long, event_type string, value double")
    events.selectExpr("*", "timestamp_micros(1704067200000000 + event_id * 1000000)::timestamp_ntz AS ts").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{tmp_path}/events.parquet/*.parquet'")
    want = con.execute(f"select slope, trend, n_valid from ({entry.oracle_sql()['window_stats_trend']})").fetchall()
    found = [tuple(r) for r in entry.queries()["window_stats_trend"](spark, str(tmp_path)).select("slope", "trend", "n_valid").collect()]
    assert str(found) == str(want) == "[(-0.0, 'stable', 20)]"


def test_a_slope_at_a_threshold_is_summed_from_the_last_point(spark, tmp_path):
    """Ten points of slope -0.05 to the digit: the order of the sum decides the trend. Before, it was 'stable'."""
    points = [("purchase", 91.11), ("view", 24.7), ("error", 20.55), ("click", 116.37), ("error", 26.17), ("error", 17.21), ("view", 6.55), ("error", 53.04), ("error", 22.65), ("view", 111.34)]
    events = spark.createDataFrame([(k, 7, *p) for k, p in enumerate(points)], "event_id long, user_id long, event_type string, value double")
    events.selectExpr("*", "timestamp_micros(1704067200000000 + event_id * 1000000)::timestamp_ntz AS ts").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{tmp_path}/events.parquet/*.parquet'")
    names = [r[0] for r in con.execute(f"describe {entry.oracle_sql()['window_stats_trend']}").fetchall()]
    want = con.execute(entry.oracle_sql()["window_stats_trend"]).fetchall()  # all columns: with fewer, its engine may sum in another order
    found = [tuple(r) for r in entry.queries()["window_stats_trend"](spark, str(tmp_path)).select(*names).collect()]
    assert found == want and (found[0][names.index("slope")], found[0][names.index("trend")], found[0][names.index("n_valid")]) == (-0.05, "decreased", 10)
