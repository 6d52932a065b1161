"""The store of signals and what its source takes of a query's filters."""

import pytest
from pyspark.sql import functions as F

from spindrift.sources import signal_store


def test_filters_choose_what_is_read(spark, tmp_path):
    rows = [(c, float(t), track, None if t == 3 else t * 1.5, t) for c in (1, 2, 30) for track in ("HR", "Solar8000/ART MBP") for t in range(100)]
    df = spark.createDataFrame(rows + [(None, 0.0, "HR", 1.0, 0), (1, 0.0, None, 1.0, 0)], "caseid long, time_sec double, track string, value double, ord long")
    path = f"file://{tmp_path}/signals"
    signal_store.write_signal_store(df, path)
    store = signal_store.read_signal_store(spark, path)
    assert sorted(map(str, store.collect())) == sorted(map(str, (r for r in df.collect() if r.caseid is not None and r.track is not None)))
    some = signal_store.read_signal_store(spark, path, ("caseid", ">=", 2), ("track", "==", "Solar8000/ART MBP"), ("time_sec", "<", 10.0)).filter("value > 3")
    want = [(c, float(t)) for c in (2, 30) for t in range(4, 10)]
    assert sorted((r.caseid, r.time_sec) for r in some.collect()) == want
    assert signal_store.read_signal_store(spark, path, ("caseid", "in", [1, 30, 99]), ("time_sec", "in", [3.0])).count() == 4
    assert store.filter("time_sec < 5").unionByName(store.filter("time_sec >= 90")).count() == 6 * 15
    with pytest.raises(ValueError, match="no test"):
        signal_store.read_signal_store(spark, path, ("value", ">", 1))
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        pushed = signal_store.read_signal_store(spark, path, pushdown=True).filter((F.col("caseid") >= 2) & (F.col("track") == "Solar8000/ART MBP") & (F.col("time_sec") < 10) & (F.col("value") > 3))
        assert sorted((r.caseid, r.time_sec) for r in pushed.collect()) == want
        plan = pushed._sc._jvm.PythonSQLUtils.explainString(pushed._jdf.queryExecution(), "formatted")
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")
    assert all(f in plan for f in ("GreaterThanOrEqual(caseid,2)", "EqualTo(track,Solar8000/ART MBP)", "LessThan(time_sec,10.0)"))
    assert "Condition : (isnotnull(value" in plan


def test_partitions_follow_from_folders(spark, tmp_path):
    df = spark.range(40).select((F.col("id") % 4).alias("caseid"), F.col("id").cast("double").alias("time_sec"), F.concat(F.lit("t"), F.col("id") % 2).alias("track"), F.lit(1.0).alias("value"), F.col("id").alias("ord"))
    path = f"file://{tmp_path}/signals"
    signal_store.write_signal_store(df, path)
    reader = signal_store.SignalReader(path, 1)
    assert [(p.files[0][0], p.files[0][1]) for p in reader.partitions()] == [(c, f"t{c % 2}") for c in range(4)]
    reader = signal_store.PushedSignalReader(path, 1)
    from pyspark.sql.datasource import EqualTo, GreaterThan, IsNull

    odd = IsNull(("value",))
    assert list(reader.pushFilters([EqualTo(("track",), "t1"), GreaterThan(("time_sec",), 30.0), odd])) == [odd]
    assert [p.files[0][0] for p in reader.partitions()] == [1, 3]
    assert sum(b.num_rows for p in reader.partitions() for b in reader.read(p)) == 5
    assert len(signal_store.SignalReader(path, 1 << 20).partitions()) == 1
    signal_store.write_signal_store(df.filter("false"), f"file://{tmp_path}/none")
    assert signal_store.read_signal_store(spark, f"file://{tmp_path}/none").collect() == []


def test_files_do_not_grow_with_cases_and_tracks(spark, tmp_path):
    """Before, 600 files and folders for these cases and tracks; and a track without a name came back under another."""
    rows = spark.range(30_000).select(F.expr("id % 200 caseid"), F.expr("cast(id as double) time_sec"), F.expr("elt(1 + id % 3, '', 'HR', 'HR/2') track"), F.expr("if(id % 5 = 0, null, id / 2) value"), F.expr("id ord"))
    path = f"file://{tmp_path}/signals"
    signal_store.write_signal_store(rows, path)
    assert sum(1 for _ in tmp_path.rglob("*.parquet")) <= 8
    want = {r.ord: str(r) for r in rows.collect()}
    for size in (1, 50_000, 1 << 25):
        reader = signal_store.SignalReader(path, size)
        pieces = reader.partitions()
        read = [r for p in pieces for b in reader.read(p) for r in b.column("ord").to_pylist()]
        assert sorted(read) == sorted(want) and len(pieces) == {1: 600, 50_000: 15, 1 << 25: 1}[size]
    tests = [("track", "in", ["", "HR", None]), ("caseid", "in", [7, 8.5, 150, None]), ("time_sec", ">=", 900.0), ("time_sec", "<", 20_000.0)]
    found = {r.ord: str(r) for r in signal_store.read_signal_store(spark, path, *tests).collect()}
    assert found == {k: v for k, v in want.items() if k % 200 in (7, 150) and k % 3 < 2 and 900 <= k < 20_000}
    assert signal_store.read_signal_store(spark, path, ("caseid", "in", [])).count() == 0


def test_a_long_track_is_read_by_row_groups(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(signal_store, "GROUP_ROWS", 1_000)
    rows = spark.range(20_000).select(F.lit(1).cast("long").alias("caseid"), F.when(F.col("id") % 7 != 3, F.col("id").cast("double")).otherwise(F.when(F.col("id") % 2 == 0, float("nan"))).alias("time_sec"), F.lit("HR").alias("track"), F.lit(1.0).alias("value"), F.col("id").alias("ord"))
    path = f"file://{tmp_path}/signals"
    signal_store.write_signal_store(rows, path)
    assert sorted(r.ord for r in signal_store.read_signal_store(spark, path).collect()) == list(range(20_000))
    for test, fits in ((("time_sec", ">", 19_000.0), lambda t: t > 19_000), (("time_sec", "==", 500.0), lambda t: t == 500), (("time_sec", "in", [4.0, 19_999.0]), lambda t: t in (4, 19_999)), (("time_sec", "<=", -1.0), lambda t: False)):
        reader = signal_store.SignalReader(path, 1, [test])
        read = [r for p in reader.partitions() for b in reader.read(p) for r in b.column("ord").to_pylist()]
        assert read == [t for t in range(20_000) if t % 7 != 3 and fits(t)]
