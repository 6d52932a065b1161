"""Keyword and fused ranking where the master is a cluster's and the checkpoint folder is a local one that executors share."""

import os
import subprocess
import sys
from pathlib import Path

import pyspark

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
NAMES = ("bm25_topk", "chapter_filter_fallback", "focus_rerank", "hybrid_rrf")
RUN = """
import sys
import duckdb
from pyspark.sql import SparkSession
import __spark_entry__ as entry

place, d, *names = sys.argv[1:]
conf = {"spark.ui.enabled": "false", "spark.driver.host": "127.0.0.1", "spark.sql.shuffle.partitions": "2", "spark.sql.session.timeZone": "UTC", "spark.checkpoint.dir": f"file://{place}"}
spark = SparkSession.builder.master("local-cluster[2,1,1024]").config(map=conf).getOrCreate()
spark.sparkContext.master = "spark://host:7077"  # what the queries see of it
con = duckdb.connect()
for t in ("documents", "benchmark"):
    con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
for name in names:
    try:
        got = entry.queries()[name](spark, d)
        want = con.execute(entry.oracle_sql()[name]).fetchall()
        print(name, "equal" if want and sorted(map(tuple, got.collect())) == sorted(want) else "differs")
    except ValueError as e:
        print(name, e)
spark.stop()
"""


def test_ranking_runs_on_a_cluster_with_a_local_folder(tmp_path):
    """Before, all four failed at their first intermediate table."""
    home, place = tmp_path / "home", tmp_path / "shared"
    for folder in (home / "work", place):  # executors write logs to work in Spark's home
        folder.mkdir(parents=True)
    for p in Path(pyspark.__file__).parent.iterdir():
        if p.name != "work":
            (home / p.name).symlink_to(p)
    env = os.environ | {"PYTHONPATH": ROOT, "SPARK_HOME": str(home), "SPARK_LOCAL_IP": "127.0.0.1", "SPARK_SCALA_VERSION": "2.13", "PYSPARK_PYTHON": sys.executable}
    out = subprocess.run([sys.executable, "-c", RUN, str(place), "/root/testdata/sf0.001", *NAMES], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=600)
    assert [x for x in out.stdout.splitlines() if x.split(" ")[0] in NAMES] == [f"{n} equal" for n in NAMES], out.stdout[-2000:] + out.stderr[-2000:]
