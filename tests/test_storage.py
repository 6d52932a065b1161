"""The shared folder: where it is, and what is refused."""

import os
import subprocess
import sys
from pathlib import Path

import pyspark
import pytest

from spindrift.sources import storage


class Session:
    """A session with settings, and a master, of its own."""

    def __init__(self, spark, master="local[4]", **settings):
        class Context:
            def __getattr__(self, name):
                return master if name == "master" else getattr(spark.sparkContext, name)

        class Conf:
            def get(self, name, default=None):
                return settings.get(name.replace(".", "_"), default)

        self.sparkContext, self.conf = Context(), Conf()


def test_a_path_without_a_scheme_is_of_the_default_file_system(spark, tmp_path, monkeypatch):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.shared.link./in", f"file://{tmp_path}")
    before = conf.get("fs.defaultFS")
    conf.set("fs.defaultFS", "viewfs://shared/")
    try:
        base = storage.shared_base(Session(spark, "spark://host:7077", spark_checkpoint_dir="/in/checkpoints"))
        assert base == "viewfs://shared/in/checkpoints"
        monkeypatch.setattr(storage, "shared_base", lambda _: base)
        assert storage.materialize(spark.range(5), "numbers").count() == 5 and list(tmp_path.glob("checkpoints/numbers-*/table/*.parquet"))
    finally:
        conf.set("fs.defaultFS", before)


def test_local_folders_are_refused_on_a_cluster(spark, tmp_path):
    for place in (str(tmp_path), f"file://{tmp_path}", f"file:{tmp_path}"):
        with pytest.raises(ValueError, match="local folder"):
            storage.shared_base(Session(spark, "spark://host:7077", spark_checkpoint_dir=place))
        assert storage.shared_base(Session(spark, "spark://host:7077", spark_checkpoint_dir=place, spindrift_shared_mounted="true")) == f"file://{tmp_path}"
        assert storage.shared_base(Session(spark, spark_checkpoint_dir=place)) == f"file://{tmp_path}"


def test_stores_by_sparks_names(tmp_path):
    store, path = storage.open_store("s3a://bucket/a/b?region=us-east-1")
    assert (store.type_name, path) == ("s3", "bucket/a/b")
    for uri in (f"file://{tmp_path}/x", f"file:{tmp_path}/x", f"{tmp_path}/x"):
        store, path = storage.open_store(uri)
        assert (store.type_name, path) == ("local", f"{tmp_path}/x")


ON_EXECUTORS = """
import sys
from pyspark.sql import SparkSession
from spindrift.sources import storage
from test_storage import Session

place = sys.argv[1]
spark = SparkSession.builder.master("local-cluster[2,1,1024]").config("spark.ui.enabled", "false").config("spark.driver.host", "127.0.0.1").getOrCreate()
cluster = Session(spark, "spark://host:7077", spark_checkpoint_dir=f"file://{place}")
assert storage.shared_base(cluster) == storage.shared_base(cluster) == f"file://{place}"
held = storage._SHARED_BY.pop((spark.sparkContext.applicationId, place))
storage._tasks_share = lambda *_: False
assert held and not storage._mounted(cluster.sparkContext, place)
print("seen by executors")
spark.stop()
"""


def test_a_local_folder_that_all_executors_see_is_shared(tmp_path):
    """Before, every query with an intermediate table failed on a cluster whose checkpoint folder is mounted everywhere."""
    here = os.path.dirname(os.path.abspath(__file__))
    home, place = tmp_path / "home", tmp_path / "shared"
    for folder in (home / "work", place):  # executors write logs to work in Spark's home
        folder.mkdir(parents=True)
    for p in Path(pyspark.__file__).parent.iterdir():
        if p.name != "work":
            (home / p.name).symlink_to(p)
    env = os.environ | {"PYTHONPATH": os.pathsep.join([os.path.dirname(here), here]), "SPARK_HOME": str(home), "SPARK_LOCAL_IP": "127.0.0.1", "SPARK_SCALA_VERSION": "2.13", "PYSPARK_PYTHON": sys.executable}
    out = subprocess.run([sys.executable, "-c", ON_EXECUTORS, str(place)], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "seen by executors" in out.stdout, out.stderr[-2000:]
    assert not list(place.glob("meet-*"))


def test_a_task_that_meets_no_driver_says_so(tmp_path):
    assert storage._meet(f"{tmp_path}/absent", "x") == ""
    (tmp_path / "driver").write_text("x")
    assert storage._meet(str(tmp_path), "y") == "" and storage._meet(str(tmp_path), "x")


def test_a_task_that_ran_twice_is_no_reason_to_refuse(tmp_path):
    """Before, a task tried again made every query with an intermediate table fail, and its file looked like a stranger's."""

    class Tasks:
        defaultParallelism = 1

        def __init__(self, *runs):
            self.runs = runs

        def parallelize(self, items, n):
            self.n = n
            return self

        def map(self, f):
            self.f = f
            return self

        def collect(self):
            return [[self.f(k) for _ in range(self.runs[k % len(self.runs)])][-1] for k in range(self.n)]

    assert storage._tasks_share(Tasks(1), str(tmp_path)) and storage._tasks_share(Tasks(1, 2), str(tmp_path))
    blind = Tasks(1)
    blind.map = lambda f: setattr(blind, "f", lambda _: "") or blind
    elsewhere = Tasks(1)
    elsewhere.map = lambda f: setattr(elsewhere, "f", lambda _: "written-elsewhere") or elsewhere
    assert not storage._tasks_share(blind, str(tmp_path)) and not storage._tasks_share(elsewhere, str(tmp_path)) and not os.listdir(tmp_path)
