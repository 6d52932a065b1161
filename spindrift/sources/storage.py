"""Intermediate tables in the storage that driver and executors share."""

from __future__ import annotations

import os
import shutil
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Set to true where a ``file:`` folder is mounted on every machine of a cluster.
MOUNTED = "spindrift.shared.mounted"
#: By application and folder, the machines whose tasks were seen to share it.
_SHARED_BY: dict[tuple[str, str], set[str]] = {}


def _meet(folder: str, said: str) -> str:
    """A task's part of ``_tasks_share``: the name of the file it left, '' if it doesn't see what the driver said."""
    name = uuid.uuid4().hex
    try:
        with open(f"{folder}/driver") as f:
            heard = f.read() == said
        with open(f"{folder}/{name}", "x"):
            pass
    except OSError:
        return ""
    time.sleep(0.1)  # so that no executor takes all tasks
    return name if heard else ""


def _tasks_share(context, place: str) -> bool:
    """Whether tasks read in a local folder what the driver writes there, and the driver what they write."""
    folder, said = f"{place}/meet-{uuid.uuid4().hex}", uuid.uuid4().hex
    os.makedirs(folder)
    try:
        with open(f"{folder}/driver", "x") as f:
            f.write(said)
        n = 4 * context.defaultParallelism
        left = context.parallelize(range(n), n).map(lambda _: _meet(folder, said)).collect()
        return set(os.listdir(folder)).issuperset(left)  # a task that ran twice left a file that none speaks of
    finally:
        shutil.rmtree(folder, ignore_errors=True)


def _mounted(context, place: str) -> bool:
    """Whether a local folder is one and the same for the driver and all executors, by trying; False without executors.

    A machine is asked when it is first met, so a call costs a job only after machines have joined.
    """
    machines = lambda: [e.host() for e in context._jsc.sc().statusTracker().getExecutorInfos()]  # noqa: E731  # one for the driver
    seen = _SHARED_BY.setdefault((context.applicationId, place), set())
    while True:
        asked = machines()
        if len(asked) > 1 and seen.issuperset(asked):
            return True
        if not _tasks_share(context, place) or len(machines()) < 2:
            return False
        seen.update(asked if len(asked) > 1 else ())


def shared_base(spark: SparkSession) -> str:
    """The shared folder, with the scheme that Spark's file systems give it.

    The place is ``spark.checkpoint.dir``; a path without a scheme is one of the default file system, as it is for Spark.
    Where that is unset and the master is local (tests, a single machine) a folder is made and set. A cluster without one is
    refused, and so is a ``file:`` folder on a cluster whose machines would each write to a disk of their own: it must be seen
    by all executors (``_mounted`` tries), or ``spindrift.shared.mounted`` say that it is mounted everywhere.
    """
    context = spark.sparkContext
    local = context.master.startswith("local")
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        held = context._jsc.sc().getCheckpointDir()
        if held.isDefined():
            base = held.get()
        elif not local:
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        else:
            base = "file://" + tempfile.mkdtemp(prefix="spindrift-")
            context.setCheckpointDir(base)
    path = context._jvm.org.apache.hadoop.fs.Path(base)
    out = path.getFileSystem(context._jsc.hadoopConfiguration()).makeQualified(path).toString()
    if out.startswith("file:") and not local and spark.conf.get(MOUNTED, "false") != "true" and not _mounted(context, path.toUri().getPath()):
        raise ValueError(f"{out} is a local folder of each machine; name a shared one in spark.checkpoint.dir, or set {MOUNTED} where it is mounted everywhere")
    return "file://" + out.removeprefix("file:") if out.startswith("file:/") and not out.startswith("file://") else out


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one; it goes when the session's file systems are closed."""
    out = f"{shared_base(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(out)
    fs = path.getFileSystem(context._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return out


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: its lineage is cut and any executor can be lost."""
    out = shared_dir(df.sparkSession, name) + "/table"
    df.write.parquet(out)
    return df.sparkSession.read.schema(df.schema).parquet(out)


def open_store(uri: str):
    """pyarrow file system and path of a URI, for executors that write or read plain files.

    Spark's names of a store (s3a, s3n) stand for the same store here.
    """
    from pyarrow import fs

    scheme, found, rest = uri.partition("://")
    if not found:
        return fs.FileSystem.from_uri("file://" + uri.removeprefix("file:"))
    return fs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{rest}")
