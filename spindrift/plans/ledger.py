"""Calls to services outside that happen once for each request, also after a lost task or a stopped run.

Requests are told apart by a digest. Equal requests become one; they go by digest into buckets, and a bucket is worked on
by one task. Answers go to the ledger, a folder that driver and executors share, in a file for each batch as soon as the
batch is answered; before a task asks, it reads what its bucket's files hold already. So a task that starts anew, or a later
run with the same ledger, asks only what has no answer yet. A failed call leaves no answer and is asked again by the next
run. With speculative execution two tasks may ask the same at the same time; leave it off for calls that cost.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.storage import materialize, open_store, shared_dir

Service = Callable[[list[str]], list]
#: Buckets of a ledger. A task holds the digests of one, not their answers; a batch never crosses buckets.
BUCKETS = 256


def digest(request: Column, service: str) -> Column:
    """What a request to a service is called in the ledger; null counts as an empty request."""
    return F.sha2(F.concat(F.lit(f"{service}\n"), F.coalesce(request, F.lit(""))), 256)


class _Bucket:
    """The answers that a bucket's files hold, and the file for each new batch."""

    def __init__(self, ledger: str, number: int):
        self.store, base = open_store(ledger)
        self.folder = f"{base}/{number:05d}"
        self.answered: dict[str, tuple[str, int]] = {}  # digest -> file and line
        self._lines: tuple[str, list[str]] = ("", [])
        from pyarrow import fs

        self.store.create_dir(self.folder, recursive=True)
        for info in sorted(self.store.get_file_info(fs.FileSelector(self.folder)), key=lambda x: x.path):
            if info.path.endswith(".jsonl"):
                for k, line in enumerate(self._of(info.path)):
                    self.answered.setdefault(json.loads(line)["digest"], (info.path, k))

    def _of(self, path: str) -> list[str]:
        if self._lines[0] != path:
            with self.store.open_input_stream(path) as f:
                self._lines = path, f.read().decode().splitlines()
        return self._lines[1]

    def answer(self, key: str) -> str | None:
        path, k = self.answered[key]
        return json.loads(self._of(path)[k])["answer"]

    def write(self, answers: list[tuple[str, str | None]]) -> None:
        """A file under a name of its own, moved to its place when it is whole."""
        path = f"{self.folder}/{uuid.uuid4().hex}"
        with self.store.open_output_stream(path + ".part") as f:
            f.write("\n".join(json.dumps({"digest": d, "answer": a}) for d, a in answers).encode())
        self.store.move(path + ".part", path + ".jsonl")


def once(requests: DataFrame, service: Service, name: str, ledger: str | None = None, batch: int = 16, lanes: int | None = None, per_second: float | None = None) -> DataFrame:
    """(digest, answer, error) of every distinct request of a column ``request``, each asked once; a written table.

    ``service`` takes a list of requests and gives as many answers; what is no text goes to the ledger as JSON. An exception
    is the error of its batch. ``lanes`` tasks ask at the same time, all together at most ``per_second`` batches a second.
    """
    spark = requests.sparkSession
    place = ledger or shared_dir(spark, "ledger")
    n = lanes or int(spark.conf.get("spark.sql.shuffle.partitions"))
    pause = n / per_second if per_second else 0.0
    asked = requests.select(digest(F.col("request"), name).alias("digest"), F.coalesce("request", F.lit("")).alias("request")).dropDuplicates(["digest"])
    asked = asked.withColumn("bucket", F.conv(F.substring("digest", 1, 8), 16, 10).cast("long") % BUCKETS)
    schema = pa.schema([("digest", pa.string()), ("answer", pa.string()), ("error", pa.string())])

    def ask(bucket: _Bucket, some: list[tuple[str, str]]) -> list[tuple[str, str | None, str | None]]:
        try:
            got = list(service([r for _, r in some]))
            if len(got) != len(some):
                raise ValueError("the service gave another number of answers")
        except Exception as e:  # a failed call is a result here
            return [(d, None, f"{type(e).__name__}: {e}") for d, _ in some]
        answers = [(d, a if a is None or isinstance(a, str) else json.dumps(a)) for (d, _), a in zip(some, got)]
        bucket.write(answers)
        return [(d, a, None) for d, a in answers]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, number, todo, next_call = None, None, [], 0.0

        def settle() -> pa.RecordBatch:
            nonlocal next_call
            time.sleep(max(0.0, next_call - time.monotonic()))
            next_call = time.monotonic() + pause
            rows = ask(bucket, todo)
            todo.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], schema=schema)

        for b in batches:
            for key, request, at in zip(*(b.column(c).to_pylist() for c in ("digest", "request", "bucket"))):
                if at != number:
                    if todo:
                        yield settle()
                    bucket, number = _Bucket(place, at), at
                if key in bucket.answered:
                    yield pa.RecordBatch.from_arrays([pa.array([x], pa.string()) for x in (key, bucket.answer(key), None)], schema=schema)
                    continue
                todo.append((key, request))
                if len(todo) == batch:
                    yield settle()
        if todo:
            yield settle()

    dealt = asked.repartition(n, "bucket").sortWithinPartitions("bucket", "digest").select("digest", "request", "bucket")
    return materialize(dealt.mapInArrow(run, "digest string, answer string, error string"), "answers")


def joined(rows: DataFrame, column: str, answers: DataFrame, name: str, out: str) -> DataFrame:
    """``rows`` with the answer to the request in ``column`` as ``out``, and ``error``."""
    found = answers.select(F.col("digest").alias("__digest"), F.col("answer").alias("__answer"), F.col("error").alias("__error"))
    met = rows.drop(out, "error").withColumn("__d", digest(F.col(column), name)).join(found, F.col("__d") == F.col("__digest"), "left")
    return met.withColumn(out, F.col("__answer")).withColumn("error", F.col("__error")).drop("__d", "__digest", "__answer", "__error")
