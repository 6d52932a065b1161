"""Exact vector search on a stored index: lists of vectors around centroids, opened in the order of an exact bound.

Building moves each vector once, to its list; a list is cut into files of about ``PIECE`` vectors, so no list, however many
vectors resemble each other, is held by one task. The table of lists has a row for each of at most ``MOST_LISTS`` lists. A
search moves the queries alone: those that are near the same list come together in blocks, and a block opens lists from
storage in the order of <q, centroid> + |q| radius while that reaches the k-th score of one of its queries.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.storage import materialize, open_store, shared_dir

#: Lists at most, bytes of their centroids at most, vectors of a file, queries of a block, and the fewest worth a task.
MOST_LISTS, CENTROID_BYTES, PIECE, BLOCK, LEAST_BLOCK = 4_096, 32 << 20, 16_384, 1_024, 64
SCORED = "query_id long, chunk_id long, score double"
#: Digits that scores are rounded to.
DIGITS = 9


@dataclass(frozen=True)
class VectorIndex:
    """Where the files of an index are, and its table: list, centroid, radius, pieces, vectors."""

    path: str
    lists: DataFrame


def _arrays(batch: pa.RecordBatch, first: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids and the matrix of vectors of a batch."""
    ids = batch.column(first).to_numpy(zero_copy_only=False)
    return ids, batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1).astype(np.float64)


def _file(folder: str, number: int, piece: int) -> str:
    return f"{folder}/{number:05d}/{piece:06d}.npz"


def build_index(corpus: DataFrame, path: str | None = None, lists: int | None = None) -> VectorIndex:
    """An index of (chunk_id, vector) under ``path``, or in the shared folder for this session.

    Centroids are vectors taken by the hashes of their ids, about the root of the number of vectors; vectors are all of one
    length. An empty corpus gives an index without lists.
    """
    spark = corpus.sparkSession
    folder = path or shared_dir(spark, "vector-index")
    rows = materialize(corpus.select("chunk_id", F.col("vector").cast("array<double>").alias("vector")), "vectors")  # may hold an embedder
    n, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    wanted = max(1, min(lists or int(np.sqrt(n)) + 1, MOST_LISTS, CENTROID_BYTES // max(1, 8 * size)))
    seeds = [r.vector for r in rows.orderBy(F.xxhash64("chunk_id"), "chunk_id").limit(wanted).collect()] if n else []
    centroids = np.array(seeds, dtype=np.float64).reshape(len(seeds), -1 if seeds else 1)
    half = (centroids**2).sum(axis=1) / 2

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in range(0, batch.num_rows, BLOCK):
                part = batch.slice(b, BLOCK)
                near = (_arrays(part, "chunk_id")[1] @ centroids.T - half).argmax(axis=1)
                yield pa.RecordBatch.from_arrays([part.column("chunk_id"), part.column("vector"), pa.array(near.astype(np.int32))], ["chunk_id", "vector", "list"])

    near = rows.mapInArrow(assign, "chunk_id long, vector array<double>, list int")
    sizes = {r.list: r["count"] for r in near.groupBy("list").count().collect()}
    pieces = F.create_map(*[F.lit(x) for k, v in sizes.items() for x in (k, -(-v // PIECE))]) if sizes else F.create_map().cast("map<int,int>")
    cut = near.withColumn("piece", F.pmod(F.xxhash64("chunk_id"), F.try_element_at(pieces, F.col("list")).cast("long")).cast("int"))

    def write(group: pa.Table) -> pa.Table:
        number, piece = group.column("list")[0].as_py(), group.column("piece")[0].as_py()
        ids, vectors = _arrays(group.combine_chunks().to_batches()[0], "chunk_id")
        out = io.BytesIO()
        np.savez(out, ids=ids, vectors=vectors)
        store, base = open_store(folder)
        target = _file(base, number, piece)
        store.create_dir(target.rpartition("/")[0], recursive=True)
        part = f"{target}.{uuid.uuid4().hex}.part"  # a task that starts anew leaves no half a file
        with store.open_output_stream(part) as f:
            f.write(out.getvalue())
        store.move(part, target)
        radius = float(np.sqrt(((vectors - centroids[number]) ** 2).sum(axis=1).max()))
        return pa.table({"list": pa.array([number], pa.int32()), "piece": pa.array([piece], pa.int32()), "radius": [radius], "vectors": pa.array([len(ids)], pa.int64())})

    files = cut.groupBy("list", "piece").applyInArrow(write, "list int, piece int, radius double, vectors long")
    table = files.groupBy("list").agg(F.max("radius").alias("radius"), (F.max("piece") + 1).alias("pieces"), F.sum("vectors").alias("vectors"))
    middle = spark.createDataFrame([(k, v) for k, v in enumerate(centroids.tolist())] if seeds else [], "list int, centroid array<double>")
    table.join(F.broadcast(middle), "list").select("list", "centroid", "radius", "pieces", "vectors").write.parquet(f"{folder}/lists")
    return open_index(spark, folder)


def open_index(spark: SparkSession, path: str) -> VectorIndex:
    """An index that ``build_index`` has written."""
    return VectorIndex(path, spark.read.schema("list int, centroid array<double>, radius double, pieces int, vectors long").parquet(f"{path}/lists"))


class Lists:
    """The lists of an index, as a task sees them."""

    def __init__(self, folder: str, rows: list[tuple[int, list[float], float, int]]):
        self.folder, self.numbers, self.pieces = folder, [r[0] for r in rows], [r[3] for r in rows]
        self.centroids = np.array([r[1] for r in rows], dtype=np.float64).reshape(len(rows), -1 if rows else 1)
        self.radii = np.array([r[2] for r in rows])
        self.opened = 0

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """No vector of a list scores more with a query; what rounding may add is in it."""
        norms = np.sqrt((queries**2).sum(axis=1))[:, None]
        far = np.sqrt((self.centroids**2).sum(axis=1)) + self.radii
        return queries @ self.centroids.T + norms * self.radii + 1e-8 + 1e-12 * norms * far

    def vectors(self, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        store, base = open_store(self.folder)
        for piece in range(self.pieces[k]):
            self.opened += 1
            with store.open_input_stream(_file(base, self.numbers[k], piece)) as f, np.load(io.BytesIO(f.read())) as held:
                yield held["ids"], held["vectors"]

    def best(self, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of each query's k best vectors, padded with scores of minus infinity; ties to smaller ids."""
        n = len(queries)
        ids, scores = np.zeros((n, k), dtype=np.int64), np.full((n, k), -np.inf)
        bounds = self.bounds(queries)
        # what the queries of a block are nearest to comes first
        for at in np.argsort(-bounds.max(axis=0), kind="stable").tolist():
            if not (bounds[:, at] >= scores[:, -1]).any():
                continue
            for chunk, vectors in self.vectors(at):
                open_ = np.flatnonzero(bounds[:, at] >= scores[:, -1])
                if not len(open_):
                    break
                new = np.round(queries[open_] @ vectors.T, DIGITS) + 0.0
                every = np.hstack([scores[open_], new])
                named = np.hstack([ids[open_], np.broadcast_to(chunk, new.shape)])
                order = np.lexsort((named, -every), axis=1)[:, :k]
                scores[open_], ids[open_] = np.take_along_axis(every, order, 1), np.take_along_axis(named, order, 1)
        return ids, scores


def search_index(index: VectorIndex, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, chunk_id, score) of the k best vectors of the index for each row of (query_id, vector)."""
    spark = queries.sparkSession
    rows = [(r.list, r.centroid, r.radius, r.pieces) for r in index.lists.collect()]  # MOST_LISTS rows at most
    folder, k = index.path, max(1, k)
    asked = queries.select("query_id", F.col("vector").cast("array<double>").alias("vector"))
    schema = pa.schema([("query_id", pa.int64()), ("chunk_id", pa.int64()), ("score", pa.float64())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = Lists(folder, rows)
        for batch in batches:
            for b in range(0, batch.num_rows, BLOCK):
                part = batch.slice(b, BLOCK)
                near = lists.bounds(_arrays(part, "query_id")[1]).argmax(axis=1) if rows else np.zeros(part.num_rows)
                yield pa.RecordBatch.from_arrays([part.column("query_id"), part.column("vector"), pa.array(near.astype(np.int32))], ["query_id", "vector", "near"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = Lists(folder, rows)
        for batch in batches:
            for b in range(0, batch.num_rows if rows else 0, BLOCK):
                q, vectors = _arrays(batch.slice(b, BLOCK), "query_id")
                ids, scores = lists.best(vectors, k)
                found = scores > -np.inf
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(q, k)[found.ravel()]), pa.array(ids[found]), pa.array(scores[found])], schema=schema)

    placed = materialize(asked.mapInArrow(place, "query_id long, vector array<double>, near int"), "queries-by-list")
    n = placed.count()
    tasks = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // LEAST_BLOCK)))
    blocks = placed.repartitionByRange(tasks, "near", "query_id").sortWithinPartitions("near", "query_id").select("query_id", "vector")
    return blocks.mapInArrow(run, SCORED)
