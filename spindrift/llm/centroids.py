"""Centroid clustering in whole numbers with ball trees that pass whole balls to a centroid.

Vectors become ball trees where they lie, in files of the shared folder. A node holds its centre, radius, number of vectors
and their integer sum. In a round each tree is read once: a ball goes to a centroid as a whole if that centroid is nearer
to its centre than any other by more than twice the radius, which the triangle inequality allows, and only its count and
sum are used; other balls are opened, and the vectors of leaves are compared one by one in exact arithmetic. Each task
sums over its trees, so a row for each centroid and component and task is shuffled, and the driver holds the centroids alone.

Defined results: vectors that are null, of another length, or hold a null or non-finite component take no part; equal
distances go to the smaller centroid; seeds of equal hash are taken by their vectors, those without an id last; repeated
rows count each; fewer vectors than centroids make fewer centroids; an empty centroid stays where it is; an empty table
gives an empty result; extra columns, whatever their names, are ignored. A component beyond 2**27 after scaling, whose
squared distances a long can't hold, is an error that says so.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chosen, materialize, open_store, shared_dir

#: Vectors of a tree and of a leaf.
TREE, LEAF = 8_192, 32
LARGEST = 1 << 27
#: Components up to this size have products whose sums over 64 components are exact in doubles.
_DOUBLES = 1 << 20
_PLACES = "path string, vectors long"


def whole_numbers(vector: Column, scale: float) -> Column:
    """floor(scale * x) of every component, as longs."""

    def floor(x: Column) -> Column:
        y = F.floor(x.cast("double") * F.lit(float(scale)))
        return F.when(F.abs(x.cast("double") * F.lit(float(scale))) <= LARGEST, y).otherwise(F.raise_error(F.lit(f"a component beyond {LARGEST} after scaling")).cast("long"))

    return F.transform(vector, floor)


def usable(vector: Column, dim: int) -> Column:
    bad = lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf"))
    return F.coalesce(F.size(vector) == dim, F.lit(False)) & ~F.exists(vector, bad)


class Balls:
    """A ball tree over rows of whole numbers; nodes in arrays, children after their parents."""

    _FIELDS = ("ids", "known", "points", "spans", "children", "centres", "radii", "sums")

    def __init__(self, **arrays: np.ndarray):
        for name in self._FIELDS:
            setattr(self, name, arrays[name])

    @classmethod
    def build(cls, ids: np.ndarray, known: np.ndarray, points: np.ndarray, leaf: int = LEAF) -> Balls:
        order = np.arange(len(points))
        spans, children = [(0, len(points))], [(-1, -1)]
        at = 0
        while at < len(spans):
            a, b = spans[at]
            if b - a > leaf:
                x = points[order[a:b]].astype(np.float64)
                # the direction between two far points splits at the median
                far = x[np.argmax(((x - x[0]) ** 2).sum(axis=1))]
                other = x[np.argmax(((x - far) ** 2).sum(axis=1))]
                order[a:b] = order[a:b][np.argsort(x @ (far - other), kind="stable")]
                mid = (a + b) // 2
                children[at] = (len(spans), len(spans) + 1)
                spans += [(a, mid), (mid, b)]
                children += [(-1, -1), (-1, -1)]
            at += 1
        points = points[order]
        sums = np.array([points[a:b].sum(axis=0) for a, b in spans])
        centres = sums / np.array([b - a for a, b in spans])[:, None]
        radii = np.array([np.sqrt(((points[a:b] - c) ** 2).sum(axis=1).max()) for (a, b), c in zip(spans, centres)])
        return cls(ids=ids[order], known=known[order], points=points, spans=np.array(spans), children=np.array(children), centres=centres, radii=radii, sums=sums)

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{n: getattr(self, n) for n in self._FIELDS})
        return out.getvalue()

    @classmethod
    def from_bytes(cls, raw: bytes) -> Balls:
        with np.load(io.BytesIO(raw)) as f:
            return cls(**{n: f[n] for n in cls._FIELDS})

    def assign(self, centroids: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]], np.ndarray]:
        """Centroid of each vector that was compared by itself (-1 for others), balls as (begin, end, centroid), and the
        nodes of these balls."""
        own = np.full(len(self.points), -1, dtype=np.int64)
        balls, whole = [], []
        open_ = np.zeros(1, dtype=np.int64)
        middle = centroids.astype(np.float64)
        while len(open_):
            d = np.sqrt(((self.centres[open_][:, None, :] - middle[None, :, :]) ** 2).sum(axis=2))
            best = d.argmin(axis=1)
            nearest = d[np.arange(len(open_)), best]
            d[np.arange(len(open_)), best] = np.inf
            # what rounding may take away is far below the margin
            passes = d.min(axis=1) - nearest > 2 * self.radii[open_] + 1e-6 * (1.0 + nearest + self.radii[open_])
            whole += open_[passes].tolist()
            balls += [(*span, c) for span, c in zip(self.spans[open_[passes]].tolist(), best[passes].tolist())]
            open_ = open_[~passes]
            leaves = self.children[open_, 0] < 0
            spans = self.spans[open_[leaves]]
            if len(spans):
                rows = np.concatenate([np.arange(a, b) for a, b in spans])
                own[rows] = squared(self.points[rows], centroids).argmin(axis=1)
            open_ = self.children[open_[~leaves]].ravel()
        return own, balls, np.array(whole, dtype=np.int64)


def squared(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of points (rows) to centroids (columns)."""
    kind = np.float64 if max(np.abs(points).max(initial=0), np.abs(centroids).max(initial=0)) * np.sqrt(points.shape[1] / 64 + 1) < _DOUBLES else np.int64
    x, c = points.astype(kind), centroids.astype(kind)
    return ((x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)[None, :]).astype(np.int64)


def grow_balls(rows: DataFrame, tree: int = TREE, leaf: int = LEAF) -> DataFrame:
    """Trees of all rows (id, vector) as files in the shared folder; the written table of their places."""
    folder = shared_dir(rows.sparkSession, "balls")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(folder)
        held: list[pa.RecordBatch] = []

        def stored() -> pa.RecordBatch:
            part = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            vectors, ids = part.column("vector").combine_chunks(), part.column("id").combine_chunks()
            points = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)
            path = f"{base}/{uuid.uuid4().hex}.balls"
            with store.open_output_stream(path) as f:
                f.write(Balls.build(ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_valid().to_numpy(zero_copy_only=False), points, leaf).to_bytes())
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([len(vectors)], pa.int64())], ["path", "vectors"])

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                room = tree - sum(b.num_rows for b in held)
                held.append(batch.slice(at, room))
                at += room
                if sum(b.num_rows for b in held) == tree:
                    yield stored()
        if held:
            yield stored()

    return materialize(rows.mapInArrow(run, _PLACES).withColumn("folder", F.lit(folder)), "ball-places")


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[Balls]:
    for batch in batches:
        for row in batch.to_pylist():
            store, _ = open_store(row["folder"])
            with store.open_input_stream(row["path"]) as f:
                yield Balls.from_bytes(f.read())


def _round(places: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The next centroids."""
    k, dim = centroids.shape
    schema = pa.schema([("cluster", pa.int32()), ("component", pa.int32()), ("n", pa.int64()), ("total", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(k, dtype=np.int64), np.zeros((k, dim), dtype=np.int64)
        for tree in _trees(batches):
            own, balls, nodes = tree.assign(centroids)
            for (a, b, c), node in zip(balls, nodes.tolist()):
                n[c] += b - a
                total[c] += tree.sums[node]
            for c in range(k):
                mine = own == c
                n[c] += np.count_nonzero(mine)
                total[c] += tree.points[mine].sum(axis=0)
        at = np.repeat(np.arange(k), dim)
        some = n[at] > 0
        columns = [at.astype(np.int32), np.tile(np.arange(dim, dtype=np.int32), k), n[at], total.ravel()]
        yield pa.RecordBatch.from_arrays([pa.array(c[some]) for c in columns], schema=schema)

    sums = places.mapInArrow(run, "cluster int, component int, n long, total long").groupBy("cluster", "component").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    out = centroids.copy()
    for r in sums.collect():  # centroids times components
        out[r.cluster, r.component] = r.total // r.n
    return out


class Clusters(NamedTuple):
    """vec_id, cluster (int) and squared distance (long) of every vector, and the final centroids."""

    assigned: DataFrame
    centroids: np.ndarray


def cluster_vectors(vectors: DataFrame, k: int = 8, rounds: int = 10, dim: int = 64, scale: float = 1024.0, salt: str = "3:") -> Clusters:
    """Cluster (vec_id, embedding) rows; the seeds are the k vectors whose salted ids have the smallest SHA-256."""
    spark = vectors.sparkSession
    plain = chosen(vectors, "vec_id", "embedding")
    rows = plain.filter(usable(F.col("embedding"), dim)).select(F.col("vec_id").cast("long").alias("id"), whole_numbers(F.col("embedding"), scale).alias("vector"))
    seed = F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256)
    seeds = rows.select(seed.alias("seed"), "vector").orderBy(F.col("seed").asc_nulls_last(), "vector").limit(k).collect()
    centroids = np.array([r.vector for r in seeds], dtype=np.int64).reshape(len(seeds), dim)
    if not len(seeds):
        return Clusters(spark.createDataFrame([], "vec_id long, cluster int, distance long"), centroids)
    # a tree is a task's unit of work, so trees are dealt out by their places
    places = grow_balls(rows).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path")
    for _ in range(rounds):
        moved = _round(places, centroids)
        if (moved == centroids).all():
            break  # every further round would be the same
        centroids = moved

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tree in _trees(batches):
            own, balls, _ = tree.assign(centroids)
            for a, b, c in balls:
                own[a:b] = c
            distance = np.zeros(len(own), dtype=np.int64)
            for c in range(len(centroids)):
                mine = own == c
                distance[mine] = squared(tree.points[mine], centroids[c : c + 1])[:, 0]
            yield pa.RecordBatch.from_arrays([pa.array(tree.ids, mask=~tree.known), pa.array(own.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return Clusters(materialize(places.mapInArrow(run, "vec_id long, cluster int, distance long"), "clusters"), centroids)
