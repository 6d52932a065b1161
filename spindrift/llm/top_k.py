"""Exact top-k search by inner product: a ball tree per shard, branch and bound, k-th scores shared by all shards.

Candidates become ball trees of about ``SHARD`` vectors where they lie, written to the shared folder with a small table of
their roots. Queries go in blocks; a block passes through all trees one after the other. For a query the nodes of a tree
are ordered by the upper bound <q, centre> + |q| * radius and visited while the bound reaches the query's k-th score so
far, and a tree whose root's bound reaches no query's score is not even read. So each tree shares the k-th scores of all
before it, and neither trees nor queries are shuffled against each other: what moves grows with the number of rows. A
lost task costs one block. Only a query's k best are merged last, for ids that ask with several vectors.

Scores are exact: components are floored to whole numbers, and products run in doubles only where their sum stays below
2**53, else in Python's integers. Scores beyond 64 bits are held at its ends.

Defined results: vectors that are null, hold a null or non-finite component, or lack an id take no part; shorter vectors
count as filled up with zeros; equal scores go to the smaller id; rows that share the query's id are never its
candidates, other repeated rows count each, and repeated queries each ask; fewer candidates than k are all returned;
empty tables give empty results; extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import chosen, materialize, open_store, shared_dir

K = 20
SHARD = 8_192
LEAF = 128
SHARD_BYTES = 32 << 20
#: Queries of a block, and the fewest for which a task of their own pays; trees that a task keeps in memory.
BLOCK, LEAST_BLOCK, KEPT = 1_024, 32, 8
_ENDS = (-(1 << 63), (1 << 63) - 1)


def floored(vector: Column, scale: float = 64.0) -> Column:
    """floor(scale * x) of every component, as doubles."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("double"))


def usable(vector: Column) -> Column:
    bad = lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf"))
    return vector.isNotNull() & ~F.exists(vector, bad)


def _matrix(vectors: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((len(vectors), max(map(len, vectors), default=0)))
    for k, v in enumerate(vectors):
        out[k, : len(v)] = v
    return out


def _wide(x: np.ndarray, dim: int) -> np.ndarray:
    return x if x.shape[1] >= dim else np.hstack([x, np.zeros((len(x), dim - x.shape[1]))])


class BallTree:
    """Vectors in the order of the leaves, and a centre and radius for every node."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF):
        order = np.arange(len(ids))
        spans, open_ = [], [(0, len(ids))]
        while open_:
            a, b = open_.pop()
            if b - a <= leaf:
                spans.append((a, b))
                continue
            x = vectors[order[a:b]]
            # the direction between two far points splits at the median
            far = x[np.argmax(((x - x[0]) ** 2).sum(axis=1))]
            other = x[np.argmax(((x - far) ** 2).sum(axis=1))]
            at = np.argsort(x @ (far - other), kind="stable")
            order[a:b] = order[a:b][at]
            mid = (a + b) // 2
            open_ += [(mid, b), (a, mid)]
        spans.sort()
        self.ids, self.vectors = ids[order], vectors[order]
        self.spans = np.array(spans, dtype=np.int64).reshape(-1, 2)
        self.centres = np.array([self.vectors[a:b].mean(axis=0) for a, b in spans]).reshape(len(spans), -1)
        self.radii = np.array([np.sqrt(((self.vectors[a:b] - c) ** 2).sum(axis=1).max()) for (a, b), c in zip(spans, self.centres)])
        self.norm = float(np.sqrt((self.vectors**2).sum(axis=1).max())) if len(ids) else 0.0


def _products(vectors: np.ndarray, query: np.ndarray, exact: bool) -> np.ndarray:
    if exact:
        return (vectors @ query).astype(np.int64)
    q = [int(v) for v in query]
    return np.array([min(max(sum(int(a) * b for a, b in zip(row, q)), _ENDS[0]), _ENDS[1]) for row in vectors], dtype=np.int64)


def search(tree: BallTree, query_ids: np.ndarray, queries: np.ndarray, best: list[list[tuple[int, int]]], floor_: np.ndarray, k: int = K) -> None:
    """Bring ``best`` (per query up to k of (-score, id), sorted) up to date with a shard's vectors.

    ``floor_`` holds scores that a query's k-th score is known to reach.
    """
    if not len(tree.ids):
        return
    dim = max(tree.vectors.shape[1], queries.shape[1])
    vectors, centres, queries = _wide(tree.vectors, dim), _wide(tree.centres, dim), _wide(queries, dim)
    norms = np.sqrt((queries**2).sum(axis=1))
    bounds = queries @ centres.T + norms[:, None] * tree.radii[None, :]
    bounds += 1e-6 * (1.0 + norms[:, None] * tree.norm)  # what rounding may take away
    orders = np.argsort(-bounds, axis=1)
    for q in range(len(query_ids)):
        exact = norms[q] * tree.norm < 2.0**52
        mine, kth = best[q], floor_[q]
        if len(mine) == k:
            kth = max(kth, float(-mine[-1][0]))
        todo = orders[q]
        at = 0
        width = 4
        while at < len(todo):
            some = todo[at : at + width]
            some = some[bounds[q, some] >= kth]
            if not len(some):
                break
            at += width
            width = min(2 * width, 64)
            rows = np.concatenate([np.arange(*tree.spans[n]) for n in some])
            scores = _products(vectors[rows], queries[q], exact)
            near = (scores >= kth) & (tree.ids[rows] != query_ids[q])
            rows, scores = rows[near], scores[near]
            if len(rows) > 4 * k:  # only the k best and their ties can enter
                cut = np.partition(scores, len(scores) - k)[len(scores) - k]
                rows, scores = rows[scores >= cut], scores[scores >= cut]
            ids = tree.ids[rows]
            mine = sorted(mine + [(-s, i) for s, i in zip(scores.tolist(), ids.tolist())])[:k]
            if len(mine) == k:
                kth = max(kth, float(-mine[-1][0]))
        best[q] = mine


def _stored(tree: BallTree, store, path: str) -> dict:
    """Write a tree; what a block must know to pass it by."""
    with store.open_output_stream(path) as f:
        f.write(pickle.dumps(tree))
    centre = tree.vectors.mean(axis=0)
    radius = float(np.sqrt(((tree.vectors - centre) ** 2).sum(axis=1).max()))
    return {"path": path, "centre": centre.tolist(), "radius": radius, "norm": tree.norm}


_ROOTS = pa.schema([("path", pa.string()), ("centre", pa.list_(pa.float64())), ("radius", pa.float64()), ("norm", pa.float64())])


def grow_trees(rows: DataFrame, shard: int = SHARD) -> str:
    """Trees of all rows (id, vector) in the shared folder; the place of the table of their roots.

    Rows become trees where they lie, ``shard`` rows or ``SHARD_BYTES`` at a time, so nothing is shuffled and no id,
    however often it comes, makes a tree larger.
    """
    folder = shared_dir(rows.sparkSession, "top-k-trees")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(folder)
        ids, vectors, size = [], [], 0
        roots = []

        def flush() -> None:
            nonlocal ids, vectors, size
            roots.append(_stored(BallTree(np.array(ids, dtype=np.int64), _matrix(vectors)), store, f"{base}/{uuid.uuid4().hex}.tree"))
            ids, vectors, size = [], [], 0

        for batch in batches:
            for i, v in zip(batch.column("id").to_pylist(), _vectors(batch.column("vector"))):
                ids.append(i)
                vectors.append(v)
                size += v.nbytes
                if len(ids) >= shard or size >= SHARD_BYTES:
                    flush()
        if ids:
            flush()
        yield pa.RecordBatch.from_pylist(roots, schema=_ROOTS)

    out = folder + "/roots"
    rows.mapInArrow(run, "path string, centre array<double>, radius double, norm double").write.parquet(out)
    return out


def _vectors(column: pa.ListArray) -> list[np.ndarray]:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    ends = np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))
    return np.split(flat, ends[:-1]) if len(column) else []


def _roots(place: str) -> Iterator[dict]:
    from pyarrow import dataset

    store, base = open_store(place)
    for batch in dataset.dataset(base, filesystem=store, format="parquet", schema=_ROOTS).to_batches(batch_size=1024):
        yield from batch.to_pylist()


class _Trees:
    """Trees by path, the last few of them kept."""

    def __init__(self, place: str):
        self.store, _ = open_store(place)
        self.held: dict[str, BallTree] = {}

    def __getitem__(self, path: str) -> BallTree:
        tree = self.held.pop(path, None)
        if tree is None:
            with self.store.open_input_stream(path) as f:
                tree = pickle.loads(f.read())
            while len(self.held) >= KEPT:
                del self.held[next(iter(self.held))]
        self.held[path] = tree
        return tree


def answer(place: str, trees: _Trees, ids: np.ndarray, matrix: np.ndarray, k: int) -> list[list[tuple[int, int]]]:
    """The k best (-score, id) of each query of a block, which passes through all trees with its k-th scores in hand."""
    best: list[list[tuple[int, int]]] = [[] for _ in ids]
    kth = np.full(len(ids), -np.inf)
    norms = np.sqrt((matrix**2).sum(axis=1))
    for root in _roots(place):
        centre = np.array(root["centre"])
        dim = min(len(centre), matrix.shape[1])
        bound = matrix[:, :dim] @ centre[:dim] + norms * root["radius"] + 1e-6 * (1.0 + norms * root["norm"])
        at = np.flatnonzero(bound >= kth)
        if not len(at):
            continue
        some = [best[q] for q in at.tolist()]
        search(trees[root["path"]], ids[at], matrix[at], some, kth[at], k)
        for q, mine in zip(at.tolist(), some):
            best[q] = mine
            if len(mine) == k:
                kth[q] = float(-mine[-1][0])
    return best


def top_k(vectors: DataFrame, is_query: Column, k: int = K, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score from rows of (id, vector); ``is_query`` picks the queries by the column ``id``."""
    spark = vectors.sparkSession
    rows = materialize(chosen(vectors, "id", "vector").filter(F.col("id").isNotNull()), "top-k-vectors")
    place = grow_trees(rows, shard)
    asked = rows.filter(is_query)
    n = asked.count()
    tasks = max(1, -(-n // block), min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // LEAST_BLOCK)))
    # rows that repeat id and vector ask once, for as many answers as they are
    queries = asked.repartition(tasks, "id", "vector").groupBy("id", "vector").agg(F.count(F.lit(1)).alias("n"))
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = _Trees(place)
        for batch in batches:
            for b in range(0, batch.num_rows, block):
                part = batch.slice(b, block)
                ids, times = part.column("id").to_numpy(zero_copy_only=False), part.column("n").to_pylist()
                found = answer(place, trees, ids, _matrix(_vectors(part.column("vector"))), k)
                out = [(q, i, -s) for q, mine, m in zip(ids.tolist(), found, times) for s, i in [x for x in mine for _ in range(min(m, k))][:k]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else ([], [], []))], schema=schema)

    found = queries.mapInArrow(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
