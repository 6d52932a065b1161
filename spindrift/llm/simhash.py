"""SimHash near-duplicates: pivot distance tables inside shards that share bits.

A text's fingerprint has a bit where more than half of its shingle hashes have it. Two fingerprints are linked if they
differ in ``MAX_BITS`` bits or fewer. Distances of random 64-bit words to a pivot all lie near 32, so pivots alone do
not divide the data: fingerprints are first dealt into shards. The 64 bits are cut into k blocks; two linked
fingerprints agree on k - MAX_BITS of them at least, so each choice of that many blocks is a table and their bits are
the shard. More fingerprints make more blocks, hence smaller shards; no choice loses a link. Inside a shard every
fingerprint has its row of Hamming distances to ``PIVOTS`` reference fingerprints; a pair whose distances to any pivot
differ by more than ``MAX_BITS`` cannot be linked and is discarded, and what survives is verified bit by bit.

Equal fingerprints are one before all that. A shard above ``TILE`` fingerprints is dealt into tiles that share a few
fingerprints; what lies outside its largest component after that meets all tiles of the shard. A shard reports a spanning
forest of its links rather than all of them.

Defined results: a null text has no words and fingerprint zero, as an empty one; those are linked like any other;
repeated rows share fingerprint and component, and so do ties at exactly ``MAX_BITS``; texts of any length are read whole;
a null doc_id is never a component's id unless all are null; an empty table gives an empty result; extra columns, whatever
their names, are ignored by ``near_duplicates`` and kept by ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import apart, chosen, joined_small, materialize
from .components import components

SHINGLE = 4
MAX_BITS = 4
PIVOTS = 16
TILE = 2_048
#: Fingerprints of a crowded shard that stand in each of its tiles.
HUBS = 32
#: Shards of up to this size are compared all at once.
SMALL = 256
SEED = 42
#: Shingles hashed together.
CHUNK = 1 << 15


def shingle_hashes(text: str | None, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """XXH64 of a text's word shingles, by chunks."""
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return
    if len(words) < size:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], dtype=np.uint64)
        return
    digest = xxhash.xxh64_intdigest
    for k in range(0, len(words) - size + 1, CHUNK):
        some = words[k : k + CHUNK + size - 1]
        joined = b" ".join(some)
        ends = np.cumsum(np.fromiter(map(len, some), dtype=np.int64, count=len(some)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        yield np.array([digest(joined[a:b], SEED) for a, b in zip(starts[: len(some) - size + 1].tolist(), ends[size - 1 :].tolist())], dtype=np.uint64)


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """The fingerprint as an unsigned number."""
    total, counts = 0, np.zeros(64, dtype=np.int64)
    for hashes in shingle_hashes(text, size):
        total += len(hashes)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view(np.uint64)[0]) if total else 0


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), size) for t in batch.column("text")], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return chosen(docs, "doc_id", "text").mapInArrow(run, "doc_id long, fp long")


def blocks_for(n: int, max_bits: int = MAX_BITS, shard: int = 32) -> int:
    """Number of blocks, ``max_bits`` + 2 at least, at which n random fingerprints make shards of about ``shard`` or fewer.

    Six blocks make 15 tables of 21 bits, which does for 80 million distinct fingerprints.
    """
    k = max_bits + 2
    while k < max_bits + 5 and n / 2 ** (64 * (k - max_bits) / k) > shard:
        k += 1
    return k


def shard_masks(blocks: int, max_bits: int = MAX_BITS) -> list[int]:
    """A mask of the bits that each table's shards agree on."""
    cuts = [round(64 * k / blocks) for k in range(blocks + 1)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]
    return [sum(chosen) for chosen in combinations(parts, blocks - max_bits)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _pivots(n: int) -> np.ndarray:
    return np.random.default_rng(SEED).integers(0, 1 << 64, n, dtype=np.uint64, endpoint=False)


class PivotTable:
    """Distances of fingerprints to the pivots, and the links that they leave possible."""

    def __init__(self, fps: np.ndarray, max_bits: int = MAX_BITS, pivots: int = PIVOTS):
        self.fps, self.max_bits = fps, max_bits
        self.rows = [np.bitwise_count(fps ^ p).astype(np.int16) for p in _pivots(pivots)]

    def linked(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Positions k at which fingerprints i[k] and j[k] are linked."""
        at = np.arange(len(j))
        for row in self.rows:
            if not len(at):
                break
            a = row[i] if np.ndim(i) == 0 else row[i[at]]
            at = at[np.abs(a - row[j[at]]) <= self.max_bits]
        a = self.fps[i] if np.ndim(i) == 0 else self.fps[i[at]]
        return at[np.bitwise_count(a ^ self.fps[j[at]]) <= self.max_bits]


def forest(table: PivotTable, members: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Edges of a spanning forest of the links among ``members`` (positions in the table)."""
    left, right = [], []
    rest = members
    while len(rest):
        todo, rest = [rest[0]], rest[1:]
        while todo and len(rest):
            at = todo.pop()
            hit = table.linked(at, rest)
            if len(hit):
                found = rest[hit]
                left.append(np.full(len(found), at))
                right.append(found)
                todo.extend(found.tolist())
                rest = np.delete(rest, hit)
    return left, right


def shard_links(group: np.ndarray, fps: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Positions of linked pairs that connect what is linked; ``group`` is sorted and names each row's shard."""
    table = PivotTable(fps, max_bits)
    start = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    size = np.diff(np.append(start, len(group)))
    left, right = [], []
    at = np.flatnonzero(np.repeat(size <= SMALL, size))
    number = np.repeat(np.arange(len(start)), size)
    d = 0
    while len(at):
        d += 1
        at = at[at + d < len(group)]
        at = at[number[at + d] == number[at]]
        hit = at[table.linked(at, at + d)]
        left.append(hit)
        right.append(hit + d)
    i, j = (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    many = np.bincount(number[i], minlength=len(start)) > size
    keep = ~many[number[i]]
    left, right = [i[keep]], [j[keep]]
    for k in np.flatnonzero(many | (size > SMALL)).tolist():
        a, b = forest(table, np.arange(start[k], start[k] + size[k]))
        left += a
        right += b
    return np.concatenate(left), np.concatenate(right)


def _keyed(distinct: DataFrame, max_bits: int) -> DataFrame:
    """(fp, key): each fingerprint in its shard of every table."""
    masks = shard_masks(blocks_for(distinct.count(), max_bits), max_bits)
    keys = F.array(*[F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(_signed(m)))) for k, m in enumerate(masks)])
    return distinct.select("fp", F.explode(keys).alias("key"))


def _tile() -> Column:
    return F.pmod(F.xxhash64(F.lit("tile"), F.col("fp")), F.col("tiles")).cast("int")


def _every_tile() -> Column:
    return F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))


def _in_groups(rows: DataFrame, group: Column, *kept: str) -> DataFrame:
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.select(group.alias("g"), *kept).repartition(n, "g").sortWithinPartitions("g", *kept)


def _whole_groups(batches: Iterator[pa.RecordBatch], rows: int = 200_000) -> Iterator[list[np.ndarray]]:
    """Columns of sorted batches, of some groups g at a time, each whole."""
    held: list[list[np.ndarray]] = []
    waiting = 0
    for batch in batches:
        held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        waiting += batch.num_rows
        if waiting >= rows:
            columns = [np.concatenate(x) for x in zip(*held)]
            end = int(np.searchsorted(columns[0], columns[0][-1]))  # the last group may go on
            held, waiting = [[c[end:] for c in columns]], len(columns[0]) - end
            if end:
                yield [c[:end] for c in columns]
    if held and waiting:
        yield [np.concatenate(x) for x in zip(*held)]


_PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _pairs(x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
    a, b = np.minimum(x, y), np.maximum(x, y)
    found = np.unique(np.stack([a, b], axis=1)[a < b], axis=0) if len(a) else np.zeros((0, 2), np.int64)
    return pa.RecordBatch.from_arrays([pa.array(found[:, 0].copy()), pa.array(found[:, 1].copy())], schema=_PAIRS)


def links(distinct: DataFrame, max_bits: int = MAX_BITS, tile: int = TILE) -> DataFrame:
    """(a, b) with a < b: links among distinct fingerprints (fp) that connect whatever is linked.

    A shard above ``tile`` is crowded, as near copies of one text make it. Its fingerprints are dealt into tiles, with
    ``HUBS`` of them in every tile, which connects most of what is linked at a cost in proportion to the shard. Only
    fingerprints outside the largest component so far then meet the other tiles.
    """
    keyed = _keyed(distinct, max_bits)
    crowded = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > tile)
    crowded = materialize(crowded.select("key", F.ceil(F.col("n") / tile).cast("int").alias("tiles")), "crowded-shards")
    marked = joined_small(keyed, crowded, "key")
    own = F.when(F.col("tiles").isNull(), F.col("key")).otherwise(F.xxhash64("key", _tile()))
    rows = marked.select("fp", "key", "tiles", own.alias("group"))
    members = marked.filter(F.col("tiles").isNotNull())
    some = not crowded.isEmpty()
    if some:
        members = materialize(members, "crowded-members")
        nth = F.row_number().over(Window.partitionBy("key").orderBy(F.xxhash64(F.lit("hub"), F.col("fp")), "fp"))
        hubs = members.withColumn("nth", nth).filter(F.col("nth") <= HUBS).select("fp", "key", "tiles", _every_tile().alias("at"))
        rows = rows.select("fp", "group").unionByName(hubs.select("fp", F.xxhash64("key", "at").alias("group"))).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g, f in _whole_groups(batches):
            i, j = shard_links(g, f.view(np.uint64), max_bits)
            yield _pairs(f[i], f[j])

    found = _in_groups(rows, F.col("group"), "fp").mapInArrow(run, "a long, b long")
    if not some:
        return found
    found = materialize(found, "links-in-tiles")
    return found.unionByName(_stragglers(found, members, max_bits))


def _stragglers(found: DataFrame, members: DataFrame, max_bits: int) -> DataFrame:
    """Links that the tiles of crowded shards have not shown: of fingerprints outside a shard's largest component."""
    roots = components(found)
    named = members.join(roots, members["fp"] == roots["node"], "left").select("fp", "key", "tiles", F.coalesce("root", "fp").alias("root"))
    named = materialize(named, "crowded-roots")
    sizes = named.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy("key").agg(F.max(F.struct("n", "root"))["root"].alias("largest"), F.count(F.lit(1)).alias("components"))
    largest = materialize(largest.filter(F.col("components") > 1).select("key", "largest"), "largest-components")
    open_ = joined_small(named, largest, "key", "inner")
    outside = open_.filter(F.col("root") != F.col("largest")).select("fp", "root", "key", _every_tile().alias("at"), F.lit(1).cast("long").alias("asks"))
    inside = open_.select("fp", "root", "key", _tile().alias("at"), F.lit(0).cast("long").alias("asks"))
    rows = outside.unionByName(inside)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g, asks, f, root in _whole_groups(batches):
            table = PivotTable(f.view(np.uint64), max_bits)
            start = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
            left, right = [], []
            for a, b in zip(start.tolist(), np.append(start[1:], len(g)).tolist()):
                middle = a + int(np.searchsorted(asks[a:b], 1))
                members_ = np.arange(a, middle)
                for q in range(middle, b):
                    hit = members_[table.linked(q, members_)]
                    hit = hit[root[hit] != root[q]]
                    hit = hit[np.unique(root[hit], return_index=True)[1]]  # one link to each other component will do
                    left.append(np.full(len(hit), q))
                    right.append(hit)
            if left:
                yield _pairs(f[np.concatenate(left)], f[np.concatenate(right)])

    return _in_groups(rows, F.xxhash64("key", "at"), "asks", "fp", "root").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS, size: int = SHINGLE) -> DataFrame:
    """doc_id, fp and component_id: the smallest doc_id that links lead to."""
    rows = materialize(fingerprints(docs, size), "fingerprints")
    distinct = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    roots = components(links(distinct.select("fp"), max_bits))
    rooted = materialize(distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), "rooted")
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = materialize(rooted.select("fp", "root").join(ids, "root").select("fp", "component_id"), "named")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, max_bits: int = MAX_BITS, size: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` whose doc_id names their component; of rows that share a doc_id one stays."""
    kept = near_duplicates(docs, max_bits, size).filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("__kept")).distinct()
    rows, places, names, at = apart(docs, ("doc_id",), ())
    stay = rows.join(kept, rows[at["doc_id"]].eqNullSafe(kept["__kept"]), "left_semi")
    first = F.row_number().over(Window.partitionBy(at["doc_id"]).orderBy(F.xxhash64(*places), *places))
    return stay.withColumn("first", first).filter("first = 1").select(*places).toDF(*names)
