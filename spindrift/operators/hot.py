"""Statistics, fills and thinning of a case (any key) that is too long for one task.

A case is cut into ranges of time, each range is worked on by itself, and only one small row per range goes through a task
that sees the whole case.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..sources.storage import materialize

#: Values of one key that one task may hold; quantiles and accuracy of the sketch of one round of refinement.
MOST = 65_536
BINS = 256
ACCURACY = 4096
#: Intervals sent to every executor at most; beyond that they are joined by shuffle.
FEW = 100_000
#: Seconds of a range, a power of two, so that a time's range is exact.
WIDTH = 4096.0


def _met(a: DataFrame, b: DataFrame, keys: Sequence[str], few: bool, how: str = "inner") -> DataFrame:
    """``a`` with the rows of ``b`` of equal keys, of which NULL is one; ``b`` loses its keys."""
    other = b.select(*[F.col(c).alias(f"__of_{c}") if c in keys else F.col(c) for c in b.columns])
    on = reduce(Column.__and__, [a[k].eqNullSafe(other[f"__of_{k}"]) for k in keys], F.lit(True))
    return a.join(F.broadcast(other) if few else other, on, how).drop(*[f"__of_{k}" for k in keys])


def quantiles(rows: DataFrame, keys: Sequence[str], column: str, shares: Sequence[float], extra: Sequence[Column] = (), most: int = MOST, bins: int = BINS) -> DataFrame:
    """Per key the exact quantiles of a column (an array, in the order of ``shares``), linear between values, and ``extra`` aggregates.

    Keys of at most ``most`` values are sorted in a task. Of the others each wanted rank is enclosed in an interval. A round
    sketches the interval's values by ``bins`` approximate quantiles, takes the two around the rank, counts exactly what is
    below, at, between and above them (both aggregates are merged before the shuffle), and goes on with the part that holds
    the rank, until ``most`` values or one distinct value are left. Both ends have parts of their own, so every round takes
    off a value at least, however bad the sketch; as a rule it leaves three of ``bins`` parts. NULLs do not count; NaN is the
    greatest value; a key without values has no row.
    """
    keys, shares = list(keys), [float(q) for q in shares]
    some = rows.withColumn("__v", F.col(column).cast("double")).filter(F.col("__v").isNotNull())
    plain = lambda df: df.groupBy(*keys).agg(F.percentile("__v", F.array(*map(F.lit, shares))).alias("quantiles"), *extra)
    counts = some.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi"), *extra)
    hot = materialize(counts.filter(F.col("__n") > most), "hot")
    n_hot = hot.count()
    if not n_hot:
        return plain(some)
    few = n_hot * 2 * len(shares) <= FEW
    names = hot.select(*keys)
    values = materialize(_met(some.select(*keys, "__v"), names, keys, few), "hot-values")
    at = [F.lit(q) * (F.col("__n") - 1) for q in shares]
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(p), F.ceil(p)) for p in at])))
    state = hot.select(*keys, F.explode(ranks).alias("__rank"), "__lo", "__hi", F.lit(0).cast("long").alias("__below"), F.col("__n").alias("__in"))
    span = ["__lo", "__hi", "__below", "__in"]
    unsettled = (F.col("__in") > most) & (F.col("__lo") < F.col("__hi"))
    v, lo, hi = F.col("__v"), F.col("__lo"), F.col("__hi")
    at_bin = F.floor((F.col("__rank") - F.col("__below")) * bins / F.col("__in")).cast("int")
    low, high = F.get("__cuts", F.greatest(F.lit(0), at_bin - 1)), F.get("__cuts", F.least(F.lit(bins), at_bin + 2))
    slot = F.when(v < F.col("__low"), 0).when(v == F.col("__low"), 1).when(v < F.col("__high"), 2).when(v == F.col("__high"), 3).otherwise(4)
    while True:
        state = materialize(state, "hot-ranks")
        wanted = state.filter(unsettled)
        if wanted.isEmpty():
            break
        inside = _met(values, wanted.select(*keys, *span).distinct(), keys, few).filter(v.between(lo, hi))
        cuts = inside.groupBy(*keys, *span).agg(F.percentile_approx("__v", [k / bins for k in range(bins + 1)], ACCURACY).alias("__cuts"))
        wanted = materialize(_met(wanted, cuts, [*keys, *span], False).withColumn("__low", low).withColumn("__high", high).drop("__cuts"), "hot-cuts")
        span_cut = [*span, "__low", "__high"]
        inside = _met(values, wanted.select(*keys, *span_cut).distinct(), keys, few).filter(v.between(lo, hi))
        counted = inside.groupBy(*keys, *span_cut, slot.alias("__slot")).agg(F.count(F.lit(1)).alias("__c"), F.min("__v").alias("__a"), F.max("__v").alias("__b"))
        up_to = F.sum("__c").over(Window.partitionBy(*keys, *span_cut).orderBy("__slot"))
        counted = counted.withColumn("__from", F.col("__below") + up_to - F.col("__c"))
        found = _met(wanted, counted.drop("__slot"), [*keys, *span_cut], False).filter((F.col("__rank") >= F.col("__from")) & (F.col("__rank") < F.col("__from") + F.col("__c")))
        found = found.select(*keys, "__rank", F.col("__a").alias("__lo"), F.col("__b").alias("__hi"), F.col("__from").alias("__below"), F.col("__c").alias("__in"))
        state = state.filter(~unsettled).unionByName(found)
    open_ = state.filter(lo < hi)
    sorted_ = _met(values, open_.select(*keys, *span).distinct(), keys, few).filter(v.between(lo, hi)).groupBy(*keys, *span).agg(F.sort_array(F.collect_list("__v")).alias("__all"))
    value = F.get("__all", (F.col("__rank") - F.col("__below")).cast("int"))
    settled = _met(open_, sorted_, [*keys, *span], False).select(*keys, "__rank", value.alias("__value")).unionByName(state.filter(~(lo < hi)).select(*keys, "__rank", lo.alias("__value")))
    of_rank = settled.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("__rank", "__value"))).alias("__of"))
    pick = lambda p: F.try_element_at("__of", p)
    line = [F.when(F.floor(p) == F.ceil(p), pick(F.floor(p))).otherwise((F.ceil(p) - p) * pick(F.floor(p)) + (p - F.floor(p)) * pick(F.ceil(p))) for p in at]
    out = _met(hot, of_rank, keys, False).withColumn("quantiles", F.array(*line)).drop("__n", "__lo", "__hi", "__of")
    rest = plain(_met(some, names, keys, few, "left_anti"))
    return rest.unionByName(out.select(*rest.columns))


def place(width: float) -> Column:
    """The range of a row's time."""
    return F.floor(F.col("time_sec") / F.lit(width))


def _order(df: DataFrame) -> list[str]:
    return ["time_sec", *[c for c in ("ord",) if c in df.columns]]


def neighbours(signals: DataFrame, keys: Sequence[str], width: float = WIDTH) -> DataFrame:
    """``signals`` with ``__a``, the last point (time_sec, value) with a value at or before each row, and ``__b``, the first one at or after.

    Ranges hand on their first and last points: one row per range, put in order by key, becomes two rows at the ends of the
    range it is handed to. Rows go through one shuffle, by key and range.
    """
    keys, order = list(keys), _order(signals)
    point = F.when(F.col("value").isNotNull(), F.struct("time_sec", "value"))
    rows = signals.withColumn("__place", place(width)).withColumn("__point", point).withColumn("__side", F.lit(0))
    at = F.when(F.col("value").isNotNull(), F.struct(*order))
    ends = rows.groupBy(*keys, "__place").agg(F.min_by("__point", at).alias("__first"), F.max_by("__point", at).alias("__last"))
    earlier = Window.partitionBy(*keys).orderBy("__place").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(*keys).orderBy(F.desc("__place")).rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("__before", F.last("__last", ignorenulls=True).over(earlier)).withColumn("__after", F.last("__first", ignorenulls=True).over(later))
    handed = F.explode(F.array(F.struct(F.lit(-1).alias("side"), F.col("__before").alias("point")), F.struct(F.lit(1).alias("side"), F.col("__after").alias("point"))))
    handed = ends.select(*keys, "__place", handed.alias("__h")).select(*keys, "__place", F.col("__h.side").alias("__side"), F.col("__h.point").alias("__point")).filter("__point is not null")
    every = rows.unionByName(handed, allowMissingColumns=True)
    here = Window.partitionBy(*keys, "__place")
    back = here.orderBy("__side", *order).rowsBetween(Window.unboundedPreceding, 0)
    ahead = here.orderBy(F.desc("__side"), *[F.desc(c) for c in order]).rowsBetween(Window.unboundedPreceding, 0)  # a frame that grows backwards is built anew for each row
    every = every.withColumn("__a", F.last("__point", ignorenulls=True).over(back)).withColumn("__b", F.last("__point", ignorenulls=True).over(ahead))
    return every.filter("__side = 0").drop("__place", "__point", "__side")


def with_past(signals: DataFrame, keys: Sequence[str], lookback_sec: float, width: float = WIDTH) -> DataFrame:
    """Rows of each key and ``__place`` with what they need of earlier ranges: points of the last ``lookback_sec`` before the
    range, and the last point before those. ``__own`` tells a range's own rows; the others only serve to be looked at."""
    keys, order = list(keys), _order(signals)
    width = max(width, 2.0 ** math.ceil(math.log2(lookback_sec)) if lookback_sec > 0 else width)
    rows = signals.withColumn("__place", place(width)).withColumn("__own", F.lit(True))
    near = F.col("time_sec") >= (F.col("__place") + 1) * width - lookback_sec
    whole = F.struct(*[F.col(f"`{c}`") for c in signals.columns])
    known = F.col("value").isNotNull()
    ends = rows.groupBy(*keys, "__place").agg(F.max_by(whole, F.when(known & ~near, F.struct(*order))).alias("__early"), F.max_by(whole, F.when(known, F.struct(*order))).alias("__late"))
    by = Window.partitionBy(*keys).orderBy("__place")
    late = lambda upto: F.last("__late", ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, upto))
    next_to = F.lag("__place").over(by) == F.col("__place") - 1
    ends = ends.withColumn("__past", F.when(next_to, F.coalesce(F.lag("__early").over(by), late(-2))).otherwise(late(-1)))
    past = ends.filter("__past is not null").select("__place", "__past.*").withColumn("__own", F.lit(False))
    halo = rows.filter(near & known).withColumn("__place", F.col("__place") + 1).withColumn("__own", F.lit(False))
    return rows.unionByName(halo).unionByName(past)


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables that end where a range (caseid, __place) ends; the last range of a batch waits for the next batch."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, table]) if held is not None else table
        cut = int(_starts(table)[-1])
        if cut:
            yield table.slice(0, cut)
        held = table.slice(cut)
    if held is not None:
        yield held


def _starts(table: pa.Table) -> np.ndarray:
    """First rows of the ranges of a sorted table."""
    case = pd.factorize(table.column("caseid").to_pandas(), use_na_sentinel=False)[0]
    at = table.column("__place").to_numpy()
    return np.flatnonzero(np.concatenate([[True], (case[1:] != case[:-1]) | (at[1:] != at[:-1])]))


def _nexts(times: np.ndarray, marks: np.ndarray | None, gap: float) -> np.ndarray:
    """For each event of a range the first later one that is ``gap`` away or has another mark; the length if there is none."""
    n = len(times)
    at = np.arange(n)
    far = np.maximum(np.searchsorted(times, times + gap), at + 1)
    while True:  # sums and differences round apart
        less = (far - 1 > at) & (times[far - 1] - times >= gap)
        more = (far < n) & (times[np.minimum(far, n - 1)] - times < gap)
        if not less.any() and not more.any():
            break
        far = far - less + (more & ~less)
    if marks is None:
        return far
    ends = np.append(np.flatnonzero(marks[1:] != marks[:-1]) + 1, n)
    return np.minimum(far, ends[np.searchsorted(ends, at, side="right")])


def thin_long(events: DataFrame, gap_sec: float, label: str | None = None, width: float | None = None) -> DataFrame:
    """``anchors.thin`` for cases of any length: the same events are kept, and no task holds or goes through a whole case.

    Which event is kept next is a function that composes. Every range follows it, by doubling jumps, from each event that
    could be the first one kept there to the last one kept: the events of the range's first ``gap_sec`` and one more, of which
    those with the same end are one row. A case's ranges are linked over those few rows, and then thinned by themselves, each knowing what was kept before it. A task holds
    one range's rows: ``width`` seconds (64 gaps unless given). Events without a time drop out; with no gap all others stay.
    """
    rows = events.filter(F.col("time_sec").isNotNull() & ~F.isnan(F.col("time_sec").cast("double")))
    if gap_sec <= 0:
        return rows
    width = width or 2.0 ** math.ceil(math.log2(64 * gap_sec))
    if width < gap_sec:
        raise ValueError("a range must be as wide as the gap")
    rows = materialize(rows.withColumn("__place", place(width)), "thin")
    order = [*_order(events), *([label] if label else [])]
    tasks = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    case_type = events.schema["caseid"].dataType
    by_range = ["caseid", "__place", *order]

    def parts(table: pa.Table) -> Iterator[tuple[int, int, np.ndarray, np.ndarray | None]]:
        starts = _starts(table).tolist()
        times = table.column("time_sec").to_numpy().astype(float)
        marks = pd.factorize(table.column(label).to_pandas(), use_na_sentinel=False)[0] if label else None
        for begin, end in zip(starts, [*starts[1:], table.num_rows]):
            yield begin, end, times[begin:end], None if marks is None else marks[begin:end]

    def exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole(batches):
            enter, leave, number = [], [], []
            for begin, _, times, marks in parts(table):
                nexts = _nexts(times, marks, gap_sec)
                jump = np.where(nexts < len(times), nexts, np.arange(len(times)))
                while not np.array_equal(further := jump[jump], jump):
                    jump = further
                n = min(int(np.argmax(times - times[0] >= gap_sec)) + 1 if times[-1] - times[0] >= gap_sec else len(times), len(times))
                other = jump[1:n] != jump[: n - 1]
                if marks is not None:
                    other |= marks[1:n] != marks[: n - 1]
                ends_run = np.flatnonzero(np.append(other, True))  # of a run with one end the last one stands for all: it may come first whenever one of them may
                enter.append(begin + ends_run)
                leave.append(begin + jump[ends_run])
                number.append(ends_run)
            enter, leave = np.concatenate(enter), np.concatenate(leave)
            mark = table.column(label).cast(pa.string()) if label else pa.nulls(table.num_rows, pa.string())
            names = ["caseid", "place", "no", "time", "mark", "last", "last_mark"]
            took = [table.column("caseid").take(enter), table.column("__place").take(enter), pa.array(np.concatenate(number)), table.column("time_sec").cast(pa.float64()).take(enter), mark.take(pa.array(enter)), table.column("time_sec").cast(pa.float64()).take(leave), mark.take(pa.array(leave))]
            yield from pa.table(took, names=names).combine_chunks().to_batches()

    field = lambda n, t: T.StructField(n, t)
    ends = [field("time", T.DoubleType()), field("mark", T.StringType()), field("last", T.DoubleType()), field("last_mark", T.StringType())]
    table_schema = T.StructType([field("caseid", case_type), field("place", T.LongType()), field("no", T.LongType()), *ends])
    jumps = rows.repartition(tasks, "caseid", "__place").sortWithinPartitions(*by_range).mapInArrow(exits, table_schema)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        case = at = last = tag = None
        begun = done = False
        for batch in batches:
            out = []
            for c, p, t, m, to, to_mark in zip(*[batch.column(n).to_pylist() for n in ("caseid", "place", "time", "mark", "last", "last_mark")]):
                if not begun or c != case:
                    begun, case, at, last, tag = True, c, None, None, None
                if p != at:
                    at, done = p, False
                    out.append((c, p, last, tag))
                if not done and (last is None or m != tag or t - last >= gap_sec):
                    last, tag, done = to, to_mark, True
            columns = list(zip(*out)) or [[]] * 4
            types = [batch.schema.field("caseid").type, pa.int64(), pa.float64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=["caseid", "__place", "__last", "__tag"])

    before_schema = T.StructType([field("caseid", case_type), field("__place", T.LongType()), field("__last", T.DoubleType()), field("__tag", T.StringType())])
    before = materialize(jumps.repartition(tasks, "caseid").sortWithinPartitions("caseid", "place", "no").mapInArrow(link, before_schema), "thin-links")
    known = _met(rows, before, ["caseid", "__place"], False).repartition(tasks, "caseid", "__place").sortWithinPartitions(*by_range)
    columns = events.columns

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole(batches):
            kept = np.zeros(table.num_rows, dtype=bool)
            last, tag = table.column("__last"), table.column("__tag")
            for begin, end, times, marks in parts(table):
                n, before_it = end - begin, last[begin].as_py()
                ok = np.ones(n, dtype=bool) if before_it is None else times - before_it >= gap_sec
                if label and before_it is not None:
                    said = table.column(label).slice(begin, n).cast(pa.string()).to_pandas()
                    name = tag[begin].as_py()
                    ok |= (said.notna() if name is None else said != name).to_numpy(dtype=bool)
                at = int(np.argmax(ok)) if ok.any() else n
                nexts = _nexts(times, marks, gap_sec)
                while at < n:
                    kept[begin + at] = True
                    at = int(nexts[at])
            yield from table.select(columns).filter(pa.array(kept)).combine_chunks().to_batches()

    return known.mapInArrow(keep, events.schema)
