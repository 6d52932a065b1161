"""Signals as a store by case and track, and a Spark data source that reads of it what a query asks for.

The store is two Parquet tables. ``data`` holds the signals in order of case, track and time, many cases to a file; a long
case goes over several files. ``index`` has a row for each case and track of a file: which rows of the file they are, and
their first and last time. The source plans its partitions from the index alone: tests on caseid, track and time choose runs
of rows before any signal is read, then row groups by their statistics, and then rows. Small runs share a partition.

Tests are given when the store is opened; with ``pushdown``, and the session's ``spark.sql.python.filterPushdown.enabled``
on, they also come from a query's filters. In that case Spark 4.1 keeps one set of pushed filters for each
DataFrame that was loaded, so a query that filters the same one in two ways must load it twice; opening with tests has no
such limit.
"""

from __future__ import annotations

import json
import operator
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import pyarrow as pa
from pyarrow import compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual

from .storage import open_store

SCHEMA = "caseid long, time_sec double, track string, value double, ord long"
_ARROW = pa.schema([("caseid", pa.int64()), ("time_sec", pa.float64()), ("track", pa.string()), ("value", pa.float64()), ("ord", pa.int64())])
#: Bytes of signals that a partition reads, and of a signal (its three numbers).
PARTITION_BYTES = 32 << 20
ROW_BYTES = 24
#: Rows of a row group; runs of a file that are no further apart are read at one go.
GROUP_ROWS = 1 << 17
_COMPARE = {"==": pc.equal, ">": pc.greater, ">=": pc.greater_equal, "<": pc.less, "<=": pc.less_equal}
_PUSHED = {EqualTo: "==", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}
#: A test: column, one of the comparisons or "in", value or list of values.
Test = tuple[str, str, object]


def write_signal_store(rows: DataFrame, path: str) -> None:
    """Write (caseid, time_sec, track, value, ord) as a store; rows without a case or a track are left out."""
    order = ["caseid", "track", "time_sec", "ord"]
    kept = rows.select("caseid", "time_sec", "track", "value", "ord").filter("caseid is not null and track is not null")
    kept.repartitionByRange(*order).sortWithinPartitions(*order).write.option("parquet.block.row.count.limit", GROUP_ROWS).parquet(f"{path}/data")
    written = rows.sparkSession.read.schema(SCHEMA).parquet(f"{path}/data")
    time = F.nanvl("time_sec", F.lit(None).cast("double"))  # no test holds for NaN
    runs = written.groupBy(F.col("_metadata.file_name").alias("file"), "caseid", "track").agg(F.min("_metadata.row_index").alias("row"), F.count(F.lit(1)).alias("n"), F.min(time).alias("first_time"), F.max(time).alias("last_time"))
    runs.orderBy("file", "row").write.parquet(f"{path}/index")


def read_signal_store(spark: SparkSession, path: str, *tests: Test, pushdown: bool = False) -> DataFrame:
    """The store's signals that pass all tests on caseid, track and time_sec.

    With ``pushdown`` a query's own filters on them are taken as well; the session's setting must allow it.
    """
    for column, how, _ in tests:
        if column not in ("caseid", "track", "time_sec") or how not in (*_COMPARE, "in"):
            raise ValueError(f"no test {how} on {column}")
    spark.dataSource.register(SignalStore)
    return spark.read.format("signal_store").option("tests", json.dumps(tests)).option("pushdown", str(pushdown).lower()).load(path)


@dataclass
class Piece(InputPartition):
    """Rows that are read together: case and track of the first, file, number of the first, and of the one after the last."""

    files: list[tuple[int, str, str, int, int]] = field(default_factory=list)


def _valued(column: str, values: list) -> list:
    """What a column can hold of the values it is tested against."""
    kind = {"caseid": int, "time_sec": float, "track": str}[column]
    return [kind(v) for v in values if v is not None and kind(v) == v]


def _holds(at, column: str, how: str, value):
    """A test of a column, given as its values or as an expression."""
    return pc.is_in(at, value_set=pa.array(_valued(column, value), _ARROW.field(column).type)) if how == "in" else _COMPARE[how](at, value)


def _may_hold(column: str, how: str, value):
    """Whether a test can hold in a run, as an expression on the index."""
    if column != "time_sec":
        return _holds(pc.field(column), column, how, value)
    first, last = pc.field("first_time"), pc.field("last_time")
    if how in ("==", "in"):
        times = [value] if how == "==" else _valued(column, value)
        return (first <= max(times)) & (last >= min(times)) if times else pc.scalar(False)
    return _COMPARE[how](last if how in (">", ">=") else first, value)


class SignalStore(DataSource):
    @classmethod
    def name(cls) -> str:
        return "signal_store"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        kind = PushedSignalReader if self.options.get("pushdown") == "true" else SignalReader
        return kind(self.options["path"], int(self.options.get("partition_bytes", PARTITION_BYTES)), json.loads(self.options.get("tests", "[]")))


class SignalReader(DataSourceReader):
    def __init__(self, path: str, partition_bytes: int, tests: Iterable[Test] = ()):
        self.path, self.partition_bytes, self.tests = path, partition_bytes, [tuple(t) for t in tests]

    def _times(self) -> list[Test]:
        return [t for t in self.tests if t[0] == "time_sec"]

    def partitions(self) -> list[InputPartition]:
        from pyarrow import dataset, fs

        store, base = open_store(self.path)
        test = reduce(operator.and_, [_may_hold(*t) for t in self.tests]) if self.tests else None
        out, size = [Piece()], 0
        for info in sorted(store.get_file_info(fs.FileSelector(f"{base}/index")), key=lambda x: x.path):
            if not info.base_name.endswith(".parquet"):
                continue
            for b in dataset.dataset(info.path, filesystem=store, format="parquet").to_batches(filter=test):
                for name, case, track, row, n in zip(*(b.column(c).to_pylist() for c in ("file", "caseid", "track", "row", "n"))):
                    files, path = out[-1].files, f"{base}/data/{name}"
                    near = bool(files) and files[-1][2] == path and row - files[-1][4] <= GROUP_ROWS
                    cost = (row + n - (files[-1][4] if near else row)) * ROW_BYTES  # with what lies between
                    if files and size + cost > self.partition_bytes:
                        out.append(Piece([(case, track, path, row, row + n)]))
                        size = n * ROW_BYTES
                        continue
                    if near:
                        files[-1] = (*files[-1][:4], row + n)
                    else:
                        files.append((case, track, path, row, row + n))
                    size += cost
        return out

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        from pyarrow import dataset

        store, _ = open_store(self.path)
        test = reduce(operator.and_, [_holds(pc.field(c), c, how, value) for c, how, value in self.tests]) if self.tests else None
        for _, _, path, start, end in partition.files:
            whole = dataset.ParquetFileFormat().make_fragment(path, filesystem=store)
            chosen = {g.id for g in (whole if test is None else whole.subset(test)).row_groups}
            at = 0
            for group in whole.row_groups:
                first, at = at, at + group.num_rows
                if group.id not in chosen or first >= end or at <= start:
                    continue
                rows = whole.subset(row_group_ids=[group.id]).to_table(columns=_ARROW.names)
                rows = rows.slice(max(start - first, 0), min(end, at) - max(start, first))
                for c, how, value in self.tests:
                    rows = rows.filter(_holds(rows.column(c), c, how, value))
                yield from rows.cast(_ARROW).to_batches(max_chunksize=65_536)


class PushedSignalReader(SignalReader):
    """A reader that Spark hands a query's filters to."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Takes comparisons of caseid, track and time_sec with a value; gives back all others."""
        left = []
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column in ("caseid", "track", "time_sec") and isinstance(f, In):
                self.tests.append((column, "in", list(f.value)))
            elif column in ("caseid", "track", "time_sec") and type(f) in _PUSHED:
                self.tests.append((column, _PUSHED[type(f)], f.value))
            else:
                left.append((column, f))
        # a folder's name is a value always, and so is a time that passes a test
        valued = ("caseid", "track", "time_sec") if self._times() else ("caseid", "track")
        yield from (f for column, f in left if not (isinstance(f, IsNotNull) and column in valued))
