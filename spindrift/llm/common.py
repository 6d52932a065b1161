"""Helpers shared by the corpus operators: reading tables, the shared folder, written intermediate tables."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.storage import materialize, open_store, shared_dir

__all__ = ["apart", "batches", "chosen", "joined_small", "materialize", "open_store", "shared_dir", "table", "word_count", "words_of"]

#: What counts as a word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: ASCII white space as a Java character class.
SPACES = r"[\x20\x09-\x0D]+"
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the parquet tables of ``sf_dir``; any path that Spark can read will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _place(names: list[str], wanted: str) -> int:
    """Where a column is: its exact name counts first, then one that differs in case alone."""
    for same in (lambda n: n == wanted, lambda n: n.lower() == wanted.lower()):
        found = [k for k, n in enumerate(names) if same(n)]
        if found:
            return found[0]
    raise ValueError(f"no column {wanted} among {names}")


def chosen(df: DataFrame, *names: str) -> DataFrame:
    """Just the named columns, told by place, so that columns whose names clash with them do no harm."""
    at = [_place(df.columns, n) for n in names]
    return df.toDF(*[f"c{k}" for k in range(len(df.columns))]).select(*[F.col(f"c{k}").alias(n) for k, n in zip(at, names)])


def apart(df: DataFrame, needed: tuple[str, ...], made: tuple[str, ...]) -> tuple[DataFrame, list[str], list[str], dict[str, str]]:
    """``df`` with columns c0, c1, ..., for operators that add to rows whatever their columns are called.

    Also the names (c0, ...) and the original names of the columns that stay, which are all but those named as one that
    is ``made``, in any case; and where each ``needed`` column is. Afterwards ``toDF`` gives the names back.
    """
    places = {n: f"c{_place(df.columns, n)}" for n in needed}
    stay = [k for k, n in enumerate(df.columns) if n.lower() not in {m.lower() for m in made}]
    kept = [f"c{k}" for k in stay]
    plain = df.toDF(*[f"c{k}" for k in range(len(df.columns))])
    return plain.select(*kept, *sorted(set(places.values()) - set(kept))), kept, [df.columns[k] for k in stay], places


def word_count(text: Column) -> Column:
    """Number of words as a long; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def words_of(text: Column) -> Column:
    """The words of a text in order as an array; null gives an empty array.

    Splitting at one literal character takes the JVM's short cut, which a character class does not.
    """
    blank = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x09-\x0D]", " ")
    return F.array_remove(F.split(blank, " "), "")


def joined_small(big: DataFrame, small: DataFrame, on, how: str = "left", limit: int = 100_000) -> DataFrame:
    """Join with a side that is expected to be small: broadcast only if a count proves ``limit`` rows or fewer.

    Beyond the limit Spark's own join runs, whose skewed partitions adaptive execution splits.
    """
    side = F.broadcast(small) if small.limit(limit + 1).count() <= limit else small
    return big.join(side, on, how)


def batches(schema: pa.Schema, source: Iterator[dict], rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """Record batches of ``schema`` from row dicts."""
    held: list[dict] = []
    for row in source:
        held.append(row)
        if len(held) >= rows:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)
