"""Writing groups, records, logs and reports with Spark's own writers."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.values import printable


def write_groups(cases: DataFrame, path: str, group: str = "surgery_group") -> None:
    """For each group its cases (``clinical_subset``) and their ids (``caseids``) as CSV, in folders by group."""
    for name, df in (("clinical_subset", cases), ("caseids", cases.select("caseid", group))):
        df.write.mode("overwrite").partitionBy(group).option("header", True).csv(f"{path}/{name}")


def clean_strings(df: DataFrame) -> DataFrame:
    """Control characters out of all top-level text columns and arrays of text."""
    def clean(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            return printable(c).alias(f.name)
        if f.dataType == T.ArrayType(T.StringType()):
            return F.transform(c, printable).alias(f.name)
        return c

    return df.select([clean(f) for f in df.schema.fields])


def write_json_lines(df: DataFrame, path: str, append: bool = False) -> None:
    clean_strings(df).write.mode("append" if append else "overwrite").option("ignoreNullFields", False).json(path)


def write_json_array(df: DataFrame, path: str) -> None:
    """All rows as one JSON array in one file under ``path``. An array has one writer: rows stream through one task."""
    lines = clean_strings(df).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).coalesce(1)

    def run(batches):
        first = True
        for batch in batches:
            rows = [("[" if first and k == 0 else ",") + r for k, r in enumerate(batch.column("value").to_pylist())]
            first = first and not rows
            yield pa.RecordBatch.from_pydict({"value": rows})
        yield pa.RecordBatch.from_pydict({"value": ["[]" if first else "]"]})

    lines.mapInArrow(run, "value string").write.mode("overwrite").text(path)


BOM = "\ufeff"


def write_csv(df: DataFrame, path: str, separator: str = ";", mark: bool = False) -> None:
    """Arrays joined to text, one header per file; ``mark`` puts a byte order mark before the header."""
    flat = [F.array_join(F.col(f"`{f.name}`").cast("array<string>"), separator).alias(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f"`{f.name}`") for f in df.schema.fields]
    out = clean_strings(df.select(flat))
    out = out.toDF(*[(BOM if mark and k == 0 else "") + n for k, n in enumerate(out.columns)])
    out.write.mode("overwrite").option("header", True).csv(path)


def write_evaluation(rows: DataFrame, summary: DataFrame, path: str) -> None:
    """An evaluation as JSON lines, as CSV with a byte order mark, and its one-row summary as JSON."""
    write_json_lines(rows, f"{path}/rows")
    write_csv(rows, f"{path}/table", mark=True)
    write_json_lines(summary.limit(1), f"{path}/summary")


def write_cleaned(rows: DataFrame, before: str, after: str, strict: str, path: str) -> DataFrame:
    """JSON lines of the rows of which something is left, and the counts of the cleaning pass as one row."""
    some = F.col(after).isNotNull() & (F.trim(after) != "")
    write_json_lines(rows.filter(some), path)
    return rows.agg(*cleaning_counts(before, after, strict))


def write_buckets(records: DataFrame, path: str) -> DataFrame:
    """A folder of JSON lines per bucket; returns the counts."""
    records.write.mode("overwrite").partitionBy("training_bucket").json(path)
    return records.groupBy("training_bucket").agg(F.count(F.lit(1)).alias("n"))


def write_index(vectors: DataFrame, path: str, signature: str) -> None:
    vectors.withColumn("signature", F.lit(signature)).write.mode("overwrite").parquet(path)


def cleaning_counts(before: str, after: str, strict: str) -> list:
    """Aggregates of a cleaning pass: total, changed, strict, dropped."""
    n = lambda c, a: F.count(F.when(c, 1)).alias(a)
    b, a = F.col(before), F.col(after)
    return [F.count(F.lit(1)).alias("total"), n(~a.eqNullSafe(b), "changed"), n(F.col(strict), "strict"), n(a.isNull() | (F.trim(a) == ""), "dropped")]


def markdown(summary: dict, rows: list[dict], title: str, most: int = 50) -> str:
    """A small report of counters and a table; rows are a limited selection made by the caller."""
    out = [f"# {title}", ""] + [f"- {k}: {v}" for k, v in summary.items()]
    if rows:
        names = list(rows[0])
        cell = lambda v: str(v).replace("|", "\\|").replace("\n", " ")
        out += ["", "| " + " | ".join(names) + " |", "|" + "---|" * len(names)]
        out += ["| " + " | ".join(cell(r[n]) for n in names) + " |" for r in rows[:most]]
    return "\n".join(out) + "\n"


def plot_data(window: DataFrame, keys: list[str]) -> DataFrame:
    """What a window plot shows: interpolated series and the share of valid points."""
    from ..operators.series import interpolated

    share = window.groupBy(*keys).agg(F.count("value").alias("n_valid"), F.count(F.lit(1)).alias("n_total"))
    return interpolated(window, keys).join(share, keys)
