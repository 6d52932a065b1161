"""Reading cases, records, corpora, annotations, rules and indexes with Spark's own readers."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.values import case_id, first_present, safe_number, strip, valid_text
from .storage import materialize

# Names under which columns come.
TIME_NAMES = ("time_sec", "time_second", "time_s", "time", "sec", "seconds", "timestamp_sec", "timestamp")
LABEL_NAMES = ("label", "arrhythmia", "arrhythmia_label", "rhythm", "rhythm_label", "annotation", "event")
TEXT_KEYS = ("text", "content", "passage", "chunk", "body")
CORPUS_KEYS = {
    "source": ("source", "title"), "chapter": ("chapter", "chapter_title", "chapter_name", "chapter_id"), "section": ("section", "section_title", "section_name"),
    "subsection": ("subsection", "subsection_title", "subsection_name"), "paragraph": ("paragraph", "paragraph_id", "para_id", "paragraph_index"), "page": ("page", "page_no", "page_index"),
}


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text; quotes may hold line ends."""
    return spark.read.csv(path, header=True, inferSchema=False, multiLine=True, escape='"')


def read_cases(spark: SparkSession, path: str) -> DataFrame:
    """A case table with a long caseid; rows without one drop out, an absent column is an error."""
    df = read_csv(spark, path)
    ids = [c for c in (first_present(df, "caseid"), first_present(df, "case_id")) if c]
    if not ids:
        raise ValueError("the table has no caseid column")
    return df.withColumn("caseid", case_id(*[F.col(f"`{c}`") for c in dict.fromkeys(ids)])).filter(F.col("caseid").isNotNull())


def read_signals(spark: SparkSession, path: str, tracks: list[str] | None = None) -> DataFrame:
    """Long signals from Parquet; NaN is missing; a choice of tracks reaches the scan."""
    df = spark.read.parquet(path)
    df = df.filter(F.col("track").isin(tracks)) if tracks else df
    return df.withColumn("value", safe_number(F.col("value")))


def read_medication(spark: SparkSession, path: str, tracks: list[str], step: float = 3.0) -> DataFrame:
    """Signals of medication alone, one value per track and ``step`` seconds: the last known one of each step."""
    slot = F.floor(F.col("time_sec") / step) * step
    rows = read_signals(spark, path, tracks).withColumn("__slot", slot)
    at = F.struct("time_sec", "ord") if "ord" in rows.columns else F.col("time_sec")
    value = F.max_by("value", F.when(F.col("value").isNotNull(), at))
    return rows.groupBy("caseid", "track", F.col("__slot").alias("time_sec")).agg(value.alias("value")).withColumn("ord", F.lit(0).cast("long"))


def read_annotations(spark: SparkSession, path: str, pattern: str = r"Annotation_file_(\d+)\.csv", time: str | None = None, label: str | None = None) -> DataFrame:
    """caseid (from the file's name), ord, time_sec, label of rhythm annotations; unreadable files are skipped."""
    df = spark.read.option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True).csv(path, header=True, inferSchema=False)
    at, said = first_present(df, *([time] if time else TIME_NAMES)), first_present(df, *([label] if label else LABEL_NAMES))
    if at is None:
        raise ValueError("no time column among the annotations")
    file = F.col("_metadata.file_path")
    return df.select(
        F.regexp_extract(file, pattern, 1).try_cast("long").alias("caseid"),
        F.monotonically_increasing_id().alias("ord"),
        safe_number(F.col(f"`{at}`")).alias("time_sec"),
        (F.col(f"`{said}`") if said else F.lit(None).cast("string")).alias("label"),
    )


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One variant per JSON object: of JSON lines, of which broken ones are skipped, or of a .json array."""
    if path.endswith(".json"):
        whole = spark.read.text(path, wholetext=True).select(F.try_parse_json("value").alias("v"))
        rows = whole.select(F.explode(F.try_variant_get("v", "$", "array<variant>")).alias("record"))
    else:
        rows = spark.read.text(path).select(F.try_parse_json("value").alias("record"))
    return rows.filter(F.col("record").isNotNull() & F.schema_of_variant("record").startswith("OBJECT"))


def snapshots_of(records: DataFrame) -> DataFrame:
    """The snapshot within each record, or the record itself."""
    inner = F.try_variant_get("record", "$.snapshot", "variant")
    return records.withColumn("snapshot", F.coalesce(inner, "record"))


def read_corpus(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """chunk_id, line_no, text and locators of passages in JSON lines, under any of their names; blank passages drop out.

    line_no counts all lines of the input from 1, chunk_id the kept passages from 0, both in the order of the file:
    positions come from Spark's line order within partitions and a prefix over partitions.
    """
    text = lambda names: F.coalesce(*[valid_text(F.try_variant_get("record", f"$.{n}", "string")) for n in names])
    lines = numbered(spark.read.text(path), "line_no").select((F.col("line_no") + 1).alias("line_no"), F.try_parse_json("value").alias("record"))
    rows = lines.filter(F.col("record").isNotNull() & F.schema_of_variant("record").startswith("OBJECT"))
    rows = rows.select("line_no", text(TEXT_KEYS).alias("text"), *[text(n).alias(k) for k, n in CORPUS_KEYS.items()]).filter(F.col("text").isNotNull())
    return numbered(rows, "chunk_id")


def numbered(rows: DataFrame, name: str) -> DataFrame:
    """Consecutive numbers from 0 in the present order; only a count per partition goes through one task.

    Rows are written with their places first: another run of their plan might cut its partitions elsewhere.
    """
    at = materialize(rows.withColumn("__p", F.spark_partition_id()).withColumn("__m", F.monotonically_increasing_id()), "numbered")
    counts = at.groupBy("__p").agg(F.count(F.lit(1)).alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    joined = at.join(F.broadcast(counts.select("__p", before.alias("__before"))), "__p")
    return joined.withColumn(name, F.col("__before") + F.col("__m").bitwiseAND(F.lit((1 << 33) - 1))).drop("__p", "__m", "__before")


def read_passages(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(source, page, chapter, section, text) of corpus files of any kind, told by their names' ends in any case.

    JSON lines (.jsonl) hold passages, PDF files pages, and text files (.txt, .md) one text each; blank texts drop out. A
    file of another kind is an error, and so is a list without files.
    """
    readers = {(".jsonl", ".ndjson"): _jsonl_passages, (".pdf",): _pdf_passages, (".txt", ".md"): _text_passages}
    found: list[DataFrame] = []
    left = list(dict.fromkeys(paths))
    for ends, read in readers.items():
        some = [p for p in left if p.lower().endswith(ends)]
        left = [p for p in left if p not in some]
        if some:
            found.append(read(spark, some))
    if left or not found:
        raise ValueError(f"no corpus files: {', '.join(left) or 'nothing to read'}")
    out = found[0]
    for df in found[1:]:
        out = out.unionByName(df)
    return out.filter(strip(F.col("text")) != "")


def _passages(df: DataFrame) -> DataFrame:
    known = {c for c in df.columns}
    return df.select(*[(F.col(c) if c in known else F.lit(None)).cast("string").alias(c) for c in ("source", "page", "chapter", "section", "text")])


def _jsonl_passages(spark: SparkSession, paths: list[str]) -> DataFrame:
    return _passages(read_corpus(spark, paths))


def _pdf_passages(spark: SparkSession, paths: list[str]) -> DataFrame:
    return _passages(read_pdf_pages(spark, paths))


def _text_passages(spark: SparkSession, paths: list[str]) -> DataFrame:
    return _passages(read_texts(spark, paths))


def read_texts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(source, text) of plain text or Markdown files, one row a file."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("source"), strip(F.col("value")).alias("text")).filter("text <> ''")


def read_pdf_pages(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(source, page, text) of PDF files; needs a PDF library on the executors."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches):
        import io

        import pandas as pd
        from pypdf import PdfReader

        for pdf in batches:
            for name, content in pdf.itertuples(index=False):
                pages = PdfReader(io.BytesIO(content)).pages
                yield pd.DataFrame({"source": name, "page": range(1, len(pages) + 1), "text": [p.extract_text() or "" for p in pages]})

    return files.mapInPandas(run, "source string, page long, text string")


def index_signature(path: str, model: str, chunk_chars: int, overlap: int, size: int, changed: int) -> str:
    """What an embedding index was made from."""
    import hashlib

    return hashlib.sha256("|".join(map(str, (path, size, changed, model, chunk_chars, overlap))).encode()).hexdigest()


def read_index(spark: SparkSession, path: str, signature: str) -> DataFrame | None:
    """A stored embedding index, or None if it was made from something else."""
    try:
        df = spark.read.parquet(path)
    except Exception as e:  # an absent index is made anew
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise
    held = df.select("signature").limit(1).collect()
    return df.drop("signature") if held and held[0][0] == signature else None


def load_rules(text: str | None, default: dict) -> dict:
    """Rules from JSON, or YAML where a parser is installed; the default if there are none."""
    if not text:
        return default
    try:
        found = json.loads(text)
    except ValueError:
        try:
            import yaml
        except ImportError:
            return default
        found = yaml.safe_load(text)
    return found if isinstance(found, dict) else default


def judge_rules(rules: dict) -> tuple[tuple, tuple]:
    """Conflict and alignment rules as ``policy.judge`` takes them, from a dict with lists of dicts under
    ``conflict_rules`` (id, all, not, high_risk) and ``alignment_rules`` (id, all, not, outcome)."""
    def of(name: str, last: str, none) -> tuple:
        return tuple((r["id"], tuple(r.get("all") or ()), tuple(r.get("not") or ()), r.get(last, none)) for r in rules.get(name) or () if isinstance(r, dict) and r.get("id") and r.get("all"))

    return of("conflict_rules", "high_risk", False), of("alignment_rules", "outcome", "aligned")
