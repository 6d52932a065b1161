"""Events in signals ("anchors"): changes of rates and volumes, labels, periods; thinning and choice per case."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .hot import with_past

#: Labels of a normal rhythm, lower case and blanks squeezed; no label is normal too.
NORMAL_RHYTHMS = ("", "n", "normal", "normal sinus rhythm", "sinus rhythm", "nsr", "sinus")


@dataclass(frozen=True)
class AnchorConfig:
    rate_delta: float = 0.5
    volume_delta: float = 0.03
    lookback_sec: float = 60.0
    gap_sec: float = 30.0
    per_case: int = 3
    setup_before: float = 1.0
    setup_after: float = 300.0
    setup_delta: float = 100.0
    setup_early_sec: float = 1800.0


def changes(signals: DataFrame) -> DataFrame:
    """Each sample with the one before it on its track: before, after, delta, prev_time_sec, dt_sec.

    A missing value hides the changes on both its sides.
    """
    w = Window.partitionBy("caseid", "track").orderBy("time_sec", "ord")
    out = signals.withColumn("before", F.lag("value").over(w)).withColumn("prev_time_sec", F.lag("time_sec").over(w))
    return out.withColumn("after", F.col("value")).withColumn("delta", F.col("after") - F.col("before")).withColumn("dt_sec", F.col("time_sec") - F.col("prev_time_sec"))


def rate_anchors(signals: DataFrame, threshold: float) -> DataFrame:
    """Changes by the threshold or more in either direction."""
    return changes(signals).filter(F.abs("delta") >= threshold)


def volume_anchors(signals: DataFrame, threshold: float) -> DataFrame:
    """Increases by the threshold or more, with the rate they imply in units an hour."""
    out = changes(signals).filter(F.col("delta") >= threshold)
    return out.withColumn("rate_per_h", F.when(F.col("dt_sec") > 0, F.col("delta") / F.col("dt_sec") * 3600.0))


def smoothed_rates(signals: DataFrame, lookback_sec: float) -> DataFrame:
    """Each sample with the last one at least ``lookback_sec`` earlier, else the first, and the rate between them.

    Ranges of a case are looked at by themselves, with what they need of the past (``hot.with_past``).
    """
    over = "over (partition by caseid, track, __place order by time_sec range between unbounded preceding and {} preceding)"
    point = "case when value is not null then struct(time_sec, value) end"
    first = f"first({point}, true) over (partition by caseid, track, __place order by time_sec range between unbounded preceding and current row)"
    ref = F.expr(f"coalesce(last({point}, true) {over.format(repr(float(lookback_sec)) + 'D')}, {first})")
    rows = with_past(signals, ["caseid", "track"], lookback_sec).withColumn("__ref", ref).filter("__own").drop("__own", "__place")
    dt = F.col("time_sec") - F.col("__ref.time_sec")
    return rows.select(
        "*",
        F.col("__ref.time_sec").alias("ref_time_sec"),
        F.col("__ref.value").alias("ref_value"),
        F.when(dt > 0, dt).alias("smoothed_dt_sec"),
        (F.col("value") - F.col("__ref.value")).alias("smoothed_delta"),
        F.when(dt > 0, (F.col("value") - F.col("__ref.value")) / dt * 3600.0).alias("smoothed_rate_per_h"),
    ).drop("__ref")


def likely_setup(cfg: AnchorConfig = AnchorConfig()) -> Column:
    """A large jump from about zero early in a case: a pump being set up."""
    c = F.col
    return (F.abs(c("before")) <= cfg.setup_before) & (F.abs(c("delta")) >= cfg.setup_delta) & (c("after") >= cfg.setup_after) & (F.lit(cfg.setup_early_sec <= 0) | (c("time_sec") <= cfg.setup_early_sec))


def zero_start(least: float = 100.0) -> Column:
    """A jump from exactly zero by ``least`` or more."""
    return (F.col("before") == 0) & (F.col("delta") >= least)


def thin(events: DataFrame, gap_sec: float, label: str | None = None) -> DataFrame:
    """Events of each case in time order that lie ``gap_sec`` or more after the last one kept.

    With ``label``, only an event with the same label as the last one kept can be too close. What is kept depends on
    all that was kept before, so rows stream through in order with one time per case held; nothing is gathered, and each
    step goes from one kept event to the next.
    """
    spark = events.sparkSession
    names = events.columns
    order = ["caseid", "time_sec", *[c for c in ("ord",) if c in names]]
    rows = events.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "caseid").sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        case = last = tag = None  # of the last event kept
        for batch in batches:
            if not batch.num_rows:
                continue
            cases = batch.column("caseid").dictionary_encode()
            code = cases.indices.fill_null(-1).to_numpy(zero_copy_only=False)
            times = batch.column("time_sec").to_numpy(zero_copy_only=False)
            names = batch.column(label).dictionary_encode() if label else None
            mark = names.indices.fill_null(-1).to_numpy(zero_copy_only=False) if label else np.zeros(len(code), dtype=np.int32)
            of = lambda values, k: values.dictionary[k].as_py() if k >= 0 else None
            starts = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
            same_until = np.append(np.flatnonzero((code[1:] != code[:-1]) | (mark[1:] != mark[:-1])) + 1, len(code))  # ends of runs of one label
            keep = np.zeros(len(code), dtype=bool)
            for begin, end in zip(starts.tolist(), np.append(starts[1:], len(code)).tolist()):
                this = of(cases, code[begin])

                def after(at: int, time: float, name) -> int:
                    """The first event from ``at`` on that is far enough, or of another label, from one kept."""
                    far = at + int(np.searchsorted(times[at:end], time + gap_sec))
                    while far > at and times[far - 1] - time >= gap_sec:  # sums and differences round apart
                        far -= 1
                    while far < end and times[far] - time < gap_sec:
                        far += 1
                    if label is None or at >= end:
                        return far
                    other = at if of(names, mark[at]) != name else int(same_until[np.searchsorted(same_until, at, side="right")])
                    return min(far, other)

                at = begin if last is None or this != case else after(begin, last, tag)
                while at < end:
                    keep[at], case, last, tag = True, this, float(times[at]), of(names, mark[at]) if label else None
                    at = after(at + 1, last, tag)
            yield batch.filter(pa.array(keep))

    return rows.mapInArrow(run, events.schema)


def label_events(annotations: DataFrame, end_sec: Column, keep_normal: bool = False, default: str = "unknown") -> DataFrame:
    """Annotations (caseid, ord, time_sec, label) within the case with the label before each; normal rhythms drop out.

    A label counts as "before" for the next row even if its own row is dropped as normal, but not if its time is bad.
    """
    rows = annotations.filter(F.col("time_sec").between(F.lit(0.0), end_sec))
    norm = F.regexp_replace(F.lower(F.trim(F.coalesce("label", F.lit("")))), r"\s+", " ")
    w = Window.partitionBy("caseid").orderBy("ord")
    named = F.when(F.trim(F.coalesce("label", F.lit(""))) != "", F.trim("label")).otherwise(default)
    rows = rows.withColumn("__normal", norm.isin(*NORMAL_RHYTHMS)).withColumn("after_label", named).withColumn("before_label", F.lag("after_label").over(w))
    return (rows if keep_normal else rows.filter(~F.col("__normal"))).drop("__normal")


def periodic(cases: DataFrame, start: float, window: float, step: float) -> DataFrame:
    """(caseid, time_sec) at regular times up to each case's ``end_sec``, the first with a whole window behind it."""
    begin = max(start, window)
    n = F.floor((F.col("end_sec") - begin) / max(1.0, step)).cast("int")
    return cases.filter(F.col("end_sec") >= begin).select("caseid", F.explode(F.sequence(F.lit(0), n)).alias("__k")).select("caseid", (F.lit(begin) + F.col("__k") * max(1.0, step)).alias("time_sec"))


def merged(parts: list[DataFrame]) -> DataFrame:
    """Events of several kinds together with the number of their kind; sort by time_sec, kind for their order."""
    out = None
    for k, df in enumerate(parts):
        df = df.withColumn("kind", F.lit(k))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def first_k(events: DataFrame, k: int, order: list[str]) -> DataFrame:
    """The first k events of each case; 0 means all."""
    if k <= 0:
        return events
    w = Window.partitionBy("caseid").orderBy(*order)
    return events.withColumn("anchor_no", F.row_number().over(w)).filter(F.col("anchor_no") <= k)


ANCHOR_SCHEMA = T.StructType(
    [T.StructField(n, t) for n, t in (
        ("time_sec", T.DoubleType()), ("medication_key", T.StringType()), ("track", T.StringType()), ("delta", T.DoubleType()),
        ("before_num", T.DoubleType()), ("after_num", T.DoubleType()), ("before_label", T.StringType()), ("after_label", T.StringType()),
        ("prev_time_sec", T.DoubleType()), ("dt_sec", T.DoubleType()), ("inferred_rate_ml_per_h", T.DoubleType()),
        ("smoothed_rate_ml_per_h", T.DoubleType()), ("smoothed_dt_sec", T.DoubleType()), ("smoothed_ref_time_sec", T.DoubleType()),
        ("smoothed_delta_volume_ml", T.DoubleType()), ("anchor_source", T.StringType()), ("arrhythmia_label", T.StringType()), ("annotation_row_id", T.LongType()),
    )]
)
