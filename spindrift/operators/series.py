"""Signals in long form (caseid, time_sec, track, value): grids, tracks, units, windows before events, tail runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.values import let, with_unit
from .hot import WIDTH, neighbours, quantiles

#: Plausible ranges, both ends included.
RANGES: dict[str, tuple[float, float]] = {"MBP": (20.0, 220.0), "HR": (20.0, 220.0), "SPO2": (50.0, 100.0), "BIS": (1.0, 100.0)}
KPA_TO_MMHG = 7.50062


def in_range(value: Column, low: float, high: float) -> Column:
    """The value, or NULL outside the range."""
    return F.when(value.between(low, high), value)


def masked(signals: DataFrame, ranges: dict[str, tuple[float, float]], key: str = "track") -> DataFrame:
    """Values outside their key's range become NULL; keys without a range stay as they are."""
    value = F.col("value")
    out = None
    for name, (low, high) in ranges.items():
        hit = F.col(key) == name
        out = F.when(hit, in_range(value, low, high)) if out is None else out.when(hit, in_range(value, low, high))
    return signals if out is None else signals.withColumn("value", out.otherwise(value))


def resampled(signals: DataFrame, step: float, tracks: list[str]) -> DataFrame:
    """One row per case and grid time, a column per track with the mean of the slot."""
    slot = (F.floor(F.col("time_sec") / step) * step).alias("time_sec")
    return signals.filter(F.col("track").isin(tracks)).groupBy("caseid", slot).pivot("track", tracks).agg(F.avg("value"))


def best_track(signals: DataFrame, low: float, high: float, priority: Column) -> DataFrame:
    """Per case the track with the most values in range; ties, and cases without any, go by priority."""
    good = F.count(F.when(F.col("value").between(low, high), 1))
    counts = signals.groupBy("caseid", "track").agg(good.alias("n_valid")).withColumn("__p", priority)
    w = Window.partitionBy("caseid").orderBy(F.desc("n_valid"), "__p")
    return counts.withColumn("__n", F.row_number().over(w)).filter("__n = 1").select("caseid", "track", "n_valid")


def kpa_cases(signals: DataFrame, threshold: float = 20.0) -> DataFrame:
    """Per case whether its pressures look like kPa: four fifths below the threshold, or median and 90 % quantile low."""
    some = signals.filter((F.col("value") > 0) & (F.col("value") < 300))
    stats = quantiles(some, ["caseid"], "value", (0.5, 0.9), [F.avg((F.col("value") < threshold).cast("double")).alias("low_share")])
    stats = stats.withColumn("mid", F.get("quantiles", 0)).withColumn("high", F.get("quantiles", 1))
    return stats.select("caseid", "low_share", "mid", "high", ((F.col("low_share") >= 0.8) | ((F.col("mid") < threshold) & (F.col("high") < 1.5 * threshold))).alias("is_kpa"))


def in_mmhg(signals: DataFrame, kpa: DataFrame, factor: float = KPA_TO_MMHG) -> DataFrame:
    """Pressures with kPa cases scaled."""
    joined = signals.join(kpa.select("caseid", "is_kpa"), "caseid", "left")
    return joined.withColumn("value", F.when(F.coalesce("is_kpa", F.lit(False)), F.col("value") * factor).otherwise(F.col("value"))).drop("is_kpa")


def changing_cases(signals: DataFrame, threshold: float, cumulative: bool = False) -> DataFrame:
    """Cases with a nonzero value or half a threshold's change between values that are there."""
    w = Window.partitionBy("caseid", "track").orderBy("time_sec", "ord")
    known = signals.filter(F.col("value").isNotNull()).withColumn("__d", F.col("value") - F.lag("value").over(w))
    hit = F.col("__d") >= 0.5 * threshold if cumulative else (F.col("value") != 0) | (F.abs("__d") >= 0.5 * threshold)
    return known.groupBy("caseid").agg(F.bool_or(F.coalesce(hit, F.lit(False))).alias("__any")).filter("__any").select("caseid")


def windows(events: DataFrame, signals: DataFrame, before: float, until: float = 0.0) -> DataFrame:
    """Every event with its signals at times from t - before to t - until, both included.

    Signals are dealt into buckets as wide as the window; an event looks into the buckets that its window touches, so
    the join is on case and bucket.
    """
    width = max(before - until, 1e-9)
    low, high = F.greatest(F.lit(0.0), F.col("event_time") - before), F.greatest(F.lit(0.0), F.col("event_time") - until)
    e = events.withColumn("__low", low).withColumn("__high", high)
    e = e.withColumn("__bucket", F.explode(F.sequence(F.floor(F.col("__low") / width), F.floor(F.col("__high") / width))))
    s = signals.select("caseid", "track", "time_sec", "value", F.floor(F.col("time_sec") / width).alias("__bucket"))
    joined = e.join(s, ["caseid", "__bucket"]).filter("time_sec between __low and __high")
    return joined.drop("__bucket", "__low", "__high")


def trend(slope: Column) -> Column:
    """A word for a slope per sample."""
    return (
        F.when(slope <= -0.2, "rapidly decreased").when(slope <= -0.05, "decreased").when(slope >= 0.2, "rapidly increased").when(slope >= 0.05, "increased").otherwise("stable")
    )


def summaries(window: DataFrame, keys: list[str], least: int = 10) -> DataFrame:
    """Per key: start, end, mean, min, max, slope per valid sample, trend; keys with too few valid values drop out."""
    known = window.filter(F.col("value").isNotNull())
    by = Window.partitionBy(*keys)
    # from the last point to the first: a sum's last bits depend on the order, and decide the trend of a slope at a threshold
    ordered = by.orderBy(F.desc("time_sec"))
    rows = known.withColumn("__j", F.row_number().over(ordered)).withColumn("__n", F.count(F.lit(1)).over(by))
    rows = rows.withColumn("__i", F.col("__n") - F.col("__j") + 1)
    k = F.greatest(F.lit(5), F.least(F.lit(20), F.floor(F.col("__n") / 10)))
    rows = rows.withColumn("__k", k).filter(F.col("__n") >= least)
    mean_if = lambda c: F.avg(F.when(c, F.col("value")))
    out = rows.groupBy(*keys).agg(
        F.max("__n").alias("n_valid"),
        mean_if(F.col("__i") <= F.col("__k")).alias("start"),
        mean_if(F.col("__j") <= F.col("__k")).alias("end"),
        F.avg("value").alias("mean"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.regr_slope(F.col("value"), F.col("__i").cast("double")).alias("slope"),
    )
    return out.withColumn("trend", trend(F.col("slope")))


def recent_median(window: DataFrame, keys: list[str], points: int = 60) -> DataFrame:
    """Median of the last valid values of each key."""
    w = Window.partitionBy(*keys).orderBy(F.desc("time_sec"))
    last = window.filter(F.col("value").isNotNull()).withColumn("__i", F.row_number().over(w)).filter(F.col("__i") <= points)
    return last.groupBy(*keys).agg(F.median("value").alias("recent_median"))


def baselines(events: DataFrame, signals: DataFrame, keys: list[str], start: float = 1200.0, end: float = 600.0) -> DataFrame:
    """Median of the values between ``start`` and ``end`` seconds before an event; early events look at time 0 alone."""
    return windows(events, signals.filter(F.col("value").isNotNull()), start, end).groupBy(*keys).agg(F.median("value").alias("baseline_median"))


def percent_drop(baseline: Column, current: Column) -> Column:
    """How far the current value lies below a positive baseline, in percent."""
    return F.when(baseline > 0, (baseline - current) / baseline * 100.0)


def tail_runs(signals: DataFrame, keys: list[str], holds: Column) -> DataFrame:
    """Seconds for which a condition has held up to each key's last valid value; 0 if it does not hold there.

    The run counts one median step more than the time between its ends.
    """
    known = signals.filter(F.col("value").isNotNull()).withColumn("__h", F.coalesce(holds, F.lit(False)))
    w = Window.partitionBy(*keys).orderBy("time_sec")
    rows = known.withColumn("__step", F.col("time_sec") - F.lag("time_sec").over(w))
    rows = rows.withColumn("__bad", F.max(F.when(~F.col("__h"), F.col("time_sec"))).over(Window.partitionBy(*keys)))
    inside = F.when(F.col("__bad").isNull() | (F.col("time_sec") > F.col("__bad")), F.col("time_sec"))
    out = rows.groupBy(*keys).agg(F.min(inside).alias("__from"), F.max("time_sec").alias("__to"), F.coalesce(F.median(F.when(F.col("__step") > 0, F.col("__step"))), F.lit(1.0)).alias("step_sec"))
    length = F.greatest(F.col("step_sec"), F.col("__to") - F.col("__from") + F.col("step_sec"))
    return out.select(*keys, "step_sec", F.when(F.col("__from").isNotNull(), length).otherwise(0.0).alias("held_sec"))


def interpolated(signals: DataFrame, keys: list[str], width: float = WIDTH) -> DataFrame:
    """``filled``: linear between the values around a gap, the nearest value beyond the ends; by ranges of ``width`` seconds (``hot``)."""
    rows = neighbours(signals, keys, width)
    span = F.col("__b.time_sec") - F.col("__a.time_sec")
    line = F.col("__a.value") + (F.col("__b.value") - F.col("__a.value")) * (F.col("time_sec") - F.col("__a.time_sec")) / F.when(span > 0, span)
    return rows.withColumn("filled", F.coalesce("value", line, "__a.value", "__b.value")).drop("__a", "__b")


# Statistics of the points of one window, as an array of (time_sec, value) in order: bounded by the window's length.


def array_median(values: Column) -> Column:
    """Median of an array without NULLs; NULL for an empty one."""
    middle = lambda s: (F.get(s, F.floor((F.size(s) - 1) / 2).cast("int")) + F.get(s, F.floor(F.size(s) / 2).cast("int"))) / 2.0
    return F.when(F.size(values) > 0, let(F.array_sort(values), middle))


def array_mean(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + v) / F.nullif(F.size(values), F.lit(0))


def summary_of(points: Column, least: int = 10) -> Column:
    """``summaries`` of one array of points as a struct; NULL with too few points."""
    def of(v: Column) -> Column:
        n = F.size(v)
        k = F.greatest(F.lit(5), F.least(F.lit(20), F.floor(n / 10).cast("int")))
        middle = (n - 1) / 2.0
        slope = F.aggregate(F.transform(v, lambda x, i: (i - middle) * x), F.lit(0.0), lambda a, x: a + x) / (n.cast("double") * (n * n - 1) / 12.0)
        return F.struct(
            array_mean(F.slice(v, 1, k)).alias("start"), array_mean(F.slice(v, F.greatest(n - k, F.lit(0)) + 1, k)).alias("end"), array_mean(v).alias("mean"),
            F.array_min(v).alias("min"), F.array_max(v).alias("max"), slope.alias("slope"), trend(slope).alias("trend"),
        )

    return F.when(F.size(points) >= least, let(F.transform(points, lambda p: p["value"]), of))


def recent_median_of(points: Column, most: int = 60) -> Column:
    """``recent_median`` of one array of points."""
    values = F.transform(points, lambda p: p["value"])
    return array_median(F.slice(values, F.greatest(F.size(points) - most, F.lit(0)) + 1, most))


def step_of(points: Column) -> Column:
    """The median of the positive steps between points, 1 without any."""
    steps = F.transform(points, lambda p, i: p["time_sec"] - F.get(points, i - 1)["time_sec"])
    return F.coalesce(array_median(F.filter(steps, lambda d: d > 0)), F.lit(1.0))


def held_of(points: Column, step: Column, holds) -> Column:
    """``tail_runs`` of one array of points: seconds for which ``holds(value)`` has been true up to the last point."""
    bad = F.array_max(F.transform(F.filter(points, lambda p: ~holds(p["value"])), lambda p: p["time_sec"]))
    inside = let(bad, lambda b: F.array_min(F.transform(F.filter(points, lambda p: b.isNull() | (p["time_sec"] > b)), lambda p: p["time_sec"])))
    last = F.get(points, F.size(points) - 1)["time_sec"]
    return F.coalesce(let(inside, lambda f: F.when(f.isNotNull(), F.greatest(step, last - f + step))), F.lit(0.0))


# Units of the vitals, and what stands for a trend without data.
UNITS = {"MBP": "mmHg", "HR": "bpm", "SPO2": "%", "BIS": ""}
NO_TREND = "insufficient valid data"


def trend_text(summary: Column, unit: str) -> Column:
    """A sentence on a window: from where to where, its mean and its range."""
    v = lambda n: with_unit(summary[n], unit)
    said = F.concat(F.lit("from "), v("start"), F.lit(" "), summary["trend"], F.lit(" to "), v("end"), F.lit("; mean "), v("mean"), F.lit(", range ["), v("min"), F.lit(", "), v("max"), F.lit("]"))
    return F.when(summary.isNull(), NO_TREND).otherwise(said)


#: Least changes of a rate that count as medication, for agents of which little is given: fixed values.
SMALL_CHANGES = ((("SEVO_ET_RATE", "SEVO_FI_RATE", "DES_ET_RATE", "DES_FI_RATE", "ISO_ET_RATE", "ISO_FI_RATE"), 0.15), (("MAC_RATE",), 0.05))


def rate_threshold(track: Column, base: float) -> Column:
    """The least change of a rate that counts for a track."""
    out = F
    for tracks, most in SMALL_CHANGES:
        out = out.when(track.isin(*tracks), min(base, most))
    return out.otherwise(base)


def medicated_cases(signals: DataFrame, rate_delta: float = 0.5, volume_delta: float = 0.03) -> DataFrame:
    """Cases with any nonzero rate, half a rate threshold's change, or half a volume threshold's increase."""
    w = Window.partitionBy("caseid", "track").orderBy("time_sec", "ord")
    known = signals.filter(F.col("value").isNotNull()).withColumn("__d", F.col("value") - F.lag("value").over(w))
    of_rate = (F.col("value") != 0) | (F.abs("__d") >= rate_threshold(F.col("track"), rate_delta) * 0.5)
    hit = F.when(F.col("track").endswith("_RATE"), of_rate).when(F.col("track").endswith("_VOL"), F.col("__d") >= 0.5 * volume_delta)
    return known.groupBy("caseid").agg(F.bool_or(F.coalesce(hit, F.lit(False))).alias("__any")).filter("__any").select("caseid")
