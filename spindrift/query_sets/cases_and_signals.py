"""Queries on case tables and signals."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.values import case_id, first_fields, first_valid, rounded, seconds_of, valid_fields
from ..operators import anchors, cases, hot, series
from ..plans.snapshots import SnapshotConfig, nested, snapshots, visible_context
from .base import DAY, HOUR, SIGNALS_SQL, START, signals, table

RANGES = {"click": (1.0, 400.0), "purchase": (1.0, 400.0), "view": (5.0, 300.0)}
CHANGE = 100.0
GAP = 6 * HOUR
WINDOW = 10 * DAY
#: Seconds of a range where a case has a few values a day.
SPARSE = 2.0**20


def case_filter_group(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("caseid"), F.col("p_size").cast("double").alias("ane_dur"), F.col("p_type").alias("department"), F.col("p_name").alias("opname"))
    out = cases.select_cases(parts, "caseid", least_duration=10.0, departments=["economy", "standard"])
    return out.select("caseid", "ane_dur", "surgery_group")


CASE_FILTER_GROUP = """
WITH c AS (SELECT p_partkey AS caseid, p_size::DOUBLE AS ane_dur, p_type AS department, p_name AS opname FROM part WHERE p_size IS NULL OR p_size >= 10),
d AS (SELECT *, lower(coalesce(department, '') || ' ' || coalesce(opname, '')) AS t FROM c WHERE contains(lower(department), 'economy') OR contains(lower(department), 'standard')),
o AS (SELECT *, row_number() OVER (PARTITION BY caseid ORDER BY caseid) AS n FROM d)
SELECT caseid, ane_dur, CASE
  WHEN regexp_matches(t, 'thorac|vats|lung|chest|pulmonary|mediast') THEN 'Thoracic_Surgery'
  WHEN regexp_matches(t, 'neuro|brain|crani|spine|intracran|cns') THEN 'Neurosurgery'
  WHEN regexp_matches(t, 'general|gastric|colon|rect|hep|chole|pancre|hernia') THEN 'General_Surgery'
  WHEN regexp_matches(t, 'uro|kidney|renal|bladder|prostate') THEN 'Urology'
  WHEN regexp_matches(t, 'gyn|hyster|ovary|uter|obstet') THEN 'Gynecology'
  WHEN regexp_matches(t, 'ortho|joint|hip|knee|fracture|arthro|spine') THEN 'Orthopedics'
  WHEN regexp_matches(t, 'cardiac|cabg|valve|aorta|bypass') THEN 'Cardiac_Surgery'
  ELSE 'Dept_' || trim(regexp_replace(department, '[^\\p{L}\\p{N}]+', '_', 'g'), '_') END AS surgery_group
FROM o WHERE n = 1"""


def multisource_union_dedup(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("caseid"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("caseid"), F.col("s_acctbal").alias("balance"))
    both = cases.tagged_union({"customers": c, "suppliers": s})
    both = both.withColumn("segment", F.coalesce("segment", F.lit("unknown"))).withColumn("caseid", case_id(F.col("caseid").cast("string")))
    return cases.keep_first(both, ["caseid"], ["source_dataset"]).select("caseid", "balance", "segment", "source_dataset")


MULTISOURCE = """
WITH u AS (SELECT c_custkey AS caseid, c_acctbal AS balance, c_mktsegment AS segment, 'customers' AS source_dataset FROM customer
  UNION ALL SELECT s_suppkey, s_acctbal, NULL, 'suppliers' FROM supplier)
SELECT caseid, balance, coalesce(segment, 'unknown') AS segment, source_dataset FROM u
QUALIFY row_number() OVER (PARTITION BY caseid ORDER BY source_dataset) = 1"""


def source_counts(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("caseid"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("caseid"))
    both = cases.tagged_union({"customers": c, "suppliers": s})
    return both.groupBy("source_dataset").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("caseid").alias("n_cases"))


SOURCE_COUNTS = """SELECT source_dataset, count(*)::BIGINT AS n_rows, count(DISTINCT caseid)::BIGINT AS n_cases FROM (
  SELECT c_nationkey AS caseid, 'customers' AS source_dataset FROM customer UNION ALL SELECT s_nationkey, 'suppliers' FROM supplier) GROUP BY 1"""


def signal_resample_pivot(spark, sf_dir):
    out = series.resampled(signals(spark, sf_dir), HOUR * 12, ["click", "view"])
    return out.select("caseid", "time_sec", F.round("click", 6).alias("click"), F.round("view", 6).alias("view"))


RESAMPLE = f"""WITH {SIGNALS_SQL}
SELECT caseid, floor(time_sec / 43200.0) * 43200.0 AS time_sec, round(avg(value) FILTER (track = 'click'), 6) AS click, round(avg(value) FILTER (track = 'view'), 6) AS view
FROM signals WHERE track IN ('click', 'view') GROUP BY 1, 2"""


def best_track_per_case(spark, sf_dir):
    priority = F.when(F.col("track") == "click", 1).when(F.col("track") == "view", 2).when(F.col("track") == "purchase", 3).when(F.col("track") == "error", 4).otherwise(5)
    return series.best_track(signals(spark, sf_dir), 20.0, 220.0, priority)


BEST_TRACK = f"""WITH {SIGNALS_SQL}, c AS (
  SELECT caseid, track, count(*) FILTER (value BETWEEN 20 AND 220)::BIGINT AS n_valid FROM signals GROUP BY 1, 2)
SELECT caseid, track, n_valid FROM c QUALIFY row_number() OVER (PARTITION BY caseid ORDER BY n_valid DESC,
  CASE track WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'purchase' THEN 3 WHEN 'error' THEN 4 ELSE 5 END) = 1"""


def range_mask(spark, sf_dir):
    out = series.masked(signals(spark, sf_dir), RANGES)
    return out.groupBy("caseid", "track").agg(F.count("value").alias("n_valid"), F.count(F.lit(1)).alias("n_rows"))


RANGE_MASK = f"""WITH {SIGNALS_SQL}
SELECT caseid, track, count(CASE WHEN track IN ('click', 'purchase') AND NOT value BETWEEN 1 AND 400 THEN NULL
  WHEN track = 'view' AND NOT value BETWEEN 5 AND 300 THEN NULL ELSE value END)::BIGINT AS n_valid, count(*)::BIGINT AS n_rows FROM signals GROUP BY 1, 2"""


def unit_inference(spark, sf_dir):
    s = signals(spark, sf_dir).withColumn("value", F.when(F.col("caseid") % 3 == 0, F.col("value") / 20).otherwise(F.col("value")))
    kpa = series.kpa_cases(s)
    fixed = series.in_mmhg(s, kpa)
    return fixed.groupBy("caseid").agg(F.round(F.sum("value"), 4).alias("total")).join(kpa, "caseid").select("caseid", "total", "is_kpa", F.round("low_share", 6).alias("low_share"), F.round("mid", 6).alias("mid"), F.round("high", 6).alias("high"))


UNIT_INFERENCE = f"""WITH {SIGNALS_SQL}, s AS (SELECT caseid, CASE WHEN caseid % 3 = 0 THEN value / 20 ELSE value END AS value FROM signals),
k AS (SELECT caseid, avg((value < 20)::INT) AS low_share, median(value) AS mid, quantile_cont(value, 0.9) AS high FROM s WHERE value > 0 AND value < 300 GROUP BY 1),
f AS (SELECT *, (low_share >= 0.8 OR (mid < 20 AND high < 30)) AS is_kpa FROM k)
SELECT s.caseid, round(sum(CASE WHEN is_kpa THEN value * 7.50062 ELSE value END), 4) AS total, any_value(is_kpa) AS is_kpa,
  round(any_value(low_share), 6) AS low_share, round(any_value(mid), 6) AS mid, round(any_value(high), 6) AS high FROM s JOIN f USING (caseid) GROUP BY 1"""


def _rate_anchors(spark, sf_dir):
    return anchors.rate_anchors(signals(spark, sf_dir), CHANGE)


def anchors_rate_change(spark, sf_dir):
    out = _rate_anchors(spark, sf_dir).filter(~anchors.zero_start())
    return out.select("caseid", "time_sec", "track", "before", "after", F.round("delta", 6).alias("delta"), F.round("dt_sec", 3).alias("dt_sec"), anchors.likely_setup(anchors.AnchorConfig(setup_before=20.0, setup_early_sec=0.0)).alias("likely_setup"))


_CHANGES_SQL = f"""{SIGNALS_SQL}, l AS (
  SELECT *, lag(value) OVER w AS before, lag(time_sec) OVER w AS prev_time_sec FROM signals WINDOW w AS (PARTITION BY caseid, track ORDER BY time_sec, ord)),
a AS (SELECT *, value AS after, value - before AS delta, time_sec - prev_time_sec AS dt_sec FROM l WHERE abs(value - before) >= {CHANGE})"""
ANCHORS_RATE = f"""WITH {_CHANGES_SQL}
SELECT caseid, time_sec, track, before, after, round(delta, 6) AS delta, round(dt_sec, 3) AS dt_sec,
  abs(before) <= 20 AND abs(delta) >= 100 AND after >= 300 AS likely_setup
FROM a WHERE NOT (before = 0 AND delta >= 100)"""


def _running(spark, sf_dir):
    from pyspark.sql.window import Window

    w = Window.partitionBy("caseid", "track").orderBy("time_sec", "ord").rowsBetween(Window.unboundedPreceding, 0)
    return signals(spark, sf_dir).withColumn("value", F.round(F.sum(F.round("value", 2).cast("decimal(18,2)")).over(w), 2).cast("double"))


def anchors_cumulative_change(spark, sf_dir):
    rated = anchors.smoothed_rates(_running(spark, sf_dir), DAY)
    rated = rated.select("caseid", "track", "time_sec", "ord", "value", "ref_time_sec", "smoothed_delta", "smoothed_rate_per_h")
    found = anchors.volume_anchors(rated, 60.0)
    return found.filter(F.col("smoothed_delta") >= 80.0).select("caseid", "track", "time_sec", F.round("delta", 4).alias("delta"), F.round("rate_per_h", 4).alias("rate_per_h"), "ref_time_sec", F.round("smoothed_delta", 4).alias("smoothed_delta"), F.round("smoothed_rate_per_h", 4).alias("smoothed_rate_per_h"))


ANCHORS_CUMULATIVE = f"""WITH {SIGNALS_SQL}, r AS (
  SELECT caseid, track, time_sec, ord, sum(value::DECIMAL(18,2)) OVER (PARTITION BY caseid, track ORDER BY time_sec, ord)::DOUBLE AS value FROM signals),
l AS (SELECT *, lag(value) OVER w AS before, lag(time_sec) OVER w AS prev, first_value(time_sec) OVER w AS t0, first_value(value) OVER w AS v0,
  last_value(time_sec) OVER (PARTITION BY caseid, track ORDER BY time_sec RANGE BETWEEN UNBOUNDED PRECEDING AND 86400.0 PRECEDING) AS t1,
  last_value(value) OVER (PARTITION BY caseid, track ORDER BY time_sec RANGE BETWEEN UNBOUNDED PRECEDING AND 86400.0 PRECEDING) AS v1
  FROM r WINDOW w AS (PARTITION BY caseid, track ORDER BY time_sec, ord)),
s AS (SELECT *, value - before AS delta, coalesce(t1, t0) AS ref_time_sec, value - coalesce(v1, v0) AS smoothed_delta FROM l)
SELECT caseid, track, time_sec, round(delta, 4) AS delta, round(delta / (time_sec - prev) * 3600, 4) AS rate_per_h, ref_time_sec, round(smoothed_delta, 4) AS smoothed_delta,
  round(smoothed_delta / nullif(greatest(time_sec - ref_time_sec, 0), 0) * 3600, 4) AS smoothed_rate_per_h
FROM s WHERE delta >= 60 AND smoothed_delta >= 80"""


def anchors_gap_dedup(spark, sf_dir):
    thinned = anchors.thin(signals(spark, sf_dir).select("caseid", "time_sec", "ord"), DAY)
    return anchors.first_k(thinned, 5, ["time_sec", "ord"]).select("caseid", "time_sec", "anchor_no")


ANCHORS_GAP = f"""WITH RECURSIVE {SIGNALS_SQL}, e AS (SELECT DISTINCT caseid, time_sec FROM signals),
r AS (SELECT caseid, min(time_sec) AS time_sec, 1 AS anchor_no FROM e GROUP BY 1
  UNION ALL SELECT r.caseid, (SELECT min(e.time_sec) FROM e WHERE e.caseid = r.caseid AND e.time_sec - r.time_sec >= 86400.0), anchor_no + 1 FROM r WHERE r.time_sec IS NOT NULL AND anchor_no < 5)
SELECT caseid, time_sec, anchor_no::INTEGER AS anchor_no FROM r WHERE time_sec IS NOT NULL"""


def anchors_label_dedup(spark, sf_dir):
    label = F.when(F.col("track") == "view", " Normal  sinus rhythm ").when(F.col("track") == "signup", " ").otherwise(F.col("track"))
    s = signals(spark, sf_dir).select("caseid", "time_sec", "ord", label.alias("label"))
    labelled = anchors.label_events(s, F.lit(1e12))
    return anchors.thin(labelled.select("caseid", "time_sec", "ord", "before_label", "after_label"), DAY, label="after_label").select("caseid", "time_sec", "before_label", "after_label")


# normal labels drop out, but stand before the labels that follow them
ANCHORS_LABEL = f"""WITH RECURSIVE {SIGNALS_SQL}, nm AS (SELECT *, CASE track WHEN 'view' THEN 'Normal  sinus rhythm' WHEN 'signup' THEN 'unknown' ELSE track END AS after_label FROM signals),
lb AS (SELECT *, lag(after_label) OVER (PARTITION BY caseid ORDER BY ord) AS before_label FROM nm),
e AS (SELECT caseid, time_sec, after_label, before_label, row_number() OVER (PARTITION BY caseid ORDER BY time_sec, ord) AS n FROM lb WHERE track NOT IN ('view', 'signup')),
r AS (SELECT caseid, n, time_sec AS last_t, after_label AS last_l, true AS kept FROM e WHERE n = 1
  UNION ALL SELECT e.caseid, e.n, CASE WHEN e.time_sec - r.last_t >= 86400.0 OR e.after_label <> r.last_l THEN e.time_sec ELSE r.last_t END,
    CASE WHEN e.time_sec - r.last_t >= 86400.0 OR e.after_label <> r.last_l THEN e.after_label ELSE r.last_l END,
    e.time_sec - r.last_t >= 86400.0 OR e.after_label <> r.last_l FROM r JOIN e ON e.caseid = r.caseid AND e.n = r.n + 1)
SELECT e.caseid, e.time_sec, e.before_label, e.after_label FROM e JOIN r USING (caseid, n) WHERE kept"""


def _ends(spark, sf_dir):
    return signals(spark, sf_dir).groupBy("caseid").agg((F.max("time_sec") - START).alias("end_sec"))


def anchors_periodic(spark, sf_dir):
    return anchors.periodic(_ends(spark, sf_dir), 2 * DAY, 3 * DAY, 4 * DAY)


_ENDS_SQL = f"ends AS (SELECT caseid, max(time_sec) - {START} AS end_sec FROM signals GROUP BY 1)"
_PERIODIC_SQL = f"p AS (SELECT caseid, 259200.0 + k * 345600.0 AS time_sec FROM ends, generate_series(0, 100) g(k) WHERE 259200.0 + k * 345600.0 <= end_sec)"
ANCHORS_PERIODIC = f"WITH {SIGNALS_SQL}, {_ENDS_SQL}, {_PERIODIC_SQL} SELECT caseid, time_sec FROM p"


def anchors_hybrid(spark, sf_dir):
    changed = _rate_anchors(spark, sf_dir).select("caseid", (F.col("time_sec") - START).alias("time_sec"), "ord")
    steady = anchors_periodic(spark, sf_dir).withColumn("ord", F.lit(0).cast("long"))
    return anchors.first_k(anchors.merged([changed, steady]), 3, ["time_sec", "kind", "ord"]).select("caseid", "time_sec", "kind", "anchor_no")


ANCHORS_HYBRID = f"""WITH {_CHANGES_SQL}, {_ENDS_SQL}, {_PERIODIC_SQL},
u AS (SELECT caseid, time_sec - {START} AS time_sec, ord, 0 AS kind FROM a UNION ALL SELECT caseid, time_sec, 0, 1 FROM p)
SELECT caseid, time_sec, kind, row_number() OVER (PARTITION BY caseid ORDER BY time_sec, kind, ord)::INTEGER AS anchor_no FROM u QUALIFY anchor_no <= 3"""


def case_has_change_semijoin(spark, sf_dir):
    s = signals(spark, sf_dir)
    hit = series.changing_cases(s.filter("track = 'purchase'").withColumn("value", F.col("value") - 0.0), 600.0, cumulative=True)
    return s.join(hit, "caseid", "left_semi").groupBy("caseid").agg(F.count(F.lit(1)).alias("n"))


CASE_HAS_CHANGE = f"""WITH {SIGNALS_SQL}, d AS (SELECT caseid, value - lag(value) OVER (PARTITION BY caseid, track ORDER BY time_sec, ord) AS d FROM signals WHERE track = 'purchase' AND value IS NOT NULL)
SELECT caseid, count(*)::BIGINT AS n FROM signals s WHERE EXISTS (SELECT 1 FROM d WHERE d.caseid = s.caseid AND d.d >= 300) GROUP BY 1"""


def _chosen(spark, sf_dir):
    found = _rate_anchors(spark, sf_dir).select("caseid", F.col("time_sec").alias("event_time"), F.col("time_sec"), "ord")
    return anchors.first_k(found, 3, ["time_sec", "ord"]).select("caseid", "event_time", "anchor_no")


_CHOSEN_SQL = f"{_CHANGES_SQL}, c AS (SELECT caseid, time_sec AS event_time, row_number() OVER (PARTITION BY caseid ORDER BY time_sec, ord)::INTEGER AS anchor_no FROM a QUALIFY anchor_no <= 3)"
_WINDOW_SQL = f"{_CHOSEN_SQL}, w AS (SELECT c.*, s.time_sec, s.value, s.track FROM c JOIN signals s ON s.caseid = c.caseid AND s.time_sec BETWEEN greatest(0, event_time - {WINDOW}) AND event_time)"


def window_stats_trend(spark, sf_dir):
    w = series.windows(_chosen(spark, sf_dir), signals(spark, sf_dir), WINDOW)
    out = series.summaries(w, ["caseid", "anchor_no"])
    recent = series.recent_median(w, ["caseid", "anchor_no"])
    out = out.join(recent, ["caseid", "anchor_no"])
    return out.select("caseid", "anchor_no", "n_valid", *[rounded(F.col(c) + 1e-9, 4).alias(c) for c in ("start", "end", "mean", "min", "max", "slope", "recent_median")], "trend")


WINDOW_STATS = f"""WITH {_WINDOW_SQL}, i AS (
  SELECT *, row_number() OVER (PARTITION BY caseid, anchor_no ORDER BY time_sec) AS i, row_number() OVER (PARTITION BY caseid, anchor_no ORDER BY time_sec DESC) AS j,
    count(*) OVER (PARTITION BY caseid, anchor_no) AS n FROM w WHERE value IS NOT NULL),
k AS (SELECT *, greatest(5, least(20, n // 10)) AS k FROM i WHERE n >= 10),
s AS (SELECT caseid, anchor_no, max(n)::BIGINT AS n_valid, avg(value) FILTER (i <= k) AS start, avg(value) FILTER (j <= k) AS "end", avg(value) AS mean, min(value) AS min, max(value) AS max,
  regr_slope(value, i::DOUBLE) AS slope, median(value) FILTER (j <= 60) AS recent_median FROM k GROUP BY 1, 2)
SELECT caseid, anchor_no, n_valid, round(start + 1e-9, 4) AS start, round("end" + 1e-9, 4) AS "end", round(mean + 1e-9, 4) AS mean, round(min + 1e-9, 4) AS min, round(max + 1e-9, 4) AS max, round(slope + 1e-9, 4) AS slope, round(recent_median + 1e-9, 4) AS recent_median,
  CASE WHEN slope <= -0.2 THEN 'rapidly decreased' WHEN slope <= -0.05 THEN 'decreased' WHEN slope >= 0.2 THEN 'rapidly increased' WHEN slope >= 0.05 THEN 'increased' ELSE 'stable' END AS trend FROM s"""


def baseline_compare(spark, sf_dir):
    s, chosen, keys = signals(spark, sf_dir), _chosen(spark, sf_dir), ["caseid", "anchor_no"]
    base = series.baselines(chosen, s, keys, 8 * DAY, 4 * DAY)
    now = series.recent_median(series.windows(chosen, s, WINDOW), keys)
    out = now.join(base, keys, "left")
    return out.select(*keys, F.round("baseline_median", 4).alias("baseline"), F.round("recent_median", 4).alias("current"), F.round(series.percent_drop(F.col("baseline_median"), F.col("recent_median")), 4).alias("drop_pct"))


BASELINE = f"""WITH {_WINDOW_SQL}, n AS (
  SELECT caseid, anchor_no, median(value) AS cur FROM (SELECT *, row_number() OVER (PARTITION BY caseid, anchor_no ORDER BY time_sec DESC) AS j FROM w WHERE value IS NOT NULL) WHERE j <= 60 GROUP BY 1, 2),
b AS (SELECT c.caseid, c.anchor_no, median(s.value) AS base FROM c JOIN signals s ON s.caseid = c.caseid AND s.time_sec BETWEEN greatest(0, event_time - {8 * DAY}) AND greatest(0, event_time - {4 * DAY}) GROUP BY 1, 2)
SELECT n.caseid, n.anchor_no, round(base, 4) AS baseline, round(cur, 4) AS current, round(CASE WHEN base > 0 THEN (base - cur) / base * 100.0 END, 4) AS drop_pct FROM n LEFT JOIN b USING (caseid, anchor_no)"""


def tail_persistence(spark, sf_dir):
    out = series.tail_runs(signals(spark, sf_dir), ["caseid"], F.col("value") < 100.0)
    return out.select("caseid", F.round("step_sec", 3).alias("step_sec"), F.round("held_sec", 3).alias("held_sec"))


TAIL = f"""WITH {SIGNALS_SQL}, d AS (SELECT caseid, time_sec, value < 100.0 AS h, time_sec - lag(time_sec) OVER (PARTITION BY caseid ORDER BY time_sec) AS step,
    max(CASE WHEN NOT value < 100.0 THEN time_sec END) OVER (PARTITION BY caseid) AS bad FROM signals WHERE value IS NOT NULL),
g AS (SELECT caseid, min(CASE WHEN bad IS NULL OR time_sec > bad THEN time_sec END) AS f, max(time_sec) AS t, coalesce(median(step) FILTER (step > 0), 1.0) AS step_sec FROM d GROUP BY 1)
SELECT caseid, round(step_sec, 3) AS step_sec, round(CASE WHEN f IS NULL THEN 0.0 ELSE greatest(step_sec, t - f + step_sec) END, 3) AS held_sec FROM g"""


def interpolate_gaps(spark, sf_dir):
    s = signals(spark, sf_dir).withColumn("value", F.when(F.col("ord") % 3 != 0, F.col("value")))
    return series.interpolated(s, ["caseid"], SPARSE).select("caseid", "ord", F.round("filled", 4).alias("filled"))


INTERPOLATE = f"""WITH {SIGNALS_SQL}, s AS (SELECT caseid, ord, time_sec, CASE WHEN ord % 3 <> 0 THEN value END AS value FROM signals),
p AS (SELECT *, last_value(value IGNORE NULLS) OVER b AS av, last_value(CASE WHEN value IS NOT NULL THEN time_sec END IGNORE NULLS) OVER b AS a_t,
  first_value(value IGNORE NULLS) OVER f AS bv, first_value(CASE WHEN value IS NOT NULL THEN time_sec END IGNORE NULLS) OVER f AS b_t FROM s
  WINDOW b AS (PARTITION BY caseid ORDER BY time_sec ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), f AS (PARTITION BY caseid ORDER BY time_sec ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT caseid, ord, round(coalesce(value, av + (bv - av) * (time_sec - a_t) / CASE WHEN b_t - a_t > 0 THEN b_t - a_t END, av, bv), 4) AS filled FROM p"""


def _one_long_case(spark, sf_dir):
    """All views as one case, everything else by user."""
    return signals(spark, sf_dir).withColumn("caseid", F.when(F.col("track") == "view", 0).otherwise(F.col("caseid")))


LONG_SQL = SIGNALS_SQL + ", long AS (SELECT * REPLACE (CASE WHEN track = 'view' THEN 0 ELSE caseid END AS caseid) FROM signals)"


def long_case_quantiles(spark, sf_dir):
    """Quantiles by case where one case has a third of all rows; a task sorts 1,024 values at most."""
    q = hot.quantiles(_one_long_case(spark, sf_dir), ["caseid"], "value", (0.05, 0.5, 0.9), [F.count("value").alias("n")], most=1024)
    return q.select("caseid", "n", *[F.round(F.get("quantiles", k), 6).alias(c) for k, c in enumerate(("low", "mid", "high"))])


LONG_QUANTILES = f"""WITH {LONG_SQL} SELECT caseid, count(value)::BIGINT AS n, round(quantile_cont(value, 0.05), 6) AS low, round(quantile_cont(value, 0.5), 6) AS mid, round(quantile_cont(value, 0.9), 6) AS high
FROM long WHERE value IS NOT NULL GROUP BY 1"""


def long_case_fill(spark, sf_dir):
    """The values around each row, by case, where one case has a third of all rows; ranges of an hour."""
    s = _one_long_case(spark, sf_dir).withColumn("value", F.when(F.col("ord") % 3 != 0, F.col("value")))
    out = hot.neighbours(s, ["caseid"], HOUR)
    return out.select("caseid", "ord", F.col("__a.time_sec").alias("from_sec"), F.col("__a.value").alias("from_value"), F.col("__b.time_sec").alias("to_sec"), F.col("__b.value").alias("to_value"))


LONG_FILL = f"""WITH {LONG_SQL}, s AS (SELECT caseid, ord, time_sec, CASE WHEN ord % 3 <> 0 THEN value END AS value FROM long)
SELECT caseid, ord, last_value(CASE WHEN value IS NOT NULL THEN time_sec END IGNORE NULLS) OVER b AS from_sec, last_value(value IGNORE NULLS) OVER b AS from_value,
  first_value(CASE WHEN value IS NOT NULL THEN time_sec END IGNORE NULLS) OVER f AS to_sec, first_value(value IGNORE NULLS) OVER f AS to_value FROM s
WINDOW b AS (PARTITION BY caseid ORDER BY time_sec, ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), f AS (PARTITION BY caseid ORDER BY time_sec, ord ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"""


def long_case_thinning(spark, sf_dir):
    """Events six hours or more after the last one kept of their case, where one case has a third of all rows."""
    return hot.thin_long(_one_long_case(spark, sf_dir), GAP, width=2.0**17).select("caseid", "ord", "time_sec")


LONG_THIN = f"""WITH RECURSIVE {LONG_SQL},
next AS (SELECT caseid, time_sec, ord, min(time_sec) OVER (PARTITION BY caseid ORDER BY time_sec RANGE BETWEEN {GAP} FOLLOWING AND UNBOUNDED FOLLOWING) AS then_sec FROM long),
step AS (SELECT caseid, time_sec, min(ord) AS ord, any_value(then_sec) AS then_sec FROM next GROUP BY 1, 2),
kept AS (SELECT * FROM step WHERE (caseid, time_sec) IN (SELECT (caseid, min(time_sec)) FROM step GROUP BY caseid)
  UNION ALL SELECT s.* FROM kept k JOIN step s ON s.caseid = k.caseid AND s.time_sec = k.then_sec)
SELECT caseid, ord, time_sec FROM kept"""


def coalesce_first_valid(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    blank = F.when(F.col("doc_id") % 3 == 0, " nan ").when(F.col("doc_id") % 3 == 1, "\n \t").otherwise(F.col("source"))
    return d.select("doc_id", first_valid(blank, F.when(F.col("doc_id") % 2 == 0, F.col("lang")), default="none").alias("value"))


COALESCE_VALID = """SELECT doc_id, CASE WHEN doc_id % 3 = 2 THEN source WHEN doc_id % 2 = 0 THEN lang ELSE 'none' END AS value FROM documents"""


def row_fields_map(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("lang")).alias("preop_lang"), F.col("source").alias("preop_source"), F.col("n_chars").cast("string").alias("intraop_n"))
    fields = valid_fields(d, prefix="preop_")
    return d.select("doc_id", F.size(fields).alias("n_fields"), F.array_join(F.map_values(fields), "|").alias("values"), F.array_join(first_fields([F.col("intraop_n"), F.col("preop_lang"), F.col("preop_source")], 2), "|").alias("context"))


ROW_FIELDS = """SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 2 ELSE 1 END::INTEGER AS n_fields, CASE WHEN doc_id % 2 = 0 THEN lang || '|' || source ELSE source END AS "values",
  n_chars::VARCHAR || '|' || CASE WHEN doc_id % 2 = 0 THEN lang ELSE source END AS context FROM documents"""


def time_parse(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("int").alias("q"))  # noqa: E741
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    text = F.when(F.col("l_linenumber") % 4 == 0, F.concat(two(F.col("q") % 24), F.lit(":"), two(F.col("q")), F.lit(":07.5"))).when(F.col("l_linenumber") % 4 == 1, F.concat(two(F.col("q")), F.lit(":30"))).when(F.col("l_linenumber") % 4 == 2, F.concat(F.lit("t="), F.col("q"), F.lit("s"))).otherwise(F.lit(" "))
    return l.select("l_orderkey", "l_linenumber", seconds_of(text).alias("seconds"))


TIME_PARSE = """SELECT l_orderkey, l_linenumber, CASE l_linenumber % 4 WHEN 0 THEN (l_quantity::INT % 24) * 3600.0 + l_quantity::INT * 60.0 + 7.5
  WHEN 1 THEN l_quantity::INT * 60.0 + 30.0 WHEN 2 THEN l_quantity::INT::DOUBLE END::DOUBLE AS seconds FROM lineitem"""

TRACKS = {"purchase": "PHE_RATE", "signup": "NOR_RATE", "click": "MBP", "view": "HR", "error": "SPO2"}
SNAPSHOT = SnapshotConfig(window_sec=20 * DAY, least_points=8, baseline_sec=(28 * DAY, 14 * DAY), anchor=anchors.AnchorConfig(rate_delta=40.0, gap_sec=DAY, per_case=4, setup_early_sec=0.0))


def _snapshots(spark, sf_dir):
    names = F.create_map(*[F.lit(x) for pair in TRACKS.items() for x in pair])
    s = signals(spark, sf_dir).withColumn("track", F.try_element_at(names, "track"))
    is_rate = F.col("track").endswith("_RATE")
    return snapshots(s.filter(is_rate), s.filter(~is_rate), SNAPSHOT)


def snapshot_build(spark, sf_dir):
    """Events of two medications with the windows of three vitals, assessed and judged."""
    n = lambda c: rounded(F.col(c) + 1e-9, 4).alias(c)
    heart = F.col("vital_stats")["HR"]
    return _snapshots(spark, sf_dir).select(
        "caseid", "anchor_no", "key", "event_time", *[n(c) for c in ("map_now", "hr_now", "spo2_now", "map_baseline", "map_drop_pct", "hr_change_pct", "map_lt_65_held", "hr_lt_50_held", "spo2_lt_94_held")],
        F.size("vital_stats").alias("n_stats"), rounded(heart["slope"] + 1e-9, 4).alias("hr_slope"), F.round(heart["end"] + 1e-9, 4).alias("hr_end"), "risk_level", "unstable", F.size("risk_flags").alias("n_flags"), "intervention_type",
    )


_W, _B0, _B1 = 20 * DAY, 28 * DAY, 14 * DAY
_TRACK_SQL = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TRACKS.items())


def _held_sql(name: str, track: str, test: str) -> str:
    return f"""{name} AS (SELECT caseid, anchor_no, CASE WHEN max(f) IS NULL THEN 0.0 ELSE greatest(max(step), max(last) - max(f) + max(step)) END AS {name} FROM (
  SELECT caseid, anchor_no, min(time_sec) FILTER (bad IS NULL OR time_sec > bad) AS f, max(time_sec) AS last, coalesce(median(d) FILTER (d > 0), 1.0) AS step FROM (
    SELECT *, max(CASE WHEN NOT value {test} THEN time_sec END) OVER (PARTITION BY caseid, anchor_no) AS bad, time_sec - lag(time_sec) OVER (PARTITION BY caseid, anchor_no ORDER BY time_sec, value) AS d FROM v WHERE track = '{track}')
  GROUP BY 1, 2) GROUP BY 1, 2)"""


_SNAPSHOT_SQL = f"""{SIGNALS_SQL}, sg AS (SELECT caseid, time_sec, CASE track {_TRACK_SQL} END AS track, value, ord FROM signals),
l AS (SELECT *, lag(value) OVER (PARTITION BY caseid, track ORDER BY time_sec, ord) AS before FROM sg WHERE suffix(track, '_RATE')),
e AS (SELECT caseid, time_sec, track, row_number() OVER (PARTITION BY caseid ORDER BY time_sec, ord) AS n FROM l WHERE abs(value - before) >= 40 AND NOT (before = 0 AND value - before >= 100) AND NOT (abs(before) <= 1 AND abs(value - before) >= 100 AND value >= 300)),
r AS (SELECT caseid, n, time_sec AS last_t, true AS kept FROM e WHERE n = 1
  UNION ALL SELECT e.caseid, e.n, CASE WHEN e.time_sec - r.last_t >= 86400.0 THEN e.time_sec ELSE r.last_t END, e.time_sec - r.last_t >= 86400.0 FROM r JOIN e ON e.caseid = r.caseid AND e.n = r.n + 1),
k AS (SELECT caseid, track AS key, time_sec AS t, row_number() OVER (PARTITION BY caseid ORDER BY n)::INTEGER AS anchor_no FROM e JOIN r USING (caseid, n) WHERE kept QUALIFY anchor_no <= 4),
j AS (SELECT k.caseid, anchor_no, t, s.time_sec, s.track, CASE WHEN s.track IN ('MBP', 'HR') AND s.value BETWEEN 20 AND 220 THEN s.value WHEN s.track = 'SPO2' AND s.value BETWEEN 50 AND 100 THEN s.value END AS value
  FROM k JOIN sg s ON s.caseid = k.caseid AND NOT suffix(s.track, '_RATE') AND s.time_sec BETWEEN greatest(0, t - {_B0}) AND t),
c AS (SELECT caseid, anchor_no FROM j WHERE time_sec >= greatest(0, t - {_W}) GROUP BY 1, 2 HAVING count(DISTINCT time_sec) >= 8),
b AS (SELECT caseid, anchor_no, median(value) FILTER (track = 'MBP') AS map_baseline, median(value) FILTER (track = 'HR') AS hr_base FROM j WHERE time_sec BETWEEN greatest(0, t - {_B0}) AND greatest(0, t - {_B1}) GROUP BY 1, 2),
v AS (SELECT * FROM j WHERE value IS NOT NULL AND time_sec >= greatest(0, t - {_W})),
i AS (SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY caseid, anchor_no, track) AS n FROM v WINDOW w AS (PARTITION BY caseid, anchor_no, track ORDER BY time_sec, value)),
st AS (SELECT caseid, anchor_no, track, max(n) AS n, median(value) FILTER (i > n - 60) AS now, regr_slope(value, i::DOUBLE) AS slope, avg(value) FILTER (i > n - greatest(5, least(20, n // 10))) AS fin FROM i GROUP BY 1, 2, 3),
sm AS (SELECT caseid, anchor_no, count(*) FILTER (n >= 10)::INTEGER AS n_stats, max(now) FILTER (track = 'MBP') AS map_now, max(now) FILTER (track = 'HR') AS hr_now, max(now) FILTER (track = 'SPO2') AS spo2_now,
  max(slope) FILTER (track = 'HR' AND n >= 10) AS hr_slope, max(fin) FILTER (track = 'HR' AND n >= 10) AS hr_end FROM st GROUP BY 1, 2),
{_held_sql('m55', 'MBP', '< 55')}, {_held_sql('m65', 'MBP', '< 65')}, {_held_sql('h100', 'HR', '> 100')}, {_held_sql('h50', 'HR', '< 50')}, {_held_sql('o90', 'SPO2', '< 90')}, {_held_sql('o94', 'SPO2', '< 94')},
x AS (SELECT k.*, coalesce(n_stats, 0) AS n_stats, map_now, hr_now, spo2_now, hr_slope, hr_end, map_baseline, CASE WHEN map_baseline > 0 THEN (map_baseline - map_now) / map_baseline * 100 END AS fall, CASE WHEN hr_base > 0 THEN (hr_now - hr_base) / hr_base * 100 END AS hr_change,
  coalesce(m55, 0.0) AS m55, coalesce(m65, 0.0) AS m65, coalesce(h100, 0.0) AS h100, coalesce(h50, 0.0) AS h50, coalesce(o90, 0.0) AS o90, coalesce(o94, 0.0) AS o94 FROM k JOIN c USING (caseid, anchor_no) LEFT JOIN sm USING (caseid, anchor_no) LEFT JOIN b USING (caseid, anchor_no)
  LEFT JOIN m55 USING (caseid, anchor_no) LEFT JOIN m65 USING (caseid, anchor_no) LEFT JOIN h100 USING (caseid, anchor_no) LEFT JOIN h50 USING (caseid, anchor_no) LEFT JOIN o90 USING (caseid, anchor_no) LEFT JOIN o94 USING (caseid, anchor_no)),
y AS (SELECT *, map_now IS NOT NULL AND (m55 >= 30 OR m65 >= 60) AS absolute, coalesce(fall >= 20, false) AS relative, spo2_now IS NOT NULL AND o90 >= 30 AS grave_o, map_now IS NOT NULL AND m55 >= 30 AS grave_m FROM x)"""
SNAPSHOT_BUILD = f"""WITH RECURSIVE {_SNAPSHOT_SQL}
SELECT caseid, anchor_no, key, t AS event_time, round(map_now + 1e-9, 4) AS map_now, round(hr_now + 1e-9, 4) AS hr_now, round(spo2_now + 1e-9, 4) AS spo2_now, round(map_baseline + 1e-9, 4) AS map_baseline, round(fall + 1e-9, 4) AS map_drop_pct, round(hr_change + 1e-9, 4) AS hr_change_pct,
  round(m65 + 1e-9, 4) AS map_lt_65_held, round(h50 + 1e-9, 4) AS hr_lt_50_held, round(o94 + 1e-9, 4) AS spo2_lt_94_held, n_stats, round(hr_slope + 1e-9, 4) AS hr_slope, round(hr_end + 1e-9, 4) AS hr_end, CASE WHEN grave_m OR grave_o THEN 'high' ELSE 'moderate' END AS risk_level,
  coalesce(map_now < 65, false) OR coalesce(fall >= 15, false) OR coalesce(hr_now < 50 OR hr_now > 100, false) OR coalesce(spo2_now < 94, false) AS unstable,
  (absolute OR coalesce(map_now < 65, false))::INTEGER + (hr_now IS NOT NULL AND (h100 >= 60 OR h50 >= 60))::INTEGER + (spo2_now IS NOT NULL AND (o90 >= 30 OR o94 >= 60))::INTEGER + 1 + relative::INTEGER * 2 + absolute::INTEGER AS n_flags, 'rate_adjustment' AS intervention_type FROM y"""


def snapshot_records(spark, sf_dir):
    """Nested records, as their JSON says them: background, context, stage, and what was done."""
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("caseid"), F.col("c_nationkey").cast("string").alias("age"), F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")).alias("department"), F.when(F.col("c_custkey") % 2 == 0, " nan ").alias("dx"), F.col("c_acctbal").cast("string").alias("preop_balance"), F.col("c_name").alias("opname"))
    records = nested(_snapshots(spark, sf_dir), customers, SNAPSHOT)
    s = F.parse_json(F.to_json("snapshot"))
    get = lambda path, kind="string": F.try_variant_get(s, f"$.{path}", kind)
    visible = F.parse_json(F.to_json(visible_context(F.col("snapshot"), 28800)))
    return records.select(
        "caseid", "surgery_group", "anchor_no", get("patient_background.age").alias("age"), get("patient_background.department").alias("department"), get("patient_background.sex").alias("sex"), F.array_join(get("preop_context", "array<string>"), "|").alias("context"),
        get("intraop_stage").alias("stage"), get("anchor_detail.medication_key").alias("key"), get("clinical_table_structured.diagnosis_and_surgery.dx").alias("dx"), get("clinical_table_structured.preop_metrics.preop_balance").alias("balance"),
        get("clinical_assessment.risk_level").alias("risk_level"), get("clinical_assessment.map_policy.absolute_triggered", "boolean").alias("absolute"), F.try_variant_get(visible, "$.surgery_type", "string").alias("shown"), F.try_variant_get(visible, "$.actual_intervention", "string").isNull().alias("hides_action"),
        F.try_variant_get(visible, "$.intraop_signal_state.signals.BIS.trend_text", "string").alias("bis"),
    )


SNAPSHOT_RECORDS = f"""WITH RECURSIVE {_SNAPSHOT_SQL}
SELECT caseid, 'Other' AS surgery_group, anchor_no, c_nationkey::VARCHAR AS age, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment ELSE 'Unknown' END AS department, 'Unknown' AS sex, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment || '|' || c_name ELSE c_name END AS context,
  'Intraoperative (relative timestamp: ' || floor(t)::BIGINT || ' sec)' AS stage, key, '' AS dx, c_acctbal::VARCHAR AS balance, CASE WHEN grave_m OR grave_o THEN 'high' ELSE 'moderate' END AS risk_level, absolute, c_name AS shown, true AS hides_action, 'insufficient valid data' AS bis FROM y JOIN customer ON c_custkey = caseid"""


def medicated_semijoin(spark, sf_dir):
    """Cases with medication: volumes have to rise, small rates of volatile agents count."""
    names = {"purchase": "PHE_VOL", "signup": "SEVO_ET_RATE", "click": "MAC_RATE", "view": "HR", "error": "NOR_RATE"}
    table_ = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    s = signals(spark, sf_dir).withColumn("track", F.try_element_at(table_, "track"))
    s = s.withColumn("value", F.when(F.col("track") == "NOR_RATE", 0.0).when(F.col("track") == "SEVO_ET_RATE", F.when(F.col("ord") % 2 == 0, 0.0)).when(F.col("track") == "MAC_RATE", F.lit(None).cast("double")).otherwise(F.col("value")))
    hit = series.medicated_cases(s.filter(F.col("caseid") % 2 == 0), volume_delta=900.0).unionByName(series.medicated_cases(s.filter((F.col("caseid") % 2 == 1) & (F.col("ord") % 5 == 0) & (F.col("track") != "PHE_VOL")).withColumn("value", F.when(F.col("ord") % 25 == 0, 0.1).otherwise(F.lit(0.0)))))
    return s.join(hit, "caseid", "left_semi").groupBy("caseid").agg(F.count(F.lit(1)).alias("n"))


MEDICATED = f"""WITH {SIGNALS_SQL}, d AS (SELECT caseid, value - lag(value) OVER (PARTITION BY caseid ORDER BY time_sec, ord) AS d FROM signals WHERE track = 'purchase' AND caseid % 2 = 0),
hit AS (SELECT caseid FROM d WHERE d >= 450 UNION SELECT caseid FROM signals WHERE caseid % 2 = 1 AND ord % 25 = 0 AND track IN ('signup', 'click', 'error'))
SELECT caseid, count(*)::BIGINT AS n FROM signals WHERE caseid IN (SELECT caseid FROM hit) GROUP BY 1"""

REGISTER = [
    ("snapshot_build", snapshot_build, SNAPSHOT_BUILD),
    ("snapshot_records", snapshot_records, SNAPSHOT_RECORDS),
    ("medicated_semijoin", medicated_semijoin, MEDICATED),
    ("anchors_rate_change", anchors_rate_change, ANCHORS_RATE),
    ("case_filter_group", case_filter_group, CASE_FILTER_GROUP),
    ("multisource_union_dedup", multisource_union_dedup, MULTISOURCE),
    ("source_counts", source_counts, SOURCE_COUNTS),
    ("signal_resample_pivot", signal_resample_pivot, RESAMPLE),
    ("best_track_per_case", best_track_per_case, BEST_TRACK),
    ("range_mask", range_mask, RANGE_MASK),
    ("unit_inference", unit_inference, UNIT_INFERENCE),
    ("anchors_cumulative_change", anchors_cumulative_change, ANCHORS_CUMULATIVE),
    ("anchors_gap_dedup", anchors_gap_dedup, ANCHORS_GAP),
    ("anchors_label_dedup", anchors_label_dedup, ANCHORS_LABEL),
    ("anchors_periodic", anchors_periodic, ANCHORS_PERIODIC),
    ("anchors_hybrid", anchors_hybrid, ANCHORS_HYBRID),
    ("case_has_change_semijoin", case_has_change_semijoin, CASE_HAS_CHANGE),
    ("window_stats_trend", window_stats_trend, WINDOW_STATS),
    ("baseline_compare", baseline_compare, BASELINE),
    ("tail_persistence", tail_persistence, TAIL),
    ("interpolate_gaps", interpolate_gaps, INTERPOLATE),
    ("long_case_quantiles", long_case_quantiles, LONG_QUANTILES),
    ("long_case_fill", long_case_fill, LONG_FILL),
    ("long_case_thinning", long_case_thinning, LONG_THIN),
    ("coalesce_first_valid", coalesce_first_valid, COALESCE_VALID),
    ("row_fields_map", row_fields_map, ROW_FIELDS),
    ("time_parse", time_parse, TIME_PARSE),
]
