"""From signals to snapshots: events, windows, baselines, persistence, assessment, one row for each event.

Every event meets its signals in one join by case and bucket; the points of its window come together as one bounded row,
of which all statistics are array expressions.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import first_fields, first_present, first_valid, valid_fields, with_unit
from ..operators import anchors, assessment, policy, series


@dataclass(frozen=True)
class SnapshotConfig:
    window_sec: float = 300.0
    least_points: int = 60
    baseline_sec: tuple[float, float] = (1200.0, 600.0)
    vitals: tuple[str, ...] = ("MBP", "HR", "SPO2", "BIS")
    anchor: anchors.AnchorConfig = field(default_factory=anchors.AnchorConfig)


KEYS = ["caseid", "anchor_no"]
NOW = {"map_now": "MBP", "hr_now": "HR", "spo2_now": "SPO2", "bis_now": "BIS"}


def find_events(medication: DataFrame, cfg: SnapshotConfig) -> DataFrame:
    """Rate and volume changes without setup artefacts, thinned over all tracks, the first few of each case.

    The cut to the first few comes before the check of window lengths, so a short window uses up a place.
    """
    a = cfg.anchor
    rates = anchors.changes(medication.filter(F.col("track").endswith("_RATE"))).filter(F.abs("delta") >= series.rate_threshold(F.col("track"), a.rate_delta))
    rates = rates.filter(~anchors.zero_start()).filter(~F.coalesce(anchors.likely_setup(a), F.lit(False)))
    smoothed = anchors.smoothed_rates(medication.filter(F.col("track").endswith("_VOL")), a.lookback_sec)
    volumes = anchors.volume_anchors(smoothed, a.volume_delta).filter(F.coalesce(F.col("smoothed_delta") >= 0.5, F.lit(True)))
    both = rates.unionByName(volumes, allowMissingColumns=True)
    kept = anchors.thin(both, a.gap_sec)
    return anchors.first_k(kept, a.per_case, ["time_sec", "ord"])


def window_points(events: DataFrame, points: DataFrame, cfg: SnapshotConfig) -> DataFrame:
    """A row per event (caseid, anchor_no, event_time) with n_times of its window, the window's valid points of each
    vital in order, and the baselines of pressure and heart rate.

    ``points`` are (caseid, time_sec, track, value); the join reaches back as far as the baseline does.
    """
    begin, end = cfg.baseline_sec
    reach = series.windows(events, points, max(begin, cfg.window_sec))
    at, t = F.col("time_sec"), F.col("event_time")
    back = lambda sec: F.greatest(F.lit(0.0), t - sec)
    inside, before = at >= back(cfg.window_sec), at.between(back(begin), back(end))
    of = lambda v: F.col("track") == v
    valid = F.col("value").isNotNull()
    lists = [F.array_sort(F.collect_list(F.when(inside & of(v) & valid, F.struct("time_sec", "value")))).alias(f"points_{v}") for v in cfg.vitals]
    times = F.size(F.collect_set(F.when(inside, at))).alias("n_times")
    base = [F.median(F.when(before & of(v), F.col("value"))).alias(n) for n, v in (("map_baseline", "MBP"), ("hr_baseline", "HR"))]
    return reach.groupBy(*KEYS).agg(times, *lists, *base)


def statistics(rows: DataFrame, cfg: SnapshotConfig) -> DataFrame:
    """Summaries, current medians, persistence and changes against the baseline from ``window_points``."""
    df = rows
    for v in cfg.vitals:
        df = df.withColumn(f"step_{v}", series.step_of(F.col(f"points_{v}")))
    points = lambda v: F.col(f"points_{v}") if v in cfg.vitals else F.array().cast("array<struct<time_sec:double,value:double>>")
    step = lambda v: F.col(f"step_{v}") if v in cfg.vitals else F.lit(1.0)
    stats = F.filter(F.array(*[F.struct(F.lit(v).alias("key"), series.summary_of(points(v)).alias("value")) for v in cfg.vitals]), lambda e: e["value"].isNotNull())
    df = df.select(
        *KEYS, "n_times", "map_baseline", "hr_baseline", F.map_from_entries(stats).alias("vital_stats"),
        *[series.recent_median_of(points(v)).alias(n) for n, v in NOW.items()],
        *[series.held_of(points(v), step(v), test).alias(n) for n, (v, test) in assessment.HELD.items()],
    )
    change = F.when(F.col("hr_baseline") > 0, (F.col("hr_now") - F.col("hr_baseline")) / F.col("hr_baseline") * 100.0)
    return df.withColumn("map_drop_pct", series.percent_drop(F.col("map_baseline"), F.col("map_now"))).withColumn("hr_change_pct", change)


def snapshots(medication: DataFrame, vitals: DataFrame, cfg: SnapshotConfig = SnapshotConfig()) -> DataFrame:
    """Events with statistics of each vital in the window before, current medians, baselines, persistence, assessment,
    what was done, and how that agrees with the rules.

    ``medication`` and ``vitals`` are (caseid, time_sec, track, value, ord); a vital's track is its key.
    """
    events = find_events(medication, cfg).withColumn("event_time", F.col("time_sec"))
    found = statistics(window_points(events.select(*KEYS, "event_time"), series.masked(vitals, series.RANGES), cfg), cfg)
    out = events.drop("time_sec").join(found.filter(F.col("n_times") >= cfg.least_points).drop("n_times"), KEYS)
    none = F.lit(None).cast("string")
    out = out.withColumn("key", F.col("track")).withColumn("anchor_source", F.lit("medication")).withColumn("label", none)
    out = out.withColumn("assessment", assessment.assessment(baseline(cfg)))
    out = out.withColumn("risk_flags", F.col("assessment.risk_flags")).withColumn("risk_level", F.col("assessment.risk_level")).withColumn("unstable", assessment.unstable())
    kind = policy.intervention_type(F.col("key"), F.col("anchor_source"), F.col("smoothed_rate_per_h"), F.col("smoothed_delta"))
    done = F.struct("key", "label", "before", "after", "delta", "dt_sec", F.col("rate_per_h"), F.col("smoothed_rate_per_h").alias("smoothed_rate"), F.col("smoothed_dt_sec"), F.col("smoothed_delta"))
    out = out.withColumn("intervention_type", kind).withColumn("actual_intervention", policy.describe(done, F.col("intervention_type")))
    said = F.col("actual_intervention")
    out = out.withColumn("action_class", policy.action_class(F.col("key"), said)).withColumn("action_drug", policy.action_drug(F.col("key"), said)).withColumn("escalation", policy.escalates(F.col("delta"), said))
    return policy.judge(out)


def baseline(cfg: SnapshotConfig) -> Column:
    """The comparison with the baseline as a struct."""
    back = lambda sec: F.greatest(F.lit(0.0), F.col("event_time") - sec)
    return F.struct(
        back(cfg.baseline_sec[0]).alias("baseline_window_start_sec"), back(cfg.baseline_sec[1]).alias("baseline_window_end_sec"),
        F.col("map_baseline").alias("MAP_baseline_mmhg"), F.col("map_now").alias("MAP_current_mmhg"), F.col("map_drop_pct").alias("MAP_drop_from_baseline_pct"),
        F.col("hr_baseline").alias("HR_baseline_bpm"), F.col("hr_now").alias("HR_current_bpm"), F.col("hr_change_pct").alias("HR_change_from_baseline_pct"),
    )


# Which fields of a case go where, and what stands for none.
BACKGROUND = {"age": ("age",), "sex": ("sex", "gender"), "height_cm": ("height", "height_cm"), "weight_kg": ("weight", "weight_kg", "wt"), "bmi": ("bmi",), "asa": ("asa",), "department": ("department",)}
CONTEXT = ("dx", "opdiag", "opdiag1", "preop_dx", "comorbidity", "allergy", "lab", "department", "optype", "opname", "approach", "position", "ane_type", "preop_htn", "preop_dm")
NO_CONTEXT = "No obvious preop comorbidity/lab abnormality in source table"
SURGERY = ("department", "optype", "opname", "approach", "position", "ane_type")
TABLES = {
    "airway_and_lines": ("cormack", "airway", "tubesize", "dltubesize", "lmasize", "iv1", "iv2", "aline1", "aline2", "cline1", "cline2"),
    "timeline": ("casestart", "caseend", "anestart", "aneend", "opstart", "opend", "adm", "dis", "icu_days", "death_inhosp"),
    "source_meta": ("caseid", "subjectid", "source_dataset", "case_id", "analysis_start_time_sec", "analysis_end_time_sec", "analyzed_duration_sec", "total_beats", "rhythm_classes", "ane_dur"),
}


def case_block(cases: DataFrame) -> DataFrame:
    """(caseid, surgery_group, case): what snapshots say of a case, as one struct of backgrounds and tables."""
    def first(names: tuple[str, ...], default: str | None = "Unknown") -> Column:
        return first_valid(*[F.col(f"`{c}`") for c in [first_present(cases, n) for n in names] if c], default=default)

    some = [F.col(n) for n in CONTEXT if n in cases.columns]
    context = first_fields(some) if some else F.array().cast("array<string>")
    group = F.coalesce(F.col("surgery_group") if "surgery_group" in cases.columns else F.lit(None).cast("string"), F.lit("Other"))
    structured = F.struct(
        F.struct(first(("dx",), "").alias("dx"), *[first((n,), "Unknown surgery" if n == "opname" else "Unknown").alias(n) for n in SURGERY]).alias("diagnosis_and_surgery"),
        valid_fields(cases, prefix="preop_").alias("preop_metrics"), valid_fields(cases, prefix="intraop_").alias("intraop_summary"),
        *[valid_fields(cases, list(names)).alias(table) for table, names in TABLES.items()],
    )
    block = F.struct(
        F.struct(*[first(names).alias(n) for n, names in BACKGROUND.items()], group.alias("surgery_group")).alias("patient_background"),
        F.when(F.size(context) == 0, F.array(F.lit(NO_CONTEXT))).otherwise(context).alias("preop_context"),
        first(("opname",), "Unknown surgery").alias("surgery_type"), structured.alias("clinical_table_structured"), valid_fields(cases).alias("clinical_table_all_fields"),
    )
    return cases.select("caseid", group.alias("surgery_group"), block.alias("case"))


def nested(flat: DataFrame, cases: DataFrame, cfg: SnapshotConfig = SnapshotConfig()) -> DataFrame:
    """Records (caseid, surgery_group, anchor_no, snapshot) from ``snapshots`` and a case table; every field of a
    snapshot under its own name. Cases without a row in the table drop out, as their snapshots would have no background."""
    df = flat.join(case_block(cases), "caseid")
    c, case = F.col, lambda n: F.col(f"case.{n}").alias(n)
    whole = lambda v: F.floor(v).cast("long")
    trends = F.struct(*[series.trend_text(F.try_element_at("vital_stats", F.lit(v)), series.UNITS.get(v, "")).alias(v) for v in cfg.vitals])
    detail = {
        "anchor_source": c("anchor_source"), "track": c("track"), "medication_key": c("key"), "arrhythmia_label": c("label"), "time_sec": whole(c("event_time")), "prev_time_sec": c("prev_time_sec"),
        "delta_time_sec": c("dt_sec"), "delta": c("delta"), "inferred_rate_ml_per_h": c("rate_per_h"), "smoothed_rate_ml_per_h": c("smoothed_rate_per_h"), "smoothed_delta_time_sec": c("smoothed_dt_sec"),
        "smoothed_ref_time_sec": c("ref_time_sec"), "smoothed_ref_volume_ml": c("ref_value"), "smoothed_delta_volume_ml": c("smoothed_delta"), "intervention_type": c("intervention_type"), "before": c("before"), "after": c("after"),
    }
    snapshot = F.struct(
        case("patient_background"), case("preop_context"), case("surgery_type"), F.concat(F.lit("Intraoperative (relative timestamp: "), whole(c("event_time")).cast("string"), F.lit(" sec)")).alias("intraop_stage"),
        trends.alias(f"vital_trend_last_{int(cfg.window_sec / 60)}min"), c("vital_stats"), c("assessment.baseline_comparison"), c("assessment").alias("clinical_assessment"),
        F.struct("strategies", "verdict", "reason", c("high_risk").alias("high_risk_conflict")).alias("miller_alignment"), c("actual_intervention"), c("intervention_type").alias("interpreted_intervention_type"),
        F.struct(*[v.alias(n) for n, v in detail.items()]).alias("anchor_detail"), case("clinical_table_structured"), case("clinical_table_all_fields"), F.lit("").alias("waveform_image_path"),
    )
    return df.select("caseid", "surgery_group", "anchor_no", snapshot.alias("snapshot"))


# Names of the vitals in prompts, and the units that answers keep to.
PROMPT_NAMES = {"MBP": "MAP", "HR": "HR", "SPO2": "SpO2", "BIS": "BIS"}
UNIT_GUIDE = {"MAP": "mmHg", "HR": "bpm", "SpO2": "%", "BIS": "index", "infusion_rate": "mL/h", "bolus_volume": "mL", "volatile_concentration": "vol%", "time": "s or min"}
SUPPORT_FIELDS = ("preop_context", "baseline_comparison", "clinical_assessment", "clinical_table_structured", "clinical_table_all_fields", "miller_alignment", "actual_intervention", "interpreted_intervention_type", "anchor_detail")


def signal_context(vital_stats: Column, minutes: int) -> Column:
    """What a question may say of the signals: current value, trend and mean of each vital, or that there are none."""
    def of(v: str) -> Column:
        s, unit = F.try_element_at(vital_stats, F.lit(v)), series.UNITS[v]
        value = lambda n: F.when(s.isNotNull(), with_unit(s[n], unit))
        course = F.concat(value("start"), F.lit(" -> "), value("end"), F.lit(" ("), s["trend"], F.lit(")"))
        return F.struct(value("end").alias("current"), course.alias("trend"), value("mean").alias("window_mean"), F.when(s.isNull(), series.NO_TREND).alias("trend_text"))

    return F.struct(F.lit(f"last_{minutes}min").alias("trend_window"), F.struct(*[of(v).alias(n) for v, n in PROMPT_NAMES.items()]).alias("signals"))


def visible_context(snapshot: Column, minutes: int) -> Column:
    """What a question may show: background, surgery, stage, signals and units; nothing that was concluded or done."""
    units = F.struct(*[F.lit(u).alias(n) for n, u in UNIT_GUIDE.items()])
    return F.struct(*[snapshot[n].alias(n) for n in ("patient_background", "surgery_type", "intraop_stage")], signal_context(snapshot["vital_stats"], minutes).alias("intraop_signal_state"), units.alias("unit_standard"))


def support_context(snapshot: Column) -> Column:
    """What supports a decision and must stay out of a question."""
    return F.struct(*[snapshot[n].alias(n) for n in SUPPORT_FIELDS])
