"""Assessment of a state in words: risk flags, notes, a level, a hint on the drug, and whether the state is unstable.

A state is a row of map_now, hr_now, spo2_now, bis_now, map_drop_pct, the seconds for which conditions have held at the
end of the window (``HELD``), key (of the medication), anchor_source, label (of a rhythm event) and delta. Unknown values
are NULL: a vital without a current value raises no flag, however long a condition has held, except that a missing BIS
is a flag itself. Numbers in texts are rounded half to even.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.values import closed, contains_any, fixed, those_of
from .policy import BIS_DEEP, BIS_LIGHT, CRITICAL_SEC, HEMODYNAMIC_SEC, HR_HIGH, HR_LOW, INHALED, MAP_DROP_PCT, MAP_LOW, MAP_SEVERE, SLOW_SEC, SPO2_LOW, SPO2_SEVERE

#: Columns of seconds: condition -> (vital, test of a value).
HELD = {
    "map_lt_55_held": ("MBP", lambda v: v < MAP_SEVERE), "map_lt_65_held": ("MBP", lambda v: v < MAP_LOW),
    "hr_gt_100_held": ("HR", lambda v: v > HR_HIGH), "hr_lt_50_held": ("HR", lambda v: v < HR_LOW),
    "spo2_lt_90_held": ("SPO2", lambda v: v < SPO2_SEVERE), "spo2_lt_94_held": ("SPO2", lambda v: v < SPO2_LOW),
    "bis_gt_60_held": ("BIS", lambda v: v > BIS_LIGHT), "bis_lt_40_held": ("BIS", lambda v: v < BIS_DEEP),
}
#: Objective instability sets in at a smaller drop than the relative flag.
UNSTABLE_DROP_PCT = 15.0

# Texts of flags; {} is a number of seconds or percent.
MAP_SEVERE_TEXT = "重度低血压（MAP < 55 mmHg，持续约{}s，>= 30s）"
MAP_LOW_TEXT = "低血压（MAP < 65 mmHg，持续约{}s，>= 60s）"
MAP_EARLY_TEXT = "MAP低于65但持续不足60s（早期预警）"
HR_HIGH_TEXT = "心动过速（HR > 100 bpm，持续约{}s）"
HR_LOW_TEXT = "心动过缓（HR < 50 bpm，持续约{}s）"
SPO2_SEVERE_TEXT = "重度低氧血症（SpO2 < 90%，持续约{}s）"
SPO2_LOW_TEXT = "血氧下降（SpO2 < 94%，持续约{}s）"
BIS_LIGHT_TEXT = "BIS持续偏高（>60，持续约{}s，需结合刺激与EMG）"
BIS_DEEP_TEXT = "BIS持续偏低（<40，持续约{}s，需结合低灌注排查）"
BIS_BRIEF_TEXT = "BIS短时偏离（持续不足120s，不单独作为给药依据）"
BIS_MISSING_TEXT = "BIS 数据缺失（优先依据MAP/HR/SpO2趋势和手术刺激评估）"
DROP_TEXT = "MAP较基线下降明显（{}%）"
ABSOLUTE_TEXT = "MAP绝对阈值触发：作为器官灌注底线优先处理"
RELATIVE_TEXT = "MAP相对下降触发：用于个体化风险分层"
RHYTHM_TEXT = "心律事件标注：{}"
SEVERE_RHYTHM_TEXT = "严重心律失常风险（arrdb标注）"
SEVERE_RHYTHMS = ("vf", "vt", "ventricular", "asystole", "torsade", "af with rvr")
SEVERE_WORDS = ("重度", "严重")
# Notes on combinations.
LOW_LOW_TEXT = "MAP低+HR低：优先考虑麻醉相关抑制或传导问题，避免单纯加深麻醉。"
LOW_HIGH_TEXT = "MAP低+HR高：需警惕低容量/失血或应激反应，不应仅按BIS加药。"
LOW_DEEPER_TEXT = "MAP低+正在加深麻醉：符合药理性低血压风险，应先守住灌注底线。"
LOW_PRESSOR_TEXT = "MAP低+升压药背景：提示可能为难治性低血压，需要复核病因与容量状态。"
LIGHT_LOW_TEXT = "BIS高合并低血压时，不能机械加深麻醉，应先稳定循环。"
LIGHT_HIGH_TEXT = "BIS高+HR/MAP上冲更像镇痛不足或镇静镇痛双不足，需要联合调整。"
DEEP_LOW_TEXT = "BIS低+MAP低提示可能过深麻醉并低灌注，宜减浅麻醉并支持循环。"
# Keys of drugs that raise pressure and of drugs that deepen anesthesia.
PRESSOR_KEYS = ("NOR_RATE", "EPH_VOL", "EPH_RATE", "PHE_RATE", "EPI_RATE", "DOPA_RATE")
DEPTH_KEYS = ("PPF20_VOL", *INHALED, "MAC_RATE")
# What to consider for a drug.
HINTS = (
    (("PHE_RATE",), "去氧肾上腺素通常用于血管扩张相关低血压且心率不低的场景；若明显心动过缓需谨慎。"),
    (("EPH_VOL", "EPH_RATE"), "麻黄碱更适合低血压合并低心率；若已明显心动过速应避免继续加量。"),
    (("NOR_RATE",), "去甲肾上腺素用于难治性血管扩张性低血压；疑似低容量时应先扩容后升压。"),
    (("EPI_RATE",), "肾上腺素主要用于抢救级循环衰竭场景；不宜作为常规轻中度低血压首选。"),
    (("NTG_VOL", "NTG_RATE"), "硝酸甘油用于缺血/高血压/肺水肿场景；MAP偏低时可显著恶化循环，需谨慎。"),
    (("MIL_VOL", "MIL_RATE"), "米力农可改善低心排与肺高压，但有扩血管效应；低血压未纠正前避免升级。"),
    (("ATRO_VOL", "ATRO_RATE"), "阿托品用于有血流动力学意义的严重心动过缓；非症状性慢心率不应机械使用。"),
    (("PPF20_VOL",), "丙泊酚调整需先看灌注：当MAP已低时应先稳循环，再评估是否继续加深麻醉。"),
    (("REMI_VOL", "REMI_RATE", "RFTN20_VOL", "RFTN50_VOL", "RFTN20_RATE", "RFTN50_RATE"), "阿片类调整常用于手术刺激上冲控制；需同步监测呼吸抑制、心动过缓与低血压。"),
    ((*INHALED, "MAC_RATE"), "吸入麻醉浓度调整应与MAP/HR/SpO2共同判断，避免仅凭BIS单指标机械加深或减浅。"),
)
RHYTHM_HINT = "该锚点来自 arrdb 心律标注事件，建议结合血流动力学与麻醉深度判断是否需要节律/循环干预。"
PERIODIC_HINT = "该锚点来自无标记时间采样，用于让模型基于体征上下文学习临床推理。"
NO_HINT = "未触发特定干预启发式。"
MISSING_GUIDANCE = "If BIS data is missing, infer anesthesia depth from autonomic signs (HR/MBP trends) and surgical stimulation context."


def _said(text: str, number: Column, digits: int = 0) -> Column:
    before, after = text.split("{}")
    return F.concat(F.lit(before), fixed(number, digits), F.lit(after))


def _held(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0.0))


def _rhythm() -> Column:
    """Whether the event is a rhythm annotation: by its key or source, unless its key is a drug with a hint."""
    drugs = [k for keys, _ in HINTS for k in keys]
    return ~closed(F.col("key").isin(*drugs)) & closed((F.col("anchor_source") == "arrdb") | (F.col("key") == "ARR_EVENT"))


def absolute_triggered() -> Column:
    return closed(F.col("map_now").isNotNull() & ((_held("map_lt_55_held") >= CRITICAL_SEC) | (_held("map_lt_65_held") >= HEMODYNAMIC_SEC)))


def relative_triggered() -> Column:
    return closed(F.col("map_drop_pct") >= MAP_DROP_PCT)


def risk_flags() -> Column:
    """Flags in the order of their vitals, then what they trigger, then the rhythm."""
    c = F.col

    def cascade(now: str, *steps: tuple[str, float, str]) -> Column:
        out = F
        for name, least, text in steps:
            out = out.when(c(now).isNotNull() & (_held(name) >= least), _said(text, _held(name)))
        return out

    map_flag = cascade("map_now", ("map_lt_55_held", CRITICAL_SEC, MAP_SEVERE_TEXT), ("map_lt_65_held", HEMODYNAMIC_SEC, MAP_LOW_TEXT)).when(c("map_now") < MAP_LOW, MAP_EARLY_TEXT)
    hr_flag = cascade("hr_now", ("hr_gt_100_held", HEMODYNAMIC_SEC, HR_HIGH_TEXT), ("hr_lt_50_held", HEMODYNAMIC_SEC, HR_LOW_TEXT))
    spo2_flag = cascade("spo2_now", ("spo2_lt_90_held", CRITICAL_SEC, SPO2_SEVERE_TEXT), ("spo2_lt_94_held", HEMODYNAMIC_SEC, SPO2_LOW_TEXT))
    bis_flag = cascade("bis_now", ("bis_gt_60_held", SLOW_SEC, BIS_LIGHT_TEXT), ("bis_lt_40_held", SLOW_SEC, BIS_DEEP_TEXT))
    bis_flag = bis_flag.when((c("bis_now") > BIS_LIGHT) | (c("bis_now") < BIS_DEEP), BIS_BRIEF_TEXT).when(c("bis_now").isNull(), BIS_MISSING_TEXT)
    drop = F.when(relative_triggered(), _said(DROP_TEXT, c("map_drop_pct"), 1))
    label = F.trim(F.coalesce(c("label"), F.lit("")))
    rhythm = F.when(_rhythm() & (label != ""), F.concat(F.lit(RHYTHM_TEXT.removesuffix("{}")), label))
    grave = F.when(_rhythm() & contains_any(F.lower(label), list(SEVERE_RHYTHMS)), SEVERE_RHYTHM_TEXT)
    triggered = (F.when(absolute_triggered(), ABSOLUTE_TEXT), F.when(relative_triggered(), RELATIVE_TEXT))
    return those_of(map_flag, hr_flag, spo2_flag, bis_flag, drop, *triggered, rhythm, grave)


def notes() -> Column:
    """What combinations of vitals and the drug say."""
    c = F.col
    low = c("map_now") < MAP_LOW
    light, fast = c("bis_now") > BIS_LIGHT, c("hr_now") > HR_HIGH
    found = (
        (low & (c("hr_now") < HR_LOW), LOW_LOW_TEXT),
        (low & fast, LOW_HIGH_TEXT),
        (low & c("key").isin(*DEPTH_KEYS) & (c("delta") > 0), LOW_DEEPER_TEXT),
        (low & c("key").isin(*PRESSOR_KEYS), LOW_PRESSOR_TEXT),
    )
    together = F.when(closed(light & low), LIGHT_LOW_TEXT).when(closed(light & fast), LIGHT_HIGH_TEXT)
    deep = F.when(closed((c("bis_now") < BIS_DEEP) & low), DEEP_LOW_TEXT)
    return those_of(*[F.when(closed(cond), text) for cond, text in found], together, deep)


def risk_level(flags: Column) -> Column:
    grave = F.exists(flags, lambda f: F.contains(f, F.lit(SEVERE_WORDS[0])) | F.contains(f, F.lit(SEVERE_WORDS[1])))
    return F.when(grave, "high").when(F.size(flags) > 0, "moderate").otherwise("low")


def hint() -> Column:
    """What to consider for the event's drug or kind."""
    out = F
    for keys, text in HINTS:
        out = out.when(closed(F.col("key").isin(*keys)), text)
    out = out.when(_rhythm(), RHYTHM_HINT)
    return out.when(closed((F.col("anchor_source") == "periodic") | (F.col("key") == "UNLABELED_EVENT")), PERIODIC_HINT).otherwise(NO_HINT)


def has_flags(flags: Column) -> Column:
    """Whether some flag says something."""
    return closed(F.exists(flags, lambda f: F.trim(f) != ""))


def unstable() -> Column:
    """Objective instability. BIS counts only beside another abnormal vital, which is enough by itself."""
    c = F.col
    return closed(c("map_now") < MAP_LOW) | closed(c("map_drop_pct") >= UNSTABLE_DROP_PCT) | closed((c("hr_now") < HR_LOW) | (c("hr_now") > HR_HIGH)) | closed(c("spo2_now") < SPO2_LOW)


def assessment(baseline: Column | None = None, reference: dict[str, dict[str, str]] | None = None) -> Column:
    """All of it as one struct; ``baseline`` is a struct that goes in as it is, ``reference`` a table of drugs."""
    flags = risk_flags()
    seconds = {n.removesuffix("_held"): _held(n) for n in HELD}
    windows = {"critical_window_sec": CRITICAL_SEC, "hemodynamic_window_sec": HEMODYNAMIC_SEC, "slow_trend_window_sec": SLOW_SEC}
    parts = [
        F.struct(F.col("map_now").alias("MAP_mmhg"), F.col("hr_now").alias("HR_bpm"), F.col("spo2_now").alias("SpO2_pct"), F.col("bis_now").alias("BIS")).alias("recent_state_mean"),
        flags.alias("risk_flags"),
        notes().alias("contextual_interpretation"),
        risk_level(flags).alias("risk_level"),
        F.struct(F.lit(True).alias("absolute_primary"), F.lit(True).alias("relative_layered"), absolute_triggered().alias("absolute_triggered"), relative_triggered().alias("relative_triggered")).alias("map_policy"),
        F.struct(*[v.alias(n) for n, v in seconds.items()]).alias("persistence_seconds"),
        F.struct(*[F.lit(v).alias(n) for n, v in windows.items()]).alias("decision_windows_sec"),
        hint().alias("intervention_consideration"),
        F.lit(MISSING_GUIDANCE).alias("missing_data_guidance"),
    ]
    if baseline is not None:
        parts.insert(1, baseline.alias("baseline_comparison"))
    if reference:
        parts.append(_table(reference).alias("drug_reference"))
    return F.struct(*parts)


def _table(reference: dict[str, dict[str, str]]) -> Column:
    inner = lambda facts: F.create_map(*[F.lit(x) for pair in facts.items() for x in pair])
    return F.create_map(*[x for drug, facts in reference.items() for x in (F.lit(drug), inner(facts))])
