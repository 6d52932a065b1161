"""Facts and rules: strategies from a state, rules over facts, verdicts; intervention types and label checks.

A state is a row of map_now, hr_now, spo2_now, bis_now, map_drop_pct, map_lt_65_held, map_lt_55_held, spo2_lt_90_held,
delta, action_class, action_drug and escalation; unknown values are NULL and make a fact false unless it says otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import closed, contains_any, fixed, let
from .qa import json_object

# Thresholds.
MAP_LOW, MAP_SEVERE, MAP_DROP_PCT = 65.0, 55.0, 20.0
HR_HIGH, HR_LOW = 100.0, 50.0
SPO2_LOW, SPO2_SEVERE = 94.0, 90.0
BIS_LIGHT, BIS_DEEP = 60.0, 40.0
CRITICAL_SEC, HEMODYNAMIC_SEC, SLOW_SEC = 30.0, 60.0, 120.0

# Conflict rules as (id, all of, none of, high risk), first match gives the reason.
CONFLICT_RULES = (
    ("oxygenation_worsen_perfusion", ("strategy_oxygenation_first", "action_escalation", "class_worsen_perfusion"), (), True),
    ("perfusion_worsen_perfusion", ("strategy_perfusion_first", "action_escalation", "class_worsen_perfusion"), (), True),
    ("map_low_escalate_hypnotic_or_vasodilator", ("map_low", "action_escalation", "class_hypnotic_or_vasodilator_inodilator"), (), True),
    ("bis_high_and_low_map_hypnotic_escalation", ("map_below_75", "bis_high", "class_hypnotic", "action_escalation"), (), True),
    ("reduce_depth_but_hypnotic_escalation", ("strategy_reduce_depth", "class_hypnotic", "action_escalation"), (), True),
    ("phenylephrine_in_bradycardia", ("action_escalation", "drug_phenylephrine", "hr_lt_50"), (), True),
    ("ephedrine_in_tachycardia", ("action_escalation", "drug_ephedrine", "hr_gt_100"), (), True),
    ("epinephrine_non_rescue", ("action_escalation", "drug_epinephrine", "map_not_lt_55"), (), False),
    ("nitroglycerin_when_map_low", ("action_escalation", "drug_nitroglycerin", "map_low"), (), True),
    ("milrinone_when_map_low", ("action_escalation", "drug_milrinone", "map_low"), (), True),
    ("atropine_when_tachycardia", ("action_escalation", "drug_atropine", "hr_gt_100"), (), False),
    ("propofol_in_severe_hypotension", ("action_escalation", "drug_propofol", "severe_hypotension"), (), True),
    ("remifentanil_brady_hypotension", ("action_escalation", "drug_remifentanil", "map_low", "hr_lt_50"), (), True),
    ("remifentanil_in_severe_hypotension", ("action_escalation", "drug_remifentanil", "map_lt_55"), (), True),
    ("norepinephrine_without_volume_optimization", ("action_escalation", "drug_norepinephrine", "severe_hypotension", "hr_gt_110", "map_drop_ge_relative"), (), True),
)
# Alignment rules as (id, all of, none of, outcome); the last aligned and the first partial reason count.
ALIGNMENT_RULES = (
    ("vasopressor_when_perfusion_first", ("class_vasopressor_or_inopressor", "strategy_perfusion_first"), (), "aligned"),
    ("vasopressor_when_map_low_partial", ("class_vasopressor_or_inopressor", "map_low"), ("strategy_perfusion_first",), "partial"),
    ("opioid_or_hypnotic_when_bis_high", ("class_opioid_or_hypnotic", "strategy_consider_depth_or_analgesia_increase"), (), "aligned"),
    ("opioid_or_hypnotic_with_low_map_caution", ("class_opioid_or_hypnotic", "strategy_consider_depth_or_analgesia_increase", "map_below_75"), (), "partial"),
    ("decrease_hypnotic_when_reduce_depth", ("class_hypnotic", "strategy_reduce_depth", "delta_negative"), (), "aligned"),
    ("monitoring_in_low_signal_context", ("strategy_context_monitoring", "class_monitoring_compatible"), (), "aligned"),
    ("phenylephrine_with_severe_hypotension_hr_not_low", ("drug_phenylephrine", "severe_hypotension", "hr_not_low"), (), "aligned"),
    ("ephedrine_with_low_hr_hypotension", ("drug_ephedrine", "severe_hypotension", "hr_lt_60", "hr_le_100"), (), "aligned"),
    ("norepinephrine_with_severe_hypotension", ("drug_norepinephrine", "severe_hypotension"), (), "aligned"),
    ("epinephrine_rescue_range", ("drug_epinephrine", "map_lt_55"), (), "aligned"),
    ("atropine_with_critical_brady", ("drug_atropine", "severe_hypotension", "hr_lt_45"), (), "aligned"),
    ("vasodilator_or_inodilator_when_map_65_75", ("drug_vasodilator_or_inodilator", "map_ge_65", "map_below_75"), (), "partial"),
    ("vasodilator_or_inodilator_when_map_ge_75", ("drug_vasodilator_or_inodilator", "map_ge_75"), (), "aligned"),
)
# Words by which a text names a drug, in order, with the drug and its class.
DRUG_WORDS = (
    (("去氧", "苯肾上腺素", "phenylephrine"), "phenylephrine"),
    (("麻黄碱", "ephedrine"), "ephedrine"),
    (("去甲", "norepinephrine"), "norepinephrine"),
    (("肾上腺素", "epinephrine"), "epinephrine"),
    (("硝酸甘油", "nitroglycerin", "glyceryl trinitrate", "tng"), "nitroglycerin"),
    (("米力农", "milrinone"), "milrinone"),
    (("阿托品", "atropine"), "atropine"),
    (("丙泊酚", "propofol"), "propofol"),
    (("瑞芬太尼", "remifentanil"), "remifentanil"),
)
CLASS_WORDS = (
    (("去甲", "去氧", "肾上腺素", "norepinephrine", "phenylephrine", "epinephrine"), "vasopressor"),
    (("麻黄碱", "ephedrine"), "vasopressor"),
    (("丙泊酚", "propofol"), "hypnotic_iv"),
    (("瑞芬太尼", "remifentanil"), "opioid_analgesic"),
    (("七氟烷", "地氟烷", "异氟烷", "sevoflurane", "desflurane", "isoflurane"), "hypnotic_volatile"),
    (("硝酸甘油", "nitroglycerin", "glyceryl trinitrate", "tng"), "vasodilator"),
    (("米力农", "milrinone"), "inodilator"),
    (("阿托品", "atropine"), "chronotropic"),
    (("尼卡地平", "硝普钠", "艾司洛尔", "乌拉地尔", "nicardipine", "nitroprusside", "esmolol"), "anti_sympathetic"),
)
DECREASE_WORDS = ("减少", "减量", "下调", "降低", "停用", "decrease", "down-titrate", "stop", "wean")
INCREASE_WORDS = ("增加", "加量", "追加", "上调", "推注", "滴注", "泵注", "increase", "up-titrate", "bolus")
# Medication keys with class, drug, name and the words by which a text names them.
KEYS = {
    "PHE_RATE": ("vasopressor", "phenylephrine", "去氧肾上腺素泵速", ("去氧肾上腺素", "苯肾上腺素", "phenylephrine")),
    "NOR_RATE": ("vasopressor", "norepinephrine", "去甲肾上腺素泵速", ("去甲肾上腺素", "norepinephrine")),
    "EPH_VOL": ("vasopressor", "ephedrine", "麻黄碱累计量", ("麻黄碱", "ephedrine")),
    "EPH_RATE": ("vasopressor", "ephedrine", "麻黄碱泵速", ("麻黄碱", "ephedrine")),
    "EPI_RATE": ("inopressor", "epinephrine", "肾上腺素泵速", ("肾上腺素", "epinephrine")),
    "DOPA_RATE": ("inopressor", None, "多巴胺泵速", ("多巴胺", "dopamine")),
    "ESMO_RATE": ("anti_sympathetic", None, "艾司洛尔泵速", ("艾司洛尔", "esmolol")),
    "NICA_RATE": ("anti_sympathetic", None, "尼卡地平泵速", ("尼卡地平", "nicardipine")),
    "NPS_RATE": ("anti_sympathetic", None, "硝普钠泵速", ("硝普钠", "nitroprusside")),
    "NTG_VOL": ("vasodilator", "nitroglycerin", "硝酸甘油累计量", ("硝酸甘油", "nitroglycerin", "glyceryl trinitrate")),
    "NTG_RATE": ("vasodilator", "nitroglycerin", "硝酸甘油泵速", ("硝酸甘油", "nitroglycerin", "glyceryl trinitrate")),
    "MIL_VOL": ("inodilator", "milrinone", "米力农累计量", ("米力农", "milrinone")),
    "MIL_RATE": ("inodilator", "milrinone", "米力农泵速", ("米力农", "milrinone")),
    "ATRO_VOL": ("chronotropic", "atropine", "阿托品累计量", ("阿托品", "atropine")),
    "ATRO_RATE": ("chronotropic", "atropine", "阿托品泵速", ("阿托品", "atropine")),
    "URA_RATE": ("anti_sympathetic", None, "乌拉地尔泵速", ("乌拉地尔", "urapidil")),
    "PPF20_VOL": ("hypnotic_iv", "propofol", "丙泊酚累计量", ("丙泊酚", "propofol")),
    "REMI_VOL": ("opioid_analgesic", "remifentanil", "瑞芬太尼累计量", ("瑞芬太尼", "remifentanil")),
    "REMI_RATE": ("opioid_analgesic", "remifentanil", "瑞芬太尼泵速", ("瑞芬太尼", "remifentanil")),
    "RFTN20_VOL": ("opioid_analgesic", "remifentanil", "瑞芬太尼20浓度累计量", ("瑞芬太尼", "remifentanil")),
    "RFTN50_VOL": ("opioid_analgesic", "remifentanil", "瑞芬太尼50浓度累计量", ("瑞芬太尼", "remifentanil")),
    "RFTN20_RATE": ("opioid_analgesic", "remifentanil", "瑞芬太尼20浓度速率", ("瑞芬太尼", "remifentanil")),
    "RFTN50_RATE": ("opioid_analgesic", "remifentanil", "瑞芬太尼50浓度速率", ("瑞芬太尼", "remifentanil")),
    "ROC_VOL": ("neuromuscular", None, "罗库溴铵累计量", ("罗库溴铵", "rocuronium")),
    "ROC_RATE": ("neuromuscular", None, "罗库溴铵泵速", ("罗库溴铵", "rocuronium")),
    "SEVO_ET_RATE": ("hypnotic_volatile", None, "七氟烷呼气末浓度", ("七氟烷", "sevoflurane")),
    "SEVO_FI_RATE": ("hypnotic_volatile", None, "七氟烷吸入浓度", ("七氟烷", "sevoflurane")),
    "DES_ET_RATE": ("hypnotic_volatile", None, "地氟烷呼气末浓度", ("地氟烷", "desflurane")),
    "DES_FI_RATE": ("hypnotic_volatile", None, "地氟烷吸入浓度", ("地氟烷", "desflurane")),
    "ISO_ET_RATE": ("hypnotic_volatile", None, "异氟烷呼气末浓度", ("异氟烷", "isoflurane")),
    "ISO_FI_RATE": ("hypnotic_volatile", None, "异氟烷吸入浓度", ("异氟烷", "isoflurane")),
    "MAC_RATE": ("hypnotic_volatile", None, "吸入麻醉MAC", ("吸入麻醉", "volatile", "mac")),
    "ARR_EVENT": ("arrhythmia", None, None, ("心律", "arrhythmia")),
    "UNLABELED_EVENT": ("unknown", None, None, ()),
}
KEY_CLASSES = {k: v[0] for k, v in KEYS.items()}
KEY_DRUGS = {k: v[1] for k, v in KEYS.items() if v[1]}
KEY_NAMES = {k: v[2] for k, v in KEYS.items() if v[2]}
# Keys of inhaled agents, whose unit is vol%.
INHALED = ("SEVO_ET_RATE", "SEVO_FI_RATE", "DES_ET_RATE", "DES_FI_RATE", "ISO_ET_RATE", "ISO_FI_RATE")
WORSENS_PERFUSION = ("hypnotic_iv", "hypnotic_volatile", "anti_sympathetic", "vasodilator", "inodilator")


def _by_words(text: Column, table) -> Column:
    low = F.lower(F.coalesce(text, F.lit("")))
    out = None
    for words, name in table:
        hit = contains_any(low, list(words))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("unknown")


def _by_key(key: Column, table: dict[str, str]) -> Column:
    known = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.try_element_at(known, F.coalesce(key, F.lit("")))


def display_name(key: Column) -> Column:
    """A medication key's name, the key itself if it has none."""
    return F.coalesce(_by_key(key, KEY_NAMES), key)


def key_words(key: Column) -> Column:
    """Words of which a text on the medication should have one; none for unknown keys."""
    none = F.array().cast("array<string>")
    known = F.create_map(*[x for k, v in KEYS.items() for x in (F.lit(k), F.array(*[F.lit(w) for w in v[3]]).cast("array<string>"))])
    return F.coalesce(F.try_element_at(known, F.coalesce(key, F.lit(""))), none)


def action_class(key: Column, text: Column) -> Column:
    return F.coalesce(_by_key(key, KEY_CLASSES), _by_words(text, CLASS_WORDS))


def action_drug(key: Column, text: Column) -> Column:
    return F.coalesce(_by_key(key, KEY_DRUGS), _by_words(text, DRUG_WORDS))


def escalates(delta: Column, text: Column) -> Column:
    """By the sign of the change; without one by words, of which those for less win."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.when(delta > 0, True).when(delta < 0, False).otherwise(~contains_any(low, list(DECREASE_WORDS)) & contains_any(low, list(INCREASE_WORDS)))


def severe_hypotension() -> Column:
    c = F.col
    held = lambda n: F.coalesce(c(n), F.lit(0.0))
    by_map = (c("map_now") < MAP_SEVERE) | (c("map_now").isNotNull() & (held("map_lt_55_held") >= CRITICAL_SEC)) | ((c("map_now") < MAP_LOW) & (held("map_lt_65_held") >= HEMODYNAMIC_SEC))
    return closed(by_map) | closed(c("map_drop_pct") >= MAP_DROP_PCT)


def _strategy_conditions() -> dict[str, Column]:
    """Ordered strategy tags of a state. Needs ``__severe`` beside the state."""
    c = F.col
    severe, hr = c("__severe"), c("hr_now")
    very_low = (c("map_now") < MAP_SEVERE) | (F.coalesce(c("map_lt_55_held"), F.lit(0.0)) >= CRITICAL_SEC)
    oxygen = c("spo2_now").isNotNull() & ((c("spo2_now") < SPO2_SEVERE) | (F.coalesce(c("spo2_lt_90_held"), F.lit(0.0)) >= CRITICAL_SEC))
    deeper = (c("bis_now") > BIS_LIGHT) & (c("map_now").isNull() | (c("map_now") >= MAP_LOW)) & (c("spo2_now").isNull() | (c("spo2_now") >= SPO2_LOW))
    return {
        "oxygenation_first": oxygen,
        "perfusion_first": severe,
        "treat_brady_or_reduce_depth": severe & (hr < HR_LOW),
        "consider_volume_or_stimulus": severe & (hr > HR_HIGH),
        "prefer_phenylephrine_when_hr_not_low": severe & (hr >= 60.0),
        "prefer_ephedrine_when_hypotension_with_low_hr": severe & (hr < 60.0),
        "consider_atropine_for_hemodynamic_bradycardia": severe & (hr < 45.0),
        "consider_norepinephrine_for_refractory_hypotension": severe & very_low,
        "rule_out_hypovolemia_before_high_dose_norepinephrine": severe & (hr > 110.0),
        "avoid_vasodilator_when_map_low": c("map_now") < MAP_LOW,
        "consider_depth_or_analgesia_increase": deeper,
        "reduce_depth": (c("bis_now") < BIS_DEEP) & severe,
    }


def _fact_conditions() -> dict[str, Column]:
    """Facts by name beside the strategies. Needs ``__severe`` beside the state."""
    c = F.col
    cls, drug, m, hr = c("action_class"), c("action_drug"), c("map_now"), c("hr_now")
    out = {
        "action_escalation": c("escalation"),
        "class_worsen_perfusion": cls.isin(*WORSENS_PERFUSION),
        "class_hypnotic_or_vasodilator_inodilator": cls.isin("hypnotic_iv", "hypnotic_volatile", "vasodilator", "inodilator"),
        "class_hypnotic": cls.isin("hypnotic_iv", "hypnotic_volatile"),
        "class_vasopressor_or_inopressor": cls.isin("vasopressor", "inopressor"),
        "class_opioid_or_hypnotic": cls.isin("opioid_analgesic", "hypnotic_iv", "hypnotic_volatile"),
        "class_monitoring_compatible": cls.isin("unknown", "neuromuscular", "arrhythmia"),
    }
    out |= {f"drug_{d}": drug == d for d in dict.fromkeys(KEY_DRUGS.values())}
    return out | {
        "drug_vasodilator_or_inodilator": drug.isin("nitroglycerin", "milrinone"),
        "map_low": m < MAP_LOW, "map_below_75": m < 75.0, "map_lt_55": m < 55.0, "map_not_lt_55": m.isNull() | (m >= 55.0),
        "map_ge_65": m >= 65.0, "map_ge_75": m >= 75.0, "map_drop_ge_relative": c("map_drop_pct") >= MAP_DROP_PCT, "bis_high": c("bis_now") > BIS_LIGHT,
        "hr_lt_50": hr < 50.0, "hr_lt_60": hr < 60.0, "hr_lt_45": hr < 45.0, "hr_gt_100": hr > 100.0, "hr_gt_110": hr > 110.0,
        "hr_le_100": hr <= 100.0, "hr_not_low": hr.isNull() | (hr >= 60.0), "delta_negative": c("delta") < 0, "severe_hypotension": c("__severe"),
    }


def judge(states: DataFrame, conflicts=CONFLICT_RULES, alignments=ALIGNMENT_RULES) -> DataFrame:
    """``states`` with strategies, verdict, reason and high_risk.

    What is true of a state becomes the bits of one number, worked out once; a rule is a constant mask over it. Unknown
    counts as false, and so does a fact that nobody knows.
    """
    tags, facts = list(_strategy_conditions()), list(_fact_conditions())
    place = {n: k for k, n in enumerate([f"strategy_{t}" for t in tags] + facts + ["strategy_context_monitoring"])}
    bit = lambda cond, n: F.when(closed(cond), F.lit(1 << place[n])).otherwise(F.lit(0)).cast("long")
    conditions = {f"strategy_{n}": c for n, c in _strategy_conditions().items()} | _fact_conditions()
    df = states.withColumn("__severe", severe_hypotension())
    held = None
    for name, cond in conditions.items():
        held = bit(cond, name) if held is None else held.bitwiseOR(bit(cond, name))
    df = df.withColumn("__known", held)
    any_tag = F.col("__known").bitwiseAND(F.lit((1 << len(tags)) - 1)) != 0
    df = df.withColumn("__known", F.col("__known").bitwiseOR(bit(~any_tag, "strategy_context_monitoring")))
    known = F.col("__known")

    def hit(rule) -> Column:
        if any(n not in place for n in rule[1]):
            return F.lit(False)
        need, bar = (sum(1 << place[n] for n in set(names) if n in place) for names in rule[1:3])
        return known.bitwiseAND(F.lit(need | bar).cast("long")) == F.lit(need)

    def first(rules) -> Column:
        out = F.lit(None).cast("string")
        for rule in reversed(rules):
            out = F.when(hit(rule), rule[0]).otherwise(out)
        return out

    df = df.withColumn("__against", first(conflicts)).withColumn("__partial", first([r for r in alignments if r[3] != "aligned"]))
    df = df.withColumn("__aligned", first([r for r in reversed(alignments) if r[3] == "aligned"]))
    risky = F.lit(False)
    for rule in conflicts:
        risky = risky | hit(rule) if rule[3] else risky
    is_ = lambda n: F.col(n).isNotNull()
    verdict = F.when(is_("__against"), "misaligned").when(is_("__partial"), "partially_aligned").when(is_("__aligned"), "aligned").otherwise("uncertain")
    has = lambda n: known.bitwiseAND(F.lit(1 << place[n]).cast("long")) != 0
    named = F.array_compact(F.array(*[F.when(has(f"strategy_{t}"), t) for t in [*tags, "context_monitoring"]]))
    df = df.withColumn("strategies", named).withColumn("verdict", verdict)
    df = df.withColumn("reason", F.coalesce("__against", "__partial", "__aligned", F.lit("insufficient_discriminative_signal"))).withColumn("high_risk", risky)
    return df.drop("__severe", "__known", "__against", "__partial", "__aligned")


def report(judged: DataFrame) -> DataFrame:
    """Counts by verdict and reason with their rank within the verdict (most first, then first seen by ``ord``)."""
    from pyspark.sql.window import Window

    counts = judged.groupBy("verdict", "reason").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("high_risk"), 1)).alias("n_high_risk"), F.min("ord").alias("first_ord"))
    w = Window.partitionBy("verdict").orderBy(F.desc("n"), "first_ord")
    return counts.withColumn("rank", F.row_number().over(w)).filter("rank <= 10").drop("first_ord")


def report_totals(judged: DataFrame) -> DataFrame:
    """One row: how many were judged, how many have each verdict, the share of misaligned ones, and high risks."""
    n = lambda *v: F.count(F.when(F.col("verdict").isin(*v), 1))
    bad = n("misaligned", "potentially_inaccurate")
    share = F.when(F.count(F.lit(1)) > 0, bad / F.count(F.lit(1))).otherwise(0.0)
    return judged.agg(
        F.count(F.lit(1)).alias("total_evaluated"), n("aligned").alias("aligned"), n("partially_aligned").alias("partially_aligned"), bad.alias("misaligned"), n("uncertain").alias("uncertain"),
        share.alias("misaligned_ratio"), F.count(F.when(F.col("high_risk"), 1)).alias("high_risk_conflicts"),
    )


def report_counts(judged: DataFrame, most: int = 10) -> DataFrame:
    """(name, value, n, rank): the most frequent reasons, medication keys and keys of misaligned actions, first seen first."""
    from pyspark.sql.window import Window

    text = lambda c, none: F.coalesce(F.when(F.trim(c) != "", F.trim(c)), F.lit(none))
    key, bad = text("key", "UNKNOWN"), F.col("verdict").isin("misaligned", "potentially_inaccurate")
    named = F.array(F.struct(F.lit("reason").alias("name"), text("reason", "unknown").alias("value")), F.struct(F.lit("key").alias("name"), key.alias("value")), F.struct(F.lit("misaligned_key").alias("name"), F.when(bad, key).alias("value")))
    rows = judged.select("ord", F.explode(named).alias("p")).select("ord", "p.*").filter(F.col("value").isNotNull())
    counts = rows.groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("first_ord"))
    w = Window.partitionBy("name").orderBy(F.desc("n"), "first_ord")
    return counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= most).drop("first_ord")


def intervention_type(key: Column, source: Column, rate: Column, delta: Column, bolus_rate: float = 50.0, bolus_delta: float = 1.0) -> Column:
    bolus = (key == "PPF20_VOL") & (rate >= bolus_rate) & (delta >= bolus_delta)
    return (
        F.when(closed((source == "arrdb") | (key == "ARR_EVENT")), "arrhythmia_event")
        .when(closed((source == "periodic") | (key == "UNLABELED_EVENT")), "unlabeled_context_snapshot")
        .when(~F.coalesce(key, F.lit("")).endswith("_VOL"), "rate_adjustment")
        .when(closed(bolus), "bolus_like_event")
        .otherwise("continuous_infusion")
    )


def check_label(text: Column, keywords: Column, before: Column, after: Column, delta: Column) -> Column:
    """Struct of verdict, confidence and reason: does a logged action name its drug and do its numbers agree?"""
    said = F.lower(F.trim(F.coalesce(text, F.lit(""))))
    off = F.abs((after - before) - delta) > F.greatest(F.lit(0.05), 0.02 * F.greatest(F.abs(delta), F.lit(1.0)))
    out = lambda v, c, r: F.struct(F.lit(v).alias("verdict"), F.lit(c).alias("confidence"), F.lit(r).alias("reason"))
    return (
        F.when(said == "", out("invalid", 0.95, "empty_actual_intervention"))
        .when((F.size(keywords) > 0) & ~contains_any(said, keywords), out("invalid", 0.9, "keyword_mismatch_with_medication_key"))
        .when(closed(off), out("invalid", 0.88, "numeric_delta_inconsistent_with_anchor"))
        .otherwise(out("valid", 0.8, "rule_consistent_with_anchor"))
    )


# Reasons that say nothing, and reasons of a check that had to do without a model's answer.
PLACEHOLDERS = ("", "...", "…", "unknown")
NO_REQUEST, NO_CHOICE, NO_JSON, NO_OPINION = "fallback_rule_after_validation_request_failed", "fallback_rule_after_validation_empty_choices", "fallback_rule_after_validation_non_json_output", "fallback_rule_after_model_uncertain"
SAYS_INVALID, SAYS_VALID = "validation_non_json_output_detected_invalid", "validation_non_json_output_detected_valid"


def checked_by_model(rule: Column, answer: Column, error: Column) -> Column:
    """A label's check by a model, as ``check_label``'s struct; the rule's where the model gives no opinion.

    ``answer`` is NULL if the model gave none, ``error`` is not if the call failed.
    """
    raw = F.trim(answer)
    low = F.lower(raw)
    out = lambda v, c, r: F.struct(v.alias("verdict"), c.cast("double").alias("confidence"), r.alias("reason"))
    text = lambda v, n: F.coalesce(F.trim(F.try_variant_get(v, f"$.{n}", "string")), F.lit(""))

    def by_rule(why: Column, least: Column) -> Column:
        return out(rule["verdict"], F.greatest(least, rule["confidence"]), F.concat(why, F.lit("; "), rule["reason"]))

    def of_object(v: Column) -> Column:
        said = F.lower(F.coalesce(F.trim(F.try_variant_get(v, "$.verdict", "string")), F.lit("uncertain")))
        verdict = F.when(said.isin("valid", "invalid", "uncertain"), said).otherwise("uncertain")
        sure = F.coalesce(F.try_variant_get(v, "$.confidence", "string").try_cast("double"), F.lit(0.0))
        empty = (verdict == "uncertain") | text(v, "reason").isin(*PLACEHOLDERS)
        return F.when(empty, by_rule(F.lit(NO_OPINION), sure)).otherwise(out(verdict, sure, text(v, "reason")))

    said = lambda *words: contains_any(low, list(words))
    loose = (
        F.when(said("invalid", "无效", "不准确"), out(F.lit("invalid"), F.lit(0.35), F.lit(SAYS_INVALID)))
        .when(said("valid", "有效", "准确"), out(F.lit("valid"), F.lit(0.35), F.lit(SAYS_VALID)))
        .otherwise(by_rule(F.lit(NO_JSON), F.lit(0.6)))
    )
    parsed = let(json_object(raw), lambda v: F.when(v.isNotNull(), of_object(v)).otherwise(loose))
    return (
        F.when(error.isNotNull(), by_rule(F.concat(F.lit(NO_REQUEST + ": "), error), F.lit(0.6)))
        .when(answer.isNull(), by_rule(F.lit(NO_CHOICE), F.lit(0.6)))
        .otherwise(parsed)
    )


def skipped(verdict: Column, drop_invalid: bool = True, drop_uncertain: bool = False) -> Column:
    """Whether a record drops out after its label was checked; no verdict counts as uncertain."""
    low = F.lower(F.trim(F.coalesce(verdict, F.lit("uncertain"))))
    return (F.lit(drop_invalid) & (low == "invalid")) | (F.lit(drop_uncertain) & (low == "uncertain"))


VERDICT_SCORES = {"aligned": 3, "partially_aligned": 2, "uncertain": 1, "misaligned": 0, "potentially_inaccurate": 0, "unavailable": -1}


def expected_unit(key: Column, source: Column, kind: Column, rate: Column) -> Column:
    """The unit that a text on the action should use; NULL for events that are no medication."""
    no_drug = closed(key.isin("ARR_EVENT", "UNLABELED_EVENT")) | closed(F.lower(F.trim(source)).isin("arrdb", "periodic"))
    steady = closed(rate >= 0) & closed(kind.isin("continuous_infusion", "rate_adjustment"))
    volume = closed(key.endswith("_VOL"))
    return (
        F.when(no_drug, F.lit(None).cast("string"))
        .when(closed(key.isin(*INHALED)), "vol%")
        .when(closed(key == "MAC_RATE"), "MAC")
        .when(closed(kind == "bolus_like_event"), "mL")
        .when(volume & steady, "mL/h")
        .when(volume, "mL")
        .when(closed(key.endswith("_RATE")), "mL/h")
    )


def expected_value(unit: Column, smoothed_rate: Column, rate: Column, smoothed_delta: Column, delta: Column, after: Column) -> Column:
    """The number that goes with the unit, from the event's own figures."""
    positive = lambda v: F.when(v > 0, v)
    return F.when(unit == "mL/h", F.coalesce(positive(smoothed_rate), positive(rate))).when(unit == "mL", F.abs(F.coalesce(smoothed_delta, delta))).when(unit.isin("vol%", "MAC"), after)


def describe(e: Column, kind: Column, bolus_rate: float = 50.0) -> Column:
    """A sentence on what was done, from a struct of key, label, before, after, delta, dt_sec, rate_per_h,
    smoothed_rate, smoothed_dt_sec and smoothed_delta. Numbers are rounded half to even.

    The texts are fixed values."""
    say = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    name, volume = display_name(e["key"]), closed(e["key"].endswith("_VOL"))
    change, from_to = fixed(e["delta"], 3, sign=True), say(fixed(e["before"], 3), " -> ", fixed(e["after"], 3))
    one_sided, timed = e["before"].isNull() | e["after"].isNull(), e["rate_per_h"].isNotNull() & e["dt_sec"].isNotNull()
    smooth = F.when(e["smoothed_rate"].isNotNull() & e["smoothed_dt_sec"].isNotNull(), say("；", fixed(e["smoothed_dt_sec"], 1), "s平滑窗口估算速率 ", fixed(e["smoothed_rate"], 2), " mL/h")).otherwise("")
    seconds, rate = fixed(e["dt_sec"], 1), fixed(e["rate_per_h"], 2)
    of_volume = (
        F.when(one_sided & timed, say(name, "：累计量变化 ", change, " mL（", seconds, "s内，瞬时估算速率 ", rate, " mL/h", smooth, "）"))
        .when(one_sided, say(name, "：累计量变化 ", change, " mL"))
        .when(timed, say(name, "：累计量 ", from_to, " mL（变化 ", change, " mL，", seconds, "s内瞬时估算速率 ", rate, " mL/h", smooth, "）"))
        .otherwise(say(name, "：累计量 ", from_to, " mL（变化 ", change, " mL", smooth, "）"))
    )
    propofol = F.when(e["smoothed_rate"] > bolus_rate, say("单次追加推注丙泊酚约 ", fixed(e["smoothed_delta"], 1), " mL")).otherwise(say("丙泊酚静脉维持泵注平滑速率约 ", fixed(e["smoothed_rate"], 2), " mL/h"))
    inhaled = F.when(one_sided, say(name, "：浓度变化 ", change, " vol%")).otherwise(say(name, "：", from_to, " vol%（变化 ", change, " vol%）"))
    word = F.when(e["key"] == "MAC_RATE", "变化 ").otherwise("速率变化 ")
    return (
        F.when(kind == "arrhythmia_event", say("心律事件标注：", F.trim(F.coalesce(e["label"], F.lit("arrhythmia_event")))))
        .when(kind == "unlabeled_context_snapshot", "无标记时间采样锚点（用于上下文推理训练）")
        .when(closed(e["key"] == "PPF20_VOL") & e["smoothed_rate"].isNotNull() & e["smoothed_delta"].isNotNull(), propofol)
        .when(volume, of_volume)
        .when(closed(e["key"].isin(*INHALED)), inhaled)
        .when(one_sided, say(name, "：", word, change))
        .otherwise(say(name, "：", from_to, "（变化 ", change, "）"))
    )


def judge_text(states: DataFrame, text: str) -> DataFrame:
    """``judge`` on what a generated text says: class, drug and direction come from its words alone."""
    none = F.lit(None).cast("string")
    said = F.coalesce(F.col(text), F.lit(""))
    df = states.withColumn("delta", F.lit(None).cast("double")).withColumn("action_class", action_class(none, said)).withColumn("action_drug", action_drug(none, said)).withColumn("escalation", escalates(F.col("delta"), said))
    out, empty = judge(df), F.trim(said) == ""
    out = out.withColumn("verdict", F.when(empty, "unavailable").otherwise(F.col("verdict"))).withColumn("reason", F.when(empty, "empty_final_output").otherwise(F.col("reason")))
    return out.withColumn("high_risk", F.col("high_risk") & ~empty)


def verdict_score(verdict: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in VERDICT_SCORES.items() for x in pair])
    return F.coalesce(F.try_element_at(table, F.lower(F.trim(verdict))), F.lit(0))
