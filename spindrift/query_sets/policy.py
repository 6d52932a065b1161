"""Queries on facts, rules and labels; order lines stand in for states."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import assessment as a
from ..operators import policy
from .base import table

KEYS = ("PHE_RATE", "EPI_RATE", "PPF20_VOL", "REMI_RATE", "NOR_RATE", "EPH_VOL", "NTG_RATE", "MIL_RATE", "ATRO_VOL", "ROC_RATE", "OTHER", "PPF20_RATE", "PHE_VOL")


def _states(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    q, k, p = F.col("l_quantity"), F.col("l_orderkey"), F.col("l_partkey")
    known = lambda v, n: F.when((k + F.col("l_linenumber")) % n != 0, v)
    df = li.select(
        (k * 100 + F.col("l_linenumber")).alias("ord"),
        known(q + 40, 7).cast("double").alias("map_now"),
        known((p % 90 + 35).cast("double"), 11).alias("hr_now"),
        known((F.lit(85) + p % 15).cast("double"), 5).alias("spo2_now"),
        known((k % 60 + 20).cast("double"), 3).alias("bis_now"),
        known((F.col("l_discount") * 300), 2).alias("map_drop_pct"),
        (q * 2).alias("map_lt_65_held"),
        q.alias("map_lt_55_held"),
        (q / 2).alias("spo2_lt_90_held"),
        F.when(p % 4 == 0, None).otherwise((p % 3 - 1).cast("double")).alias("delta"),
        F.element_at(F.array(*[F.lit(x) for x in KEYS]), (p % len(KEYS) + 1).cast("int")).alias("key"),
        F.when(k % 2 == 0, "increase remifentanil").otherwise("decrease dose of propofol").alias("said"),
    )
    df = df.withColumn("action_class", policy.action_class(F.col("key"), F.col("said"))).withColumn("action_drug", policy.action_drug(F.col("key"), F.col("said")))
    return df.withColumn("escalation", policy.escalates(F.col("delta"), F.col("said")))


def rule_engine_verdict(spark, sf_dir):
    return policy.judge(_states(spark, sf_dir)).select("ord", F.array_join("strategies", ",").alias("strategies"), "verdict", "reason", "high_risk")


def alignment_report(spark, sf_dir):
    return policy.report(policy.judge(_states(spark, sf_dir)))


def alignment_totals(spark, sf_dir):
    return policy.report_totals(policy.judge(_states(spark, sf_dir))).withColumn("misaligned_ratio", F.round("misaligned_ratio", 9))


def alignment_counts(spark, sf_dir):
    return policy.report_counts(policy.judge(_states(spark, sf_dir)))


def _when(tag: str, cond: str) -> str:
    return f"CASE WHEN {cond} THEN '{tag}' END"


_KEY_LIST = ", ".join(f"'{k}'" for k in KEYS)
_CLASS = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in policy.KEY_CLASSES.items())
_DRUG = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in policy.KEY_DRUGS.items())
_HYPNOTIC = "cls IN ('hypnotic_iv', 'hypnotic_volatile')"
#: What each fact means in SQL.
_FACT_SQL = {
    "strategy_oxygenation_first": "list_contains(tags, 'oxygenation_first')", "strategy_perfusion_first": "list_contains(tags, 'perfusion_first')",
    "strategy_reduce_depth": "list_contains(tags, 'reduce_depth')", "strategy_context_monitoring": "list_contains(tags, 'context_monitoring')",
    "strategy_consider_depth_or_analgesia_increase": "list_contains(tags, 'consider_depth_or_analgesia_increase')",
    "action_escalation": "up", "class_worsen_perfusion": f"({_HYPNOTIC} OR cls IN ('anti_sympathetic', 'vasodilator', 'inodilator'))",
    "class_hypnotic_or_vasodilator_inodilator": f"({_HYPNOTIC} OR cls IN ('vasodilator', 'inodilator'))", "class_hypnotic": _HYPNOTIC,
    "class_vasopressor_or_inopressor": "cls IN ('vasopressor', 'inopressor')", "class_opioid_or_hypnotic": f"({_HYPNOTIC} OR cls = 'opioid_analgesic')",
    "class_monitoring_compatible": "cls IN ('unknown', 'neuromuscular', 'arrhythmia')", "drug_vasodilator_or_inodilator": "drug IN ('nitroglycerin', 'milrinone')",
    "map_low": "coalesce(m < 65, false)", "map_below_75": "coalesce(m < 75, false)", "map_lt_55": "coalesce(m < 55, false)", "map_not_lt_55": "coalesce(m >= 55, true)",
    "map_ge_65": "coalesce(m >= 65, false)", "map_ge_75": "coalesce(m >= 75, false)", "map_drop_ge_relative": "coalesce(fall >= 20, false)", "bis_high": "coalesce(b > 60, false)",
    "hr_lt_50": "coalesce(h < 50, false)", "hr_lt_60": "coalesce(h < 60, false)", "hr_lt_45": "coalesce(h < 45, false)", "hr_gt_100": "coalesce(h > 100, false)",
    "hr_gt_110": "coalesce(h > 110, false)", "hr_le_100": "coalesce(h <= 100, false)", "hr_not_low": "coalesce(h >= 60, true)", "delta_negative": "coalesce(delta < 0, false)",
    "severe_hypotension": "severe",
}


def _rule(rule) -> str:
    name, need, bar, _ = rule
    fact = lambda f: _FACT_SQL.get(f, f"drug = '{f.removeprefix('drug_')}'")
    return _when(name, " AND ".join([f"({fact(f)})" for f in need] + [f"NOT ({fact(f)})" for f in bar]))


def _rules(rules) -> str:
    return "list_filter([" + ", ".join(_rule(r) for r in rules) + "], lambda x: x IS NOT NULL)"


_JUDGED_SQL = f"""s AS (SELECT l_orderkey * 100 + l_linenumber AS ord, CASE WHEN (l_orderkey + l_linenumber) % 7 <> 0 THEN l_quantity + 40 END AS m,
  CASE WHEN (l_orderkey + l_linenumber) % 11 <> 0 THEN l_partkey % 90 + 35 END AS h, CASE WHEN (l_orderkey + l_linenumber) % 5 <> 0 THEN 85 + l_partkey % 15 END AS o,
  CASE WHEN (l_orderkey + l_linenumber) % 3 <> 0 THEN l_orderkey % 60 + 20 END AS b, CASE WHEN (l_orderkey + l_linenumber) % 2 <> 0 THEN l_discount * 300 END AS fall,
  l_quantity AS q, CASE WHEN l_partkey % 4 <> 0 THEN l_partkey % 3 - 1 END AS delta, ([{_KEY_LIST}])[l_partkey % {len(KEYS)} + 1] AS key, l_orderkey % 2 = 0 AS more FROM lineitem),
c AS (SELECT *, CASE key {_CLASS} ELSE CASE WHEN more THEN 'opioid_analgesic' ELSE 'hypnotic_iv' END END AS cls,
  CASE key {_DRUG} ELSE CASE WHEN more THEN 'remifentanil' ELSE 'propofol' END END AS drug, CASE WHEN delta > 0 THEN true WHEN delta < 0 THEN false ELSE more END AS up,
  coalesce(m < 55 OR (m IS NOT NULL AND q >= 30) OR (m < 65 AND q * 2 >= 60), false) OR coalesce(fall >= 20, false) AS severe FROM s),
t AS (SELECT *, list_filter([{_when('oxygenation_first', 'o < 90 OR (o IS NOT NULL AND q / 2 >= 30)')}, {_when('perfusion_first', 'severe')},
  {_when('treat_brady_or_reduce_depth', 'severe AND h < 50')}, {_when('consider_volume_or_stimulus', 'severe AND h > 100')}, {_when('prefer_phenylephrine_when_hr_not_low', 'severe AND h >= 60')},
  {_when('prefer_ephedrine_when_hypotension_with_low_hr', 'severe AND h < 60')}, {_when('consider_atropine_for_hemodynamic_bradycardia', 'severe AND h < 45')},
  {_when('consider_norepinephrine_for_refractory_hypotension', 'severe AND (m < 55 OR q >= 30)')}, {_when('rule_out_hypovolemia_before_high_dose_norepinephrine', 'severe AND h > 110')},
  {_when('avoid_vasodilator_when_map_low', 'm < 65')}, {_when('consider_depth_or_analgesia_increase', 'b > 60 AND (m IS NULL OR m >= 65) AND (o IS NULL OR o >= 94)')},
  {_when('reduce_depth', 'b < 40 AND severe')}], lambda x: x IS NOT NULL) AS found FROM c),
u AS (SELECT *, CASE WHEN len(found) = 0 THEN ['context_monitoring'] ELSE found END AS tags FROM t),
v AS (SELECT *, {_rules(policy.CONFLICT_RULES)} AS against, len({_rules([r for r in policy.CONFLICT_RULES if r[3]])}) > 0 AS high_risk,
  {_rules([r for r in policy.ALIGNMENT_RULES if r[3] == 'aligned'])} AS good, {_rules([r for r in policy.ALIGNMENT_RULES if r[3] != 'aligned'])} AS part FROM u),
jk AS (SELECT *, CASE WHEN len(against) > 0 THEN 'misaligned' END AS verdict FROM v),
j AS (SELECT ord, array_to_string(tags, ',') AS strategies, high_risk,
  CASE WHEN len(against) > 0 THEN 'misaligned' WHEN len(part) > 0 THEN 'partially_aligned' WHEN len(good) > 0 THEN 'aligned' ELSE 'uncertain' END AS verdict,
  CASE WHEN len(against) > 0 THEN against[1] WHEN len(part) > 0 THEN part[1] WHEN len(good) > 0 THEN good[-1] ELSE 'insufficient_discriminative_signal' END AS reason FROM v)"""
VERDICT = f"WITH {_JUDGED_SQL} SELECT ord, strategies, verdict, reason, high_risk FROM j"
REPORT = f"""WITH {_JUDGED_SQL}, g AS (SELECT verdict, reason, count(*)::BIGINT AS n, count(*) FILTER (high_risk)::BIGINT AS n_high_risk, min(ord) AS f FROM j GROUP BY 1, 2)
SELECT verdict, reason, n, n_high_risk, row_number() OVER (PARTITION BY verdict ORDER BY n DESC, f)::INTEGER AS rank FROM g QUALIFY rank <= 10"""


TOTALS = f"""WITH {_JUDGED_SQL} SELECT count(*)::BIGINT AS total_evaluated, count(*) FILTER (verdict = 'aligned')::BIGINT AS aligned, count(*) FILTER (verdict = 'partially_aligned')::BIGINT AS partially_aligned,
  count(*) FILTER (verdict = 'misaligned')::BIGINT AS misaligned, count(*) FILTER (verdict = 'uncertain')::BIGINT AS uncertain, round(count(*) FILTER (verdict = 'misaligned') / count(*), 9) AS misaligned_ratio, count(*) FILTER (high_risk)::BIGINT AS high_risk_conflicts FROM j"""
COUNTS = f"""WITH {_JUDGED_SQL},
n AS (SELECT 'reason' AS name, reason AS value, ord FROM j UNION ALL SELECT 'key', s.key, s.ord FROM s UNION ALL SELECT 'misaligned_key', key, ord FROM jk WHERE verdict = 'misaligned'),
g AS (SELECT name, value, count(*)::BIGINT AS n, min(ord) AS f FROM n GROUP BY 1, 2)
SELECT name, value, n, row_number() OVER (PARTITION BY name ORDER BY n DESC, f)::INTEGER AS rank FROM g QUALIFY rank <= 10"""


def label_validation(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    text = F.when(F.col("l_linenumber") == 1, F.lit(" ")).when(F.col("l_linenumber") == 2, F.lit("Propofol up")).otherwise(F.lit("phenylephrine RATE up"))
    verdict = policy.check_label(text, F.array(F.lit("phenylephrine")), F.col("l_quantity"), F.col("l_quantity") + F.col("l_discount"), F.when(F.col("l_linenumber") % 2 == 0, F.col("l_tax")).otherwise(F.col("l_discount")))
    return li.select("l_orderkey", "l_linenumber", verdict.alias("v")).select("l_orderkey", "l_linenumber", "v.verdict", "v.confidence", "v.reason")


LABELS = """WITH c AS (SELECT *, abs((l_quantity + l_discount) - l_quantity - CASE WHEN l_linenumber % 2 = 0 THEN l_tax ELSE l_discount END)
    > greatest(0.05, 0.02 * greatest(abs(CASE WHEN l_linenumber % 2 = 0 THEN l_tax ELSE l_discount END), 1.0)) AS off FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <= 2 OR off THEN 'invalid' ELSE 'valid' END AS verdict,
  CASE WHEN l_linenumber = 1 THEN 0.95 WHEN l_linenumber = 2 THEN 0.9 WHEN off THEN 0.88 ELSE 0.8 END::DOUBLE AS confidence,
  CASE WHEN l_linenumber = 1 THEN 'empty_actual_intervention' WHEN l_linenumber = 2 THEN 'keyword_mismatch_with_medication_key' WHEN off THEN 'numeric_delta_inconsistent_with_anchor' ELSE 'rule_consistent_with_anchor' END AS reason FROM c"""


EVENT_KEYS = (*KEYS, "DOPA_RATE", "SEVO_ET_RATE", "MAC_RATE", "RFTN20_RATE", "ARR_EVENT", "UNLABELED_EVENT", "URA_RATE")
LABELS_SAID = ("AF with RVR", " VT run ", "", "sinus bradycardia", "Asystole")


def _pick(values, n):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (n % len(values) + 1).cast("int"))


def _assessed(spark, sf_dir):
    """Order lines as assessed states: every vital and every condition known and unknown, held long and briefly."""
    li = table(spark, sf_dir, "lineitem")
    k, n, p, q = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_quantity").cast("int")
    known = lambda v, m: F.when((k + n) % m != 0, v).cast("double")
    held = lambda v: v.cast("double")
    return li.select(
        (k * 100 + n).alias("ord"), known(q + 40, 7).alias("map_now"), known(p % 90 + 35, 11).alias("hr_now"), known(F.lit(85) + p % 15, 5).alias("spo2_now"), known(k % 60 + 20, 3).alias("bis_now"),
        known(F.col("l_discount") * 300, 2).alias("map_drop_pct"), held(F.when(q % 3 == 0, q * 2)).alias("map_lt_55_held"), held(q * 2).alias("map_lt_65_held"),
        held(p % 5 * 20).alias("hr_gt_100_held"), held(p % 7 * 15).alias("hr_lt_50_held"), held(k % 9 * 5).alias("spo2_lt_90_held"), held(k % 8 * 12).alias("spo2_lt_94_held"),
        held(p % 13 * 12).alias("bis_gt_60_held"), held(p % 11 * 14).alias("bis_lt_40_held"), _pick(EVENT_KEYS, p).alias("key"),
        F.when(k % 13 == 0, "arrdb").when(k % 17 == 0, "periodic").otherwise("medication").alias("anchor_source"), F.when(n != 7, _pick(LABELS_SAID, k)).alias("label"),
        F.when(p % 4 != 0, (p % 3 - 1).cast("double")).alias("delta"),
    )


def _list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


_STATES_SQL = f"""z AS (SELECT *, l_orderkey AS k, l_linenumber AS n, l_partkey AS p, floor(l_quantity)::BIGINT AS q FROM lineitem),
st AS (SELECT k * 100 + n AS ord, CASE WHEN (k + n) % 7 <> 0 THEN q + 40 END AS m, CASE WHEN (k + n) % 11 <> 0 THEN p % 90 + 35 END AS h, CASE WHEN (k + n) % 5 <> 0 THEN 85 + p % 15 END AS o,
  CASE WHEN (k + n) % 3 <> 0 THEN k % 60 + 20 END AS b, CASE WHEN (k + n) % 2 <> 0 THEN l_discount * 300 END AS fall, CASE WHEN q % 3 = 0 THEN q * 2 ELSE 0 END AS m55, q * 2 AS m65,
  p % 5 * 20 AS h100, p % 7 * 15 AS h50, k % 9 * 5 AS o90, k % 8 * 12 AS o94, p % 13 * 12 AS b60, p % 11 * 14 AS b40, ({_list(EVENT_KEYS)})[p % {len(EVENT_KEYS)} + 1] AS key,
  CASE WHEN k % 13 = 0 THEN 'arrdb' WHEN k % 17 = 0 THEN 'periodic' ELSE 'medication' END AS src, CASE WHEN n <> 7 THEN ({_list(LABELS_SAID)})[k % {len(LABELS_SAID)} + 1] END AS label,
  CASE WHEN p % 4 <> 0 THEN p % 3 - 1 END AS delta FROM z)"""


def _text(text: str, number: str, form: str = "%.0f") -> str:
    before, after = text.split("{}")
    return f"'{before}' || printf('{form}', ({number})::DOUBLE) || '{after}'"


_DRUG_HINT = " ".join(f"WHEN key IN ({', '.join(repr(k) for k in keys)}) THEN '{t}'" for keys, t in a.HINTS)
_HINTED = ", ".join(repr(k) for keys, _ in a.HINTS for k in keys)
_ASSESSED_SQL = f"""{_STATES_SQL}, rh AS (SELECT *, key NOT IN ({_HINTED}) AND (src = 'arrdb' OR key = 'ARR_EVENT') AS rhythm, trim(coalesce(label, '')) AS said,
  m IS NOT NULL AND (m55 >= 30 OR m65 >= 60) AS absolute, coalesce(fall >= 20, false) AS relative FROM st),
fl AS (SELECT *, list_filter([
  CASE WHEN m IS NULL THEN NULL WHEN m55 >= 30 THEN {_text(a.MAP_SEVERE_TEXT, 'm55')} WHEN m65 >= 60 THEN {_text(a.MAP_LOW_TEXT, 'm65')} WHEN m < 65 THEN '{a.MAP_EARLY_TEXT}' END,
  CASE WHEN h IS NULL THEN NULL WHEN h100 >= 60 THEN {_text(a.HR_HIGH_TEXT, 'h100')} WHEN h50 >= 60 THEN {_text(a.HR_LOW_TEXT, 'h50')} END,
  CASE WHEN o IS NULL THEN NULL WHEN o90 >= 30 THEN {_text(a.SPO2_SEVERE_TEXT, 'o90')} WHEN o94 >= 60 THEN {_text(a.SPO2_LOW_TEXT, 'o94')} END,
  CASE WHEN b IS NULL THEN '{a.BIS_MISSING_TEXT}' WHEN b60 >= 120 THEN {_text(a.BIS_LIGHT_TEXT, 'b60')} WHEN b40 >= 120 THEN {_text(a.BIS_DEEP_TEXT, 'b40')} WHEN b > 60 OR b < 40 THEN '{a.BIS_BRIEF_TEXT}' END,
  CASE WHEN relative THEN {_text(a.DROP_TEXT, 'fall', '%.1f')} END, CASE WHEN absolute THEN '{a.ABSOLUTE_TEXT}' END, CASE WHEN relative THEN '{a.RELATIVE_TEXT}' END,
  CASE WHEN rhythm AND said <> '' THEN {a.RHYTHM_TEXT.replace('{}', '')!r} || said END,
  CASE WHEN rhythm AND regexp_matches(lower(said), 'vf|vt|ventricular|asystole|torsade|af with rvr') THEN '{a.SEVERE_RHYTHM_TEXT}' END], lambda x: x IS NOT NULL) AS flags,
  list_filter([CASE WHEN m < 65 AND h < 50 THEN '{a.LOW_LOW_TEXT}' END, CASE WHEN m < 65 AND h > 100 THEN '{a.LOW_HIGH_TEXT}' END,
  CASE WHEN m < 65 AND key IN ('PPF20_VOL', 'SEVO_ET_RATE', 'SEVO_FI_RATE', 'DES_ET_RATE', 'DES_FI_RATE', 'ISO_ET_RATE', 'ISO_FI_RATE', 'MAC_RATE') AND delta > 0 THEN '{a.LOW_DEEPER_TEXT}' END,
  CASE WHEN m < 65 AND key IN ('NOR_RATE', 'EPH_VOL', 'EPH_RATE', 'PHE_RATE', 'EPI_RATE', 'DOPA_RATE') THEN '{a.LOW_PRESSOR_TEXT}' END,
  CASE WHEN b > 60 AND m < 65 THEN '{a.LIGHT_LOW_TEXT}' WHEN b > 60 AND h > 100 THEN '{a.LIGHT_HIGH_TEXT}' END, CASE WHEN b < 40 AND m < 65 THEN '{a.DEEP_LOW_TEXT}' END], lambda x: x IS NOT NULL) AS notes FROM rh),
lv AS (SELECT *, CASE WHEN len(list_filter(flags, lambda x: contains(x, '重度') OR contains(x, '严重'))) > 0 THEN 'high' WHEN len(flags) > 0 THEN 'moderate' ELSE 'low' END AS level FROM fl)"""


def risk_flags_level(spark, sf_dir):
    flags = _assessed(spark, sf_dir).withColumn("flags", a.risk_flags())
    return flags.select("ord", F.array_join("flags", ",").alias("flags"), a.risk_level(F.col("flags")).alias("level"))


FLAGS = f"WITH {_ASSESSED_SQL} SELECT ord, array_to_string(flags, ',') AS flags, level FROM lv"


def clinical_assessment(spark, sf_dir):
    s = _assessed(spark, sf_dir).withColumn("x", a.assessment())
    return s.select("ord", F.array_join("x.contextual_interpretation", "|").alias("notes"), F.col("x.risk_level").alias("level"), F.col("x.map_policy.absolute_triggered").alias("absolute"), F.col("x.map_policy.relative_triggered").alias("relative"),
        F.col("x.intervention_consideration").alias("hint"), F.col("x.persistence_seconds.map_lt_55").alias("map_lt_55"), a.has_flags(F.col("x.risk_flags")).alias("has_flags"), a.unstable().alias("unstable"))


ASSESSMENT = f"""WITH {_ASSESSED_SQL} SELECT ord, array_to_string(notes, '|') AS notes, level, absolute, relative,
  CASE {_DRUG_HINT} WHEN rhythm THEN '{a.RHYTHM_HINT}' WHEN src = 'periodic' OR key = 'UNLABELED_EVENT' THEN '{a.PERIODIC_HINT}' ELSE '{a.NO_HINT}' END AS hint, m55::DOUBLE AS map_lt_55, len(flags) > 0 AS has_flags,
  coalesce(m < 65, false) OR coalesce(fall >= 15, false) OR coalesce(h < 50 OR h > 100, false) OR coalesce(o < 94, false) AS unstable FROM lv"""


def label_check_by_model(spark, sf_dir):
    """Answers of a model of every kind: opinions, placeholders, no JSON, nothing, and failed calls."""
    li = table(spark, sf_dir, "lineitem")
    rule = policy.check_label(F.when(F.col("l_linenumber") == 1, F.lit(" ")).otherwise(F.lit("phenylephrine up")), F.array(F.lit("phenylephrine")), F.lit(0.0), F.lit(1.0), F.lit(1.0))
    answer, failed = _pick(MODEL_ANSWERS, F.col("l_orderkey")), F.col("l_orderkey") % len(MODEL_ANSWERS)
    answer, error = F.when(failed != 0, answer), F.when(failed == 1, "no route")
    out = li.select("l_orderkey", "l_linenumber", policy.checked_by_model(rule, answer, error).alias("v")).select("l_orderkey", "l_linenumber", "v.*")
    return out.withColumn("skipped", policy.skipped(F.col("verdict"))).withColumn("skipped_unsure", policy.skipped(F.col("verdict"), False, True))


MODEL_ANSWERS = (
    "-", "-", '{"verdict": "Invalid ", "confidence": 0.7, "reason": "wrong unit"}', 'so: {"verdict": "valid", "confidence": "0.9", "reason": "fits"} ok', '{"verdict": "maybe", "confidence": 0.99, "reason": "x"}',
    '{"verdict": "valid", "confidence": 0.2, "reason": " ... "}', "this is INVALID", "it is valid", "no idea", '{"verdict": "valid", "confidence": "high", "reason": "fits"}', '{"confidence": 0.3, "reason": "fits"}',
)
MODEL_CHECK = f"""WITH r AS (SELECT l_orderkey, l_linenumber, l_orderkey % {len(MODEL_ANSWERS)} AS a, CASE WHEN l_linenumber = 1 THEN 'invalid' ELSE 'valid' END AS rv,
  CASE WHEN l_linenumber = 1 THEN 0.95 ELSE 0.8 END::DOUBLE AS rc, CASE WHEN l_linenumber = 1 THEN 'empty_actual_intervention' ELSE 'rule_consistent_with_anchor' END AS rr FROM lineitem),
v AS (SELECT *, CASE WHEN a IN (2, 6) THEN 'invalid' WHEN a IN (3, 7, 9) THEN 'valid' ELSE rv END AS verdict,
  CASE a WHEN 2 THEN 0.7 WHEN 3 THEN 0.9 WHEN 4 THEN greatest(0.99, rc) WHEN 6 THEN 0.35 WHEN 7 THEN 0.35 WHEN 9 THEN 0.0 ELSE rc END::DOUBLE AS confidence,
  CASE a WHEN 0 THEN 'fallback_rule_after_validation_empty_choices; ' || rr WHEN 1 THEN 'fallback_rule_after_validation_request_failed: no route; ' || rr WHEN 2 THEN 'wrong unit' WHEN 3 THEN 'fits'
    WHEN 6 THEN 'validation_non_json_output_detected_invalid' WHEN 7 THEN 'validation_non_json_output_detected_valid' WHEN 8 THEN 'fallback_rule_after_validation_non_json_output; ' || rr WHEN 9 THEN 'fits'
    ELSE 'fallback_rule_after_model_uncertain; ' || rr END AS reason FROM r)
SELECT l_orderkey, l_linenumber, verdict, confidence, reason, verdict = 'invalid' AS skipped, false AS skipped_unsure FROM v"""


def _events(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    k, n, p, q = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_quantity").cast("double")
    key = _pick(EVENT_KEYS, p)
    e = F.struct(
        key.alias("key"), F.lit(" AF ").alias("label"), F.when(k % 5 != 0, q).alias("before"), F.when(k % 7 != 0, q + n).alias("after"), n.cast("double").alias("delta"), F.when(k % 2 == 0, n * 2.0).alias("dt_sec"),
        F.when(k % 2 == 0, q * 10).alias("rate_per_h"), F.when(k % 3 == 0, q * 2).alias("smoothed_rate"), F.when(k % 3 == 0, 60.0).alias("smoothed_dt_sec"), F.when(k % 3 == 0, n / 4).alias("smoothed_delta"),
    )
    source = F.when(k % 13 == 0, "arrdb").when(k % 17 == 0, "periodic").otherwise("medication")
    df = li.select((k * 100 + n).alias("ord"), source.alias("source"), e.alias("e"))
    return df.withColumn("kind", policy.intervention_type(F.col("e.key"), F.col("source"), F.col("e.smoothed_rate"), F.col("e.smoothed_delta")))


def action_description(spark, sf_dir):
    return _events(spark, sf_dir).select("ord", policy.describe(F.col("e"), F.col("kind")).alias("said"))


def action_units(spark, sf_dir):
    e = lambda n: F.col(f"e.{n}")
    df = _events(spark, sf_dir).withColumn("unit", policy.expected_unit(e("key"), F.col("source"), F.col("kind"), e("smoothed_rate")))
    value = policy.expected_value(F.col("unit"), e("smoothed_rate"), e("rate_per_h"), e("smoothed_delta"), e("delta"), e("after"))
    return df.select("ord", "unit", value.alias("value"), F.array_join(policy.key_words(e("key")), "|").alias("words"), policy.display_name(e("key")).alias("name"))


_NAMES = " ".join(f"WHEN '{k}' THEN '{policy.KEY_NAMES[k]}'" for k in dict.fromkeys(EVENT_KEYS) if k in policy.KEY_NAMES)
_WORDS = " ".join(f"WHEN '{k}' THEN '{'|'.join(policy.KEYS[k][3])}'" for k in dict.fromkeys(EVENT_KEYS) if k in policy.KEYS)
_EVENTS_SQL = f"""ev AS (SELECT l_orderkey * 100 + l_linenumber AS ord, ({_list(EVENT_KEYS)})[l_partkey % {len(EVENT_KEYS)} + 1] AS key, CASE WHEN l_orderkey % 13 = 0 THEN 'arrdb' WHEN l_orderkey % 17 = 0 THEN 'periodic' ELSE 'medication' END AS src,
  CASE WHEN l_orderkey % 5 <> 0 THEN l_quantity END AS before, CASE WHEN l_orderkey % 7 <> 0 THEN l_quantity + l_linenumber END AS after, l_linenumber::DOUBLE AS delta, CASE WHEN l_orderkey % 2 = 0 THEN l_linenumber * 2.0 END AS dt,
  CASE WHEN l_orderkey % 2 = 0 THEN l_quantity * 10 END AS rate, CASE WHEN l_orderkey % 3 = 0 THEN l_quantity * 2 END AS srate, CASE WHEN l_orderkey % 3 = 0 THEN l_linenumber / 4 END AS sdelta FROM lineitem),
kd AS (SELECT *, CASE key {_NAMES} ELSE key END AS name, CASE WHEN src = 'arrdb' OR key = 'ARR_EVENT' THEN 'rhythm' WHEN src = 'periodic' OR key = 'UNLABELED_EVENT' THEN 'none' WHEN NOT suffix(key, '_VOL') THEN 'rate'
  WHEN key = 'PPF20_VOL' AND srate >= 50 AND sdelta >= 1 THEN 'bolus' ELSE 'steady' END AS kind FROM ev)"""
_F3 = lambda x: f"printf('%.3f', {x}::DOUBLE)"
_CHANGE = "printf('%+.3f', delta)"
_SMOOTH = "CASE WHEN srate IS NOT NULL THEN '；60.0s平滑窗口估算速率 ' || printf('%.2f', srate::DOUBLE) || ' mL/h' ELSE '' END"
DESCRIPTION = f"""WITH {_EVENTS_SQL}, d AS (SELECT *, before IS NULL OR after IS NULL AS half, {_F3('before')} || ' -> ' || {_F3('after')} AS span FROM kd)
SELECT ord, CASE WHEN kind = 'rhythm' THEN '心律事件标注：AF' WHEN kind = 'none' THEN '无标记时间采样锚点（用于上下文推理训练）'
  WHEN key = 'PPF20_VOL' AND srate > 50 THEN '单次追加推注丙泊酚约 ' || printf('%.1f', round_even(sdelta, 1)) || ' mL' WHEN key = 'PPF20_VOL' AND srate IS NOT NULL THEN '丙泊酚静脉维持泵注平滑速率约 ' || printf('%.2f', srate::DOUBLE) || ' mL/h'
  WHEN suffix(key, '_VOL') AND half AND rate IS NOT NULL THEN name || '：累计量变化 ' || {_CHANGE} || ' mL（' || printf('%.1f', dt::DOUBLE) || 's内，瞬时估算速率 ' || printf('%.2f', rate::DOUBLE) || ' mL/h' || {_SMOOTH} || '）'
  WHEN suffix(key, '_VOL') AND half THEN name || '：累计量变化 ' || {_CHANGE} || ' mL'
  WHEN suffix(key, '_VOL') AND rate IS NOT NULL THEN name || '：累计量 ' || span || ' mL（变化 ' || {_CHANGE} || ' mL，' || printf('%.1f', dt::DOUBLE) || 's内瞬时估算速率 ' || printf('%.2f', rate::DOUBLE) || ' mL/h' || {_SMOOTH} || '）'
  WHEN suffix(key, '_VOL') THEN name || '：累计量 ' || span || ' mL（变化 ' || {_CHANGE} || ' mL' || {_SMOOTH} || '）'
  WHEN key = 'SEVO_ET_RATE' AND half THEN name || '：浓度变化 ' || {_CHANGE} || ' vol%' WHEN key = 'SEVO_ET_RATE' THEN name || '：' || span || ' vol%（变化 ' || {_CHANGE} || ' vol%）'
  WHEN half THEN name || CASE WHEN key = 'MAC_RATE' THEN '：变化 ' ELSE '：速率变化 ' END || {_CHANGE} ELSE name || '：' || span || '（变化 ' || {_CHANGE} || '）' END AS said FROM d"""
UNITS_EXPECTED = f"""WITH {_EVENTS_SQL}, u AS (SELECT *, CASE WHEN kind IN ('rhythm', 'none') THEN NULL WHEN key = 'SEVO_ET_RATE' THEN 'vol%' WHEN key = 'MAC_RATE' THEN 'MAC' WHEN kind = 'bolus' THEN 'mL'
  WHEN suffix(key, '_VOL') AND srate >= 0 AND kind = 'steady' THEN 'mL/h' WHEN suffix(key, '_VOL') THEN 'mL' WHEN suffix(key, '_RATE') THEN 'mL/h' END AS unit FROM kd)
SELECT ord, unit, (CASE unit WHEN 'mL/h' THEN coalesce(CASE WHEN srate > 0 THEN srate END, CASE WHEN rate > 0 THEN rate END) WHEN 'mL' THEN abs(coalesce(sdelta, delta)) WHEN 'vol%' THEN after WHEN 'MAC' THEN after END)::DOUBLE AS value,
  CASE key {_WORDS} ELSE '' END AS words, name FROM u"""


def intervention_types(spark, sf_dir):
    s = _states(spark, sf_dir)
    source = F.when(F.col("ord") % 13 == 0, "arrdb").when(F.col("ord") % 17 == 0, "periodic")
    return s.select("ord", policy.intervention_type(F.col("key"), source, F.col("map_lt_65_held"), F.col("delta")).alias("kind"))


TYPES = f"""WITH {_JUDGED_SQL} SELECT ord, CASE WHEN ord % 13 = 0 THEN 'arrhythmia_event' WHEN ord % 17 = 0 THEN 'unlabeled_context_snapshot' WHEN key NOT LIKE '%\\_VOL' ESCAPE '\\' THEN 'rate_adjustment'
  WHEN key = 'PPF20_VOL' AND q * 2 >= 50 AND delta >= 1 THEN 'bolus_like_event' ELSE 'continuous_infusion' END AS kind FROM s"""

REGISTER = [
    ("rule_engine_verdict", rule_engine_verdict, VERDICT),
    ("alignment_report", alignment_report, REPORT),
    ("alignment_totals", alignment_totals, TOTALS),
    ("alignment_counts", alignment_counts, COUNTS),
    ("label_validation", label_validation, LABELS),
    ("risk_flags_level", risk_flags_level, FLAGS),
    ("clinical_assessment", clinical_assessment, ASSESSMENT),
    ("label_check_by_model", label_check_by_model, MODEL_CHECK),
    ("action_description", action_description, DESCRIPTION),
    ("action_units", action_units, UNITS_EXPECTED),
    ("intervention_types", intervention_types, TYPES),
]
