"""Queries on what is loaded from files of several kinds (annotations, rules, cases of several sources), and on reports and checks of texts."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from ..operators import cases, evaluate, policy, qa
from ..sources import readers, writers
from ..sources.storage import shared_dir
from .base import table
from .policy import _JUDGED_SQL, _rules, _states


def annotations_read(spark, sf_dir):
    """Annotations as a file of CSV per nation, some times unreadable, and back with the case from the file's path."""
    c = table(spark, sf_dir, "customer").filter(F.col("c_nationkey").isNotNull())
    at = F.when(F.col("c_custkey") % 9 == 0, "soon").otherwise(F.col("c_acctbal").cast("string"))
    path = shared_dir(spark, "annotations") + "/all"
    c.select("c_nationkey", at.alias("at"), F.col("c_mktsegment").alias("said")).write.partitionBy("c_nationkey").option("header", True).csv(path)
    return readers.read_annotations(spark, path, r"c_nationkey=(\d+)/", "at", "said").select("caseid", "time_sec", "label")


ANNOTATIONS = "SELECT c_nationkey::BIGINT AS caseid, CASE WHEN c_custkey % 9 <> 0 THEN c_acctbal END AS time_sec, c_mktsegment AS label FROM customer WHERE c_nationkey IS NOT NULL"

#: Rules of another site, as its file says them.
SITE_RULES = {
    "conflict_rules": [
        {"id": "more_while_low", "all": ["action_escalation", "map_low"], "not": ["class_vasopressor_or_inopressor"], "high_risk": True},
        {"id": "less_support_while_low", "all": ["class_vasopressor_or_inopressor", "delta_negative", "map_below_75"]},
    ],
    "alignment_rules": [
        {"id": "fast_and_light", "all": ["bis_high", "hr_gt_100"], "outcome": "partially_aligned"},
        {"id": "support_while_low", "all": ["class_vasopressor_or_inopressor", "map_low"], "not": ["delta_negative"]},
        {"id": "watching", "all": ["class_monitoring_compatible"]},
    ],
}


def site_rules_verdict(spark, sf_dir):
    """Verdicts by rules that a file brings; a text that holds none leaves the library's own."""
    conflicts, alignments = readers.judge_rules(readers.load_rules(json.dumps(SITE_RULES), {}))
    judged = policy.judge(_states(spark, sf_dir), conflicts, alignments)
    return judged.select("ord", "verdict", "reason", "high_risk")


def _with_rules(sql: str, conflicts, alignments) -> str:
    """The SQL of verdicts with other rules."""
    kinds = (lambda c, a: c, lambda c, a: [r for r in c if r[3]], lambda c, a: [r for r in a if r[3] == "aligned"], lambda c, a: [r for r in a if r[3] != "aligned"])
    for kind in kinds:
        sql = sql.replace(_rules(kind(policy.CONFLICT_RULES, policy.ALIGNMENT_RULES)), _rules(kind(conflicts, alignments)))
    return sql


SITE_VERDICT = f"WITH {_with_rules(_JUDGED_SQL, *readers.judge_rules(SITE_RULES))} SELECT ord, verdict, reason, high_risk FROM j"


def text_verdict(spark, sf_dir):
    """Verdicts on what a text says alone; every fifth line of an order says nothing."""
    said = F.when(F.col("ord") % 5 == 0, " ").otherwise(F.col("said"))
    judged = policy.judge_text(_states(spark, sf_dir).withColumn("said", said), "said")
    return judged.select("ord", "verdict", "reason", "high_risk", policy.verdict_score(F.col("verdict")).alias("score"))


def _only_text(sql: str) -> str:
    """The SQL of verdicts without key and change."""
    begin, end = sql.index("CASE WHEN l_partkey % 4 <> 0"), sql.index(" AS key,")
    return sql[:begin] + "NULL::INTEGER AS delta, ''" + sql[end:]


_SCORES = " ".join(f"WHEN '{k}' THEN {v}" for k, v in policy.VERDICT_SCORES.items())
TEXT_VERDICT = f"""WITH {_only_text(_JUDGED_SQL)},
x AS (SELECT ord, CASE WHEN ord % 5 = 0 THEN 'unavailable' ELSE verdict END AS verdict, CASE WHEN ord % 5 = 0 THEN 'empty_final_output' ELSE reason END AS reason, high_risk AND ord % 5 <> 0 AS high_risk FROM j)
SELECT *, coalesce(CASE verdict {_SCORES} END, 0)::INTEGER AS score FROM x"""


def sources_as_cases(spark, sf_dir):
    """Cases of two sources in one CSV, absent columns empty, and back."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("caseid"), F.col("c_name").alias("opname"), F.col("c_mktsegment").alias("department"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("caseid"), F.col("s_name").alias("opname"))
    path = shared_dir(spark, "sources") + "/cases"
    writers.write_csv(cases.tagged_union({"customer": c, "supplier": s}), path)
    return readers.read_cases(spark, path).select("caseid", "opname", "department", "source_dataset")


SOURCES = """SELECT c_custkey AS caseid, c_name AS opname, c_mktsegment AS department, 'customer' AS source_dataset FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL, 'supplier' FROM supplier"""


def segment_report(spark, sf_dir):
    """A report of counters and a table; only the segments' counts come to the driver."""
    c = table(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("c_acctbal") < 0).cast("long")).alias("n_owing"))
    rows = [r.asDict() for r in c.orderBy("c_mktsegment").limit(50).collect()]
    total = table(spark, sf_dir, "customer").count()
    return spark.createDataFrame([(writers.markdown({"customers": total}, rows, "Segments"),)], "report string")


SEGMENTS = """WITH g AS (SELECT c_mktsegment, count(*) AS n, count(*) FILTER (c_acctbal < 0) AS n_owing FROM customer GROUP BY 1 ORDER BY 1 LIMIT 50)
SELECT '# Segments' || chr(10) || chr(10) || '- customers: ' || (SELECT count(*) FROM customer) || chr(10) || chr(10) || '| c_mktsegment | n | n_owing |' || chr(10) || '|---|---|---|' || chr(10)
  || string_agg('| ' || c_mktsegment || ' | ' || n || ' | ' || n_owing || ' |', chr(10) ORDER BY c_mktsegment) || chr(10) AS report FROM g"""


def first_orders(spark, sf_dir):
    """The first 100 orders in the order of their keys: the limit is the operator."""
    return cases.first_rows(table(spark, sf_dir, "orders"), 100, ["o_orderkey"]).select("o_orderkey", "o_custkey", "o_totalprice")


FIRST_ORDERS = "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100"


def evidence_texts(spark, sf_dir):
    """The texts of hits as one evidence: the turn, a part of it or a blank, its role, and a hit without text."""
    c = table(spark, sf_dir, "conversations")
    part = F.when(F.col("turn") % 3 == 0, "  ").otherwise(F.concat(F.lit(" "), F.split_part("text", F.lit("."), F.lit(1))))
    hits = F.array(*[F.struct(x.alias("text")) for x in (F.col("text"), part, F.col("role"), F.lit(None).cast("string"))])
    said = evaluate.evidence_text(hits)
    return c.select("conv_id", "turn", F.length(said).alias("n_chars"), F.md5(said).alias("md5"))


EVIDENCE = """WITH h AS (SELECT conv_id, turn, array_to_string(list_filter(list_transform([text, CASE WHEN turn % 3 = 0 THEN '  ' ELSE ' ' || split_part(text, '.', 1) END, role], lambda x: trim(coalesce(x, ''))), lambda x: x <> ''), chr(10)) AS said FROM conversations)
SELECT conv_id, turn, length(said)::INTEGER AS n_chars, md5(said) AS md5 FROM h"""

CONFLICT = qa.CONFLICT_WORDS[0]


def payload_gate(spark, sf_dir):
    """Which JSON answers are poor: built from turns, with a decision of the turn's first word, other keys, or none."""
    c = table(spark, sf_dir, "conversations")
    k = F.col("conv_id") % 5
    first = F.regexp_extract("text", "^([A-Za-z]*)", 1)
    reason = F.when(k == 1, F.concat(F.col("text"), F.lit(f" {CONFLICT}"))).otherwise(F.col("text"))
    answer = F.to_json(F.struct(F.col("role").alias("question"), reason.alias("reasoning"), first.alias("miller_decision")))
    payload = F.when(k == 2, F.to_json(F.struct(F.col("text").alias("other")))).when(k != 3, answer)
    return c.select("conv_id", "turn", qa.poor_payload(F.try_parse_json(payload)).alias("poor"))


PAYLOADS = f"""SELECT conv_id, turn, conv_id % 5 IN (1, 2, 3) OR length(regexp_extract(text, '^([A-Za-z]*)', 1)) < 2 OR {" OR ".join(f"contains(lower(concat_ws(' ', role, text)), '{w}')" for w in qa.CONFLICT_WORDS)} AS poor FROM conversations"""


def strict_answers(spark, sf_dir):
    """The first strict format on answers around whole turns: an end without a mark, an open bracket, a list."""
    c = table(spark, sf_dir, "conversations")
    body = F.regexp_replace("text", r"[.!?]+$", "")
    said = F.concat(
        F.lit("Q: what now\nA: [Clinical Reasoning] "), F.when(F.col("conv_id") % 7 == 0, "(").otherwise(""), F.when(F.col("conv_id") % 11 == 0, "\n- ").otherwise(""), F.lit(f"{qa.LABELS.guideline} a\n{qa.LABELS.logged} "),
        body, F.when(F.length("text") % 3 == 0, "").otherwise("."),
    )
    return c.select("conv_id", "turn", qa.strict_v1(said).alias("strict_v1"))


STRICT = r"""WITH s AS (SELECT conv_id, turn, regexp_replace(text, '[.!?]+$', '') || CASE WHEN length(text) % 3 = 0 THEN '' ELSE '.' END AS said FROM conversations)
SELECT conv_id, turn, regexp_matches(said, '[。！？.!?]$') AND conv_id % 7 <> 0 AND conv_id % 11 <> 0 AND NOT regexp_matches(said, '(?m)\n\s*(?:\*|-|\d+\.)\s+')
  AND len(said) - len(replace(said, '(', '')) = len(said) - len(replace(said, ')', '')) AND NOT regexp_matches(lower(said), 'logged_action|actual_intervention|golden') AS strict_v1 FROM s"""

REGISTER = [
    ("annotations_read", annotations_read, ANNOTATIONS),
    ("site_rules_verdict", site_rules_verdict, SITE_VERDICT),
    ("text_verdict", text_verdict, TEXT_VERDICT),
    ("sources_as_cases", sources_as_cases, SOURCES),
    ("segment_report", segment_report, SEGMENTS),
    ("first_orders", first_orders, FIRST_ORDERS),
    ("evidence_texts", evidence_texts, EVIDENCE),
    ("payload_gate", payload_gate, PAYLOADS),
    ("strict_answers", strict_answers, STRICT),
]
