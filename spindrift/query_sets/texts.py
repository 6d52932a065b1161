"""Queries on question-answer texts, JSON lines and control characters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.values import one_line, printable, safe_number
from ..operators import qa
from .base import table


def json_lines_parse(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    line = F.when(F.col("event_id") % 5 == 0, F.substring("props", 1, 4)).when(F.col("event_id") % 5 == 1, F.concat(F.lit("here: "), F.col("props"), F.lit(" ."))).otherwise(F.col("props"))
    k = F.try_variant_get(qa.json_object(line), "$.k", "int")
    return e.select("event_id", k.alias("k")).filter(F.col("k").isNotNull())


JSON_LINES = "SELECT event_id, json_extract(props, '$.k')::INTEGER AS k FROM events WHERE event_id % 5 <> 0"


def control_char_sanitize(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    dirty = F.concat(F.lit("\x01a\tb\x0b"), F.col("text"), F.lit("\x1f\n"))
    return d.select("doc_id", F.md5(printable(dirty)).alias("md5"), F.length(printable(dirty)).alias("n"))


CONTROL = "SELECT doc_id, md5('a' || chr(9) || 'b' || text || chr(10)) AS md5, (length(text) + 4)::INTEGER AS n FROM documents"


def one_line_preview(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", one_line(F.col("text"), 60).alias("line"))


ONE_LINE = r"""WITH s AS (SELECT doc_id, trim(regexp_replace(text, '[\s\x00]+', ' ', 'g')) AS t FROM documents)
SELECT doc_id, CASE WHEN length(t) > 60 THEN left(t, 57) || '...' ELSE t END AS line FROM s"""


def _qa_rows(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    k = F.col("conv_id") % 4
    dose = (F.col("conv_id") % 50 + 1).cast("string")
    head = F.when(k == 0, F.lit("<think>draft\nQ: draft</think>\n")).when(k == 1, F.lit("```text\n")).otherwise(F.lit(""))
    first = F.concat(F.lit("Q: What should be done now?\nA: 【临床推理】"), F.translate("text", "\n*-", "   "))
    third = F.concat(F.lit("\n【决策干预（Miller）】诊断依据：MAP 60；具体干预：给予 propofol "), dose, F.lit(" mL/h，5 min 复评；原文摘录：\"keep MAP\" [M10 #1, Chapter 3, p. 12]"))
    fourth = F.concat(F.lit("\n【决策干预（VitalDB）】：propofol "), (F.col("conv_id") % 30 + 1).cast("string"), F.lit(" mL/h（与记录一致）。"))
    tail = F.when(k == 1, F.lit("\n```")).when(k == 2, F.lit("\n\nnotes")).otherwise(F.lit(""))
    return c.select("conv_id", "turn", F.concat(head, first, third, F.when(F.col("turn") < 2, fourth).otherwise(F.lit("")), tail).alias("said"))


def qa_extract(spark, sf_dir):
    rows = _qa_rows(spark, sf_dir)
    block = qa.final_qa(F.col("said"))
    return rows.select("conv_id", "turn", F.size(F.split(block, "\n")).alias("n_lines"), F.md5(block).alias("md5"), qa.strict_v1(block).alias("strict_v1"), qa.strict_v2(F.col("said")).alias("strict_v2"))


QA = """WITH b AS (SELECT conv_id, turn, 'Q: What should be done now?' || chr(10) || 'A: 【临床推理】' || translate(text, chr(10) || '*-', '   ') || chr(10)
  || '【决策干预（Miller）】诊断依据：MAP 60；具体干预：给予 propofol ' || (conv_id % 50 + 1) || ' mL/h，5 min 复评；原文摘录："keep MAP" [M10 #1, Chapter 3, p. 12]'
  || CASE WHEN turn < 2 THEN chr(10) || '【决策干预（VitalDB）】：propofol ' || (conv_id % 30 + 1) || ' mL/h' ELSE '' END AS block FROM conversations)
SELECT conv_id, turn, len(string_split(block, chr(10)))::INTEGER AS n_lines, md5(block) AS md5, false AS strict_v1, turn < 2 AS strict_v2 FROM b"""


def section_extract(spark, sf_dir):
    rows = _qa_rows(spark, sf_dir)
    guide = qa.guideline_section(F.col("said"))
    return rows.select("conv_id", "turn", qa.evidence(guide)["evidence_quote"].alias("quote"), qa.evidence(guide)["chapter_paragraph"].alias("place"), qa.action_clause(guide).alias("action"), qa.concrete(guide, "mL/h").alias("concrete"))


SECTIONS = """SELECT conv_id, turn, 'keep MAP' AS quote, '[M10 #1, Chapter 3, p. 12]' AS place, '给予 propofol ' || (conv_id % 50 + 1) || ' mL/h，5 min 复评' AS action, true AS concrete FROM conversations"""


def unit_values(spark, sf_dir):
    rows = _qa_rows(spark, sf_dir)
    guide, logged = qa.action_clause(qa.guideline_section(F.col("said"))), qa.logged_section(F.col("said"))
    return rows.select(
        "conv_id",
        "turn",
        F.element_at(qa.values_with_unit(guide, "mL/h"), 1).alias("guided"),
        F.element_at(qa.values_with_unit(logged, "mL/h"), 1).alias("logged"),
        qa.consistent(guide, logged, "mL/h").alias("consistent"),
        qa.close_to(qa.values_with_unit(logged, "mL/h"), safe_number((F.col("conv_id") % 20 + 1).cast("string")), "mL/h").alias("close"),
    )


# without a logged section the whole answer is read: the turn's own values, then the guided one
UNITS = r"""WITH r AS (SELECT conv_id, turn, (conv_id % 50 + 1)::DOUBLE AS guided, (conv_id % 20 + 1)::DOUBLE AS target, CASE WHEN turn < 2 THEN [(conv_id % 30 + 1)::DOUBLE] ELSE
  list_append(list_transform(regexp_extract_all(translate(text, chr(10) || '*-', '   '), '(?i)(\d+(?:\.\d+)?)\s*ml\s*/\s*h', 1), lambda x: x::DOUBLE), (conv_id % 50 + 1)::DOUBLE) END AS v FROM conversations)
SELECT conv_id, turn, guided, v[1] AS logged, list_min([greatest(x, guided) / greatest(least(x, guided), 1e-9) for x in v]) <= 3.0 AS consistent,
  list_min([greatest(x, target) / greatest(least(x, target), 1e-9) for x in v]) <= 1.35 OR list_min([abs(x - target) for x in v]) <= greatest(3.0, target * 0.2) AS close FROM r"""


def numeric_closeness(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    text = F.concat(F.lit("set to "), F.col("l_quantity").cast("int"), F.lit(" mL/h, then "), F.col("l_linenumber"), F.lit(" ml / h and "), F.col("l_linenumber"), F.lit(" mL"))
    values = qa.values_with_unit(text, "mL/h")
    return li.select("l_orderkey", "l_linenumber", F.size(values).alias("n"), qa.close_to(values, F.lit(20.0), "mL/h").alias("close"))


CLOSENESS = """WITH v AS (SELECT l_orderkey, l_linenumber, [floor(l_quantity)::INT::DOUBLE, l_linenumber::DOUBLE] AS v FROM lineitem)
SELECT l_orderkey, l_linenumber, 2 AS n, list_min([greatest(x, 20) / greatest(least(x, 20), 1e-9) for x in v]) <= 1.35 OR list_min([abs(x - 20) for x in v]) <= 4.0 AS close FROM v"""

VARIANTS = 9


def _answers(spark, sf_dir):
    """Turns as the reasoning of answers: good ones, and ones that each fail some of the checks."""
    c = table(spark, sf_dir, "conversations")
    v, dose = (F.col("conv_id") + F.col("turn")) % VARIANTS, (F.col("conv_id") % 20 + 5).cast("string")
    is_ = lambda k, yes, no="": F.when(v == k, yes).otherwise(no)
    plain = F.trim(F.regexp_replace("text", r"[^A-Za-z0-9]+", " "))
    said = F.concat(
        F.lit("Q: MAP 60 mmHg, HR 80 bpm"), is_(5, "，提示低灌注"), is_(8, "，如何", "，最合理的干预措施是什么"), F.lit("？\nA: 【临床推理】：r "), plain, F.lit("\n【决策干预（Miller）】：诊断依据：MAP 60; 具体干预：给予 propofol "), dose, F.lit(" mL/h"),
        is_(2, "", "，5 min 复评"), is_(1, "", "; 原文摘录：\"keep MAP\" [M10 | 相关章节: Depth | p.12]"), F.lit("\n【决策干预（VitalDB）】："), is_(3, "phenylephrine", "Propofol"), F.lit(" 上调至 "), is_(4, "400", dose), is_(6, " x", " mL/h"), F.lit("，2 min 复评。"),
    )
    unit = F.when(F.col("conv_id") % 3 != 0, "mL/h")
    return c.select("conv_id", "turn", v.alias("v"), F.when(v != 7, said).otherwise(" ").alias("said"), unit.alias("unit"), (F.col("conv_id") % 20 + 5).cast("double").alias("target"), F.array(F.lit("丙泊酚"), F.lit("propofol")).alias("words"))


def answer_checks(spark, sf_dir):
    rows = _answers(spark, sf_dir).withColumn("c", qa.checked(F.col("said"), F.col("words"), F.col("unit"), F.col("target")))
    return rows.select("conv_id", "turn", *[f"c.{n}" for n in (*qa.CHECKS, "trainable")])


# a variant fails what its part is for; a dose of 400 is far from any target, and without its unit there is nothing to compare
CHECKED = f"""WITH a AS (SELECT conv_id, turn, (conv_id + turn) % {VARIANTS} AS v, conv_id % 3 <> 0 AS has_unit FROM conversations),
c AS (SELECT conv_id, turn, v NOT IN (1, 5, 7, 8) AS strict, v NOT IN (3, 7) AS aligned, v NOT IN (1, 2, 7) AS concrete_guideline, v <> 7 AND v <> 6 AS concrete_logged,
  v <> 7 AND NOT (has_unit AND v IN (4, 6)) AS consistent, v <> 7 AND NOT (has_unit AND v IN (4, 6)) AS close FROM a)
SELECT *, strict AND aligned AND concrete_guideline AND concrete_logged AND consistent AND close AS trainable FROM c"""


def answer_fields(spark, sf_dir):
    rows = _answers(spark, sf_dir)
    rows = rows.withColumn("f", qa.fields(F.col("said"), F.col("unit"), F.col("target")))
    rows = rows.withColumn("loose", qa.validity(F.col("said"), F.col("words"))).withColumn("strict", qa.validity(F.col("said"), F.col("words"), "strict"))
    return rows.select(
        "conv_id", "turn", F.col("f.evidence.evidence_quote").alias("quote"), F.col("f.evidence.chapter_paragraph").alias("place"), F.col("f.unit_consistency.expected_action_unit").alias("unit"), F.col("f.unit_consistency.consistent").alias("consistent"),
        F.col("f.alignment.close_to_logged_action").alias("close"), F.col("loose.valid").alias("valid"), F.col("strict.valid").alias("valid_strictly"), F.length("loose.guideline_output").alias("n_output"),
    )


FIELDS = f"""WITH a AS (SELECT conv_id, turn, (conv_id + turn) % {VARIANTS} AS v, conv_id % 3 <> 0 AS has_unit, (conv_id % 20 + 5)::VARCHAR AS dose FROM conversations)
SELECT conv_id, turn, CASE WHEN v IN (1, 7) THEN '' ELSE 'keep MAP' END AS quote, CASE WHEN v IN (1, 7) THEN '' ELSE '[M10 | 相关章节: Depth | p.12]' END AS place, CASE WHEN v <> 7 AND has_unit THEN 'mL/h' ELSE '' END AS unit,
  v <> 7 AND NOT (has_unit AND v IN (4, 6)) AS consistent, v <> 7 AND NOT (has_unit AND v IN (4, 6)) AS close, v <> 7 AS valid, v NOT IN (1, 3, 5, 7, 8) AS valid_strictly,
  CASE WHEN v = 7 THEN 0 ELSE length('诊断依据：MAP 60; 具体干预：给予 propofol ' || dose || ' mL/h' || CASE WHEN v = 2 THEN '' ELSE '，5 min 复评' END || CASE WHEN v = 1 THEN '' ELSE '; 原文摘录："keep MAP" [M10 | 相关章节: Depth | p.12]' END) END::INTEGER AS n_output FROM a"""


def relaxed_sections(spark, sf_dir):
    """Turns under labels of other names, without labels, and without anything to take for a decision."""
    c = table(spark, sf_dir, "conversations")
    v, plain = (F.col("conv_id") + F.col("turn")) % 5, F.trim(F.regexp_replace("text", r"[^b-df-hj-km-npr-tv-z ]+", ""))
    said = (
        F.when(v == 0, F.concat(F.lit("question：what now?\n[Clinical Reasoning]: r "), plain, F.lit("\n[Miller]: give more\n【VitalDB】 same")))
        .when(v == 1, F.concat(F.lit("Q: what\nA: 【临床推理】：r\n建议干预：升压 "), plain))
        .when(v == 2, F.concat(F.lit("r "), plain, F.lit("\n镇痛")))
        .when(v == 3, F.concat(F.lit("A: plain "), plain))
        .otherwise(F.lit(" "))
    )
    rows = c.select("conv_id", "turn", said.alias("said")).withColumn("p", qa.relaxed(F.col("said"))).withColumn("m", qa.relaxed(F.col("said"), repair=True))
    out = qa.rendered(*[F.col(f"m.{n}") for n in ("question", "reason", "guideline", "logged")])
    return rows.select("conv_id", "turn", "p.question", "p.guideline", "p.logged", "p.missing_label", "p.inferred", F.col("m.guideline").alias("repaired"), F.md5("p.reason").alias("reason_md5"), F.size(F.split(out, "\n")).alias("n_lines"))


RELAXED = f"""WITH a AS (SELECT conv_id, turn, (conv_id + turn) % 5 AS v, trim(regexp_replace(text, '[^b-df-hj-km-npr-tv-z ]+', '', 'g')) AS t FROM conversations),
b AS (SELECT *, trim(regexp_replace(t, ' +', ' ', 'g')) AS u FROM a),
c AS (SELECT *, '{qa.DEFAULT_REASON}' || chr(10) || trim('r ' || u) || chr(10) || '镇痛' AS r2 FROM b)
SELECT conv_id, turn, CASE v WHEN 0 THEN 'Q: question:what now?' WHEN 1 THEN 'Q: what' WHEN 4 THEN '' ELSE '{qa.DEFAULT_QUESTION}' END AS question,
  CASE v WHEN 0 THEN 'give more' WHEN 1 THEN trim('建议干预:升压 ' || u) ELSE '' END AS guideline, CASE v WHEN 0 THEN 'same' ELSE '' END AS logged, v <> 0 AS missing_label, v = 1 AS inferred,
  CASE v WHEN 0 THEN 'give more' WHEN 1 THEN trim('建议干预:升压 ' || u) WHEN 2 THEN r2 WHEN 3 THEN '请基于术中快照给出最合理的麻醉干预？' ELSE '' END AS repaired,
  md5(CASE v WHEN 0 THEN trim('r ' || u) WHEN 1 THEN 'A: 【临床推理】:r' || chr(10) || trim('建议干预:升压 ' || u) WHEN 2 THEN r2 ELSE '' END) AS reason_md5, (CASE v WHEN 1 THEN 5 WHEN 2 THEN 8 ELSE 4 END)::INTEGER AS n_lines FROM c"""

REGISTER = [
    ("answer_checks", answer_checks, CHECKED),
    ("answer_fields", answer_fields, FIELDS),
    ("relaxed_sections", relaxed_sections, RELAXED),
    ("json_lines_parse", json_lines_parse, JSON_LINES),
    ("control_char_sanitize", control_char_sanitize, CONTROL),
    ("one_line_preview", one_line_preview, ONE_LINE),
    ("qa_extract", qa_extract, QA),
    ("section_extract", section_extract, SECTIONS),
    ("unit_values", unit_values, UNITS),
    ("numeric_closeness", numeric_closeness, CLOSENESS),
]
