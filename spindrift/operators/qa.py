"""Question-answer texts: extraction, strict formats, sections, units and numbers, labels, JSON in free text.

The section labels are fixed values of the format; ``Labels`` lets another format use the same operators.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.values import closed, contains_any, let, strip


@dataclass(frozen=True)
class Labels:
    """How sections begin and what must not leak."""

    reason: tuple[str, ...] = ("【临床推理】", "[Clinical Reasoning]")
    guideline: str = "【决策干预（Miller）】"
    logged: str = "【决策干预（VitalDB）】"
    plain: str = "【决策干预】"
    section: str = "【决策干预"
    leaks: str = r"logged_action|actual_intervention|golden"
    banned: tuple[str, ...] = ("let's think", "<think>", "</think>", "**content requirements**", "**strategy**")


LABELS = Labels()
# Keys within the guideline line, words for actions and for what cannot be converted.
DIAGNOSIS, ACTION, QUOTE = "诊断依据", "具体干预", "原文摘录"
ACTION_WORDS = ("上调", "下调", "滴定", "追加", "减量", "增量", "维持", "暂停", "给予", "复评", "titrate", "bolus")
UNCONVERTIBLE = ("无法换算", "不能换算", "缺少体重", "缺乏体重", "无体重", "缺少浓度", "缺乏浓度", "无药物浓度", "无法精确换算")
DOSE = r"(?i)\d+(?:\.\d+)?\s*(?:mL/h|mL|mg/kg/h|mg/kg/min|[μµu]g/kg/min|mcg/kg/min|mg|[μµu]g|mcg|vol%|MAC)"
DRUGS = r"(?i)丙泊酚|瑞芬太尼|去氧肾上腺素|去甲肾上腺素|麻黄碱|肾上腺素|硝酸甘油|米力农|阿托品|七氟烷|地氟烷|异氟烷|propofol|remifentanil|phenylephrine|norepinephrine|ephedrine|epinephrine|nitroglycerin|milrinone|atropine|sevoflurane|desflurane|isoflurane"
# A number with its unit.
UNIT_VALUES = {
    "mL/h": r"(?i)(\d+(?:\.\d+)?)\s*ml\s*/\s*h",
    "mL": r"(?i)(\d+(?:\.\d+)?)\s*ml(?!\s*/\s*h)",
    "vol%": r"(?i)(\d+(?:\.\d+)?)\s*(?:vol\s*%|%)",
    "MAC": r"(?i)(\d+(?:\.\d+)?)\s*MAC\b",
}
UNIT_NAMES = {"mL/h": r"(?i)\bml\s*/\s*h\b", "mL": r"(?i)\bml\b(?!\s*/\s*h)", "vol%": r"(?i)\bvol\s*%|vol%", "MAC": r"(?i)mac"}
# Per unit the largest ratio, the least difference that always passes, and the share of the target.
CLOSE = {"mL/h": (1.35, 3.0, 0.2), "mL": (1.5, 0.5, 0.35), "vol%": (1.4, 0.8, 0.0), "MAC": (1.4, 0.25, 0.0)}


def unfenced(text: Column) -> Column:
    """Without a code fence around it, line ends as line feeds, stripped."""
    out = F.regexp_replace(strip(F.coalesce(text, F.lit(""))), r"(?i)^```(?:json|markdown|text)?\s*", "")
    return strip(F.replace(F.regexp_replace(out, r"\s*```$", ""), F.lit("\r\n"), F.lit("\n")))


def without_meta(text: Column, label: str = "VitalDB") -> Column:
    """Remarks on the logged action removed from the text behind the last label's colon."""
    return let(text, lambda t: _without_meta(t, label))


# Remarks on the logged action that must not stay in an answer, and what stands for an empty one.
REMARKS = (
    r"(?i)[（(][^）)]*(?:logged_action|actual_intervention|golden|记录|对照)[^）)]*[）)]",
    r"(?i)按\s*(?:logged_action|actual_intervention)\s*同类",
    r"(?i)严格\s*对照[^，,。；;]*",
    r"(?i)(?:与|和)?(?:原始)?记录(?:动作|方向|剂量|数值|单位)?一致",
    r"(?i)\b(?:logged_action|actual_intervention|golden)\b",
    r"(?:并|且)\s*$",
)
NO_REMARK = "维持当前给药策略。"


def _without_meta(text: Column, label: str) -> Column:
    """The body begins behind the first full-width colon after the last label, or the first plain one if there is none."""
    wide, plain = rf"(?s)^(.*{label}[^：]*：)(.*)$", rf"(?s)^(.*{label}[^:]*:)(.*)$"
    tail = F.regexp_extract(text, rf"(?s)^.*{label}(.*)$", 1)
    pick = lambda k: F.when(F.contains(tail, F.lit("：")), F.regexp_extract(text, wide, k)).otherwise(F.regexp_extract(text, plain, k))
    body = strip(pick(2))
    for pattern in REMARKS:
        body = F.regexp_replace(body, pattern, "")
    body = F.regexp_replace(F.regexp_replace(body, r"\s{2,}", " "), r"^[ ，,；;。]+|[ ，,；;。]+$", "")
    kept = let(body, lambda b: F.when(b == "", NO_REMARK).otherwise(b))
    return F.when(~tail.rlike("[:：]"), text).otherwise(F.concat(pick(1), kept))


def final_qa(text: Column, labels: Labels = LABELS) -> Column:
    """The last question and answer: thoughts dropped, from the last line that begins with Q:, up to a blank line,
    a bullet, a tag or a fence behind the decision."""
    out = strip(F.regexp_replace(unfenced(text), r"(?is)<think>.*?</think>", ""))
    out = strip(F.try_element_at(F.split(out, "</think>"), F.lit(-1)))
    pattern = rf"(?is)(Q\s*[:：].*?A\s*[:：].*?{labels.section}.*?)(?=\n\n|\n\*|\n<(?=[a-zA-Z!/])|```|\z)"
    last = let(out, lambda o: F.when(o.rlike(r"(?im)^Q\s*[:：]"), strip(F.try_element_at(F.split(o, r"(?im)^(?=Q\s*[:：])"), F.lit(-1)))).otherwise(o))
    block = let(last, lambda o: let(F.regexp_extract(o, pattern, 1), lambda b: F.when(b != "", b).otherwise(o)))
    return without_meta(strip(block))


def _lines(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, r"\R"), strip), lambda x: x != "")


def question(text: Column) -> Column:
    return F.coalesce(F.try_element_at(F.filter(_lines(text), lambda x: x.rlike(r"(?i)^Q\s*[:：]")), F.lit(1)), F.lit(""))


def strict_v1(text: Column, labels: Labels = LABELS) -> Column:
    """Labels, no leaks or bullets, balanced brackets, an end that closes a sentence."""
    return let(strip(F.coalesce(text, F.lit(""))), lambda out: _strict_v1(out, labels))


def _strict_v1(out: Column, labels: Labels) -> Column:
    low = F.lower(out)
    count = lambda c: F.length(out) - F.length(F.replace(out, F.lit(c), F.lit("")))
    has = lambda s: F.contains(out, F.lit(s))
    ok = ~low.rlike(labels.leaks) & ~contains_any(low, list(labels.banned)) & ~out.rlike(r"(?im)^\s*(?:\*|-|\d+\.)\s+")
    ok = ok & out.rlike(r"(?im)^Q\s*[:：]") & out.rlike(r"(?im)^A\s*[:：]") & (has(labels.reason[0]) | has(labels.reason[1])) & has(labels.guideline) & has(labels.logged)
    ok = ok & (count("【") == count("】")) & (count("（") == count("）")) & (count("(") == count(")")) & ~has("�")
    return closed(ok & out.rlike(r"[。！？.!?]$"))


def strict_v2(text: Column, labels: Labels = LABELS, locator: str | None = None, subjective: str | None = None, asks: str | None = None) -> Column:
    """Four labelled lines, of which the third has diagnosis, action and quote and names where the quote is from."""
    return let(final_qa(text, labels), lambda out: let(_lines(out), lambda lines: _strict_v2(out, lines, labels, locator, subjective, asks)))


def _strict_v2(out: Column, lines: Column, labels: Labels, locator: str | None, subjective: str | None, asks: str | None) -> Column:
    low = F.lower(out)
    line = lambda n: F.coalesce(F.try_element_at(lines, F.lit(n)), F.lit(""))
    third, q = line(3), line(1)
    ok = ~low.rlike(labels.leaks) & ~contains_any(low, list(labels.banned)) & ~out.rlike(r"(?im)^\s*(?:\*|-|\d+\.)\s+") & (F.size(lines) == 4)
    ok = ok & q.startswith("Q:") & line(2).startswith("A:") & third.startswith(labels.guideline) & line(4).startswith(labels.logged)
    ok = ok & contains_any(out, list(labels.reason))
    if subjective:
        ok = ok & ~q.rlike(subjective)
    if asks:
        ok = ok & q.rlike(asks)
    for key in (DIAGNOSIS, ACTION, QUOTE):
        ok = ok & third.rlike(rf"{key}\s*[:：=]")
    page = third.rlike(r"(?i)\bp\.\s*\d+\b") | F.contains(third, F.lit("页"))
    paragraph = third.rlike(r"(?i)段落\s*[:：]?\s*\d+|\bpara(?:graph)?\s*[:：#]?\s*\d+\b")
    chapter = contains_any(third, ["章节", "Chapter", "相关章节"])
    book = third.rlike(locator or r"(?i)m10(?:\s*#\d+)?")
    return closed(ok & ((book & (page | paragraph | chapter)) | (chapter & (page | paragraph))))


def _section(text: Column, label: str) -> Column:
    return strip(F.regexp_extract(text, rf"(?is)\Q{label}\E[:：]?\s*(.*?)(?=\n【|\z)", 1))


def logged_section(text: Column, labels: Labels = LABELS) -> Column:
    """The section on the logged action, else the plain decision section, else the whole text."""
    return let(final_qa(text, labels), lambda out: _logged(out, labels))


def _logged(out: Column, labels: Labels) -> Column:
    old = strip(F.regexp_extract(out, rf"(?is)\Q{labels.plain}\E[:：]?\s*(.*)$", 1))
    return F.when(F.contains(out, F.lit(labels.logged)), _section(out, labels.logged)).when(F.contains(out, F.lit(labels.plain)), old).otherwise(out)


def guideline_section(text: Column, labels: Labels = LABELS) -> Column:
    either = lambda out: F.when(F.contains(out, F.lit(labels.guideline)), _section(out, labels.guideline)).otherwise(_logged(out, labels))
    return let(final_qa(text, labels), either)


def evidence(section: Column) -> Column:
    """Struct of the quoted evidence and where it is from."""
    return let(section, _evidence)


def _evidence(section: Column) -> Column:
    pick = lambda p: F.regexp_extract(section, p, 1)
    first = lambda *xs: F.coalesce(*[F.when(x != "", strip(x)) for x in xs], F.lit(""))
    quote = first(pick(rf'(?i){QUOTE}\s*[:：=]\s*["“](.*?)["”]'), pick(r'(?i)证据原文\s*[:：=]\s*["“](.*?)["”]'))
    place = first(pick(r"(?i)章节段落\s*[:：=]\s*(\[[^\]]+\]|[^；。]+)"), pick(r"(?i)(\[M10(?:\s*#\d+)?[^\]]*\])"))
    return F.struct(quote.alias("evidence_quote"), place.alias("chapter_paragraph"))


def action_clause(section: Column) -> Column:
    return let(section, _action)


def _action(section: Column) -> Column:
    found = F.regexp_extract(section, rf"(?is){ACTION}\s*[:：=]\s*(.*?)(?:[;；]\s*{QUOTE}\s*[:：=]|\z)", 1)
    return strip(F.when(section.rlike(rf"{ACTION}\s*[:：=]"), found).otherwise(section))


def values_with_unit(text: Column, unit: str) -> Column:
    """All numbers that carry the unit."""
    plain = F.regexp_replace(F.coalesce(text, F.lit("")), "[μµ]", "u")
    return F.transform(F.regexp_extract_all(plain, F.lit(UNIT_VALUES[unit]), F.lit(1)), lambda x: x.cast("double"))


def names_unit(text: Column, unit: str) -> Column:
    return closed(text.rlike(UNIT_NAMES[unit]))


def unconvertible(text: Column) -> Column:
    return contains_any(text, list(UNCONVERTIBLE))


def has_dose(text: Column) -> Column:
    return closed(text.rlike(DOSE))


def has_drug(text: Column) -> Column:
    return closed(text.rlike(DRUGS))


def _ratio(a: Column, b: Column) -> Column:
    return F.greatest(a, b) / F.greatest(F.least(a, b), F.lit(1e-9))


def close_to(values: Column, target: Column, unit: str) -> Column:
    """Whether the best ratio or the best difference of a value to a positive target is within the unit's tolerance."""
    return let(values, lambda v: _close(v, target, unit))


def _close(values: Column, target: Column, unit: str) -> Column:
    ratio, least, share = CLOSE[unit]
    best_ratio = F.array_min(F.transform(values, lambda v: _ratio(v, target)))
    best_diff = F.array_min(F.transform(values, lambda v: F.abs(v - target)))
    near = (best_ratio <= ratio) | (best_diff <= F.greatest(F.lit(least), target * share))
    return F.when(target.isNull() | (target <= 0), True).otherwise(closed(near))


def consistent(a: Column, b: Column, unit: str) -> Column:
    """Whether two texts give values with the unit of which some pair is within three times, or say why not."""
    return let(F.struct(a.alias("a"), b.alias("b")), lambda s: _consistent(s["a"], s["b"], unit))


def _consistent(a: Column, b: Column, unit: str) -> Column:
    va, vb = values_with_unit(a, unit), values_with_unit(b, unit)
    best = F.array_min(F.flatten(F.transform(va, lambda x: F.transform(vb, lambda y: _ratio(x, y)))))
    both = names_unit(a, unit) & names_unit(b, unit)
    return F.when(both & ((F.size(va) == 0) | (F.size(vb) == 0)), True).when(both, closed(best <= 3.0)).otherwise(unconvertible(a) | unconvertible(b))


def concrete(section: Column, unit: str | None) -> Column:
    """Whether a guideline section says what to give, how much, and when to look again."""
    both = let(section, lambda s: F.struct(s.alias("section"), _action(s).alias("clause")))
    return let(both, lambda s: _concrete(s["section"], s["clause"], unit))


def _concrete(section: Column, clause: Column, unit: str | None) -> Column:
    keys = F.lit(True)
    for key in (DIAGNOSIS, ACTION, QUOTE):
        keys = keys & section.rlike(rf"{key}\s*[:：=]")
    again = clause.rlike(r"(?i)\d+(?:\.\d+)?\s*(?:s|sec|秒|min|分钟)") | F.contains(clause, F.lit("复评"))
    ok = contains_any(F.lower(clause), list(ACTION_WORDS)) & again & has_dose(clause) & has_drug(clause) & keys
    return closed(ok if unit is None else ok & (names_unit(clause, unit) | unconvertible(clause) | unconvertible(section)))


#: The parts of a question that hint at its answer, and what a question must ask for: fixed values.
SUBJECTIVE = "提示|显示|考虑|怀疑|警惕|符合|循环稳定|循环不稳|血流动力学稳定|麻醉深度不足|麻醉过深|麻醉过浅"
ASKS = r"(?=.*[?？])(?=.*(?:干预|措施|处理))"
QUANTITY = r"(?i)\d+(?:\.\d+)?\s*(?:mL/h|mL|mmHg|bpm|%|vol%|MAC)"
AGAIN = r"(?i)\d+(?:\.\d+)?\s*(?:s|sec|秒|min|分钟)"


def by_unit(unit: Column, of, otherwise) -> Column:
    """``of(u)`` for the unit that a column names, ``otherwise`` for none."""
    out = F
    for u in UNIT_VALUES:
        out = out.when(unit == u, of(u))
    return out.otherwise(otherwise)


def action_aligned(logged: Column, keywords: Column) -> Column:
    """Whether a section on the logged action has one of the words; true if there are none to have."""
    low = F.lower(logged)
    return (F.size(keywords) == 0) | closed(F.exists(keywords, lambda k: F.contains(low, F.lower(k))))


def concrete_logged(logged: Column, unit: Column) -> Column:
    """Whether a section on the logged action says what to do, how much, and when to look again."""
    ok = contains_any(F.lower(logged), list(ACTION_WORDS)) & (logged.rlike(AGAIN) | F.contains(logged, F.lit("复评"))) & logged.rlike(QUANTITY)
    return closed(ok & by_unit(unit, lambda u: names_unit(logged, u) | unconvertible(logged), True))


def _parts(text: Column, labels: Labels) -> Column:
    """Struct of an answer's block, its guideline and logged section, and the action in the former."""
    def of_block(out: Column) -> Column:
        guideline = F.when(F.contains(out, F.lit(labels.guideline)), _section(out, labels.guideline)).otherwise(_logged(out, labels))
        return F.struct(out.alias("block"), guideline.alias("guideline"), _logged(out, labels).alias("logged"))

    return let(let(final_qa(text, labels), of_block), lambda s: F.struct(s["block"].alias("block"), s["guideline"].alias("guideline"), s["logged"].alias("logged"), _action(s["guideline"]).alias("action")))


def checked(text: Column, keywords: Column, unit: Column, target: Column, labels: Labels = LABELS) -> Column:
    """Struct of all checks of an answer against what was done: strict, aligned, concrete_guideline, concrete_logged,
    consistent, close, and trainable, which is all of them. An answer without text passes none."""
    def of(s: Column) -> Column:
        strict = strict_v2(s["block"], labels, subjective=SUBJECTIVE, asks=ASKS)
        guided = lambda u: _concrete(s["guideline"], s["action"], u)
        near = lambda u: _close(values_with_unit(s["logged"], u), target, u)
        checks = {
            "strict": strict, "aligned": action_aligned(s["logged"], keywords),
            "concrete_guideline": closed(s["guideline"] != "") & by_unit(unit, guided, guided(None)),
            "concrete_logged": closed(s["logged"] != "") & concrete_logged(s["logged"], unit),
            "consistent": by_unit(unit, lambda u: _consistent(s["action"], s["logged"], u), True), "close": by_unit(unit, near, True),
        }
        some = closed(F.trim(s["block"]) != "")
        return F.struct(*[(some & closed(c)).alias(n) for n, c in checks.items()])

    passed = lambda s: F.struct(*[s[n].alias(n) for n in CHECKS], (s["strict"] & s["aligned"] & s["concrete_guideline"] & s["concrete_logged"] & s["consistent"] & s["close"]).alias("trainable"))
    return let(let(_parts(F.when(strip(text) != "", text), labels), of), passed)


CHECKS = ("strict", "aligned", "concrete_guideline", "concrete_logged", "consistent", "close")


def fields(text: Column, unit: Column, target: Column, labels: Labels = LABELS) -> Column:
    """The structured fields of an answer: quoted evidence and its place, the expected unit and whether both decisions
    keep to it, and whether the logged one is close to what was done. Blank and false for an answer without text."""
    def of(s: Column) -> Column:
        evidence_ = _evidence(s["guideline"])
        consistent_ = by_unit(unit, lambda u: _consistent(s["action"], s["logged"], u), True)
        close = by_unit(unit, lambda u: _close(values_with_unit(s["logged"], u), target, u), True)
        return _fields(evidence_["evidence_quote"], evidence_["chapter_paragraph"], F.coalesce(unit, F.lit("")), closed(consistent_), closed(close))

    blank = _fields(F.lit(""), F.lit(""), F.lit(""), F.lit(False), F.lit(False))
    return F.when(F.coalesce(strip(text), F.lit("")) == "", blank).otherwise(let(_parts(text, labels), of))


def _fields(quote: Column, place: Column, unit: Column, consistent_: Column, close: Column) -> Column:
    return F.struct(
        F.struct(quote.alias("evidence_quote"), place.alias("chapter_paragraph")).alias("evidence"),
        F.struct(unit.alias("expected_action_unit"), consistent_.alias("consistent")).alias("unit_consistency"),
        F.struct(close.alias("close_to_logged_action")).alias("alignment"),
    )


def validity(text: Column, keywords: Column, mode: str = "guideline_only", labels: Labels = LABELS) -> Column:
    """Struct of valid, strict_valid, guideline_valid and guideline_output; ``mode`` strict makes the strict check decide."""
    def of(s: Column) -> Column:
        some = F.coalesce(strip(text), F.lit("")) != ""
        strict = some & strict_v2(s["block"], labels, subjective=SUBJECTIVE, asks=ASKS) & action_aligned(s["logged"], keywords)
        output = F.when(some, strip(s["guideline"])).otherwise("")
        return F.struct(closed(strict if mode == "strict" else output != "").alias("valid"), closed(strict).alias("strict_valid"), closed(output != "").alias("guideline_valid"), output.alias("guideline_output"))

    return let(_parts(F.coalesce(text, F.lit("")), labels), of)


def canonical_lines(text: Column, aliases: dict[str, str]) -> Column:
    """Lines joined again with the labels at their beginnings replaced by the aliases' names."""
    def one(line: Column) -> Column:
        out = strip(line)
        for alias, name in aliases.items():
            out = F.when(F.lower(out).startswith(alias.lower()), F.concat(F.lit(name), F.substr(out, F.lit(len(alias) + 1)))).otherwise(out)
        return out

    return F.array_join(F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), r"\R"), one), lambda x: x != ""), "\n")


# Other names of the labels, and words by which a line is taken for the guideline's decision.
GUIDELINE_NAMES = ("【决策干预（miller）】", "【决策干预(miller)】", "【决策干预 m i l l e r】", "【miller决策】", "【miller建议】", "【miller】", "[miller]", "miller decision")
LOGGED_NAMES = ("【决策干预（vitaldb）】", "【决策干预(vitaldb)】", "【决策干预 vitaldb】", "【vitaldb决策】", "【vitaldb】", "[vitaldb]", "vitaldb decision")
REASON_NAMES = ("【临床推理】", "[临床推理]", "[clinical reasoning]", "clinical reasoning")
INFER_WORDS = ("根据miller", "miller", "建议干预", "优先处理", "应考虑", "增加镇痛", "加深麻醉", "继续观察", "维持灌注", "升压")
REPAIR_WORDS = ("miller", "建议", "优先", "应考虑", "升压", "镇痛", "麻醉", "灌注")
OTHER_DECISION = "vitaldb"


def canonical_line(line: Column, labels: Labels = LABELS) -> Column:
    """A line whose label, under any of its names, has become the label itself."""
    squeezed = let(line, lambda x: strip(F.regexp_replace(F.replace(x, F.lit("："), F.lit(":")), r"\s+", " ")))

    def of(x: Column) -> Column:
        low = F.lower(x)
        said = strip(F.regexp_replace(x, r"(?i)^(?:q|a)\s*:\s*", ""))
        payload = strip(F.regexp_replace(x, r"^[\[【].*?[\]】]\s*:?\s*", ""))
        named = lambda names: contains_any(low, list(names))
        return (
            F.when(low.rlike(r"^(?:q|question)\s*:"), F.concat(F.lit("Q: "), said))
            .when(low.rlike(r"^a\s*:") & ~F.contains(x, F.lit("临床推理")) & ~F.contains(low, F.lit("clinical reasoning")), F.concat(F.lit("A: "), said))
            .when(named(GUIDELINE_NAMES), F.concat(F.lit(f"{labels.guideline}："), payload))
            .when(named(LOGGED_NAMES), F.concat(F.lit(f"{labels.logged}："), payload))
            .when(named(REASON_NAMES), F.concat(F.lit(f"A: {labels.reason[0]}："), payload))
            .otherwise(x)
        )

    return let(squeezed, of)


def normalised(text: Column, labels: Labels = LABELS) -> Column:
    """An answer's lines with their labels made canonical; a missing question or answer line gets a default."""
    lines = F.filter(F.transform(F.split(final_qa(text, labels), "\n"), lambda x: canonical_line(x, labels)), lambda x: x != "")

    def completed(x: Column) -> Column:
        asked = F.when(F.get(x, F.lit(0)).rlike(r"(?i)^Q\s*:"), x).otherwise(F.concat(F.array(F.lit(DEFAULT_QUESTION)), x))
        reason = F.lit(f"A: {labels.reason[0]}：{DEFAULT_REASON}")
        whole = let(asked, lambda y: F.when(F.exists(y, lambda z: z.startswith("A:")), y).otherwise(F.concat(F.slice(y, 1, 1), F.array(reason), F.slice(y, 2, 1_000_000))))
        return F.when(F.size(x) == 0, x).otherwise(whole)

    return F.array_join(let(lines, completed), "\n")


def relaxed(text: Column, repair: bool = False, labels: Labels = LABELS) -> Column:
    """Struct of question, reason, guideline, logged, missing_label and inferred from a loosely labelled answer.

    Without a section on the guideline's decision the first line that sounds like one is taken; with ``repair`` the
    reasoning, and then any line that mentions treatment, may stand in for it.
    """
    section = lambda t, label: strip(F.regexp_extract(t, rf"(?is)\Q{label}\E\s*[:：]?\s*(.*?)(?=\n(?:Q:|A:|【)|\z)", 1))

    def lined(t: Column) -> Column:
        return F.struct(t.alias("text"), _lines(t).alias("lines"), section(t, labels.reason[0]).alias("reason"), section(t, labels.guideline).alias("guideline"), section(t, labels.logged).alias("logged"))

    def of(s: Column) -> Column:
        low = F.lower
        sounds = F.filter(s["lines"], lambda x: ~F.contains(low(x), F.lit(OTHER_DECISION)) & ~F.contains(x, F.lit("临床推理")) & contains_any(low(x), list(INFER_WORDS)))
        guess = F.coalesce(strip(F.regexp_replace(F.get(sounds, F.lit(0)), r"(?i)^(?:A:|Q:)\s*", "")), F.lit(""))
        if repair:
            candidates = F.concat(F.filter(F.array(s["reason"]), lambda x: x != ""), s["lines"])
            fits = F.filter(candidates, lambda x: ~F.contains(low(x), F.lit(OTHER_DECISION)) & contains_any(low(x), list(REPAIR_WORDS)))
            mended = F.coalesce(strip(F.regexp_replace(F.get(fits, F.lit(0)), r"(?i)^(?:A:|Q:|【[^】]+】[:：]?)\s*", "")), F.lit(""))
            guess = F.when(guess != "", guess).otherwise(mended)
        asked = F.coalesce(F.get(F.filter(s["lines"], lambda x: x.rlike(r"(?i)^Q\s*:")), F.lit(0)), F.lit(""))
        return F.struct(
            asked.alias("question"), s["reason"].alias("reason"), F.when(s["guideline"] != "", s["guideline"]).otherwise(guess).alias("guideline"), s["logged"].alias("logged"),
            (~F.contains(s["text"], F.lit(labels.guideline))).alias("missing_label"), ((s["guideline"] == "") & (guess != "")).alias("inferred"),
        )

    return let(let(normalised(text, labels), lined), of)


def json_object(text: Column) -> Column:
    """A JSON object as a variant: the whole text, else from its first brace to its last."""
    whole = F.try_parse_json(unfenced(text))
    inner = F.regexp_extract(unfenced(text), r"(?s)\{.*\}", 0)
    is_object = lambda v: F.schema_of_variant(v).startswith("OBJECT")
    return F.coalesce(F.when(is_object(whole), whole), F.try_parse_json(F.when(inner != "", inner)))


def failure(api_error: Column, has_text: Column, has_labels: Column, is_strict: Column, is_aligned: Column) -> Column:
    """Why an answer is not valid, the gravest first; NULL if it is."""
    return F.when(closed(api_error), "api_error").when(~closed(has_text), "no_semantic").when(~closed(has_labels), "missing_label").when(~closed(is_strict), "strict_format").when(~closed(is_aligned), "action_align")


def inject_locator(line: Column, locator: Column, present: str = r"(?i)\[[^\]]*(?:p\.|para|chapter)[^\]]*\]") -> Column:
    """A locator at the end of a line that has none."""
    return F.when(closed(line.rlike(present)) | locator.isNull(), line).otherwise(F.concat(F.regexp_replace(line, r"\s+$", ""), F.lit(" "), locator))


# Words of a text that talks about its instructions, and what stands in for missing sections.
CONFLICT_WORDS = ("return strict json only", "do not output any text outside", "output exactly one qa pair", "this means i need to", "let me check instructions", "指令冲突", "让我仔细检查指令", "这意味着我需要")
DEFAULT_QUESTION, DEFAULT_REASON = "Q: 请基于术中快照给出最合理的麻醉干预？", "请结合血流动力学与麻醉深度综合判断。"
DEFAULT_GUIDELINE, DEFAULT_LOGGED = "证据定位不足，建议基于Miller相关章节保守处理。", "建议与记录动作同类药物小步调整并复评。"


def without_index(text: Column) -> Column:
    """Book locators without the number of the hit."""
    out = F.regexp_replace(text, r"(?i)\[\s*M10#\d+\s*\]", "[M10]")
    return F.regexp_replace(out, r"(?i)(\[\s*)?\bM10#\d+\s*\|\s*", "$1M10 | ")


def _or(value: Column, default: str) -> Column:
    return let(F.trim(F.coalesce(value, F.lit(""))), lambda v: F.when(v != "", v).otherwise(default))


def rendered(question_: Column, reason: Column, guideline: Column, logged: Column, labels: Labels = LABELS) -> Column:
    """The four lines of an answer; missing parts get a default."""
    q = let(F.trim(F.coalesce(question_, F.lit(""))), lambda v: F.when(v == "", DEFAULT_QUESTION).otherwise(F.concat(F.lit("Q: "), F.regexp_replace(v, r"(?i)^Q\s*[:：]\s*", ""))))
    return F.concat(q, F.lit(f"\nA: {labels.reason[0]}："), _or(reason, DEFAULT_REASON), F.lit(f"\n{labels.guideline}："), _or(guideline, DEFAULT_GUIDELINE), F.lit(f"\n{labels.logged}："), _or(logged, DEFAULT_LOGGED))


def four_lines(text: Column, labels: Labels = LABELS) -> Column:
    """An answer with its four labels split into exactly four lines; one that lacks a label stays as it is."""
    parts = rf"(?s)Q\s*[:：]\s*(.*?)\s*A\s*[:：]\s*\Q{labels.reason[0]}\E\s*[:：]\s*(.*?)\s*\Q{labels.guideline}\E\s*[:：]\s*(.*?)\s*\Q{labels.logged}\E\s*[:：]\s*(.*)$"

    def split(out: Column) -> Column:
        p = [strip(F.regexp_extract(out, parts, k)) for k in (1, 2, 3, 4)]
        lines = F.concat(F.lit("Q: "), p[0], F.lit(f"\nA: {labels.reason[0]}："), p[1], F.lit(f"\n{labels.guideline}："), p[2], F.lit(f"\n{labels.logged}："), p[3])
        return F.when(out.rlike(parts), lines).otherwise(out)

    return F.when(strip(F.coalesce(text, F.lit(""))) != "", without_meta(let(final_qa(text, labels), split)))


def with_locator(text: Column, locator: Column, labels: Labels = LABELS) -> Column:
    """A locator at the end of the guideline line of an answer that has none."""
    def add(lines: Column) -> Column:
        third = F.coalesce(F.try_element_at(lines, F.lit(3)), F.lit(""))
        return F.array_join(F.concat(F.slice(lines, 1, 2), F.array(inject_locator(third, locator)), F.slice(lines, 4, 1_000_000)), "\n")

    lines = F.split(final_qa(text, labels), "\n")
    return let(lines, lambda x: F.when(F.size(x) < 4, F.array_join(x, "\n")).otherwise(add(x)))


def poor_payload(payload: Column) -> Column:
    """Whether a JSON answer (variant) lacks the expected keys, talks about its instructions or says next to nothing."""
    keys = ("question", "reasoning", "miller_decision", "vitaldb_decision", "final_output")
    values = [F.try_variant_get(payload, f"$.{k}", "string") for k in keys]
    said = F.lower(F.concat_ws(" ", *values))
    thin = F.length(F.trim(F.coalesce(values[2], F.lit("")))) < 2
    return F.coalesce(payload.isNull() | (F.size(F.array_compact(F.array(*values))) == 0) | contains_any(said, list(CONFLICT_WORDS)) | thin, F.lit(True))
