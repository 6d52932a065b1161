"""Comparing outputs: concepts claimed and supported, verdicts, pairs of arms, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import closed, contains_any, let, squeeze
from .policy import verdict_score
from .qa import json_object

# Concept -> (words of a claim, words of evidence).
CONCEPTS = {
    "perfusion_first": (("灌注优先", "先稳灌注", "先纠正灌注", "先纠正低血压", "perfusion first", "stabilize perfusion"), ("hypotension", "perfusion", "blood pressure", "hemodynamic", "vasopressor", "mean arterial pressure")),
    "avoid_deepen_when_hypotension": (("避免加深", "不宜加深", "不要加深", "avoid deepening", "do not deepen"), ("hypotension", "map", "hemodynamic", "anesthetic depth", "depth of anesthesia")),
    "bis_with_context": (("b i s", "bis", "结合刺激", "结合血流动力学", "不是单独触发", "not standalone trigger"), ("bis", "eeg", "stimulation", "artifact", "depth-of-anesthesia", "awareness")),
    "opioid_titration": (("阿片", "瑞芬太尼", "opioid", "remifentanil", "镇痛滴定", "analgesia"), ("opioid", "fentanyl", "remifentanil", "analges", "noxious stimulation")),
    "map65_threshold": (("map<65", "map <65", "map< 65", "map < 65", "map低于65", "map<65mmhg"), ("map", "hypotension", "mean arterial pressure", "blood pressure")),
    "vasopressor_logic": (("去氧肾上腺素", "麻黄碱", "去甲肾上腺素", "phenylephrine", "ephedrine", "norepinephrine"), ("phenylephrine", "ephedrine", "norepinephrine", "vasopressor", "hypotension")),
}
# Anchors that both texts may mention.
ANCHORS = {
    "map": ("map", "平均动脉压", "灌注压"),
    "bis": ("bis", "脑电", "麻醉深度"),
    "hypotension": ("hypotension", "低血压"),
    "perfusion": ("perfusion", "灌注"),
    "opioid": ("opioid", "阿片", "瑞芬太尼", "remifentanil"),
    "propofol": ("propofol", "丙泊酚"),
    "vasopressor": ("vasopressor", "升压药", "去甲肾上腺素", "麻黄碱", "去氧肾上腺素"),
}
#: Scores of verdicts; evaluators differ in what they give an unsupported claim.
SCORES = {"supported_strict": 3, "partially_supported": 2, "weakly_supported": 1, "unsupported": 0, "no_evidence": -1, "no_explicit_claim": -1}


def evidence_text(hits: Column) -> Column:
    """Texts of an array of hits, one per line, empty ones left out."""
    return F.array_join(F.filter(F.transform(hits, lambda h: F.trim(F.coalesce(h["text"], F.lit("")))), lambda t: t != ""), "\n")


# The concept that a threshold stated in other words claims too, and how it may be stated.
THRESHOLD_CONCEPT = "map65_threshold"
THRESHOLD_PATTERNS = (r"map\s*[<≤]\s*65", r"map[^0-9]{0,8}65")
THRESHOLD_WORDS = ("低血压", "65")


def normal(text: Column) -> Column:
    """Lower case, one blank for each run of white space."""
    return F.lower(squeeze(F.coalesce(text, F.lit(""))))


def _says(low: Column, name: str, words) -> Column:
    out = contains_any(low, list(words))
    if name == THRESHOLD_CONCEPT:
        for p in THRESHOLD_PATTERNS:
            out = out | low.rlike(p)
        out = out | (F.contains(low, F.lit(THRESHOLD_WORDS[0])) & F.contains(low, F.lit(THRESHOLD_WORDS[1])))
    return out


def claimed(output: Column, concepts=CONCEPTS) -> Column:
    return let(normal(output), lambda low: F.array_compact(F.array(*[F.when(_says(low, n, c), F.lit(n)) for n, (c, _) in concepts.items()])))


def supported(output: Column, evidence: Column, concepts=CONCEPTS) -> Column:
    """Claimed concepts that the evidence mentions."""
    both = F.struct(normal(output).alias("said"), normal(evidence).alias("shown"))
    return let(both, lambda s: F.array_compact(F.array(*[F.when(_says(s["said"], n, c) & contains_any(s["shown"], list(e)), F.lit(n)) for n, (c, e) in concepts.items()])))


def anchor_hits(output: Column, evidence: Column, anchors=ANCHORS) -> Column:
    both = F.struct(normal(output).alias("said"), normal(evidence).alias("shown"))
    return let(both, lambda s: sum((F.when(contains_any(s["said"], list(w)) & contains_any(s["shown"], list(w)), 1).otherwise(0) for w in anchors.values()), F.lit(0)))


def judged_support(claimed_: Column, supported_: Column, judge: Column) -> Column:
    """Supported concepts together with those that a judge's JSON answer names among the claimed ones."""
    said = F.transform(F.coalesce(F.try_variant_get(json_object(judge), "$.supported_concepts", "array<string>"), F.array().cast("array<string>")), lambda x: F.trim(x))
    return F.array_union(supported_, F.array_intersect(claimed_, said))


def judge_prompt(claimed_: Column, output: Column, evidence: Column, most_chars: int = 6000) -> Column:
    """What a judge of evidence is asked."""
    return F.concat(
        F.lit("Which of these claimed concepts does the evidence support in meaning? Leave out what is unsupported or uncertain and name no others.\nConcepts: "), F.to_json(claimed_),
        F.lit('\nAnswer with JSON only: {"supported_concepts": [...], "reason": "..."}\n\n[Claim]\n'), F.coalesce(output, F.lit("")), F.lit("\n\n[Evidence]\n"), F.left(F.coalesce(evidence, F.lit("")), F.lit(most_chars)),
    )


def support_verdict(n_claimed: Column, n_supported: Column, hits: Column, has_evidence: Column) -> Column:
    ratio = n_supported / F.greatest(n_claimed, F.lit(1))
    return (
        F.when(~has_evidence, "no_evidence").when(n_claimed == 0, "no_explicit_claim").when((ratio >= 1.0) & (hits >= 1), "supported_strict")
        .when(ratio >= 0.5, "partially_supported").when(ratio > 0, "weakly_supported").otherwise("unsupported")
    )


def support(rows: DataFrame, output: str, evidence: str, scores=SCORES) -> DataFrame:
    """``rows`` with claimed, supported, hits, ratio, verdict, score."""
    df = rows.withColumn("claimed", claimed(F.col(output))).withColumn("supported", supported(F.col(output), F.col(evidence)))
    df = df.withColumn("hits", anchor_hits(F.col(output), F.col(evidence))).withColumn("missing", F.array_except("claimed", "supported"))
    n, k = F.size("claimed"), F.size("supported")
    has = F.trim(F.coalesce(F.col(evidence), F.lit(""))) != ""
    df = df.withColumn("verdict", support_verdict(n, k, F.col("hits"), has)).withColumn("ratio", F.when(has & (n > 0), k / n).otherwise(0.0))
    table = F.create_map(*[F.lit(x) for pair in scores.items() for x in pair])
    return df.withColumn("score", F.element_at(table, F.col("verdict")))


def winner(a: Column, b: Column) -> Column:
    return F.when(a > b, "a").when(b > a, "b").otherwise("tie")


def pairs(a: DataFrame, b: DataFrame, key: str, text: str, score: str) -> DataFrame:
    """Both arms of each record: who scores more, whether the texts are equal, and their lengths."""
    left = a.select(key, F.col(text).alias("text_a"), F.col(score).alias("score_a"))
    right = b.select(key, F.col(text).alias("text_b"), F.col(score).alias("score_b"))
    return left.join(right, key).withColumn("winner", winner(F.col("score_a"), F.col("score_b"))).withColumn("equal", F.trim("text_a") == F.trim("text_b"))


ARMS = ("a", "b")


def compared(rows: DataFrame) -> DataFrame:
    """Both arms of each record set against each other.

    ``rows`` has structs ``a`` and ``b`` with valid, strict_valid, guideline_valid, guideline_output, final_output,
    alignment (a verdict) and support (a score). Adds both_valid, same_output, same_final, proxy_a, proxy_b and the
    winners by proxy (twice strict and once guideline), alignment and support; a missing verdict or score is the least.
    """
    flag = lambda arm, n: closed(F.col(f"{arm}.{n}"))
    text = lambda arm, n: F.trim(F.coalesce(F.col(f"{arm}.{n}"), F.lit("")))
    proxy = lambda arm: flag(arm, "strict_valid").cast("int") * 2 + flag(arm, "guideline_valid").cast("int")
    verdict = lambda arm: verdict_score(F.coalesce(F.col(f"{arm}.alignment"), F.lit("unavailable")))
    score = lambda arm: F.coalesce(F.col(f"{arm}.support"), F.lit(-1))
    same = lambda n: (text("a", n) != "") & (text("a", n) == text("b", n))
    df = rows.withColumn("both_valid", flag("a", "valid") & flag("b", "valid")).withColumn("same_output", same("guideline_output")).withColumn("same_final", same("final_output"))
    df = df.withColumn("proxy_a", proxy("a")).withColumn("proxy_b", proxy("b"))
    for name, of in (("proxy", proxy), ("alignment", verdict), ("support", score)):
        df = df.withColumn(f"winner_by_{name}", winner(of("a"), of("b")))
    return df


def arms_summary(compared_: DataFrame) -> DataFrame:
    """One row: counts of valid, strict and guideline answers by arm, of equal outputs, and of wins and ties."""
    n = lambda c: F.count(F.when(closed(c), 1))
    counts = [n(F.col(f"{arm}.{k}")).alias(f"{k}_{arm}") for arm in ARMS for k in ("valid", "strict_valid", "guideline_valid")]
    counts += [n(F.col(k)).alias(k) for k in ("both_valid", "same_output", "same_final")]
    counts += [n(F.col(f"winner_by_{by}") == who).alias(f"{who}_by_{by}") for by in ("proxy", "alignment", "support") for who in (*ARMS, "tie")]
    return compared_.agg(F.count(F.lit(1)).alias("total"), *counts)


def histogram(rows: DataFrame, values: dict[str, Column]) -> DataFrame:
    """(name, value, n): how often each value of several columns occurs; blank and missing values do not count."""
    pairs = F.array(*[F.struct(F.lit(name).alias("name"), F.trim(value).alias("value")) for name, value in values.items()])
    return rows.select(F.explode(pairs).alias("p")).select("p.*").filter("value <> ''").groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))


def summary(rows: DataFrame, verdict: str, score: str, ratio: str) -> DataFrame:
    """One row: totals by verdict, mean score, and mean of the ratios above zero."""
    counts = [F.count(F.when(F.col(verdict) == v, 1)).alias(f"n_{v}") for v in SCORES]
    return rows.agg(F.count(F.lit(1)).alias("n"), *counts, F.avg(score).alias("mean_score"), F.avg(F.when(F.col(ratio) > 0, F.col(ratio))).alias("mean_ratio"))
