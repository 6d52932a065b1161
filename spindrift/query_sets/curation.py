"""Queries on buckets, mixes, samples and comparisons."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import curate, evaluate
from .base import SIGNALS_SQL, signals, table


def _bucketed(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    n, p = F.col("l_linenumber"), F.col("l_partkey")
    kind = F.when(n % 3 == 0, "bolus_like_event").when(n % 3 == 1, "rate_adjustment").otherwise("continuous_infusion")
    key = F.when(p % 2 == 0, "PHE_RATE").otherwise("PPF20_VOL")
    before = F.when(p % 10 == 0, 0.0).otherwise(F.col("l_discount"))
    verdict = F.when(p % 17 == 0, "Invalid").otherwise("valid")
    b = curate.bucket(kind, key, before, F.col("l_extendedprice") / 100, F.col("l_quantity") * 5, F.when(p % 5 != 0, F.col("l_tax") * 20), verdict, has_flags=F.col("l_returnflag") != "N", cfg=curate.BucketConfig(need_flags=True))
    return li.select((F.col("l_orderkey") * 100 + n).alias("id"), b.alias("b")).select("id", "b.bucket", "b.reason")


def bucket_abc(spark, sf_dir):
    return _bucketed(spark, sf_dir)


_BUCKET_SQL = """x AS (SELECT l_orderkey * 100 + l_linenumber AS id, l_linenumber % 3 AS kind, l_partkey % 2 = 0 AS rate, CASE WHEN l_partkey % 10 = 0 THEN 0.0 ELSE l_discount END AS before,
  l_extendedprice / 100 AS after, l_quantity * 5 AS delta, CASE WHEN l_partkey % 5 <> 0 THEN l_tax * 20 END AS sm, l_partkey % 17 = 0 AS bad, l_returnflag <> 'N' AS flags FROM lineitem),
a AS (SELECT *, CASE WHEN kind = 1 AND NOT rate AND sm >= 1 THEN 'large_volume_adjustment' WHEN kind = 1 AND rate AND abs(delta) >= 1 THEN 'large_rate_adjustment' WHEN kind = 0 THEN 'bolus_like_event' END AS act FROM x),
r AS (SELECT id, CASE WHEN kind = 1 AND rate AND abs(before) <= 1e-6 THEN 'C:zero_start_rate_adjustment' WHEN rate AND abs(before) <= 1 AND abs(delta) >= 100 AND after >= 300 THEN 'C:setup_like_rate_jump'
  WHEN NOT rate AND sm < 0.5 THEN 'C:tiny_vol_background_drift' WHEN bad THEN 'C:actual_validation_invalid' WHEN act IS NOT NULL AND NOT flags THEN 'B:downgraded_from_' || act || '_missing_risk_flags'
  WHEN act IS NOT NULL THEN 'A:' || act ELSE 'B:maintenance_or_context' END AS v FROM a),
bk AS (SELECT id, split_part(v, ':', 1) AS bucket, split_part(v, ':', 2) AS reason FROM r)"""
BUCKETS = f"WITH {_BUCKET_SQL} SELECT id, bucket, reason FROM bk"


def ab_mix(spark, sf_dir):
    return curate.ab_mix(_bucketed(spark, sf_dir), ["id"], 0.8, most=0).select("id", "bucket")


MIX = f"""WITH {_BUCKET_SQL}, n AS (SELECT count(*) FILTER (bucket = 'A') AS na, count(*) FILTER (bucket = 'B') AS nb FROM bk),
t AS (SELECT least(na, round_even(n * 0.8, 0)) AS ta, least(nb, n - round_even(n * 0.8, 0)) AS tb FROM (SELECT *, least(floor(na / 0.8), floor(nb / (1.0 - 0.8))) AS n FROM n)),
k AS (SELECT id, bucket, row_number() OVER (PARTITION BY bucket ORDER BY md5('42:' || id)) AS o FROM bk)
SELECT id, bucket FROM k, t WHERE (bucket = 'A' AND o <= ta) OR (bucket = 'B' AND o <= tb)"""


def sample_review(spark, sf_dir):
    return curate.review_sample(_bucketed(spark, sf_dir), ["id"], 0.05)


SAMPLE = f"WITH {_BUCKET_SQL} SELECT id, bucket, reason FROM bk QUALIFY row_number() OVER (ORDER BY md5('42:' || id)) <= (SELECT floor(count(*) * 0.05) FROM bk)"


def _records(spark, sf_dir):
    return signals(spark, sf_dir).select("caseid", F.col("track").alias("key"), "ord")


def diverse_select(spark, sf_dir):
    return curate.diverse(_records(spark, sf_dir), 400, "caseid", "key", "ord").select("caseid", "key", "ord", "place")


_DIVERSE_SQL = f"""{SIGNALS_SQL}, rec AS (SELECT caseid, track AS key, ord FROM signals),
f AS (SELECT *, row_number() OVER (PARTITION BY caseid ORDER BY ord) AS c FROM rec),
u AS (SELECT caseid, key, ord, 0 AS turn, '' AS k FROM f WHERE c = 1 UNION ALL
  SELECT caseid, key, ord, row_number() OVER (PARTITION BY key ORDER BY caseid, ord), key FROM f WHERE c > 1),
dv AS (SELECT caseid, key, ord, row_number() OVER (ORDER BY turn, k, caseid, ord)::INTEGER AS place FROM u QUALIFY place <= 400)"""
DIVERSE = f"WITH {_DIVERSE_SQL} SELECT caseid, key, ord, place FROM dv"


def quota_enforce(spark, sf_dir):
    chosen = diverse_select(spark, sf_dir).select("caseid", "key", "ord")
    return curate.with_quota(chosen, _records(spark, sf_dir), F.col("key") == "error", 150, "ord")


QUOTA = f"""WITH {_DIVERSE_SQL}, m AS (SELECT greatest(0, 150 - count(*) FILTER (key = 'error')) AS missing FROM dv),
nw AS (SELECT r.* FROM rec r, m WHERE key = 'error' AND ord NOT IN (SELECT ord FROM dv) QUALIFY row_number() OVER (ORDER BY ord) <= (SELECT missing FROM m)),
gone AS (SELECT ord FROM dv WHERE key <> 'error' QUALIFY row_number() OVER (ORDER BY ord DESC) <= (SELECT count(*) FROM nw))
SELECT caseid, key, ord FROM dv WHERE ord NOT IN (SELECT ord FROM gone) UNION ALL SELECT caseid, key, ord FROM nw"""


def _arms(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    words = F.element_at(F.array(*[F.lit(w) for w in ("perfusion first, MAP < 65", "opioid and BIS", "avoid deepening", "phenylephrine", "nothing")]), (F.col("conv_id") % 5 + 1).cast("int"))
    facts = F.element_at(F.array(*[F.lit(w) for w in ("hypotension and map", "remifentanil", "", "eeg and stimulation, bis", "perfusion")]), ((F.col("conv_id") + F.col("turn")) % 5 + 1).cast("int"))
    return c.select("conv_id", "turn", "role", "text", F.concat_ws(" ", "text", words).alias("said"), facts.alias("evidence"))


def concept_support(spark, sf_dir):
    out = evaluate.support(_arms(spark, sf_dir), "said", "evidence")
    return out.select("conv_id", "turn", F.size("claimed").alias("n_claimed"), F.size("supported").alias("n_supported"), F.size("missing").alias("n_missing"), "hits", "verdict", F.round("ratio", 6).alias("ratio"), "score")


def _any(column: str, words) -> str:
    return "(" + " OR ".join(f"contains({column}, '{w}')" for w in words) + ")"


_STATES_65 = r"(regexp_matches(s, 'map\s*[<≤]\s*65') OR regexp_matches(s, 'map[^0-9]{0,8}65') OR (contains(s, '低血压') AND contains(s, '65')))"


def _claim(name: str, words) -> str:
    return f"({_any('s', words)} OR {_STATES_65})" if name == evaluate.THRESHOLD_CONCEPT else _any("s", words)


_SUPPORT_SQL = f"""c AS (SELECT conv_id, turn, role, text, lower(trim(regexp_replace(text || ' ' || (['perfusion first, MAP < 65', 'opioid and BIS', 'avoid deepening', 'phenylephrine', 'nothing'])[conv_id % 5 + 1], '\\s+', ' ', 'g'))) AS s,
  (['hypotension and map', 'remifentanil', '', 'eeg and stimulation, bis', 'perfusion'])[(conv_id + turn) % 5 + 1] AS e FROM conversations),
g AS (SELECT *, {' + '.join(f'{_claim(n, a)}::INT' for n, (a, _) in evaluate.CONCEPTS.items())} AS n_claimed, {' + '.join(f'({_claim(n, a)} AND {_any("e", b)})::INT' for n, (a, b) in evaluate.CONCEPTS.items())} AS n_supported,
  {' + '.join(f'({_any("s", w)} AND {_any("e", w)})::INT' for w in evaluate.ANCHORS.values())} AS hits FROM c),
su AS (SELECT *, CASE WHEN e = '' THEN 'no_evidence' WHEN n_claimed = 0 THEN 'no_explicit_claim' WHEN n_supported = n_claimed AND hits >= 1 THEN 'supported_strict'
  WHEN n_supported >= 0.5 * n_claimed THEN 'partially_supported' WHEN n_supported > 0 THEN 'weakly_supported' ELSE 'unsupported' END AS verdict,
  CASE WHEN e <> '' AND n_claimed > 0 THEN n_supported / n_claimed ELSE 0.0 END AS ratio FROM g),
sv AS (SELECT *, CASE verdict WHEN 'supported_strict' THEN 3 WHEN 'partially_supported' THEN 2 WHEN 'weakly_supported' THEN 1 WHEN 'unsupported' THEN 0 ELSE -1 END AS score FROM su)"""
SUPPORT = f"WITH {_SUPPORT_SQL} SELECT conv_id, turn, n_claimed, n_supported, n_claimed - n_supported AS n_missing, hits, verdict, round(ratio, 6) AS ratio, score FROM sv"


def _pairs(spark, sf_dir):
    rows = evaluate.support(_arms(spark, sf_dir), "said", "evidence")
    first = lambda role: rows.filter(F.col("role") == role).groupBy("conv_id").agg(F.min_by(F.struct("text", "score"), "turn").alias("r")).select("conv_id", "r.text", "r.score")
    return evaluate.pairs(first("user"), first("assistant"), "conv_id", "text", "score")


def pair_compare(spark, sf_dir):
    return _pairs(spark, sf_dir).select("conv_id", "winner", "equal", F.length("text_a").alias("len_a"), F.length("text_b").alias("len_b"))


PAIRS = f"""WITH {_SUPPORT_SQL}, f AS (SELECT conv_id, role, text, score FROM sv QUALIFY row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) = 1)
SELECT a.conv_id, CASE WHEN a.score > b.score THEN 'a' WHEN b.score > a.score THEN 'b' ELSE 'tie' END AS winner, trim(a.text) = trim(b.text) AS equal, length(a.text)::INTEGER AS len_a, length(b.text)::INTEGER AS len_b
FROM f a JOIN f b ON a.conv_id = b.conv_id AND a.role = 'user' AND b.role = 'assistant'"""


def arm_summary(spark, sf_dir):
    s = evaluate.summary(evaluate.support(_arms(spark, sf_dir), "said", "evidence"), "verdict", "score", "ratio")
    return s.withColumn("mean_score", F.round("mean_score", 6)).withColumn("mean_ratio", F.round("mean_ratio", 6))


SUMMARY = f"""WITH {_SUPPORT_SQL} SELECT count(*)::BIGINT AS n, {', '.join(f"count(*) FILTER (verdict = '{v}')::BIGINT AS n_{v}" for v in evaluate.SCORES)},
  round(avg(score), 6) AS mean_score, round(avg(ratio) FILTER (ratio > 0), 6) AS mean_ratio FROM sv"""

def _claims(spark, sf_dir):
    """Customers as claims about a threshold in many words, with evidence and a judge's answers."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    pick = lambda values, n: F.element_at(F.array(*[F.lit(v) for v in values]), (n % len(values) + 1).cast("int"))
    return c.select("c_custkey", pick(CLAIMS, k).alias("said"), pick(EVIDENCE, k + 1).alias("evidence"), pick(JUDGES, k).alias("judge"))


CLAIMS = ("keep MAP\n≤  65", "map was 65", "低血压时维持 65", "MAP above many numbers 65", "BIS and opioid", "nothing here", "perfusion\n first, propofol")
EVIDENCE = ("blood pressure and bis", "", "analgesia was given", "mean arterial pressure", "propofol perfusion")
JUDGES = ('{"supported_concepts": ["map65_threshold", "perfusion_first"], "reason": "x"}', 'ok: {"supported_concepts": [" opioid_titration "]}', "no json", '{"supported_concepts": "map65_threshold"}')


def judged_claims(spark, sf_dir):
    rows = evaluate.support(_claims(spark, sf_dir), "said", "evidence")
    rows = rows.withColumn("all", evaluate.judged_support(F.col("claimed"), F.col("supported"), F.col("judge")))
    return rows.select("c_custkey", F.array_join("claimed", ",").alias("claimed"), F.array_join("supported", ",").alias("supported"), F.array_join(F.array_sort("all"), ",").alias("with_judge"), "hits")


def _sql_pick(values, n: str) -> str:
    return "([" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + f"])[{n} % {len(values)} + 1]"


# what each claim says is read off the claims themselves
JUDGED_CLAIMS = f"""WITH r AS (SELECT c_custkey, c_custkey % {len(CLAIMS)} AS s, {_sql_pick(EVIDENCE, '(c_custkey + 1)')} AS e, c_custkey % {len(JUDGES)} AS j FROM customer),
c AS (SELECT *, CASE WHEN s IN (0, 1, 2) THEN ['map65_threshold'] WHEN s = 4 THEN ['bis_with_context', 'opioid_titration'] WHEN s = 6 THEN ['perfusion_first'] ELSE []::VARCHAR[] END AS cl FROM r),
u AS (SELECT *, list_filter(cl, lambda x: (x = 'map65_threshold' AND e IN ('blood pressure and bis', 'mean arterial pressure')) OR (x = 'bis_with_context' AND contains(e, 'bis')) OR (x = 'opioid_titration' AND contains(e, 'analges'))
  OR (x = 'perfusion_first' AND regexp_matches(e, 'perfusion|blood pressure|mean arterial pressure'))) AS su FROM c)
SELECT c_custkey, array_to_string(cl, ',') AS claimed, array_to_string(su, ',') AS supported,
  array_to_string(list_sort(list_distinct(su || list_filter(cl, lambda x: (j = 0 AND x IN ('map65_threshold', 'perfusion_first')) OR (j = 1 AND x = 'opioid_titration')))), ',') AS with_judge,
  (s IN (4) AND contains(e, 'bis'))::INTEGER + (s = 6 AND e = 'propofol perfusion')::INTEGER * 2 AS hits FROM u"""


def _two_arms(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    words = lambda n, *values: F.element_at(F.array(*[F.lit(v) for v in values]), (n % len(values) + 1).cast("int"))
    arm = lambda n, m: F.struct((n % 2 == 0).alias("valid"), F.when(n % 5 != 0, n % 3 == 0).alias("strict_valid"), (m % 2 == 0).alias("guideline_valid"), words(m, "give", " give ", "", None).alias("guideline_output"), words(n, "x", "y ", "y").alias("final_output"), words(n + m, "aligned", "Misaligned", "uncertain", None).alias("alignment"), F.when(m % 4 != 0, (n % 4).cast("int")).alias("support"))
    return evaluate.compared(o.select("o_orderkey", arm(k, c).alias("a"), arm(c, k + 1).alias("b")))


def arms_compare(spark, sf_dir):
    return _two_arms(spark, sf_dir).select("o_orderkey", "both_valid", "same_output", "same_final", "proxy_a", "proxy_b", "winner_by_proxy", "winner_by_alignment", "winner_by_support")


def _arm_sql(x: str, n: str, m: str) -> str:
    return f"""{n} % 2 = 0 AS valid_{x}, CASE WHEN {n} % 5 <> 0 THEN {n} % 3 = 0 ELSE false END AS strict_{x}, {m} % 2 = 0 AS guide_{x}, trim((['give', ' give ', '', ''])[{m} % 4 + 1]) AS out_{x}, trim((['x', 'y ', 'y'])[{n} % 3 + 1]) AS fin_{x},
  ([3, 0, 1, -1])[({n} + {m}) % 4 + 1] AS al_{x}, CASE WHEN {m} % 4 <> 0 THEN {n} % 4 ELSE -1 END AS su_{x}"""


_WINNER = lambda v: f"CASE WHEN {v}_a > {v}_b THEN 'a' WHEN {v}_b > {v}_a THEN 'b' ELSE 'tie' END"
_ARMS_SQL = f"""r AS (SELECT o_orderkey, {_arm_sql('a', 'o_orderkey', 'o_custkey')}, {_arm_sql('b', 'o_custkey', '(o_orderkey + 1)')} FROM orders),
p AS (SELECT *, strict_a::INT * 2 + guide_a::INT AS p_a, strict_b::INT * 2 + guide_b::INT AS p_b FROM r),
w AS (SELECT *, valid_a AND valid_b AS both_valid, out_a <> '' AND out_a = out_b AS same_output, fin_a = fin_b AS same_final, {_WINNER('p')} AS wp, {_WINNER('al')} AS wa, {_WINNER('su')} AS ws FROM p)"""
ARMS_COMPARE = f"WITH {_ARMS_SQL} SELECT o_orderkey, both_valid, same_output, same_final, p_a AS proxy_a, p_b AS proxy_b, wp AS winner_by_proxy, wa AS winner_by_alignment, ws AS winner_by_support FROM w"


def arms_totals(spark, sf_dir):
    return evaluate.arms_summary(_two_arms(spark, sf_dir))


_N = lambda c, a: f"count(*) FILTER ({c})::BIGINT AS {a}"
ARMS_TOTALS = f"""WITH {_ARMS_SQL} SELECT count(*)::BIGINT AS total, {', '.join(_N(f'{s}_{x}', f'{n}_{x}') for x in 'ab' for s, n in (('valid', 'valid'), ('strict', 'strict_valid'), ('guide', 'guideline_valid')))},
  {', '.join(_N(c, c) for c in ('both_valid', 'same_output', 'same_final'))}, {', '.join(_N(f"{s} = '{x}'", f'{x}_by_{n}') for s, n in (('wp', 'proxy'), ('wa', 'alignment'), ('ws', 'support')) for x in ('a', 'b', 'tie'))} FROM w"""


def arm_histograms(spark, sf_dir):
    rows = _two_arms(spark, sf_dir)
    low = lambda c: F.lower(F.coalesce(c, F.lit("unavailable")))
    return evaluate.histogram(rows, {"alignment_a": low(F.col("a.alignment")), "alignment_b": low(F.col("b.alignment")), "output_a": F.col("a.guideline_output")})


HISTOGRAMS = f"""WITH {_ARMS_SQL}, n AS (SELECT 'alignment_a' AS name, CASE al_a WHEN 3 THEN 'aligned' WHEN 0 THEN 'misaligned' WHEN 1 THEN 'uncertain' ELSE 'unavailable' END AS value FROM w
  UNION ALL SELECT 'alignment_b', CASE al_b WHEN 3 THEN 'aligned' WHEN 0 THEN 'misaligned' WHEN 1 THEN 'uncertain' ELSE 'unavailable' END FROM w UNION ALL SELECT 'output_a', out_a FROM w WHERE out_a <> '')
SELECT name, value, count(*)::BIGINT AS n FROM n GROUP BY 1, 2"""


def record_summary(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    p = F.col("l_partkey")
    key = F.when(p % 5 == 0, "PPF20_VOL").when(p % 5 == 1, "PHE_RATE").when(p % 5 == 2, "REMI_VOL").when(p % 5 == 3, "ARR_EVENT")
    records = li.select(F.col("l_suppkey").alias("caseid"), key.alias("key"), F.lower("l_returnflag").alias("risk_level"), F.when(p % 2 == 0, "rate_adjustment").otherwise("bolus_like_event").alias("kind"), (F.col("l_discount") * 20).alias("before"), (F.col("l_quantity") * 10).alias("after"))
    return curate.record_summary(records)


RECORD_SUMMARY = """WITH r AS (SELECT l_suppkey AS c, l_partkey % 5 AS k, lower(l_returnflag) AS risk, l_partkey % 2 = 0 AND abs(l_discount * 20) <= 1 AND l_quantity * 10 >= 300 AS setup FROM lineitem)
SELECT 'records' AS name, '' AS value, count(*)::BIGINT AS n FROM r UNION ALL SELECT 'unique_cases', '', count(DISTINCT c) FROM r UNION ALL SELECT 'other_drugs', '', count(*) FROM r WHERE k IN (1, 2)
UNION ALL SELECT 'setup_like', '', count(*) FROM r WHERE setup UNION ALL SELECT 'key', (['PPF20_VOL', 'PHE_RATE', 'REMI_VOL', 'ARR_EVENT', 'UNKNOWN'])[k + 1], count(*) FROM r GROUP BY k
UNION ALL SELECT 'risk_level', risk, count(*) FROM r GROUP BY risk"""

REGISTER = [
    ("judged_claims", judged_claims, JUDGED_CLAIMS),
    ("arms_compare", arms_compare, ARMS_COMPARE),
    ("arms_totals", arms_totals, ARMS_TOTALS),
    ("arm_histograms", arm_histograms, HISTOGRAMS),
    ("record_summary", record_summary, RECORD_SUMMARY),
    ("bucket_abc", bucket_abc, BUCKETS),
    ("ab_mix", ab_mix, MIX),
    ("sample_review", sample_review, SAMPLE),
    ("diverse_select", diverse_select, DIVERSE),
    ("quota_enforce", quota_enforce, QUOTA),
    ("concept_support", concept_support, SUPPORT),
    ("pair_compare", pair_compare, PAIRS),
    ("arm_summary", arm_summary, SUMMARY),
]
