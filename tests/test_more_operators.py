"""Assessments, numbers in texts, thinning, snapshots, services and stores on small tables, against plain versions."""

import json
import random
import time

import pytest
from pyspark.sql import functions as F

from spindrift.functions.values import fixed, with_unit
from spindrift.operators import anchors, assessment, curate, evaluate, intents, policy, qa, retrieval, series
from spindrift.plans import generation, snapshots
from spindrift.sources import readers, writers

STATE = "map_now double, hr_now double, spo2_now double, bis_now double, map_drop_pct double, " + ", ".join(f"{n} double" for n in assessment.HELD) + ", key string, anchor_source string, label string, delta double"


def state(spark, **known):
    names = [p.split()[0] for p in STATE.split(", ")]
    return spark.createDataFrame([tuple(known.get(n) for n in names)], STATE)


def test_flags_need_a_current_value(spark):
    """Long persistence without any current value raises nothing but the missing BIS."""
    held = {n: 500.0 for n in assessment.HELD}
    r = state(spark, **held).select(assessment.risk_flags().alias("f"), assessment.notes().alias("n"), assessment.unstable().alias("u"), assessment.absolute_triggered().alias("a")).first()
    assert r.f == [assessment.BIS_MISSING_TEXT] and r.n == [] and not r.u and not r.a
    r = state(spark, map_now=80.0, hr_now=70.0, spo2_now=97.0, bis_now=50.0, **held).select(assessment.risk_flags().alias("f")).first()
    assert r.f[0].startswith("重度低血压") and r.f[1].startswith("心动过速") and r.f[2].startswith("重度低氧血症") and r.f[3].startswith("BIS持续偏高") and r.f[4] == assessment.ABSOLUTE_TEXT


def test_levels_and_instability(spark):
    of = lambda **s: state(spark, bis_now=50.0, **s).select(assessment.risk_flags().alias("f"), assessment.unstable().alias("u")).withColumn("l", assessment.risk_level(F.col("f"))).first()
    assert (of(map_now=64.0).l, of(map_now=64.0).u) == ("moderate", True)
    assert (of(map_now=65.0).l, of(map_now=65.0).u) == ("low", False)
    assert (of(map_drop_pct=15.0).l, of(map_drop_pct=15.0).u) == ("low", True) and of(map_drop_pct=20.0).l == "moderate"
    assert of(key="ARR_EVENT", label=" VF ").l == "high" and of(key="PHE_RATE", anchor_source="arrdb", label="VF").l == "low"
    assert of(spo2_now=93.9).u and not of(spo2_now=94.0).u and of(hr_now=49.0).u and not of(hr_now=100.0).u


def test_numbers_round_half_to_even(spark):
    df = spark.createDataFrame([(0.25,), (2.5,), (3.5,), (-0.25,), (None,), (0.35,)], "v double")
    assert [r[0] for r in df.select(fixed(F.col("v"), 1)).collect()] == ["0.2", "2.5", "3.5", "-0.2", None, "0.4"]
    assert [r[0] for r in df.select(fixed(F.col("v"), 0)).collect()][1:3] == ["2", "4"]
    assert [r[0] for r in df.select(with_unit(F.col("v"), "mmHg")).collect()][3:5] == ["-0.2 mmHg", "NA"]


@pytest.mark.parametrize("label", [None, "name"])
def test_thinning_matches_a_plain_loop(spark, label):
    rng = random.Random(6)
    rows = [(c, rng.choice([round(rng.random() * 300, 1), 30.0, 60.0, 0.1 + 0.2]), k, rng.choice("ab")) for k, c in enumerate(rng.choices([None, 1, 2, 3], k=900))]
    want, last, tag = [], {}, {}
    for c, t, k, name in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])):
        if c not in last or t - last[c] >= 30.0 or (label and name != tag[c]):
            want.append(k)
            last[c], tag[c] = t, name
    df = spark.createDataFrame(rows, "caseid long, time_sec double, ord long, name string")
    assert sorted(r.ord for r in anchors.thin(df, 30.0, label).collect()) == sorted(want)
    assert anchors.thin(df.filter("false"), 30.0, label).collect() == []


def test_array_statistics_match_the_table_ones(spark):
    rng = random.Random(8)
    rows = [(c, float(t), "HR", rng.choice([None, float(rng.randint(30, 130))]), t) for c in range(5) for t in rng.sample(range(400), rng.choice([0, 3, 40, 300]))]
    df = spark.createDataFrame(rows, "caseid long, time_sec double, track string, value double, ord long")
    known = df.filter("value is not null")
    lists = known.groupBy("caseid").agg(F.array_sort(F.collect_list(F.struct("time_sec", "value"))).alias("p")).withColumn("step", series.step_of(F.col("p")))
    got = {r.caseid: r for r in lists.select("caseid", series.summary_of(F.col("p")).alias("s"), series.recent_median_of(F.col("p")).alias("m"), series.held_of(F.col("p"), F.col("step"), lambda v: v > 50).alias("h")).collect()}
    summaries = {r.caseid: r for r in series.summaries(df, ["caseid"]).collect()}
    medians = {r.caseid: r.recent_median for r in series.recent_median(df, ["caseid"]).collect()}
    held = {r.caseid: r.held_sec for r in series.tail_runs(df, ["caseid"], F.col("value") > 50).collect()}
    assert set(got) == set(medians) and any(held.values())
    for c, r in got.items():
        assert r.m == medians[c] and r.h == held[c] and (r.s is None) == (c not in summaries)
        if r.s is not None:
            assert all(abs(r.s[n] - summaries[c][n]) < 1e-9 for n in ("start", "end", "mean", "min", "max", "slope")) and r.s.trend == summaries[c].trend


def test_nested_snapshots(spark):
    signal = "caseid long, time_sec double, track string, value double, ord long"
    med = spark.createDataFrame([(1, 0.0, "PHE_RATE", 1.0, 0), (1, 1400.0, "PHE_RATE", 3.0, 1)], signal)
    vit = spark.createDataFrame([(1, float(t), v, x if t > 900 else y, t) for v, x, y in (("MBP", 50.0, 80.0), ("HR", 80.0, 100.0)) for t in range(1500)], signal)
    cases = spark.createDataFrame([(1, "67", "F", "Chest", " ", "12.5")], "caseid long, age string, gender string, department string, dx string, preop_hb string")
    r = snapshots.nested(snapshots.snapshots(med, vit), cases).first()
    s = r.snapshot
    assert (s.patient_background.age, s.patient_background.sex, s.patient_background.asa, s.surgery_type) == ("67", "F", "Unknown", "Unknown surgery") and s.preop_context == ["Chest"]
    assert s.intraop_stage == "Intraoperative (relative timestamp: 1400 sec)" and s.vital_trend_last_5min.SPO2 == series.NO_TREND
    assert s.vital_trend_last_5min.MBP == "from 50.0 mmHg stable to 50.0 mmHg; mean 50.0 mmHg, range [50.0 mmHg, 50.0 mmHg]"
    b = s.baseline_comparison
    assert (b.baseline_window_start_sec, b.baseline_window_end_sec, b.MAP_baseline_mmhg, b.MAP_drop_from_baseline_pct, b.HR_change_from_baseline_pct) == (200.0, 800.0, 80.0, 37.5, -20.0)
    a = s.clinical_assessment
    assert a.risk_level == "high" and a.persistence_seconds.map_lt_55 == 301.0 and a.recent_state_mean.BIS is None and a.map_policy.relative_triggered
    assert s.clinical_table_structured.preop_metrics == {"preop_hb": "12.5"} and s.anchor_detail.delta == 2.0 and s.miller_alignment.verdict == "aligned"
    out = snapshots.nested(snapshots.snapshots(med, vit), cases).select(F.to_json(snapshots.visible_context(F.col("snapshot"), 5)).alias("v"), F.to_json(snapshots.support_context(F.col("snapshot"))).alias("w")).first()
    visible, support = json.loads(out.v), json.loads(out.w)
    assert visible["intraop_signal_state"]["signals"]["MAP"] == {"current": "50.0 mmHg", "trend": "50.0 mmHg -> 50.0 mmHg (stable)", "window_mean": "50.0 mmHg"} and "actual_intervention" not in visible
    assert support["actual_intervention"] == "去氧肾上腺素泵速：1.000 -> 3.000（变化 +2.000）" and "patient_background" not in support


def test_unknown_keys_go_by_words(spark):
    df = spark.createDataFrame([("PHE_RATE", "x"), ("PHE_VOL", "propofol"), (None, None)], "k string, t string")
    assert [tuple(r) for r in df.select(policy.action_class(F.col("k"), F.col("t")), policy.action_drug(F.col("k"), F.col("t")), F.size(policy.key_words(F.col("k")))).collect()] == [("vasopressor", "phenylephrine", 3), ("hypnotic_iv", "propofol", 0), ("unknown", "unknown", 0)]


def test_rules_of_ones_own(spark):
    text = '{"conflict_rules": [{"id": "mine", "all": ["map_low", "hr_lt_50"], "not": ["bis_high"], "high_risk": true}, {"id": "never", "all": ["no_such_fact"]}], "alignment_rules": [{"id": "fine", "all": ["map_ge_75"], "outcome": "aligned"}]}'
    conflicts, alignments = readers.judge_rules(readers.load_rules(text, {}))
    schema = "map_now double, hr_now double, spo2_now double, bis_now double, map_drop_pct double, map_lt_65_held double, map_lt_55_held double, spo2_lt_90_held double, delta double, action_class string, action_drug string, escalation boolean"
    rows = [(60.0, 45.0, None, None), (60.0, 45.0, None, 65.0), (80.0, 70.0, 98.0, 50.0)]
    df = spark.createDataFrame([(*r, None, None, None, None, None, "unknown", "unknown", None) for r in rows], schema)
    got = [(r.verdict, r.reason, r.high_risk) for r in policy.judge(df, conflicts, alignments).collect()]
    assert got == [("misaligned", "mine", True), ("uncertain", "insufficient_discriminative_signal", False), ("aligned", "fine", False)]


def test_meta_remarks_behind_either_colon(spark):
    of = lambda t: spark.range(1).select(qa.without_meta(F.lit(t))).first()[0]
    assert of("x VitalDB: a：b（与记录一致）") == "x VitalDB: a：b" and of("VitalDB】: give 3（对照）") == "VitalDB】:give 3" and of("VitalDB no colon") == "VitalDB no colon" and of("VitalDB：golden") == "VitalDB：" + qa.NO_REMARK


def test_thresholds_in_other_words(spark):
    df = spark.createDataFrame([("MAP\n≤ 65",), ("map is 65",), ("低血压 below 65",), ("map was far beyond 65",), (None,)], "t string")
    assert [("map65_threshold" in r[0]) for r in df.select(evaluate.claimed(F.col("t"))).collect()] == [True, True, True, False, False]


def test_ways_to_choose(spark):
    rows = spark.createDataFrame([(k % 3, "ab"[k % 2], k) for k in range(30)], "caseid long, key string, ord long")
    pick = lambda mode: [r.ord for r in curate.choose(rows, 5, mode, "caseid", "key", "ord").collect()]
    assert pick("sequential") == [0, 1, 2, 3, 4] and pick("diverse")[:3] == [0, 1, 2] and sorted(pick("random")) == sorted(pick("random")) != pick("sequential")
    with pytest.raises(ValueError):
        pick("other")


def test_english_by_one_rewrite_or_all(spark):
    """Every text of the assessment, also in pairs and cut short, comes out as by all rewrites in order, most by one of them."""
    from pyspark.sql.types import StringType, StructField, StructType

    texts = [v.replace("{}", "12") for n, v in vars(assessment).items() if n.endswith("_TEXT")]
    texts += [a + b for a in texts for b in texts[::3]] + [t[k:] for t in texts for k in (1, 2, 3)] + [t[:-1] for t in texts] + ["M", "F", "", "BIS 40", "低血压（", None]
    out = F.coalesce("t", F.lit(""))
    for pattern, said in intents.HINTS:
        out = F.regexp_replace(out, pattern, said)
    want = F.when(out == "M", "male").when(out == "F", "female").otherwise(out)
    df = spark.createDataFrame([(t,) for t in texts], StructType([StructField("t", StringType())]))
    assert df.filter(~intents.english(F.col("t")).eqNullSafe(want)).count() == 0
    plan = df.select(intents.english(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Contains(") >= len(intents.HINTS)


def test_fixed_digits_of_odd_numbers(spark):
    numbers = [0.0, -0.0, -0.04, -0.05, 0.5, 1.5, 2.5, -2.5, 0.25, 12.345, 999999.95, 1e11, 1e12, 1e15, 1.7e308, float("inf"), float("nan"), -1e-300, None]
    df = spark.createDataFrame([(x,) for x in numbers], "x double")
    for digits in (0, 1, 2, 3):
        want = F.when(F.col("x").isNotNull(), F.format_string(f"%.{digits}f", F.bround("x", digits)))
        assert df.filter(~fixed(F.col("x"), digits).eqNullSafe(want)).collect() == []


def test_a_sample_is_the_same_wherever_its_rows_lie(spark):
    """Rows of one id tie at the cut: their other columns tell which come in, not the order of the partitions."""
    rows = [(k, w) for k in range(4) for w in "dacb"]
    take = lambda rows: sorted(map(tuple, curate.review_sample(spark.createDataFrame(rows, "id long, what string").coalesce(1), ["id"], 0.4).collect()))
    found = take(rows)
    assert found == take(rows[::-1]) == take(sorted(rows)) and len(found) == 6
    assert [w for k, w in found if [i for i, _ in found].count(k) == 2] == ["a", "b"]


def test_web_search_services(spark):
    calls = []

    def call(url, body, timeout):
        calls.append((url, body))
        return {"results": [{"title": " T ", "url": "u", "content": "c", "score": 0.5}, "broken"], "organic_results": [{"title": "G", "link": "l", "snippet": "s"}] * 9}

    search = lambda **k: generation.WebSearch(call=call, top_k=2, **k)("q w")
    assert search(provider="tavily", key="k", domains=("a.b",)) == [{"title": "T", "url": "u", "snippet": "c", "score": 0.5, "provider": "tavily"}] and calls[-1][1]["include_domains"] == ["a.b"]
    assert len(search(provider="serpapi", key="k")) == 2 and "q=q+w" in calls[-1][0] and search(provider="custom", url="http://x")[0]["provider"] == "custom"
    for bad in ({"provider": "tavily"}, {"provider": "custom"}, {"provider": "other"}):
        with pytest.raises(ValueError):
            search(**bad)
    q = spark.createDataFrame([(1, "a")], "query_id long, query string")
    assert "missing API key" in generation.search(q, generation.WebSearch("serpapi")).first().error


def test_prompts(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    goal = generation.targets(F.lit("give"), F.lit("PHE_RATE"), F.array(F.lit("a"), F.lit("b")), F.lit("mL/h"), F.lit(2.345))
    assert one(goal).endswith("words for the drug: a, b\n- its number: 2.34 mL/h")
    text = one(generation.repair_prompt(F.lit("old"), goal))
    assert text.endswith("Text:\nold") and qa.LABELS.logged in text and "final_output" in one(generation.repair_prompt(F.lit("old"), goal, payload=True))
    hits = F.array(F.struct(F.lit("t").alias("title"), F.lit("u").alias("url"), F.lit("s" * 900).alias("snippet")))
    assert one(generation.web_block(hits)) == "[Web 1] t | u | " + "s" * 500


def test_groups_and_medication(spark, tmp_path):
    writers.write_groups(spark.createDataFrame([(1, "G", "x"), (2, "H", "y")], "caseid long, surgery_group string, v string"), str(tmp_path / "g"))
    assert sorted(tuple(r) for r in spark.read.option("header", True).csv(str(tmp_path / "g" / "caseids")).collect()) == [("1", "G"), ("2", "H")]
    spark.createDataFrame([(1, 0.0, "A_RATE", 1.0), (1, 2.0, "A_RATE", 2.0), (1, 2.5, "A_RATE", None), (1, 3.0, "B", 9.0)], "caseid long, time_sec double, track string, value double").write.parquet(str(tmp_path / "s"))
    assert [(r.time_sec, r.value) for r in readers.read_medication(spark, str(tmp_path / "s"), ["A_RATE"]).collect()] == [(0.0, 2.0)]
    df = spark.createDataFrame([(1, 0.0, "MAC_RATE", 0.0, 0), (1, 1.0, "MAC_RATE", 0.0, 1), (2, 0.0, "X_VOL", 5.0, 0), (2, 1.0, "X_VOL", 5.01, 1), (3, 0.0, "X_VOL", 5.0, 0), (3, 1.0, "X_VOL", 5.02, 1)], "caseid long, time_sec double, track string, value double, ord long")
    assert [r.caseid for r in series.medicated_cases(df).collect()] == [3]


def test_hits_and_headings(spark):
    hits = spark.createDataFrame([(1, 5), (1, 0), (2, 0), (2, 1)], "q long, s int")
    assert sorted(tuple(r) for r in intents.kept_hits(hits, "q", "s", 3).collect()) == [(1, 5), (2, 0), (2, 1)] and intents.kept_hits(hits, "q", "s", 3, True).count() == 1
    lines = spark.createDataFrame([("Chapter 3: Airway 12",), ("121 Too Far",), ("7 When it began",), ("4 - ab",), (None,), ("Chapter 200 Far",)], "l string")
    assert [None if r[0] is None else tuple(r[0]) for r in lines.select(retrieval.chapter_parts(F.col("l"))).collect()] == [(3, "Airway"), None, None, None, None, None]


def test_a_long_line_is_cleaned_at_one_go(spark):
    """Before, every word of a line went through several expressions, and again for each use of the line."""
    lines = spark.createDataFrame([("a 12 34 b",), ("Chapter 3: x 12 Next 123456",), ("12 a 123 4 1234 B",), ("7 x\u00a0 12  Y 9",), ("a 12345 b 99",), ("",), (None,)], "l string")
    assert [r[0] for r in lines.select(retrieval.clean_heading(F.col("l"))).collect()] == ["a", "Chapter 3: x 12 Next 12", "12 a 123", "7 x", "a 12345 b", "", ""]
    took = []
    for _ in range(3):
        begin = time.time()
        long = spark.range(1).select(F.repeat(F.concat(F.lit("some words of a line "), F.col("id").cast("string"), F.lit(" ")), F.lit(60000)).alias("l"))
        assert long.select(F.length(retrieval.clean_heading(F.col("l")))).first()[0] == 60000 * 23 - 3
        took.append(time.time() - begin)
    assert min(took) < 1.2, took


def test_command_line_from_cases_to_a_mix(spark, tmp_path, capsys):
    from spindrift import cli

    cli.main(["config", "--set", "per_case=2", "--set", "repair=no"])
    assert json.loads(capsys.readouterr().out)["per_case"] == 2 and cli.load_config(None, ["repair=no"]).repair is False
    with pytest.raises(ValueError, match="unknown settings: x"):
        cli.load_config(None, ["x=1"])
    (tmp_path / "cases.csv").write_text("caseid,ane_dur,department,opname\n1,90,Thoracic,Lobectomy\n2,5,Thoracic,Biopsy\n3,90,Urology,Stone\n")
    signal = "caseid long, time_sec double, track string, value double, ord long"
    rows = [(1, 0.0, "PHE_RATE", 1.0, 0), (1, 400.0, "PHE_RATE", 3.0, 1), (3, 0.0, "PHE_RATE", 0.0, 0)] + [(1, float(t), "MBP", 50.0, t) for t in range(401)]
    spark.createDataFrame(rows, signal).write.parquet(str(tmp_path / "signals"))
    (tmp_path / "corpus.jsonl").write_text('{"text": "treat hypotension with a vasopressor"}\n{"text": "something else"}\n')
    settings = {"cases": tmp_path / "cases.csv", "signals": tmp_path / "signals", "corpus": tmp_path / "corpus.jsonl", "out": tmp_path / "out", "top_k": 1, "mix_ratio": 1.0}
    cli.main(["all", *[x for n, v in settings.items() for x in ("--set", f"{n}={v}")]], spark)
    assert [r.caseid for r in spark.read.option("header", True).csv(str(tmp_path / "out" / "groups" / "caseids")).collect()] == ["1"]
    answers = spark.read.json(str(tmp_path / "out" / "answers")).collect()
    assert len(answers) == 1 and answers[0].unit == "mL/h" and answers[0].words[0] == "去氧肾上腺素" and not answers[0].is_valid
    assert json.loads(answers[0].record)["snapshot"]["surgery_type"] == "Lobectomy"
    assert spark.read.json(str(tmp_path / "out" / "retrieval")).first().results[0].passage.startswith("treat")
    assert spark.read.json(str(tmp_path / "out" / "mix")).first().training_bucket == "A" and spark.read.json(str(tmp_path / "out" / "review")).count() == 1
