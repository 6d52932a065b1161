"""Operators on hand-computed fixtures and against plain Python."""

import json
import random

import pytest
from pyspark.sql import functions as F

from spindrift.functions import values
from spindrift.operators import anchors, cases, curate, evaluate, intents, policy, qa, retrieval, series
from spindrift.plans import generation, snapshots
from spindrift.sources import readers, writers
from spindrift.streaming import changes

SIGNAL = "caseid long, time_sec double, track string, value double, ord long"


def sig(spark, points, case=1, track="T"):
    return spark.createDataFrame([(case, float(t), track, None if v is None else float(v), k) for k, (t, v) in enumerate(points)], SIGNAL)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_rate_anchor_hidden_by_gaps(spark):
    df = sig(spark, [(0, 1), (1, 1.4), (2, 2.0), (3, None), (4, 9.0)])
    got = anchors.rate_anchors(df, 0.5).collect()
    assert [(r.time_sec, round(r.delta, 6)) for r in got] == [(2.0, 0.6)]
    assert series.changing_cases(df, 0.5).count() == 1


def test_zero_start_and_setup(spark):
    df = spark.createDataFrame([(0.0, 100.0, 100.0, 5.0), (0.5, 400.0, 399.5, 5.0), (0.5, 400.0, 399.5, 5000.0)], "before double, after double, delta double, time_sec double")
    assert [tuple(r) for r in df.select(anchors.zero_start(), anchors.likely_setup()).collect()] == [(True, False), (False, True), (False, False)]


def test_smoothed_rate(spark):
    df = sig(spark, [(t, t / 60) for t in (0, 30, 60, 90)])
    got = {r.time_sec: r for r in anchors.smoothed_rates(df, 60.0).collect()}
    assert (got[90.0].ref_time_sec, got[90.0].smoothed_dt_sec, round(got[90.0].smoothed_rate_per_h, 6)) == (30.0, 60.0, 60.0)
    assert (got[30.0].ref_time_sec, got[30.0].smoothed_dt_sec, round(got[30.0].smoothed_rate_per_h, 6)) == (0.0, 30.0, 60.0)
    assert got[0.0].smoothed_rate_per_h is None and got[0.0].ref_time_sec == 0.0


def test_thin(spark):
    assert sorted(r.time_sec for r in anchors.thin(sig(spark, [(t, 1) for t in (1, 10, 32, 40, 70)]), 30.0).collect()) == [1.0, 32.0, 70.0]
    rows = [(1, float(t), k, name) for k, (t, name) in enumerate([(1, "a"), (5, "b"), (9, "b"), (12, "a")])]
    got = anchors.thin(spark.createDataFrame(rows, "caseid long, time_sec double, ord long, name string"), 30.0, label="name").orderBy("time_sec").collect()
    assert [(r.time_sec, r.name) for r in got] == [(1.0, "a"), (5.0, "b"), (12.0, "a")]


def test_thin_equals_python(spark):
    rng = random.Random(1)
    rows = [(rng.randint(1, 5), float(rng.randint(0, 500)), k) for k in range(300)]
    want = []
    for case in range(1, 6):
        last = None
        for c, t, k in sorted(r for r in rows if r[0] == case):
            if last is None or t - last >= 17:
                want.append((c, t))
                last = t
    got = anchors.thin(spark.createDataFrame(rows, "caseid long, time_sec double, ord long"), 17.0).collect()
    assert sorted((r.caseid, r.time_sec) for r in got) == sorted(want)


def test_label_events(spark):
    rows = [(1, 0, 1.0, "AF"), (1, 1, 2.0, " Normal  Sinus Rhythm "), (1, 2, 3.0, "VT"), (1, 3, -1.0, "bad"), (1, 4, 4.0, "")]
    df = spark.createDataFrame(rows, "caseid long, ord long, time_sec double, label string")
    got = [(r.time_sec, r.before_label, r.after_label) for r in anchors.label_events(df, F.lit(100.0)).orderBy("time_sec").collect()]
    assert got == [(1.0, None, "AF"), (3.0, "Normal  Sinus Rhythm", "VT")]
    assert anchors.label_events(df, F.lit(100.0), keep_normal=True).count() == 4


def test_periodic(spark):
    df = spark.createDataFrame([(1, 1000.0), (2, 200.0)], "caseid long, end_sec double")
    assert [r.time_sec for r in anchors.periodic(df, 300, 300, 300).orderBy("time_sec").collect()] == [300.0, 600.0, 900.0]


@pytest.mark.parametrize("values_,held", [((60, 60, 50, 50, 50), 3.0), ((50, 50, 60), 0.0), ((50,), 1.0), ((50, 50, 50), 3.0), ((60, None, 50), 2.0)])
def test_tail_runs(spark, values_, held):
    got = series.tail_runs(sig(spark, enumerate(values_)), ["caseid"], F.col("value") < 55).first()
    assert got.held_sec == held


def test_summaries(spark):
    nine = sig(spark, [(t, 1) for t in range(9)])
    assert series.summaries(nine, ["caseid"]).count() == 0
    r = series.summaries(sig(spark, [(t, t + 1) for t in range(20)]), ["caseid"]).first()
    assert (r.start, r.end, r["mean"], r["min"], r["max"], round(r.slope, 9), r.trend) == (3.0, 18.0, 10.5, 1.0, 20.0, 1.0, "rapidly increased")


def test_units_ranges_and_baselines(spark):
    low = sig(spark, [(t, 10) for t in range(5)])
    kpa = series.kpa_cases(low)
    assert kpa.first().is_kpa and round(series.in_mmhg(low, kpa).first().value, 4) == 75.0062
    assert [r.value for r in series.masked(sig(spark, [(0, 19), (1, 20), (2, 220), (3, 221)], track="MBP"), series.RANGES).orderBy("time_sec").collect()] == [None, 20.0, 220.0, None]
    assert one(spark, series.percent_drop(F.lit(80.0), F.lit(60.0))) == 25.0 and one(spark, series.percent_drop(F.lit(0.0), F.lit(60.0))) is None
    event = spark.createDataFrame([(1, 500.0, 1)], "caseid long, event_time double, anchor_no int")
    assert series.baselines(event, sig(spark, [(0, 7), (1, 9)]), ["caseid"]).first().baseline_median == 7.0


def test_windows_equal_a_plain_join(spark):
    rng = random.Random(2)
    points = sorted((rng.uniform(0, 900), rng.random()) for _ in range(200))
    events = [(1, rng.uniform(0, 1000), k) for k in range(30)]
    got = series.windows(spark.createDataFrame(events, "caseid long, event_time double, anchor_no int"), sig(spark, points), 120.0).collect()
    want = [(n, t) for _, e, n in events for t, _ in points if max(0, e - 120) <= t <= e]
    assert sorted((r.anchor_no, r.time_sec) for r in got) == sorted(want)


def test_interpolation(spark):
    got = [r.filled for r in series.interpolated(sig(spark, [(0, None), (1, 2), (2, None), (4, 8), (5, None)]), ["caseid"]).orderBy("time_sec").collect()]
    assert got == [2.0, 2.0, 4.0, 8.0, 8.0]


def test_groups_and_cases(spark):
    assert one(spark, cases.group_of(F.lit("Neuro"), F.lit("lung biopsy"))) == "Thoracic_Surgery"
    assert one(spark, cases.group_of(F.lit("ENT & eye"), F.lit(None).cast("string"))) == "Dept_ENT_eye"
    assert one(spark, cases.group_of(F.lit(None).cast("string"), F.lit(""))) == "Other"
    df = spark.createDataFrame([(0, 1, 50.0, "a"), (1, 1, 60.0, "b"), (2, 2, None, "a"), (3, 3, 10.0, "a")], "ord long, caseid long, ane_dur double, source_dataset string")
    assert [r.ord for r in cases.select_cases(df, "ord").orderBy("ord").collect()] == [0, 2]
    assert [r.ord for r in cases.select_cases(df, "ord", keep_sources=True).orderBy("ord").collect()] == [0, 1, 2]
    assert [r.ord for r in cases.select_cases(df, "ord", most=1).collect()] == [0]


def test_scalars(spark):
    seconds = lambda s: one(spark, values.seconds_of(F.lit(s)))
    assert [seconds(s) for s in ("01:02:03.5", "02:30", "t=12s", "", "7.5", " 3 \n")] == [3723.5, 150.0, 12.0, None, 7.5, 3.0]
    assert one(spark, values.valid_text(F.lit(" NaN\n"))) is None and one(spark, values.strip(F.lit(" \n　a b\t"))) == "a b"
    assert one(spark, values.safe_number(F.lit("nan"))) is None and one(spark, values.case_id(F.lit("12.9"))) == 12 and one(spark, values.case_id(F.lit("-3.7"))) == -3
    assert one(spark, values.printable(F.lit("a\x01\tb\n\x1f"))) == "a\tb\n" and one(spark, values.one_line(F.lit("a\n\nb " + "c" * 20), 10)) == "a b ccc..."
    assert one(spark, values.closed(F.lit(None).cast("boolean"))) is False


STATE = "ord long, map_now double, hr_now double, spo2_now double, bis_now double, map_drop_pct double, map_lt_65_held double, map_lt_55_held double, spo2_lt_90_held double, delta double, action_class string, action_drug string, escalation boolean"


def judge(spark, **k):
    row = {"ord": 1, "map_lt_65_held": 0.0, "map_lt_55_held": 0.0, "spo2_lt_90_held": 0.0} | k
    names = [c.split()[0] for c in STATE.split(", ")]
    key, delta = row.pop("key", None), row.get("delta")
    row |= {"action_class": one(spark, policy.action_class(F.lit(key), F.lit(""))), "action_drug": one(spark, policy.action_drug(F.lit(key), F.lit(""))), "escalation": one(spark, policy.escalates(F.lit(delta).cast("double"), F.lit("")))}
    return policy.judge(spark.createDataFrame([tuple(row.get(n) for n in names)], STATE)).first()


def test_rule_engine(spark):
    r = judge(spark, map_now=60.0, hr_now=80.0, spo2_now=98.0, bis_now=50.0, delta=1.0, key="PPF20_VOL")
    assert (r.strategies, r.verdict, r.reason, r.high_risk) == (["avoid_vasodilator_when_map_low"], "misaligned", "map_low_escalate_hypnotic_or_vasodilator", True)
    r = judge(spark, map_now=80.0, hr_now=70.0, spo2_now=98.0, bis_now=65.0, delta=1.0, key="REMI_RATE")
    assert (r.verdict, r.high_risk) == ("aligned", False)
    r = judge(spark, key="ARR_EVENT")
    assert (r.strategies, r.verdict, r.reason) == (["context_monitoring"], "aligned", "monitoring_in_low_signal_context")
    r = judge(spark, key="EPI_RATE", delta=1.0)  # unknown pressure is not below 55
    assert (r.verdict, r.reason, r.high_risk) == ("misaligned", "epinephrine_non_rescue", False)


def test_action_words(spark):
    t = lambda f, s: one(spark, f(F.lit(None).cast("string"), F.lit(s)))
    assert t(policy.action_class, "epinephrine") == "vasopressor" and one(spark, policy.action_class(F.lit("EPI_RATE"), F.lit(""))) == "inopressor"
    assert t(policy.action_drug, "去甲肾上腺素") == "norepinephrine" and t(policy.action_drug, "?") == "unknown"
    e = lambda d, s: one(spark, policy.escalates(F.lit(d).cast("double"), F.lit(s)))
    assert [e(1, "减少"), e(-1, "增加"), e(None, "减少 增加"), e(0, "bolus"), e(None, "")] == [True, False, False, True, False]


def test_label_check(spark):
    v = lambda *a: tuple(one(spark, policy.check_label(F.lit(a[0]), F.array(F.lit("prop")), *[F.lit(float(x)) for x in a[1:]])))
    assert v("Propofol", 1, 2, 1.2)[:2] == ("invalid", 0.88) and v("Propofol", 1, 2, 1.04)[0] == "valid"
    assert v(" ", 1, 2, 1)[2] == "empty_actual_intervention" and v("remi", 1, 2, 1)[2] == "keyword_mismatch_with_medication_key"


def plain_chunks(text, size, overlap, sep):
    out, cur = [], ""
    for block in (b.strip() for b in text.split(sep)):
        if not block:
            continue
        if not cur or len(cur) + len(block) + 1 <= size:
            cur = f"{cur} {block}".strip()
        else:
            out.append(cur)
            cur = f"{cur[-overlap:] if overlap else ''} {block}".strip()
    return out + [cur] * bool(cur)


def test_chunks(spark):
    assert one(spark, retrieval.chunks(F.lit("aaaa\n\nbbbb"), 6, 2)) == ["aaaa", "aa bbbb"]
    rng = random.Random(3)
    texts = ["\n".join("x" * rng.randint(0, 12) + rng.choice(["", " ", "\t"]) for _ in range(rng.randint(0, 12))) for _ in range(60)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(retrieval.chunks(F.col("t"), 20, 5, "\n")).collect()]
    assert got == [plain_chunks(t, 20, 5, "\n") for t in texts]


def test_ranking(spark):
    assert one(spark, retrieval.tokens(F.lit("MAP < 65; anti-sympathetic x/y_z 中文"))) == ["map", "65", "anti-sympathetic", "x/y_z"]
    corpus = spark.createDataFrame([(1, "low map"), (2, "high map")], "chunk_id long, text string")
    queries = spark.createDataFrame([(7, "low"), (8, "none")], "query_id long, text string")
    got = retrieval.bm25(corpus, queries, 5).collect()
    assert [(r.query_id, r.chunk_id, round(r.score, 6)) for r in got] == [(7, 1, 0.693147)]
    a = spark.createDataFrame([(1, 5, 1)], "query_id long, chunk_id long, rank int")
    b = spark.createDataFrame([(1, 5, 2), (1, 6, 1)], "query_id long, chunk_id long, rank int")
    scores = {r.chunk_id: r.score for r in retrieval.fused(a, b).collect()}
    assert abs(scores[5] - (0.6 / 61 + 0.4 / 62)) < 1e-9 and abs(scores[6] - 0.4 / 61) < 1e-9


def test_chapter_limit_falls_back(spark):
    hits = spark.createDataFrame([(1, "3 Heart"), (1, "4"), (2, "9")], "query_id long, chapter string")
    got = retrieval.limited(hits, retrieval.allowed(F.col("chapter"), ["3"])).collect()
    assert sorted((r.query_id, r.chapter) for r in got) == [(1, "3 Heart"), (2, "9")]


def test_headings_and_locators(spark):
    h = lambda s: one(spark, retrieval.chapter_parts(F.lit(s)))
    assert tuple(h("Chapter 12:  Airway ")) == (12, "Airway") and h("121 Airway") is None and h("3 ab") is None and h("plain") is None
    assert one(spark, retrieval.locator(F.lit("B"), F.lit(" "), F.lit("4"), F.lit(None).cast("string"))) == "[B, p. 4]"


GOOD = 'Q: what now?\nA: 【临床推理】low.\n【决策干预（Miller）】诊断依据：MAP 60；具体干预：给予 propofol 10 mL/h，5 min 复评；原文摘录："keep MAP" [M10, Chapter 3, p. 12]\n【决策干预（VitalDB）】：propofol 12 mL/h'


def test_qa_formats(spark):
    t = lambda f, s: one(spark, f(F.lit(s)))
    assert t(qa.final_qa, f"<think>Q: x</think>\n```text\nQ: draft\n{GOOD}\n\nmore") == GOOD
    assert t(qa.strict_v1, GOOD + "。") and not t(qa.strict_v1, GOOD) and t(qa.strict_v2, GOOD)
    for bad in (GOOD.replace("A:", "B:"), GOOD + "\nextra", GOOD.replace("原文摘录", "x"), GOOD.replace("p. 12", "").replace("Chapter 3", ""), GOOD.replace("low", "golden"), "", "Q: a"):
        assert not t(qa.strict_v2, bad)
    assert not t(qa.strict_v1, GOOD + "（。") and not t(qa.strict_v1, GOOD + "，")
    assert one(spark, qa.concrete(qa.guideline_section(F.lit(GOOD)), "mL/h")) and not one(spark, qa.concrete(F.lit("具体干预：wait"), None))
    assert tuple(one(spark, qa.evidence(qa.guideline_section(F.lit(GOOD))))) == ("keep MAP", "[M10, Chapter 3, p. 12]")


def test_units(spark):
    close = lambda s: one(spark, qa.close_to(qa.values_with_unit(F.lit(s), "mL/h"), F.lit(30.0), "mL/h"))
    assert close("40 mL/h") and not close("45 mL/h") and not close("none")
    both = lambda a, b: one(spark, qa.consistent(F.lit(a), F.lit(b), "mL/h"))
    assert not both("10 mL/h", "31 mL/h") and both("10 mL/h", "30 ml / h") and both("x", "无法换算") and not both("x", "y")
    assert one(spark, qa.values_with_unit(F.lit("2 mL, 3 mL/h, 4.5ml"), "mL")) == [2.0, 4.5]


def test_json_in_text(spark):
    v = lambda s: one(spark, F.try_variant_get(qa.json_object(F.lit(s)), "$.k", "int"))
    assert [v('{"k": 1}'), v('say {"k": 2} end'), v("{"), v("[1]"), v('```json\n{"k": 3}\n```')] == [1, 2, None, None, 3]


def test_buckets_and_mixes(spark):
    b = lambda kind, key, before, delta: tuple(one(spark, curate.bucket(F.lit(kind), F.lit(key), F.lit(before).cast("double"), F.lit(5.0), F.lit(delta).cast("double"), F.lit(None).cast("double"), F.lit("valid"))))
    assert b("rate_adjustment", "X_RATE", 0, 5) == ("C", "zero_start_rate_adjustment")
    assert b("rate_adjustment", "X_RATE", 2, 5) == ("A", "large_rate_adjustment") and b("rate_adjustment", "X_RATE", 2, 0.5) == ("B", "maintenance_or_context")
    assert curate.mix_counts(10, 10, 0.8) == (10, 2) and curate.mix_counts(10, 10, 0.8, 15) == (10, 5) and curate.mix_counts(3, 4, 1.0) == (3, 0) and curate.mix_counts(3, 4, 0.0) == (0, 4) and curate.mix_counts(0, 0, 0.5) == (0, 0)
    assert curate.review_sample(spark.range(10), ["id"], 0.05).count() == 1


def test_quota(spark):
    chosen = spark.createDataFrame([(1, "p"), (2, "p"), (3, "o")], "ord long, key string")
    more = spark.createDataFrame([(3, "o"), (7, "o"), (8, "o"), (9, "p")], "ord long, key string")
    got = curate.with_quota(chosen, more, F.col("key") == "o", 2, "ord").collect()
    assert sorted(r.ord for r in got) == [1, 3, 7]
    assert curate.with_quota(chosen, more, F.col("key") == "o", 1, "ord") is chosen


def test_support(spark):
    v = lambda n, k, h, e=True: one(spark, evaluate.support_verdict(F.lit(n), F.lit(k), F.lit(h), F.lit(e)))
    assert [v(2, 2, 0), v(2, 1, 0), v(2, 2, 1), v(0, 0, 0), v(2, 0, 3), v(3, 1, 0), v(1, 1, 1, False)] == ["partially_supported", "partially_supported", "supported_strict", "no_explicit_claim", "unsupported", "weakly_supported", "no_evidence"]


def test_intents(spark):
    schema = "surgery_group string, surgery_type string, context array<string>, map_now double, hr_now double, spo2_now double, bis_now double, map_drop_pct double, key string, flags array<string>, notes array<string>"
    df = spark.createDataFrame([("Neuro_X", "Clip", ["HTN", "DM", "x"], 60.0, 110.0, None, 65.0, None, "PHE_RATE", None, None), (None, None, None, None, None, None, 70.0, None, None, ["BIS短时偏离（持续不足120s，不单独作为给药依据）"], None)], schema)
    a, b = [r[0] for r in df.select(intents.intents()).collect()]
    assert a[:4] == ["neuro x anesthesia", "clip", "htn", "dm"] and len(a) == 8 and "high BIS with hypotension" in a
    assert b == [] and one(spark, intents.rewritten(F.array().cast("array<string>"))) == intents.DEFAULT_QUERY
    assert df.select(intents.intents("full")).collect()[1][0][0] == "high BIS during general anesthesia"
    assert one(spark, intents.english(F.lit("MAP较基线下降明显（25%）"))) == "marked MAP decrease from baseline (25%)" and one(spark, intents.english(F.lit("M"))) == "male"
    assert one(spark, intents.hit_score(F.lit("Miller's Anesthesia"), F.lit(""), F.lit("10th edition"))) == 6
    assert one(spark, intents.web_query([F.lit(" "), F.lit(None).cast("string")], [F.lit("a"), F.lit("")], "end")) == "a; end"


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "c.csv").write_text('caseid,opname,ane_dur\n1,"a\nb",40\nx,c,1\n2.9,d,\n')
    assert sorted(r.caseid for r in readers.read_cases(spark, str(tmp_path / "c.csv")).collect()) == [1, 2]
    (tmp_path / "r.jsonl").write_text('{"snapshot": {"k": 1}}\nbroken\n[1]\n{"k": 2}\n')
    got = readers.snapshots_of(readers.read_records(spark, str(tmp_path / "r.jsonl"))).select(F.variant_get("snapshot", "$.k", "int")).collect()
    assert [r[0] for r in got] == [1, 2]
    (tmp_path / "r.json").write_text('[{"k": 5}, 3, {"k": 6}]')
    assert readers.read_records(spark, str(tmp_path / "r.json")).count() == 2
    (tmp_path / "p.jsonl").write_text('{"content": "a", "title": "T"}\n{"text": " "}\n{"body": "b", "page_no": "7"}\n')
    assert [tuple(r) for r in readers.read_corpus(spark, str(tmp_path / "p.jsonl")).select("chunk_id", "text", "source", "page").orderBy("chunk_id").collect()] == [(0, "a", "T", None), (1, "b", None, "7")]
    (tmp_path / "Annotation_file_12.csv").write_text("time_sec,rhythm\n1,AF\nx,N\n")
    notes = readers.read_annotations(spark, str(tmp_path / "Annotation_file_12.csv")).collect()
    assert [(r.caseid, r.time_sec, r.label) for r in notes] == [(12, 1.0, "AF"), (12, None, "N")]
    vectors = spark.createDataFrame([(1, [1.0])], "chunk_id long, embedding array<double>")
    writers.write_index(vectors, str(tmp_path / "index"), "s1")
    assert readers.read_index(spark, str(tmp_path / "index"), "s1").count() == 1 and readers.read_index(spark, str(tmp_path / "index"), "s2") is None and readers.read_index(spark, str(tmp_path / "no"), "s1") is None
    writers.write_json_lines(spark.createDataFrame([("é\x01", ["a\x02"])], "a string, b array<string>"), str(tmp_path / "out"))
    assert json.loads(spark.read.text(str(tmp_path / "out")).first()[0]) == {"a": "é", "b": ["a"]}
    writers.write_csv(spark.createDataFrame([(1, ["a", "b"])], "k long, b array<string>"), str(tmp_path / "csv"))
    assert spark.read.csv(str(tmp_path / "csv"), header=True).first().b == "a;b"
    assert readers.load_rules('{"a": 1}', {}) == {"a": 1} and readers.load_rules(None, {"d": 1}) == {"d": 1}
    assert "| 1 |" in writers.markdown({"n": 1}, [{"a": 1}], "T")


def test_snapshots(spark):
    med = sig(spark, [(0, 1), (100, 1), (400, 3)], track="PHE_RATE").unionByName(sig(spark, [(0, 1), (20, 9)], case=2, track="NOR_RATE"))
    vit = None
    for track, v in (("MBP", 50), ("HR", 80), ("SPO2", 97), ("BIS", 50)):
        for case in (1, 2):
            part = sig(spark, [(t, v) for t in range(0, 401)], case=case, track=track)
            vit = part if vit is None else vit.unionByName(part)
    r = snapshots.snapshots(med, vit).collect()
    assert [(x.caseid, x.event_time) for x in r] == [(1, 400.0)]  # the other window is too short
    assert r[0].map_now == 50.0 and r[0].map_lt_55_held == 301.0 and r[0].risk_level == "high" and "perfusion_first" in r[0].strategies and r[0].intervention_type == "rate_adjustment"
    assert r[0].vital_stats["HR"]["trend"] == "stable" and r[0].verdict == "aligned"


def test_generation(spark):
    rows = spark.createDataFrame([(1, f"x\n\n{GOOD}"), (2, "x\n\nbad"), (3, "boom")], "id long, prompt string").repartition(3)

    def provider(prompts):
        if "boom" in prompts[0]:
            raise RuntimeError("no service")
        return generation.echo_provider(prompts)

    out = {r.id: r for r in generation.generate(rows, provider).collect()}
    assert out[1].answer == GOOD and out[1].invalid_reason is None and out[2].answer is None and out[2].invalid_reason == "missing_label" and out[3].invalid_reason == "api_error"
    fixed = generation.generate(rows, provider, repair=lambda a: F.concat(F.lit("repair\n\n"), F.lit(GOOD))).collect()
    assert all(r.answer == GOOD for r in fixed)
    q = spark.createDataFrame([(1, "a")], "query_id long, query string")
    assert generation.search(q, lambda s: [{"title": s, "score": 1}]).first().title == "a" and "ZeroDivision" in generation.search(q, lambda s: 1 / 0).first().error


def test_stream_changes(spark, tmp_path):
    schema = "caseid long, time_sec double, track string, value double, ts timestamp"
    for k, rows in enumerate([[(1, 0.0, "a", 1.0), (1, 1.0, "a", 5.0), (2, 0.0, "a", 1.0)], [(1, 2.0, "a", 9.0), (2, 1.0, "a", None)], [(2, 2.0, "a", 90.0), (2, 3.0, "a", 1.0)]]):
        df = spark.createDataFrame([(*r, None) for r in rows], schema).coalesce(1)
        df.write.mode("append").parquet(str(tmp_path / "in" / f"b={k}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
    q = changes.stream_changes(stream, 3.0).writeStream.format("memory").queryName("changed").option("checkpointLocation", str(tmp_path / "cp")).outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    got = spark.sql("select caseid, time_sec, delta from changed").collect()
    assert sorted(map(tuple, got)) == [(1, 1.0, 4.0), (1, 2.0, 4.0), (2, 3.0, -89.0)]


def test_expected_units_and_descriptions(spark):
    s = lambda v: F.lit(v).cast("string")
    n = lambda v: F.lit(v).cast("double")
    unit = lambda key, kind=None, rate=None, source=None: one(spark, policy.expected_unit(s(key), s(source), s(kind), n(rate)))
    assert [unit("ARR_EVENT"), unit("PHE_RATE", source="periodic"), unit("SEVO_ET_RATE"), unit("MAC_RATE"), unit("PPF20_VOL", "bolus_like_event", 9), unit("EPH_VOL", "continuous_infusion", 0), unit("EPH_VOL", "continuous_infusion"), unit("NOR_RATE"), unit("X")] == [None, None, "vol%", "MAC", "mL", "mL/h", "mL", "mL/h", None]
    value = lambda u, *v: one(spark, policy.expected_value(s(u), *map(n, v)))
    assert [value("mL/h", 0, 7, 1, 1, 1), value("mL", 1, 1, None, -2, 1), value("MAC", 1, 1, 1, 1, 0.8), value(None, 1, 1, 1, 1, 1)] == [7.0, 2.0, 0.8, None]
    names = ("before", "after", "delta", "smoothed_rate", "smoothed_delta")
    event = lambda key, v: F.struct(s(key).alias("key"), s("AF").alias("label"), *[n(x).alias(c) for c, x in zip(names, v)], *[n(None).alias(c) for c in ("dt_sec", "rate_per_h", "smoothed_dt_sec")])
    say = lambda kind, key, *v: one(spark, policy.describe(event(key, v), s(kind)))
    assert say("rate_adjustment", "NOR_RATE", 1, 2.5, 1.5, None, None) == "去甲肾上腺素泵速：1.000 -> 2.500（变化 +1.500）"
    assert say("rate_adjustment", "X_RATE", 1, 2.5, 1.5, None, None) == "X_RATE：1.000 -> 2.500（变化 +1.500）"
    assert say("rate_adjustment", "SEVO_ET_RATE", None, 2, 1, None, None) == "七氟烷呼气末浓度：浓度变化 +1.000 vol%"
    assert say("bolus_like_event", "PPF20_VOL", 1, 2, 1, 60, 2.25) == "单次追加推注丙泊酚约 2.2 mL" and say("arrhythmia_event", "ARR_EVENT", 1, 2, 1, None, None) == "心律事件标注：AF"
    assert [one(spark, policy.verdict_score(s(v))) for v in (" Aligned", "unavailable", "x")] == [3, -1, 0]


def test_answers_are_normalised(spark):
    t = lambda c: one(spark, c)
    flat = "Q: a A: 【临床推理】：b 【决策干预（Miller）】：c 【决策干预（VitalDB）】：d"
    four = "Q: a\nA: 【临床推理】：b\n【决策干预（Miller）】：c\n【决策干预（VitalDB）】：d"
    assert t(qa.four_lines(F.lit(flat))) == four and t(qa.four_lines(F.lit(" "))) is None
    assert t(qa.with_locator(F.lit(four), F.lit("[M10 | p.4]"))).split("\n")[2] == "【决策干预（Miller）】：c [M10 | p.4]"
    assert t(qa.without_index(F.lit("[M10#3 | x] [ M10#4 ]"))) == "[M10 | x] [M10]"
    assert t(qa.rendered(F.lit("q：x"), F.lit(None).cast("string"), F.lit("m"), F.lit(" "))).startswith("Q: x\nA: 【临床推理】：请结合")
    poor = lambda s: t(qa.poor_payload(F.try_parse_json(F.lit(s))))
    assert [poor('{"miller_decision": "give"}'), poor('{"miller_decision": "g"}'), poor('{"x": 1}'), poor("{"), poor('{"miller_decision": "指令冲突!"}')] == [False, True, True, True, True]


def test_outlines_and_prefixes(spark):
    df = spark.createDataFrame([("b", "1 Heart", 1, 9), ("b", "Chapter 1: Heart", 0, 12), ("b", "notes", 0, 1), ("b", "2 Lung", 0, 30)], "source string, title string, depth int, page long")
    assert sorted((r.page, r.chapter) for r in retrieval.outline_starts(df).collect()) == [(12, "1 Heart"), (30, "2 Lung")]
    prefix = one(spark, retrieval.structure_prefix(F.lit("B"), F.lit("1 Heart"), F.lit(" ")))
    assert prefix == "[书籍: B, 章节: 1 Heart]" and one(spark, retrieval.chapter_of_prefix(F.lit(prefix + " text"))) == "1 Heart"


def test_judging_generated_text(spark):
    df = spark.createDataFrame([(1, 60.0, 80.0, 98.0, 50.0, None, 0.0, 0.0, 0.0, 5.0, "x", "y", True, "increase propofol"), (2, 60.0, 80.0, 98.0, 50.0, None, 0.0, 0.0, 0.0, 5.0, "x", "y", True, " ")], STATE + ", said string")
    got = {r.ord: (r.verdict, r.high_risk) for r in policy.judge_text(df, "said").collect()}
    assert got == {1: ("misaligned", True), 2: ("unavailable", False)}
