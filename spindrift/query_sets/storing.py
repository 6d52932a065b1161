"""Queries that write with the library's writers and read back with its readers, and prompts and answers of a provider."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import qa
from ..plans import generation
from ..sources import readers, signal_store, writers
from ..sources.storage import shared_dir
from .base import DAY, SIGNALS_SQL, START, signals, table
from .policy import _EVENTS_SQL, _events


def cases_round_trip(spark, sf_dir):
    """Cases as CSV by group and back: line ends and quotes inside fields, ids that are no numbers, absent ids."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    caseid = F.when(k % 7 == 0, "x").when(k % 7 == 1, F.concat(k.cast("string"), F.lit(".0"))).otherwise(k.cast("string"))
    rows = c.select(caseid.alias("caseid"), F.concat(F.lit('a "b"\n'), F.col("c_name")).alias("opname"), F.col("c_mktsegment").alias("surgery_group"))
    path = shared_dir(spark, "cases")
    rows.write.option("header", True).option("escape", '"').csv(f"{path}/all")
    cases = readers.read_cases(spark, f"{path}/all")
    writers.write_groups(cases, path)
    ids = spark.read.option("header", True).csv(f"{path}/caseids").select(F.col("caseid").cast("long").alias("caseid"), "surgery_group")
    return cases.join(ids, ["caseid", "surgery_group"]).select("caseid", "surgery_group", F.md5("opname").alias("md5"))


CASES = """SELECT c_custkey AS caseid, c_mktsegment AS surgery_group, md5('a "b"' || chr(10) || c_name) AS md5 FROM customer WHERE c_custkey % 7 <> 0"""


def signal_store_scan(spark, sf_dir):
    """All signals through a store by case and track: one track in two halves of the time, and all that these leave."""
    path = shared_dir(spark, "signals") + "/store"
    signal_store.write_signal_store(signals(spark, sf_dir).repartition(8, "caseid"), path)
    middle, track = START + 15 * DAY, "purchase"
    tests = {"early": [("track", "==", track), ("time_sec", "<", middle)], "late": [("track", "==", track), ("time_sec", ">=", middle)], "below": [("track", "<", track)], "above": [("track", ">", track)]}
    parts = [(signal_store.read_signal_store(spark, path, *t), name) for name, t in tests.items()]
    rows = [df.withColumn("part", F.lit(name)) for df, name in parts]
    whole = rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])
    return whole.groupBy("part", "caseid", "track").agg(F.count(F.lit(1)).alias("n"), F.sum("ord").alias("ords"), F.min("time_sec").alias("first"), F.max("time_sec").alias("last"))


STORE_SCAN = f"""WITH {SIGNALS_SQL}
SELECT CASE WHEN track = 'purchase' THEN CASE WHEN time_sec < {START} + 15 * {DAY} THEN 'early' ELSE 'late' END WHEN track < 'purchase' THEN 'below' ELSE 'above' END AS part, caseid, track,
  count(*) AS n, sum(ord)::BIGINT AS ords, min(time_sec) AS first, max(time_sec) AS last FROM signals GROUP BY ALL"""


def records_round_trip(spark, sf_dir):
    """Records as JSON lines and as one JSON array, and the snapshots inside them."""
    b = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("caseid"), F.struct(F.length("text").alias("n"), F.col("text").alias("t")).alias("snapshot"))
    path = shared_dir(spark, "records")
    writers.write_json_array(b, f"{path}/array.json")
    writers.write_json_lines(b, f"{path}/lines")
    array, lines = (readers.snapshots_of(readers.read_records(spark, f"{path}/{n}")) for n in ("array.json", "lines"))
    get = lambda name: [F.try_variant_get("record", "$.caseid", "long").alias("caseid"), F.md5(F.try_variant_get("snapshot", "$.t", "string")).alias(name)]
    return array.select(*get("md5")).join(lines.select(*get("md5_of_line")), "caseid")


RECORDS = "SELECT item_id AS caseid, md5(text) AS md5, md5(text) AS md5_of_line FROM benchmark"


def corpus_round_trip(spark, sf_dir):
    """Passages as JSON lines under other names, some of them blank or without a text, and back with their numbers."""
    d = table(spark, sf_dir, "documents")
    k = F.col("doc_id")
    text = F.when(k % 5 == 0, " ").otherwise(F.col("text"))
    rows = d.select(F.when(k % 2 == 0, text).alias("content"), F.when(k % 2 == 1, text).alias("body"), F.concat(F.lit("s"), k).alias("title"), F.when(k % 3 == 0, k.cast("string")).alias("page_no"))
    path = shared_dir(spark, "corpus")
    writers.write_json_lines(rows, path)
    back = readers.read_corpus(spark, path)
    n = back.agg(F.countDistinct("chunk_id").alias("n_ids"), (F.max("chunk_id") + 1).alias("n_chunks"), F.countDistinct("line_no").alias("n_lines"))
    return back.select("source", "page", F.length("text").alias("n_chars")).join(F.broadcast(n))


CORPUS = """WITH k AS (SELECT doc_id, trim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS t FROM documents WHERE doc_id % 5 <> 0), n AS (SELECT count(*)::BIGINT AS n FROM k WHERE t <> '')
SELECT 's' || doc_id AS source, CASE WHEN doc_id % 3 = 0 THEN doc_id::VARCHAR END AS page, length(t)::INTEGER AS n_chars, n AS n_ids, n AS n_chunks, n AS n_lines FROM k, n WHERE t <> ''"""


def medication_scan(spark, sf_dir):
    """Signals of chosen tracks from Parquet, one value for each step of six hours."""
    path = shared_dir(spark, "signals")
    s = signals(spark, sf_dir).withColumn("value", F.when(F.col("ord") % 4 == 0, float("nan")).otherwise(F.col("value")))
    s.write.parquet(f"{path}/table")
    out = readers.read_medication(spark, f"{path}/table", ["click", "view"], 21600.0)
    return out.select("caseid", "track", "time_sec", "value")


MEDICATION = f"""WITH {SIGNALS_SQL} SELECT caseid, track, floor(time_sec / 21600.0) * 21600.0 AS time_sec, max_by(CASE WHEN ord % 4 <> 0 THEN value END, CASE WHEN ord % 4 <> 0 THEN time_sec + ord * 1e-9 END) AS value
FROM signals WHERE track IN ('click', 'view') GROUP BY 1, 2, 3"""


def buckets_written(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_returnflag").alias("training_bucket"))
    path = shared_dir(spark, "buckets")
    counts = writers.write_buckets(li, f"{path}/all")
    back = spark.read.json(f"{path}/all").groupBy("training_bucket").agg(F.count(F.lit(1)).alias("n_back"))
    return counts.join(back, "training_bucket")


BUCKETS = "SELECT l_returnflag AS training_bucket, count(*)::BIGINT AS n, count(*)::BIGINT AS n_back FROM lineitem GROUP BY 1"


def cleaning_pass(spark, sf_dir):
    """Counts of a cleaning pass, and how many rows its file holds."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("text").alias("before"))
    rows = c.withColumn("after", F.when(F.col("turn") % 4 == 3, " ").when(F.col("turn") % 4 == 2, F.upper("before")).otherwise(F.col("before"))).withColumn("strict", F.col("turn") % 2 == 0)
    path = shared_dir(spark, "cleaned") + "/rows"
    counts = writers.write_cleaned(rows, "before", "after", "strict", path)
    return counts.join(F.broadcast(spark.read.text(path).agg(F.count(F.lit(1)).alias("written"))))


CLEANING = """SELECT count(*)::BIGINT AS total, count(*) FILTER (turn % 4 = 3 OR (turn % 4 = 2 AND upper(text) <> text))::BIGINT AS changed, count(*) FILTER (turn % 2 = 0)::BIGINT AS strict, count(*) FILTER (turn % 4 = 3)::BIGINT AS dropped,
  count(*) FILTER (turn % 4 <> 3)::BIGINT AS written FROM conversations"""


def index_round_trip(spark, sf_dir):
    """An index of vectors under its signature; another signature finds none."""
    v = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("chunk_id"), "embedding")
    path = shared_dir(spark, "index") + "/table"
    good = readers.index_signature("p", "m", 1200, 200, 1, 2)
    writers.write_index(v, path, good)
    other = readers.read_index(spark, path, readers.index_signature("p", "m", 1200, 200, 1, 3))
    return readers.read_index(spark, path, good).select("chunk_id", F.size("embedding").alias("dim"), F.lit(other is None).alias("stale"))


INDEX = "SELECT vec_id AS chunk_id, len(embedding)::INTEGER AS dim, true AS stale FROM embeddings"


def plot_points(spark, sf_dir):
    s = signals(spark, sf_dir).withColumn("value", F.when(F.col("ord") % 3 != 0, F.col("value")))
    out = writers.plot_data(s, ["caseid", "track"])
    return out.select("caseid", "track", "ord", F.round("filled", 4).alias("filled"), "n_valid", "n_total")


PLOT = f"""WITH {SIGNALS_SQL}, s AS (SELECT caseid, track, ord, time_sec, CASE WHEN ord % 3 <> 0 THEN value END AS value FROM signals),
p AS (SELECT *, last_value(value IGNORE NULLS) OVER b AS av, last_value(CASE WHEN value IS NOT NULL THEN time_sec END IGNORE NULLS) OVER b AS a_t, first_value(value IGNORE NULLS) OVER f AS bv, first_value(CASE WHEN value IS NOT NULL THEN time_sec END IGNORE NULLS) OVER f AS b_t,
  count(value) OVER (PARTITION BY caseid, track)::BIGINT AS n_valid, count(*) OVER (PARTITION BY caseid, track)::BIGINT AS n_total FROM s
  WINDOW b AS (PARTITION BY caseid, track ORDER BY time_sec ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), f AS (PARTITION BY caseid, track ORDER BY time_sec ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT caseid, track, ord, round(coalesce(value, av + (bv - av) * (time_sec - a_t) / CASE WHEN b_t - a_t > 0 THEN b_t - a_t END, av, bv), 4) AS filled, n_valid, n_total FROM p"""


def evaluation_export(spark, sf_dir):
    """Rows with lists as CSV with a byte order mark, and their summary."""
    n = table(spark, sf_dir, "nation").select("n_nationkey", F.array(F.col("n_name"), F.lit("x")).alias("names"))
    path = shared_dir(spark, "evaluation")
    writers.write_evaluation(n, n.agg(F.count(F.lit(1)).alias("total")), path)
    back = spark.read.csv(f"{path}/table")
    head = F.col("_c0").startswith(writers.BOM) | (F.col("_c0") == "n_nationkey")
    total = spark.read.json(f"{path}/summary").select(F.col("total").cast("long").alias("total"))
    return back.filter(~head).select(F.col("_c0").cast("int").alias("n_nationkey"), F.col("_c1").alias("names")).join(F.broadcast(total))


EVALUATION = "SELECT n_nationkey, n_name || ';x' AS names, (SELECT count(*) FROM nation)::BIGINT AS total FROM nation"


def question_focus(spark, sf_dir):
    """What a question is about, and which example it gets."""
    e = lambda n: F.col(f"e.{n}")
    rows = _events(spark, sf_dir)
    said = generation.focus(F.col("kind"), e("key"), e("delta") / 2, e("smoothed_delta"))
    example = generation.example_for(F.col("kind"), {"continuous_infusion": "steady", "bolus_like_event": "bolus", "arrhythmia_event": "rhythm"})
    return rows.select("ord", said.alias("focus"), example.alias("example"))


def _focus(what: str) -> str:
    return "'" + generation.FOCUS.format(what) + "'"


FOCUS = f"""WITH {_EVENTS_SQL} SELECT ord, CASE WHEN kind = 'rate' AND suffix(key, '_RATE') AND delta / 2 < 1 THEN {_focus(generation.MILD)} WHEN kind IN ('steady', 'none') THEN {_focus(generation.STEADY)} ELSE {_focus(generation.ACTIVE)} END AS focus,
  CASE kind WHEN 'bolus' THEN 'bolus' WHEN 'rhythm' THEN 'rhythm' ELSE 'steady' END AS example FROM kd"""


def generated_answers(spark, sf_dir):
    """Answers of a provider that repeats the end of its prompt: good ones, ones that need a repair, none, and failures."""
    c = table(spark, sf_dir, "conversations")
    v = (F.col("conv_id") + F.col("turn")) % 4
    good = 'Q: x，措施是什么？\nA: 【临床推理】：y\n【决策干预（Miller）】：诊断依据：a; 具体干预：b; 原文摘录："c" [M10 | p.4]\n【决策干预（VitalDB）】：d'
    last = F.when(v == 0, good).when(v == 1, "no format").when(v == 2, "boom").otherwise(" ")
    rows = c.select("conv_id", "turn", generation.prompt(last, evidence=F.to_json(F.struct("text")), contract=generation.contract()).alias("prompt"))

    def provider(prompts: list[str]) -> list[str]:
        return ["" if p.endswith("boom") else generation.echo_provider([p])[0] for p in prompts]

    mended = lambda a: F.when(F.contains(a, F.lit("no format")), F.concat(F.lit("again\n\n"), F.lit(good))).otherwise(F.lit("again\n\nstill nothing"))
    out = generation.generate(rows, provider, repair=mended)
    return out.select("conv_id", "turn", "is_valid", "invalid_reason", F.md5("answer").alias("md5"))


_GOOD = "'Q: x，措施是什么？' || chr(10) || 'A: 【临床推理】：y' || chr(10) || '【决策干预（Miller）】：诊断依据：a; 具体干预：b; 原文摘录：\"c\" [M10 | p.4]' || chr(10) || '【决策干预（VitalDB）】：d'"
ANSWERS = f"""SELECT conv_id, turn, (conv_id + turn) % 4 < 2 AS is_valid, CASE WHEN (conv_id + turn) % 4 >= 2 THEN 'missing_label' END AS invalid_reason, CASE WHEN (conv_id + turn) % 4 < 2 THEN md5({_GOOD}) END AS md5 FROM conversations"""

REGISTER = [
    ("signal_store_scan", signal_store_scan, STORE_SCAN),
    ("cases_round_trip", cases_round_trip, CASES),
    ("records_round_trip", records_round_trip, RECORDS),
    ("corpus_round_trip", corpus_round_trip, CORPUS),
    ("medication_scan", medication_scan, MEDICATION),
    ("buckets_written", buckets_written, BUCKETS),
    ("cleaning_pass", cleaning_pass, CLEANING),
    ("index_round_trip", index_round_trip, INDEX),
    ("plot_points", plot_points, PLOT),
    ("evaluation_export", evaluation_export, EVALUATION),
    ("question_focus", question_focus, FOCUS),
    ("generated_answers", generated_answers, ANSWERS),
]
