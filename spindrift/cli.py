"""Command line: ``python -m spindrift.cli STAGE --config FILE --set name=value ...``.

A run is described by one flat configuration; a JSON file changes its defaults and ``--set`` changes both. Keys of
services come from the environment variable that the configuration names and are never written anywhere. Every stage
reads what the stage before it has written under ``out``.
"""

from __future__ import annotations

import argparse
import json
import os
from dataclasses import asdict, dataclass, fields, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.values import case_id
from .operators import anchors, cases, curate, intents, policy, qa, retrieval, series
from .plans import generation, snapshots
from .sources import readers, writers


@dataclass(frozen=True)
class RunConfig:
    cases: str = ""
    signals: str = ""
    corpus: str = ""
    out: str = "out"
    departments: str = ""
    least_duration: float = 30.0
    most_cases: int = 0
    keep_sources: bool = False
    medicated_only: bool = True
    window_sec: float = 300.0
    least_points: int = 60
    rate_delta: float = 0.5
    volume_delta: float = 0.03
    gap_sec: float = 30.0
    per_case: int = 3
    top_k: int = 3
    chunk_chars: int = 1200
    chunk_overlap: int = 200
    endpoint: str = ""
    model: str = ""
    key_variable: str = "OPENAI_API_KEY"
    max_tokens: int = 2048
    repair: bool = True
    mix_ratio: float = 0.8
    mix_most: int = 0
    review_rate: float = 0.05
    choose: str = "diverse"
    choose_n: int = 0

    def snapshot(self) -> snapshots.SnapshotConfig:
        anchor = anchors.AnchorConfig(rate_delta=self.rate_delta, volume_delta=self.volume_delta, gap_sec=self.gap_sec, per_case=self.per_case)
        return snapshots.SnapshotConfig(window_sec=self.window_sec, least_points=self.least_points, anchor=anchor)

    def provider(self) -> generation.Provider:
        """The configured service, or the stand-in without a network if there is none."""
        if not self.endpoint:
            return generation.echo_provider
        return generation.ChatEndpoint(self.endpoint, self.model, os.environ.get(self.key_variable, ""), self.max_tokens)


def load_config(path: str | None, changes: list[str]) -> RunConfig:
    """The defaults, a JSON file's values, and ``name=value`` changes, each with its field's type."""
    kinds = {f.name: type(f.default) for f in fields(RunConfig)}
    values: dict = {}
    if path:
        with open(path, encoding="utf-8") as f:
            values |= json.load(f)
    values |= dict(c.split("=", 1) for c in changes)
    if unknown := sorted(set(values) - set(kinds)):
        raise ValueError(f"unknown settings: {', '.join(unknown)}")

    def of(name: str, value):
        if kinds[name] is bool and isinstance(value, str):
            return value.strip().lower() in ("1", "true", "yes", "on")
        return kinds[name](value)

    return replace(RunConfig(), **{n: of(n, v) for n, v in values.items()})


def run_cases(spark: SparkSession, cfg: RunConfig) -> DataFrame:
    """Cases that qualify, with their groups, written by group."""
    table = readers.read_cases(spark, cfg.cases)
    departments = [d for d in cfg.departments.split(",") if d.strip()]
    chosen = cases.select_cases(table, "caseid", cfg.least_duration, cfg.most_cases, departments, cfg.keep_sources)
    if cfg.medicated_only and cfg.signals:
        chosen = chosen.join(series.medicated_cases(_signals(spark, cfg), cfg.rate_delta, cfg.volume_delta), "caseid", "left_semi")
    writers.write_groups(chosen, f"{cfg.out}/groups")
    return chosen


def _signals(spark: SparkSession, cfg: RunConfig) -> DataFrame:
    rows = readers.read_signals(spark, cfg.signals)
    return rows if "ord" in rows.columns else rows.withColumn("ord", F.lit(0).cast("long"))


def run_snapshots(spark: SparkSession, cfg: RunConfig) -> DataFrame:
    """Nested records of all events of the chosen cases, as JSON lines."""
    held = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(f"{cfg.out}/groups/clinical_subset")
    held = held.withColumn("caseid", case_id(F.col("caseid")))
    rows = _signals(spark, cfg).join(held.select("caseid"), "caseid", "left_semi")
    drug = F.col("track").rlike("_(?:RATE|VOL)$")
    flat = snapshots.snapshots(rows.filter(drug), rows.filter(~drug), cfg.snapshot())
    records = snapshots.nested(flat, held, cfg.snapshot())
    writers.write_json_lines(records, f"{cfg.out}/snapshots")
    return records


def run_retrieve(spark: SparkSession, cfg: RunConfig) -> DataFrame:
    """The best passages of the corpus for each record, by keywords and vectors together."""
    records = readers.read_records(spark, f"{cfg.out}/snapshots")
    get = lambda path: F.try_variant_get("record", f"$.{path}", "string")
    flags = F.try_variant_get("record", "$.snapshot.clinical_assessment.risk_flags", "array<string>")
    query = F.concat_ws("; ", get("snapshot.surgery_type"), F.array_join(F.transform(flags, lambda h: intents.english(h)), "; "))
    queries = readers.numbered(records.select(query.alias("text"), F.to_json("record").alias("record")), "query_id")
    passages = readers.read_corpus(spark, cfg.corpus).select("chunk_id", F.explode(retrieval.chunks(F.col("text"), cfg.chunk_chars, cfg.chunk_overlap)).alias("text"))
    passages = readers.numbered(passages.select("text"), "chunk_id")
    pool = max(3 * cfg.top_k, 8)
    words = retrieval.bm25(passages, queries.select("query_id", "text"), pool)
    embed = lambda df, key: df.select(key, retrieval.embedded(F.col("text")).alias("vector"))
    found = retrieval.best_fused(retrieval.fused(words, retrieval.dense(embed(passages, "chunk_id"), embed(queries, "query_id"), pool)), cfg.top_k)
    log = retrieval.hit_log(retrieval.hit_rows(queries, found, passages))
    out = queries.select("query_id", "record").join(log, "query_id", "left")
    writers.write_json_lines(out, f"{cfg.out}/retrieval")
    return out


def run_generate(spark: SparkSession, cfg: RunConfig) -> DataFrame:
    """Answers for each record, checked, repaired once, and kept with the reason where they are not valid."""
    rows = readers.read_records(spark, f"{cfg.out}/retrieval" if cfg.corpus else f"{cfg.out}/snapshots")
    get = lambda path, kind="string": F.try_variant_get("record", f"$.{path}", kind)
    inner = F.coalesce(F.try_parse_json(get("record")), F.col("record"))
    rows = rows.select(inner.alias("record"), get("results", "array<struct<rank:int,chunk_id:long,score:double,passage:string>>").alias("hits"))
    key, done = get("snapshot.anchor_detail.medication_key"), get("snapshot.actual_intervention")
    kind, source = get("snapshot.interpreted_intervention_type"), get("snapshot.anchor_detail.anchor_source")
    number = lambda n: get(f"snapshot.anchor_detail.{n}", "double")
    unit = policy.expected_unit(key, source, kind, number("smoothed_rate_ml_per_h"))
    value = policy.expected_value(unit, number("smoothed_rate_ml_per_h"), number("inferred_rate_ml_per_h"), number("smoothed_delta_volume_ml"), number("delta"), number("after"))
    goal = generation.targets(done, key, policy.key_words(key), unit, value)
    evidence = generation.evidence_block(F.transform(F.coalesce("hits", F.array().cast("array<struct<rank:int,chunk_id:long,score:double,passage:string>>")), lambda h: F.struct(F.concat(F.lit("[M10 | "), h["chunk_id"].cast("string"), F.lit("]")).alias("locator"), h["passage"].alias("text"))))
    focus = generation.focus(kind, key, number("delta"), number("smoothed_delta_volume_ml"))
    prompts = rows.select(
        F.to_json("record").alias("record"), policy.key_words(key).alias("words"), unit.alias("unit"), value.alias("target"), goal.alias("goal"),
        generation.prompt(F.to_json(F.try_variant_get("record", "$.snapshot", "variant")), evidence, contract=generation.contract(), focus=F.concat_ws("\n\n", focus, goal)).alias("prompt"),
    )
    repair = (lambda answer: generation.repair_prompt(answer, F.col("goal"))) if cfg.repair else None
    out = generation.generate(prompts, cfg.provider(), repair=repair)
    out = out.withColumn("checks", qa.checked(F.col("answer"), F.col("words"), F.col("unit"), F.col("target")))
    writers.write_json_lines(out.drop("prompt", "goal"), f"{cfg.out}/answers")
    return out


def run_curate(spark: SparkSession, cfg: RunConfig) -> DataFrame:
    """Buckets of the answered records, the mix of two of them, and a sample to review."""
    rows = spark.read.json(f"{cfg.out}/answers").withColumn("r", F.try_parse_json("record"))
    detail = lambda n, kind="string": F.try_variant_get("r", f"$.snapshot.anchor_detail.{n}", kind)
    number = lambda n: detail(n, "double")
    verdict = F.when(F.col("is_valid"), "valid").otherwise("uncertain")
    b = curate.bucket(F.try_variant_get("r", "$.snapshot.interpreted_intervention_type", "string"), detail("medication_key"), number("before"), number("after"), number("delta"), number("smoothed_delta_volume_ml"), verdict)
    records = readers.numbered(rows.select("record", "answer", "is_valid", b.alias("b")), "id").select("id", "record", "answer", "is_valid", F.col("b.bucket").alias("training_bucket"), F.col("b.reason").alias("bucket_reason"))
    writers.write_buckets(records, f"{cfg.out}/buckets")
    mix = curate.ab_mix(records, ["id"], cfg.mix_ratio, cfg.mix_most, name="training_bucket")
    writers.write_json_lines(mix, f"{cfg.out}/mix")
    writers.write_json_lines(curate.review_sample(records, ["id"], cfg.review_rate), f"{cfg.out}/review")
    return mix


STAGES = {"cases": run_cases, "snapshots": run_snapshots, "retrieve": run_retrieve, "generate": run_generate, "curate": run_curate}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(prog="spindrift", description="Cases and signals to audited, training-ready records.")
    parser.add_argument("stage", choices=[*STAGES, "all", "config"])
    parser.add_argument("--config", help="a JSON file of settings")
    parser.add_argument("--set", action="append", default=[], metavar="NAME=VALUE", dest="changes")
    args = parser.parse_args(argv)
    cfg = load_config(args.config, args.changes)
    if args.stage == "config":
        print(json.dumps(asdict(cfg), indent=2))
        return
    session = spark or SparkSession.builder.appName("spindrift").getOrCreate()
    for name in STAGES if args.stage == "all" else [args.stage]:
        if name == "retrieve" and not cfg.corpus:
            continue
        STAGES[name](session, cfg)


if __name__ == "__main__":
    main()
