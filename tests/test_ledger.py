"""Calls that happen once: counted in a file, since tasks run in processes of their own."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from spindrift.plans import generation, ledger


def counting(log, then=None):
    def provider(prompts):
        out = []
        for p in prompts:
            if then:
                then(p)
            with open(log, "a") as f:
                f.write(p.replace("\n", " ") + "\n")
            out.append(f"{p}:{uuid.uuid4().hex}")
        return out

    return provider


def asked(log):
    return sorted(open(log).read().splitlines()) if os.path.exists(log) else []


def test_each_prompt_is_asked_once_though_answers_vary(spark, tmp_path):
    log = str(tmp_path / "log")
    rows = spark.createDataFrame([(i, f"p{i % 10}" if i else None) for i in range(200)], "id long, prompt string")
    valid = lambda a: F.rlike(a, F.lit("[02468]$"))  # noqa: E731 - about half of the answers, by chance
    out = generation.generate(rows, counting(log), valid=valid, repair=lambda a: F.concat(F.lit("again "), F.coalesce(a, F.lit("")))).cache()
    got = out.collect()
    assert sorted(r.id for r in got) == list(range(200))
    said = asked(log)
    assert len(said) == len(set(said)) and {p for p in said if not p.startswith("again")} == {"", *[f"p{i}" for i in range(10)]}
    assert all((r.answer is None) == (r.invalid_reason is not None) for r in got)


def test_a_killed_task_leaves_its_answers(spark, tmp_path):
    log, ledger_at, flag = str(tmp_path / "log"), f"file://{tmp_path}/ledger", tmp_path / "dies"
    rows = spark.range(60).select(F.concat(F.lit("q"), "id").alias("request"))
    flag.touch()

    def dies(prompt):
        if flag.exists() and os.path.exists(log) and len(open(log).readlines()) >= 20:  # names of this module are unknown to workers
            os._exit(1)

    with pytest.raises(Exception):
        ledger.once(rows, counting(log, dies), "svc", ledger=ledger_at, batch=1, lanes=2).collect()
    before = asked(log)
    assert 20 <= len(before) < 60
    flag.unlink()
    got = ledger.once(rows, counting(log, dies), "svc", ledger=ledger_at, batch=1, lanes=3).collect()
    assert asked(log) == sorted(f"q{i}" for i in range(60)) and len(got) == 60
    assert {r.answer.split(":")[0] for r in got} == {f"q{i}" for i in range(60)}
    again = ledger.once(rows, counting(log, dies), "svc", ledger=ledger_at).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got)) and len(asked(log)) == 60
    ledger.once(rows.limit(1), counting(log), "other", ledger=ledger_at).collect()
    assert len(asked(log)) == 61


def test_failed_calls_are_asked_again(spark, tmp_path):
    log, at, flag = str(tmp_path / "log"), f"file://{tmp_path}/ledger", tmp_path / "down"
    flag.touch()

    def down(prompt):
        if flag.exists() and prompt.endswith("3"):
            raise ConnectionError("down")

    rows = spark.range(10).select(F.col("id").cast("string").alias("request"))
    got = ledger.once(rows, counting(log, down), "svc", ledger=at, batch=1).collect()
    assert [r.error for r in got if r.error] == ["ConnectionError: down"]
    flag.unlink()
    assert all(r.error is None for r in ledger.once(rows, counting(log, down), "svc", ledger=at).collect())
    assert asked(log) == [str(i) for i in range(10)]
    assert ledger.once(rows.filter("false"), counting(log), "svc").collect() == []


def test_lanes_keep_to_a_rate(spark, tmp_path):
    import time

    log = str(tmp_path / "log")
    began = time.monotonic()
    rows = spark.range(6).select(F.col("id").cast("string").alias("request"))
    ledger.once(rows, counting(log), "svc", batch=1, lanes=1, per_second=4.0).collect()
    assert time.monotonic() - began >= 5 / 4.0


def test_each_query_is_searched_once(spark, tmp_path):
    log = str(tmp_path / "log")

    def find(query):
        with open(log, "a") as f:
            f.write(query + "\n")
        if query == "bad":
            raise ValueError("no")
        return [{"title": query, "url": "u", "snippet": "s", "score": k} for k in range(2)] if query != "none" else []

    q = spark.createDataFrame([(1, "a"), (2, "a"), (3, "none"), (4, "bad")], "query_id long, query string")
    got = sorted((r.query_id, r["rank"], r.title, r.score, r.error) for r in generation.search(q, find).filter("error is null").collect())
    assert got == [(i, k + 1, "a", float(k), None) for i in (1, 2) for k in range(2)] and asked(log) == ["a", "bad", "none"]
    assert [(r.query_id, r.error) for r in generation.search(q, find).filter("error is not null").collect()] == [(4, "ValueError: no")]
