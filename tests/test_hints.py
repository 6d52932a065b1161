"""Hints in English: one rewrite told by a text's beginning against all in their order, and what of them is compiled."""

import re

from pyspark.sql import functions as F

from spindrift.functions.values import those_of
from spindrift.operators import assessment as a
from spindrift.operators import intents as i
from spindrift.query_sets import searching

SAMPLES = [re.sub(r"\(\[\\d\.\]\+\)", "7.5", pattern).replace("\\", "") for pattern, _ in i.HINTS]


def in_order(text):
    for pattern, said in i.HINTS:
        text = re.sub(pattern, re.sub(r"\$(\d)", r"\\\1", said), text)
    return {"M": "male", "F": "female"}.get(text, text)


def test_a_text_is_rewritten_as_by_all_rewrites_in_order(spark):
    broken = [s[:-1] for s in SAMPLES] + [s.replace("7.5", "x") for s in SAMPLES] + [s[1:] for s in SAMPLES]
    around = [f"{x}{s}{y}" for s in SAMPLES for x, y in (("", " "), (" ", ""), ("a; ", "; b"), ("重度", ""), ("", "。"), ("", s), ("", f"；{SAMPLES[1]}"), (SAMPLES[0], ""))]
    texts = ["", "M", "F", " M", "m", "plain", "心律事件标注：vf", "心律事件标注：M", *SAMPLES, *broken, *around]
    found = [r[0] for r in spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k long, t string").coalesce(1).sortWithinPartitions("k").select(i.english(F.col("t"))).collect()]
    assert found == [in_order(t) for t in texts]
    assert spark.range(1).select(i.english(F.lit(None).cast("string"))).first()[0] == ""
    assert [r[0] for r in spark.createDataFrame([(["M", None, SAMPLES[0]],), ([],), (None,)], "t array<string>").select(i.all_english(F.col("t"))).collect()] == [["male", "", in_order(SAMPLES[0])], [], None]


def test_no_earlier_rewrite_matches_what_a_later_one_clears():
    """So a text that its own rewrite leaves without anything beyond ASCII needs no other."""
    for k, (pattern, said) in enumerate(i.HINTS):
        assert said.isascii()
        runs = re.findall(r"[^\x00-\x7f]+", pattern)
        assert not any(i._NEEDED[j] in run for j in range(k) for run in [*runs, runs[-1] + runs[0]]), pattern


def test_texts_that_are_there(spark):
    df = spark.createDataFrame([("a", None, "b"), (None, None, None), ("a", "a", "")], "x string, y string, z string")
    assert [r[0] for r in df.select(those_of("x", "y", "z")).collect()] == [["a", "b"], [], ["a", ""]]


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_flags_and_tags_are_compiled(spark):
    """Before, flags, notes and tags stood below lambdas, which are interpreted with all that they are applied to."""
    sf = "/root/testdata/sf0.001"
    assert "lambda" not in plan_of(searching._assessed(spark, sf).select(a.notes()))
    for df in (searching.english_flags(spark, sf), searching.intent_tags_full(spark, sf)):
        above, made = plan_of(df).splitlines()[:2]
        assert "severe hypotension" in above and "AS flags" in made and "array_except(array(CASE" in made
        assert not any(f"{f}(array(CASE" in line for f in ("filter", "transform", "slice") for line in (above, made))
