"""Quality rules in DataFrame expressions: counts per text and a hashed n-gram log-likelihood ratio.

Every text gives word unigrams, word bigrams and word-final character trigrams, each hashed into one of ``BUCKETS``.
Two multinomials over the buckets are counted: of trusted texts (every labelled row with quality 1) and of the raw
corpus (every row). A text's score is the sum of log(trusted / raw) over
its n-grams, divided by their number; a text below ``THRESHOLD`` is not kept.

Defined results: a null or empty text has no words, all counts 0, score 0 and fails the base rules; repeated rows are
judged alike, each on its own; texts of any length are read whole; a score equal to the threshold is kept; an empty table
gives an empty result; extra columns, whatever their names, are ignored; labels that are null or point nowhere have no
effect.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chosen, joined_small, words_of

BUCKETS = 1 << 14
THRESHOLD = -0.05
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
SMOOTHING = 1.0
SYMBOLS = "[#*$%&|<>]"
RULE_COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept")


def gram_buckets(word: Column, following: Column) -> list[Column]:
    """Buckets of the n-grams that start at a word: the word, its end, and the word with the next one (null: none)."""
    at = lambda *x: F.pmod(F.xxhash64(*x), F.lit(BUCKETS)).cast("int")
    return [at(word), at(F.lit("end"), F.substring(word, -3, 3)), at(F.lit("two"), word, following)]


def word_pairs(words: Column) -> Column:
    """Each word with the word that follows it, so that a row made of it carries two words and not the whole text."""
    return F.arrays_zip(words.alias("word"), F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))).alias("following"))


def exploded(texts: DataFrame, *keep: str) -> DataFrame:
    """A row for each word with the word that follows it. Rows stay in place; what follows is compiled code."""
    words = texts.select(*keep, words_of(F.col("text")).alias("__w"))
    pairs = words.select(*keep, F.explode(word_pairs(F.col("__w"))).alias("__p"))
    return pairs.select(*keep, F.col("__p.word").alias("word"), F.col("__p.following").alias("following"))


def gram_counts(texts: DataFrame) -> DataFrame:
    """(bucket, n, n_trusted) over all rows of (text, trusted); counts are summed before the shuffle."""
    grams = exploded(texts, "trusted").select("trusted", F.explode(F.array(*gram_buckets(F.col("word"), F.col("following")))).alias("bucket"))
    return grams.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("trusted"), 1)).alias("n_trusted"))


def log_ratios(docs: DataFrame, labels: DataFrame) -> list[float]:
    """log(trusted / raw) of every bucket, ``BUCKETS`` numbers; the raw distribution smooths the trusted one."""
    good = chosen(labels, "doc_id", "quality").filter("quality = 1 and doc_id is not null").select("doc_id").distinct()
    flags = good.select("doc_id", F.lit(True).alias("trusted"))
    texts = joined_small(chosen(docs, "doc_id", "text"), flags, "doc_id").select("text", F.coalesce("trusted", F.lit(False)).alias("trusted"))
    n, n_trusted = [SMOOTHING] * BUCKETS, [0.0] * BUCKETS
    for row in gram_counts(texts).collect():  # a row per bucket at most
        n[row.bucket] += row.n
        n_trusted[row.bucket] = float(row.n_trusted)
    total, good_total = sum(n), sum(n_trusted)
    weight = SMOOTHING * BUCKETS
    return [math.log((t + weight * x / total) / (good_total + weight) / (x / total)) for x, t in zip(n, n_trusted)]


def repeat_words(hashes: Column) -> Column:
    """Words inside windows of ``WINDOW`` words that occur twice or more, the first occurrence included.

    ``hashes`` has a 64-bit hash for each window, by position. Equal windows lie side by side once sorted; the
    positions of those with an equal neighbour then cover ``WINDOW`` words each, less what the next one covers too.
    """
    sorted_ = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def positions(s: Column) -> Column:
        twin = lambda x, j: (F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"])
        return F.array_sort(F.transform(F.filter(s, lambda x, j: F.coalesce(twin(x, j), F.lit(False))), lambda x: x["i"]))

    # a one-element array around a value lets an expression be named once and used twice
    found = F.get(F.transform(F.array(sorted_), positions), F.lit(0))
    covered = lambda p: F.aggregate(F.transform(p, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - x, F.lit(WINDOW)))), F.lit(0), lambda a, b: a + b)
    total = F.get(F.transform(F.array(found), covered), F.lit(0))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(total)


def quality_rules(docs: DataFrame, ratios: list[float], threshold: float = THRESHOLD) -> DataFrame:
    """doc_id and the columns of ``RULE_COLUMNS`` for each row of ``docs``.

    Words are exploded where their row lies and summed up again by row before the shuffle, so that only one small row
    for each text moves.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = chosen(docs, "doc_id", "text").select("doc_id", "text", words_of(F.col("text")).alias("__w"), lines.alias("__lines"))
    w = F.col("__w")
    last = F.size(w) - WINDOW + 1
    starts = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    df = df.withColumn("__windows", F.transform(starts, lambda i: F.xxhash64(F.slice(w, i, WINDOW))))
    df = df.select(
        F.monotonically_increasing_id().alias("__at"),
        "doc_id",
        "__w",
        F.size("__w").cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("__windows")).cast("long").alias("n_repeat_words"),
    )
    table = F.split(F.lit(",".join(f"{r:.9g}" for r in ratios)), ",").cast("array<double>")  # folded to one literal
    each = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    rows = df.select("__at", *each, F.explode_outer(word_pairs(F.col("__w"))).alias("__p"))
    ratio = sum((F.get(table, b) for b in gram_buckets(F.col("__p.word"), F.col("__p.following"))), F.lit(0.0))
    score = F.sum(F.when(F.col("__p").isNotNull(), ratio).otherwise(0.0))
    df = rows.groupBy("__at", *each).agg(score.alias("__sum"))
    df = df.select(*each, F.when(F.col("n_words") > 0, F.col("__sum") / (3 * F.col("n_words"))).otherwise(0.0).alias("score"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return df.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
