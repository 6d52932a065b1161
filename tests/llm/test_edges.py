"""Columns whose names clash, plain versions of what is learned and scored, and segments beyond any bound."""

import math
import random
import re
from unittest.mock import MagicMock

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from spindrift.llm import common, language_id, mixing, piece_bpe, quality_rules, rule_ensemble, simhash, token_files, warc
from spindrift.llm import chat_format as chat

SF = "/root/testdata/sf0.001"
PIECES = public_tokenizers.path("piece_bpe_32k.model")
#: Names that differ in case alone from those an operator needs or makes, hold dots, or look like its own.
CLASHES = ("a.b", "Score", "__stats", "IDS", "Decoded", "LANG_PRED", "TEXT", "c0", "in_text", "key", "row", "`q`")


def clashing(spark, rows=((1, "the good house stands here", "en", "s"), (2, None, None, None), (2, "the good house stands here", "en", "s"))):
    df = spark.createDataFrame([(*r, *(["x"] * len(CLASHES))) for r in rows], ", ".join(f"c{k} {'long' if k == 0 else 'string'}" for k in range(4 + len(CLASHES))))
    return df.toDF("doc_id", "text", "lang", "source", *CLASHES)


def test_clashing_columns_are_kept(spark):
    df = clashing(spark)
    base = ["doc_id", "text", "lang", "source"]
    model = language_id.fit_languages(df)
    for out, made in (
        (language_id.predict_languages(df, model), ["lang_pred", "score"]),
        (rule_ensemble.score_quality(df, rule_ensemble.fit_quality(df, df.select("doc_id", F.lit(1).alias("quality")))), ["score"]),
        (piece_bpe.encode_documents(df, PIECES, decode=True), ["ids", "decoded"]),
        (mixing.mix_rows(df), []),
        (simhash.keep_one(df), []),
    ):
        assert out.columns == base + [c for c in CLASHES if c.lower() not in made] + made
        rows = out.collect()
        assert rows and all(r[out.columns.index("a.b")] == "x" for r in rows)


def test_clashing_columns_are_ignored(spark):
    df = clashing(spark)
    assert simhash.near_duplicates(df).count() == 3 and mixing.mix_plan(df).count() == 3
    assert token_files.read_shards(token_files.write_shards(df, public_tokenizers.path("word_bpe_49k.json"), 2)).count() == 3
    labels = df.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("Quality"), F.lit(0).alias("DOC_ID"))
    assert quality_rules.quality_rules(df, quality_rules.log_ratios(df, labels)).count() == 3
    turns = df.select(F.col("doc_id").alias("conv_id"), F.lit(0).alias("turn"), F.lit("user").alias("role"), F.col("source").alias("text"), F.lit(1).alias("Text"), F.lit(1).alias("a.b"))
    assert chat.read_chats(chat.format_chats(turns)).count() == 2
    pages = df.select(F.col("doc_id").alias("page_id"), F.lit("u").alias("url"), F.col("source").alias("html"), F.lit(1).alias("HTML"), F.lit(1).alias("a.b"))
    assert warc.read_archives(warc.write_archives(pages)).count() == 3


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="no column text"):
        common.chosen(spark.range(1), "text")


def test_a_cluster_needs_a_shared_folder():
    session = MagicMock()
    session.conf.get.return_value = None
    session.sparkContext.master = "spark://host:7077"
    session.sparkContext._jsc.sc().getCheckpointDir().isDefined.return_value = False
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_dir(session, "x")


# classifier


def plain_statistics(text):
    """The statistics once more, word by word and character by character."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if not words:
        return [0.0] * len(rule_ensemble.STATS)
    n, size = len(words), len(text.encode())
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    runs, run = [], 1
    for a, b in zip(words, words[1:]):
        run = run + 1 if a == b else 1
        runs.append(run)
    upper, lower = sum("A" <= c <= "Z" for c in text), sum("a" <= c <= "z" for c in text)
    marks = sum(33 <= ord(c) < 127 and not c.isalnum() for c in text)
    longest = max([*runs, 1])
    return [
        math.log(1 + n), sum(len(w.encode()) for w in words) / n, sum(c in "#*$%&|<>" for c in text) / size,
        sum(len(w) < 3 and all(c in "#*$%&|<>" for c in w) for w in words) / n, sum(w[-1] in "#*$%&|<>" for w in words) / n,
        upper / max(1, upper + lower), text.count("!!") / n, len(set(words)) / n, sum(a == b for a, b in zip(words, words[1:])) / n,
        1 - len(set(zip(words, words[1:]))) / (n - 1) if n > 1 else 0.0, longest / n if longest > 2 else 0.0, 1 - len(set(lines)) / len(lines),
        sum("0" <= c <= "9" for c in text) / size, marks / size, n / len(lines), sum(x.rstrip(" \t\r\v\f")[-1] in ".!?" for x in lines) / len(lines),
        sum(len(w.encode()) > 20 for w in words) / n, n / (1 + sum(c in ".!?" for c in text)),
    ]


def test_statistics_and_scores_match_plain_versions(spark):
    texts = [None, "", " \n", "One", "a a a b !! ## $x x$\nq.\nq.\n\nÉtude 42?", "word " * 500] + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]
    for t in texts:
        assert np.allclose(rule_ensemble.text_statistics(t), plain_statistics(t)), t
    rule = rule_ensemble.Rule(((0, True, 1.0), (7, False, 0.9)))
    model = rule_ensemble.RuleEnsemble(((rule, 2.0), (rule_ensemble.Rule(((2, True, 0.01),)), -3.0)), 0.5)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in rule_ensemble.score_quality(df, model).collect():
        s = plain_statistics(texts[r.doc_id])
        z = 0.5 + 2.0 * (s[0] > 1.0 and s[7] <= 0.9) - 3.0 * (s[2] > 0.01)
        assert math.isclose(r.score, 1 / (1 + math.exp(-z)), rel_tol=1e-12)


def test_classifier_on_labels_it_has_not_seen(spark):
    from spindrift.llm import queries

    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    held = queries.op2_quality_classifier(spark, folder).filter("held_out").join(labels, "doc_id").filter("quality is not null").select("predicted", "quality").toPandas()
    assert len(held) > 50 and (held.predicted == held.quality).mean() > 0.93


def test_every_rule_reaches_the_lasso():
    rng = np.random.default_rng(2)
    x = rng.random((4000, len(rule_ensemble.STATS)))
    y = (rng.random(4000) < x[:, 0] * x[:, 1]).astype(int)
    rules = rule_ensemble._rules(x, y, np.ones(4000), rule_ensemble.TREES, rule_ensemble.DEPTH, 1)
    assert len(rules) > 400 and len(rules) == len(set(rules))


# fingerprints


def plain_fingerprint(text, size=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_and_components_match_brute_force(spark):
    from spindrift.llm import queries

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op3_simhash(spark, SF).collect()}
    prints = {r.doc_id: plain_fingerprint(r.text) for r in docs}
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(prints)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert got == {i: (f"{prints[i]:016x}", find(i)) for i in ids}
    for text in (None, "", "É É", "A b\x1cc d", "one two three", "x " * 40_000, "É\x0bZ q r s t u"):
        assert simhash.fingerprint(text) == plain_fingerprint(text)


# languages


def test_predictions_match_a_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    model = language_id.fit_languages(docs)
    logs = lambda rows: model.logs(rows, np.full(len(rows), 1 / len(rows)), np.zeros(len(rows), np.int64), 1)[0] if rows else np.zeros(len(model.languages))
    texts = [None, "", "½ ² Ⅷ 12 __", "½ ² a", "a2b c_d", "日本 x", "zzzqqq " * 50] + [r.text for r in docs.limit(40).collect()]
    probe = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in language_id.predict_languages(probe, model).collect():
        words, word = [], ""
        for c in (texts[r.doc_id] or "").lower() + " ":
            if c.isalpha():
                word += c
            else:
                words, word = words + [word] * bool(word), ""
        if not words:
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        means = sum(logs(model.rows_of(w)) for w in words) / len(words) * min(len(words), language_id.SURE_WORDS)
        share = np.exp(means - means.max())
        assert math.isclose(r.score, share.max() / share.sum(), rel_tol=1e-3)
        assert r.lang_pred == model.languages[int(np.argmax(means))] or share.max() / share.sum() < 0.51


def test_rare_languages_are_learned(spark):
    rows = [(i, f"alpha beta gamma w{i}", "aa") for i in range(3000)] + [(5000 + i, "uno dos tres", "bb") for i in range(3)] + [(7, "hot row", "cc")] * 500
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    taken = language_id._sample(df, 300)
    n = {r.lang: r["count"] for r in taken.groupBy("lang").count().collect()}
    assert n["bb"] == n["cc"] == 1 and 50 < n["aa"] < 200
    model = language_id.fit_languages(df, 300)
    assert {"aa", "bb", "cc"} == set(model.languages)


def test_most_frequent_keys(spark):
    rows = [("aa", f"k{i}", 100 - i) for i in range(50)] + [("aa", f"tie{i}", 1) for i in range(400)] + [("bb", "only", 1)]
    df = spark.createDataFrame(rows, "lang string, key string, n long")
    assert language_id._most_frequent(df, 20) == sorted(rows[:20] + rows[-1:])
    kept = language_id._most_frequent(df, 150)
    assert set(rows[:50]) <= set(kept) and 120 < len(kept) < 180 and kept == language_id._most_frequent(df.repartition(3), 150)
    assert language_id._most_frequent(df.filter("false"), 5) == []


# pieces


def test_long_segments_merge_in_rounds():
    """Runs without white space, beyond any bound that a word would keep, and pairs of which many are best at once."""
    model, rng = piece_bpe.load(PIECES), random.Random(9)
    parts = ["a", "b", "ab", "the", "ing", "é", "日本", "語の", "\U0001f600", "x" * 30, "1", "hello", "tion", "er", "aa", "bc", "nn", "ations"]
    texts = ["".join(rng.choices(parts, k=rng.randint(30, 300))) for _ in range(150)]
    texts += ["".join(rng.choices(letters, k=rng.randint(100, 3000))) for letters in ("ab", "eaon", "abcdeinorst") for _ in range(30)]
    texts += ["日本語" * 5000, "y" * 20_001, "the" * 7000, " " * 9000, "\n" * 3000]
    flat, counts = piece_bpe.Encoder(model).encode(texts)
    for text, n, end in zip(texts, counts, np.cumsum(counts)):
        assert flat[end - n : end].tolist() == model.library.encode(text), text[:50]
