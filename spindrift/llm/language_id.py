"""Language identification: words first, character n-grams for unseen words.

A model holds, per language, log frequencies of its ``WORDS`` most frequent words and of its ``GRAMS`` most frequent
character n-grams of lengths 1 to ``MAX_GRAM`` (word ends marked). A known word scores by its log frequency in each
language. An unseen word is scored by its n-grams of the greatest length at which the model knows any. A text's score in a language is the mean over its words; the
softmax of those means, sharpened by the number of words up to ``SURE_WORDS``, gives the prediction and its score.

The model is fitted on about ``FIT_ROWS`` labelled rows at most (or ``LEAST_ROWS`` of each language, where that is more),
chosen by a hash, whole texts. It holds a number for each key and each language that uses it, at most ENTRIES of words and
as many of n-grams; a language that does not know a key has its floor. Every text is predicted whole, whatever
its length.

Defined results: a null text or one without a letter is ``und`` with score 0; equal scores go to the smaller language;
repeated rows are predicted alike; an empty table gives an empty result; without labelled rows everything is ``und``;
extra columns, whatever their names, are kept unless named ``lang_pred`` or ``score`` in any case.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import apart, chosen, materialize
from .word_table import spread

#: Labelled rows that a model is fitted on, in equal shares of the languages, and the least share.
FIT_ROWS, LEAST_ROWS = 6_000, 50
#: Languages that a model can hold, the most frequent ones: more than there are.
LANGUAGES = 10_000
#: Words and n-grams of a language, and of all languages together, where each then has an equal part.
WORDS, GRAMS, ENTRIES = 20_000, 20_000, 600_000
MAX_GRAM = 4
SURE_WORDS = 12
#: Starts of n-grams in a piece of a word.
PIECE = 64
#: Tokens whose scores are remembered, and scores of all of them together.
REMEMBERED, SCORES = 150_000, 8_000_000
#: Tokens, and rows, that are looked at together.
SLICE, ROWS = 50_000, 128
UNKNOWN = "und"
_LETTERS = regex.compile(r"\p{L}+")


class SparseLogs:
    """Log frequencies by key and language: a floor for each language, and what the keys that it knows add to it."""

    def __init__(self, counts: list[tuple[str, str, int]], languages: list[str]):
        at = {lang: k for k, lang in enumerate(languages)}
        self.keys: dict[str, int] = {}
        entries: dict[int, int] = {}
        for lang, key, n in counts:
            place = self.keys.setdefault(key, len(self.keys)) * len(at) + at[lang]
            entries[place] = entries.get(place, 0) + n
        place = np.array(sorted(entries), dtype=np.int64)
        n = np.array([entries[k] for k in place.tolist()], dtype=np.float64)
        row, lang = np.divmod(place, max(1, len(at)))
        floor = 0.5
        total = np.bincount(lang, weights=n, minlength=len(at))
        self.floor = np.log(floor / (total + floor * (len(self.keys) + 1))).astype(np.float32)
        self.lang, self.more = lang.astype(np.int32), np.log((n + floor) / floor).astype(np.float32)
        self.start = np.searchsorted(row, np.arange(len(self.keys) + 1))


class LanguageModel:
    """languages, word -> row and n-gram -> row of a sparse table of log frequencies in each language."""

    def __init__(self, words: list[tuple[str, str, int]], grams: list[tuple[str, str, int]]):
        self.languages = sorted({lang for lang, _, _ in words})
        first, second = SparseLogs(words, self.languages), SparseLogs(grams, self.languages)
        self.words, self.grams = first.keys, {k: len(first.keys) + v for k, v in second.keys.items()}
        self.floors = np.stack([first.floor, second.floor])
        self.lang, self.more = np.concatenate([first.lang, second.lang]), np.concatenate([first.more, second.more])
        self.start = np.concatenate([first.start, first.start[-1] + second.start[1:]])

    def logs(self, rows: np.ndarray | list[int], weights: np.ndarray, owner: np.ndarray, owners: int) -> np.ndarray:
        """Weighted sums of rows by owner, owners times languages."""
        rows = np.asarray(rows, dtype=np.int64)
        out = np.zeros((owners, len(self.languages)), dtype=np.float32)
        for kind, of in enumerate((rows < len(self.words), rows >= len(self.words))):
            out += np.bincount(owner[of], weights=weights[of], minlength=owners)[:, None].astype(np.float32) * self.floors[kind]
        size = self.start[rows + 1] - self.start[rows]
        entry = spread(self.start[rows], size)
        np.add.at(out, (np.repeat(owner, size), self.lang[entry]), self.more[entry] * np.repeat(weights, size).astype(np.float32))
        return out

    def rows_of(self, word: str) -> list[int]:
        """Rows of the table whose mean is a word's score: its own, or its longest known n-grams'."""
        known = self.words.get(word)
        if known is not None:
            return [known]
        marked, grams = f"_{word}_", self.grams
        for n in range(min(MAX_GRAM, len(marked)), 0, -1):
            found = [grams[g] for g in [marked[i : i + n] for i in range(len(marked) - n + 1)] if g in grams]
            if found:
                return found
        return []

    def score_tokens(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """For runs without white space the sum over their words' scores, and the number of their words."""
        flat: list[int] = []
        sizes: list[int] = []  # rows of each word
        owner: list[int] = []
        n_words = np.zeros(len(tokens), dtype=np.int32)
        for k, token in enumerate(tokens):
            for word in _LETTERS.findall(token.lower()):
                n_words[k] += 1
                rows = self.rows_of(word)
                if rows:
                    flat += rows
                    sizes.append(len(rows))
                    owner.append(k)
        size = np.array(sizes, dtype=np.int64)
        scores = self.logs(flat, np.repeat(1.0 / np.maximum(size, 1), size), np.repeat(np.array(owner, dtype=np.int64), size), len(tokens))
        return scores, n_words


def _sample(labelled: DataFrame, fit_rows: int) -> DataFrame:
    """(lang, text): of each of the ``LANGUAGES`` most frequent languages about an equal share of ``fit_rows``.

    Rows are chosen by a hash of id and text below their language's threshold, so no row need be ranked or moved to be
    chosen; rows of a language that repeat a text teach once, so a hot id or text cannot fill the sample.
    """
    spark = labelled.sparkSession
    row = F.xxhash64("doc_id", "text")
    sizes = labelled.groupBy("lang").agg(F.approx_count_distinct(row).alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()
    share = max(LEAST_ROWS, fit_rows // max(1, len(sizes)))
    scale = 1 << 62
    limits = [(r.lang, scale - 1 if r.n <= share else int(scale * share / r.n)) for r in sizes]
    limits = F.broadcast(spark.createDataFrame(limits, "lang string, below long"))  # LANGUAGES rows at most
    return labelled.join(limits, "lang").filter(F.shiftrightunsigned(row, 2) <= F.col("below")).select("lang", "text").filter("text is not null").distinct()


def _most_frequent(counts: DataFrame, k: int) -> list[tuple[str, str, int]]:
    """About the k most frequent keys of each language, from (lang, key, n).

    How many keys have each count is a small table, from which each language's cut follows; of the keys at the cut
    those with the smaller hashes come in. No language's keys are ever ranked in one place.
    """
    spark = counts.sparkSession
    classes: dict[str, list[tuple[int, int]]] = {}
    for r in counts.groupBy("lang", "n").agg(F.count(F.lit(1)).alias("keys")).collect():
        classes.setdefault(r.lang, []).append((r.n, r["keys"]))
    cuts = []
    for lang, sizes in classes.items():
        room, cut, part = k, 0, 1.0
        for n, keys in sorted(sizes, reverse=True):
            if keys > room:
                cut, part = n, room / keys
                break
            room -= keys
        cuts.append((lang, cut, int(part * (1 << 30))))
    if not cuts:
        return []
    known = counts.join(F.broadcast(spark.createDataFrame(cuts, "lang string, cut long, part long")), "lang")
    lot = F.xxhash64("key").bitwiseAND(F.lit((1 << 30) - 1))
    kept = known.filter((F.col("n") > F.col("cut")) | ((F.col("n") == F.col("cut")) & (lot < F.col("part"))))
    return sorted(tuple(r) for r in kept.select("lang", "key", "n").collect())


def fit_languages(docs: DataFrame, fit_rows: int = FIT_ROWS) -> LanguageModel:
    """A model from rows of doc_id, text and lang; rows without text or lang teach nothing."""
    rows = _sample(chosen(docs, "doc_id", "text", "lang").filter("lang is not null"), fit_rows)
    words = rows.select("lang", F.explode(F.split(F.lower(F.regexp_replace("text", r"[^\p{L}]+", " ")), " ")).alias("key")).filter("key <> ''")
    counts = materialize(words.groupBy("lang", "key").agg(F.count(F.lit(1)).alias("n")), "language-words")
    marked = F.concat(F.lit("_"), "key", F.lit("_"))
    # a long word is cut in pieces of PIECE starts each, so that finding a place in it stays cheap
    at = F.explode(F.sequence(F.lit(0), F.length(marked) - 1, F.lit(PIECE)))
    # the written table is small, and what is cut from it is not: dealt out again, no one task cuts all of it
    dealt = counts.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "lang", "key")
    pieces = dealt.select("lang", "n", marked.alias("marked"), at.alias("at"))
    pieces = pieces.select("lang", "n", "at", F.substr("marked", F.col("at") + 1, F.lit(PIECE + MAX_GRAM - 1)).alias("piece"))
    size = F.length("piece")
    last = lambda n: F.least(F.greatest(size - (n - 1), F.when(F.col("at") == 0, 1).otherwise(0)), F.lit(PIECE))
    starts = lambda n: F.when(last(n) > 0, F.sequence(F.lit(1), F.greatest(last(n), F.lit(1)))).otherwise(F.array().cast("array<int>"))
    grams_of = lambda n: F.transform(starts(n), lambda i: F.substr("piece", i, F.lit(n)))
    cut = [grams_of(n) for n in range(1, MAX_GRAM + 1)]  # a second parameter of the inner lambda would be the index
    grams = pieces.select("lang", "n", F.explode(F.flatten(F.array(*cut))).alias("key")).groupBy("lang", "key").agg(F.sum("n").alias("n"))
    part = ENTRIES // max(1, counts.agg(F.count_distinct("lang")).first()[0])
    return LanguageModel(_most_frequent(counts, min(WORDS, part)), _most_frequent(materialize(grams, "language-grams"), min(GRAMS, part)))


class _Reader:
    """Scores of tokens; remembers up to ``REMEMBERED`` of them, or ``SCORES`` numbers."""

    def __init__(self, model: LanguageModel):
        self.model, self.most = model, min(REMEMBERED, SCORES // max(1, len(model.languages)))
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.scores = np.zeros((1024, len(self.model.languages)), dtype=np.float32)
        self.words = np.zeros(1024, dtype=np.int32)

    def read(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Per text the sum of the scores of its words, and their number."""
        totals, counts = np.zeros((len(texts), len(self.model.languages))), np.zeros(len(texts), dtype=np.int64)
        tokens: list[str] = []
        ends: list[tuple[int, int]] = []  # text and the end of its tokens in this round

        def settle() -> None:
            at = self._rows(tokens)
            begin = 0
            for k, end in ends:
                totals[k] += self.scores[at[begin:end]].sum(axis=0, dtype=np.float64)
                counts[k] += int(self.words[at[begin:end]].sum())
                begin = end
            tokens.clear()
            ends.clear()

        for k, text in enumerate(texts):
            cut = text.split()
            for b in range(0, len(cut), SLICE):
                tokens += cut[b : b + SLICE]
                ends.append((k, len(tokens)))
                if len(tokens) >= SLICE:
                    settle()
        settle()
        return totals, counts

    def _rows(self, tokens: list[str]) -> np.ndarray:
        at = np.fromiter(map(self.known.get, tokens, repeat(-1)), dtype=np.int64, count=len(tokens))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            if len(self.known) > self.most:
                self._forget()
                missing = np.arange(len(tokens))
            known, first = self.known, len(self.known)
            new = list(dict.fromkeys([tokens[k] for k in missing]))
            known.update(zip(new, range(first, first + len(new))))
            scores, words = self.model.score_tokens(new)
            while first + len(new) > len(self.words):
                self.scores, self.words = np.concatenate([self.scores, np.zeros_like(self.scores)]), np.concatenate([self.words, np.zeros_like(self.words)])
            self.scores[first : first + len(new)], self.words[first : first + len(new)] = scores, words
            at[missing] = np.fromiter((known[tokens[k]] for k in missing), dtype=np.int64, count=len(missing))
        return at

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        totals, counts = self.read(texts)
        sharp = totals / np.maximum(counts, 1)[:, None] * np.minimum(counts, SURE_WORDS)[:, None]
        known = (counts > 0) & (len(self.model.languages) > 0)
        if not known.any():
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        best = sharp.argmax(axis=1)
        score = 1.0 / np.exp(sharp - sharp.max(axis=1, keepdims=True)).sum(axis=1)
        return [self.model.languages[b] if k else UNKNOWN for b, k in zip(best, known)], np.where(known, score, 0.0).tolist()


def predict_languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; the model's bounded tables are broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows, places, names, at = apart(docs, ("text",), ("lang_pred", "score"))
    schema = T.StructType([*rows.select(*places).schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(shared.value)
        slices = (batch.slice(k, ROWS) for batch in batches for k in range(0, batch.num_rows, ROWS))
        for batch in slices:
            found, scores = reader.predict([t or "" for t in batch.column(at["text"]).to_pylist()])
            arrays = [batch.column(n) for n in places] + [pa.array(found, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, [*places, "lang_pred", "score"])

    return rows.mapInArrow(run, schema).toDF(*names, "lang_pred", "score")


def accepted(df: DataFrame, least: float = 0.5) -> DataFrame:
    """Rows whose language is known well enough."""
    return df.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least))
