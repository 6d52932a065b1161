"""From raw documents to a tokenized mix: five stages, each one of the corpus operators over all rows it is given.

What each stage does with odd rows:

* a null, empty or blank text and a text without letters has no language, so the first stage drops it (as it does a language it is not sure of); a null ``lang`` or
  ``source`` is no reason to drop a row (``lang`` only teaches, a null source is a source of its own in the mix);
* a text of any length is one row, read whole by every stage;
* rows that repeat a doc_id are rows of their own until the near-duplicates, where one row of each doc_id stays and copies
  fall into one group, of which one row stays;
* ties: a language of equal scores is the first by name, a score of just ``LEAST_QUALITY`` stays, the group's smallest
  doc_id stays, and the mix takes a document at its cut if half of its words or more fit;
* without documents, or with none left by a stage, the later stages give an empty table of the same columns;
* further columns are left behind at the start: stages pass on the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindrift.llm.common import DOCUMENT_COLUMNS, materialize, table
from spindrift.llm.language_id import accepted, fit_languages, predict_languages
from spindrift.llm.mixing import mix_rows
from spindrift.llm.piece_bpe import encode_documents
from spindrift.llm.rule_ensemble import fit_quality, score_quality
from spindrift.llm.simhash import keep_one

#: A document stays if its quality score is this or more.
LEAST_QUALITY = 0.3
TOKENIZER = "piece_bpe_32k.model"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a known language."""
    return accepted(predict_languages(docs, fit_languages(docs))).select(*DOCUMENT_COLUMNS)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for good text; every fifth label is left out of the fit."""
    labels = table(spark, sf_dir, "labels").filter(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) != 0)
    return score_quality(docs, fit_quality(docs, labels)).filter(F.col("score") >= LEAST_QUALITY).select(*DOCUMENT_COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest doc_id."""
    return keep_one(docs).select(*DOCUMENT_COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them."""
    return mix_rows(docs).select(*DOCUMENT_COLUMNS)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and the text that the ids decode to."""
    encoded = encode_documents(docs.select("doc_id", "text"), public_tokenizers.path(TOKENIZER), decode=True)
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("language_id", language_id),
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("sentencepiece", sentencepiece),
]

#: Learned models and hash-random keys are beyond SQL; the tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents").select(*DOCUMENT_COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
