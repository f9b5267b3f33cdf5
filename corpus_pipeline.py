"""A corpus pipeline of five operators over ``documents``.

quality classifier -> SimHash near-dedup -> benchmark decontamination ->
PII redaction -> byte-level BPE.  Every stage takes (spark, docs, sf_dir) and
works on all rows that its predecessor kept; all but the last return the columns
of ``documents``, whatever else the input has.

Defined results, in every stage: a null text counts as empty; null ids, languages,
sources and lengths are carried as they are; repeated rows are rows of their own
(``near_dedup`` keeps one of them); no rows give no rows.
"""
from __future__ import annotations

import public_tokenizers as tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tuplewright.llm import bpe, decontaminate, line_crf, pii, similar_groups
from tuplewright.llm.common import shared_path, small_batches, text_or_empty

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line CRF scores 0.7 or more; an empty text is one empty line.
    Labels of unknown or repeated ids, and null labels, do no harm; without a usable
    label every document scores 0.5 and goes."""
    model = line_crf.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    small_batches(spark)
    score = line_crf.score_column(spark, model)
    return docs.where(score(text_or_empty("text")) >= 0.7).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of five-word-shingle similarity 0.8 or more: the one of
    the smallest id (null last), then of the least digest.  All wordless texts are one group."""
    return similar_groups.one_of_each(docs.select(*COLUMNS))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark; wordless texts and items match nothing."""
    return decontaminate.clean(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; n_chars follows the text (0 for a null text, which becomes empty)."""
    clean = docs.select("doc_id", pii.redacted(text_or_empty("text")).alias("text"), "lang", "source")
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of the whole text, with the digests of ids and of decoded bytes; an empty text has none."""
    ranks = tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.digests(bpe.round_trip(docs, ranks, tokenizers.PATTERN))


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminated), ("pii", redact), ("bpe", encode)]

#: SQL can't express the classifier, the fingerprints or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read again in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
