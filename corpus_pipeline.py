"""The corpus pipeline: documents in, token ids out.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes it as
Parquet to the shared checkpoint folder and reads it again as the next one's ``docs``. All
stages but the last return the columns of ``documents``.

1. ``language``: the language model learns from the labelled rows (a bounded sample);
   documents without a letter, less like their language than ``LEAST_LIKE``, or told from the
   other ones by less than ``LEAST_MARGIN`` (unless as like as ``MIXED_LIKE``), go; a missing
   ``lang`` is filled with the prediction.
2. ``near_duplicates``: one document of each component of the n-gram join stays; documents
   are linked at a Jaccard of ``NEAR_PERCENT`` over ``NEAR_WORDS`` words (op9's own limits
   are those of its contract).
3. ``secrets``: every span found is replaced by a mark; ``n_chars`` follows.
4. ``mixture``: sources are mixed to their target weights; a row that is drawn twice
   comes twice.
5. ``tokens``: ids of each text, and whether they decode to its very bytes.

Null texts go in stage 1 (no letter); null ids, sources and labels are values like any
other; an empty table passes through all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.llm import bpe, langid, mixing, ngram_join, secrets
from rillflow.llm.common import batch_rows, fresh, read_table
from rillflow.session import materialize

#: a text of two learned languages has a small margin, but is much like one of them
LEAST_MARGIN, LEAST_LIKE, MIXED_LIKE = 0.1, 0.15, 0.6
#: near duplicates: words of an n-gram, least Jaccard in percent
NEAR_WORDS, NEAR_PERCENT = 5, 80


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    p, = fresh(docs, "_p")
    judged = langid.identified(docs, langid.fit(docs), p)
    pred = F.col(p)
    return judged.where((pred["lang_pred"] != langid.UND) & (pred["likeness"] >= LEAST_LIKE)
                        & ((pred["margin"] >= LEAST_MARGIN)
                           | (pred["likeness"] >= MIXED_LIKE))) \
        .withColumn("lang", F.coalesce("lang", pred["lang_pred"])).drop(p)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs, percent=NEAR_PERCENT, ngram=NEAR_WORDS)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    s, = fresh(docs, "_s")
    found = secrets.with_spans(docs, s).withColumn("text", F.when(
        F.size(s) > 0, secrets.redacted(F.col("text"), F.col(s))).otherwise(F.col("text")))
    return found.withColumn("n_chars", F.length("text").cast("bigint")).select(docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs).select(docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    how = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    batch_rows(spark, bpe.BATCH)
    return docs.select("doc_id", "lang", "source",
                       bpe.encoded_checked(F.col("text"), *how).alias("e")).select(
        "doc_id", "lang", "source", F.size("e.ids").cast("bigint").alias("n_tokens"),
        "e.ids", "e.decodes")


STAGES = [("language", language), ("near_duplicates", near_duplicates),
          ("secrets", mask_secrets), ("mixture", mixture), ("tokens", token_ids)]

#: language identification and byte-level BPE cannot be told in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
