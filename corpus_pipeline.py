"""Training corpus pipeline: toxicity, language, near-duplicates, packing.

Each stage reads all that its predecessor kept. The filters keep rows whole,
with every column; the last stage returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.llm import langid, packing, queries, simhash, toxicity
from gaugeflow.llm.common import shared_table, small_batches


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays under one half. Null and empty
    texts score like a text without toxic passage and stay; repeated rows share
    their fate; an empty table stays empty."""
    small_batches(spark)
    model = queries.toxicity_model(spark, docs, sf_dir)
    return docs.where(toxicity.score_column(model, F.col("text")) < queries.TOXIC_FROM)


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter whose best language reaches the least score.
    Null, empty and letterless texts go; without any labelled text no language
    is known and all go; repeated rows share their fate."""
    small_batches(spark)
    found = langid.predict_column(queries.language_network(docs), F.col("text"))
    return docs.where((found["lang_pred"] != langid.UNKNOWN) & (found["score"] >= queries.LANGUAGE_FROM))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the least id, of each group of near-duplicates.
    Null and empty texts are one group; of rows with equal ids the least by all
    columns stays; null ids come last."""
    small_batches(spark)
    return simhash.keep_one(docs, queries.SHINGLE_WORDS, queries.MAX_BITS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' ids with their place in a sequence. A null or
    empty text is the end id alone; repeated rows are packed each."""
    small_batches(spark)
    return packing.pack_documents(docs, queries.tokenizer_path("byte_bpe_50k.json"),
                                  queries.SEQUENCE_TOKENS, queries.END_ID)


STAGES = [("toxicity", drop_toxic), ("language_id", keep_known_languages),
          ("simhash_near_dedup", drop_near_duplicates), ("packing", pack_sequences)]

#: Trained models and fingerprints have no SQL form; tests hold the operators
#: against brute force, and each stage's rows against its operator.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is stored and read back."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = shared_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
