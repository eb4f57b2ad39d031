"""Registered queries of this folder: each applies one operator to its whole
table with production parameters and shapes the result as its contract asks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.llm import (ann, bm25, bpe, html_text, langid, licenses, negatives, packing, runs, simhash,
                           suffix_dedup, toxicity, url_rules)
from gaugeflow.llm.common import crc_fold, small_batches

#: (host, path, verdict) rules of the URL query.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]
SEQUENCE_TOKENS, END_ID = 1024, 0
SHINGLE_WORDS, MAX_BITS = 4, 4
TOXIC_FROM = 0.5
#: A document whose best language scores less is in no known language.
LANGUAGE_FROM = 0.4


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.ToxicityModel:
    """Learned from labelled rows whose crc32(doc_id) mod 5 is not 0."""
    return toxicity.fit(docs, table(spark, sf_dir, "labels"), crc_fold(F.col("doc_id"), 5) != 0)


def language_network(docs: DataFrame) -> langid.ByteCnn:
    """Learned from rows whose crc32(doc_id) mod 4 is not 2."""
    return langid.fit(docs, crc_fold(F.col("doc_id"), 4) != 2)


def op1_kmeans_tree_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest rows found to every embedding whose id is divisible by 100."""
    return ann.neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), SHINGLE_WORDS, MAX_BITS)


def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's address."""
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids cut into pieces and packed into sequences."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"),
                                  SEQUENCE_TOKENS, END_ID)


def op5_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity_model(spark, docs, sf_dir)
    scored = docs.select("doc_id", (crc_fold(F.col("doc_id"), 5) == 0).alias("held_out"),
                         toxicity.score_column(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= TOXIC_FROM).cast("int"))


def op6_byte_cnn_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = table(spark, sf_dir, "documents")
    found = langid.predict_column(language_network(docs), F.col("text"))
    return (docs.select("doc_id", (crc_fold(F.col("doc_id"), 4) == 2).alias("held_out"), found.alias("found"))
            .select("doc_id", "held_out", "found.lang_pred", "found.score"))


def op7_word_table_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of their decoded text."""
    return bpe.encode_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), digests=True)


def op8_block_max_wand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best other documents for every document whose id is divisible by 20, by BM25 of its whole text."""
    found = bm25.search(table(spark, sf_dir, "documents"), F.col("doc_id") % 20 == 0, 10)
    return found.select("query_id", "rank", "doc_id", F.round("score", 6).alias("score"))


OP8_SQL = r"""
WITH words AS (
  SELECT doc_id, w FROM (
    SELECT doc_id, unnest(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+')) AS w FROM documents)
  WHERE w <> ''),
tf AS (SELECT doc_id, w, count(*) AS tf FROM words GROUP BY doc_id, w),
dl AS (SELECT d.doc_id, coalesce(sum(t.tf), 0) AS dl FROM documents d LEFT JOIN tf t USING (doc_id) GROUP BY d.doc_id),
corpus AS (SELECT count(*) AS n, avg(dl) AS mean FROM dl),
idf AS (SELECT w, ln(1 + (n - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM tf, corpus GROUP BY w, n),
scored AS (
  SELECT q.doc_id AS query_id, t.doc_id,
         sum(idf * t.tf * 2.2 / (t.tf + 1.2 * (0.25 + 0.75 * dl / mean))) AS score
  FROM tf q JOIN tf t ON q.w = t.w AND q.doc_id <> t.doc_id JOIN idf ON idf.w = t.w
  JOIN dl ON dl.doc_id = t.doc_id, corpus
  WHERE q.doc_id % 20 = 0 GROUP BY q.doc_id, t.doc_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, doc_id, round(score, 6) AS score FROM ranked WHERE rank <= 10
"""


def op9_license_dice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage of every document that is close to a licence notice."""
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op10_text_tag_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract_pages(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op11_suffix_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without strings of 200 bytes that start elsewhere too."""
    found = suffix_dedup.repeated_strings(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


def op12_shared_list_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every embedding whose id is divisible by 100, with some labels moved first."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", label.alias("label"))
    return negatives.mine(rows, F.col("id") % 100 == 0)


OP12_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
         CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
ranked AS (
  SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
  FROM positives JOIN scores USING (anchor_id)
  WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 10
"""


def op13_square_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document's words, of which a tenth is made periodic first."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    docs = (table(spark, sf_dir, "documents").select("doc_id", "text", (crc % 10 == 0).alias("repeats"), F.floor(crc / 10).alias("g"))
            .withColumn("words", F.when(F.col("repeats"), F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")))
            .withColumn("n", F.size("words").cast("long")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
            .withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))))
    tail = F.array_join(runs.repeat_tail(F.col("words"), F.col("a"), F.col("p")), " ")
    found = runs.periodic_runs(docs.select("doc_id", F.when(F.col("n") > 0, tail).otherwise(F.col("text")).alias("text")))
    # the first of the runs of greatest length / period, which are ordered by start, then period
    best = F.aggregate("runs", F.lit(None).cast("struct<start:long,length:long,period:long>"), lambda b, r: F.when(
        b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return (found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of ``corpus_pipeline`` over the documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


REGISTRY = {f.__name__: (f, sql) for f, sql in (
    (op1_kmeans_tree_ann, None), (op2_simhash, None), (op3_url_rules, None), (op4_best_fit_packing, None),
    (op5_toxic_segments, None), (op6_byte_cnn_language, None), (op7_word_table_bpe, None),
    (op8_block_max_wand, OP8_SQL), (op9_license_dice, None), (op10_text_tag_ratio, None),
    (op11_suffix_family, None), (op12_shared_list_negatives, OP12_SQL), (op13_square_runs, None), (pipeline, None))}
