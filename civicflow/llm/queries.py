"""One query for each operator of this package, over whole tables and with production parameters."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, licenses, lm, mixing, packing, periodic, pii, product_codes, quality, simhash, token_counts, token_files, url_filter
from .sql import ORACLE_SQL
from .storage import shared_dir

__all__ = ["ORACLE_SQL", "QUERIES"]

#: The vocabulary file of a public tokenizer; another path may be given.
VOCABULARY = "word_bpe_49k.json"

#: Rules of the URL filter.
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    automaton = token_counts.LongestMatch(token_counts.read_vocabulary(vocabulary_path()))
    return token_counts.token_counts(table(spark, sf_dir, "documents"), automaton)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary_path())


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list holds the pages of documents labelled toxic; a page's path ends in its document's id."""
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    toxic = labels.where(F.col("toxic") == 1).select("doc_id").distinct()
    of_doc = pages.select("url", F.regexp_extract("url", r"^[^?#]*/(\d{1,18})[^/]*/?$", 1).alias("d")).where(F.col("d") != "").select("url", F.col("d").cast("long").alias("doc_id"))
    return url_filter.filter_urls(pages, of_doc.join(toxic, "doc_id", "left_semi"), URL_RULES)


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_texts(table(spark, sf_dir, "documents"))


def op8_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    spans = F.concat_ws(",", F.transform("spans", lambda s: F.concat_ws(":", s["label"], s["first"].cast("string"), s["end"].cast("string"))))
    return found.withColumn("spans", spans)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.run_digests(periodic.periodic_runs(table(spark, sf_dir, "documents"), repeated_tails=True))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = product_codes.product_codes(table(spark, sf_dir, "embeddings"))
    return product_codes.with_label_errors(coded).select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"), "label")


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files stay in the shared folder, as what this operator makes."""
    path = f"{shared_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, vocabulary_path("byte_bpe_50k.json"))
    return token_files.read_documents(spark, path)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_token_counts, op2_best_fit_packing, op3_url_filters, op4_pii, op5_nearest_neighbours, op6_simhash_near_dedup, op7_lm_scoring, op8_license_scans, op9_quality_rules, op10_mixing, op11_periodic_runs, op12_vector_codes, op13_token_files, pipeline)}
