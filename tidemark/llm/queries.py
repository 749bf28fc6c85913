"""The registered queries of this subpackage, with production parameters on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, fingerprints, langid, linededup, neardup, ppm, secretscan, sentencepieces, toxicity, urlrules
from .common import remainder, table


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(remainder("doc_id", 4) != 2))
    return toxicity.scored(docs, model, keep=["doc_id"]).select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.scanned(table(spark, sf_dir, "documents"))


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.where(remainder("doc_id", 5) != 0))
    return langid.predict(docs, model, keep=["doc_id"]).select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.near_counts(fingerprints.compared(table(spark, sf_dir, "documents")))


def op6_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.scored(table(spark, sf_dir, "documents"))


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), ((F.col("toxic") == 1) | (F.col("quality") == 0)).alias("bad"))
    return urlrules.judged(pages, urlrules.mined(pages, labels))


def op8_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("n_pieces", "ids_sha256", "best_score", "nbest_scores", "decoded_equal")
    return sentencepieces.encode(table(spark, sf_dir, "documents"), keep=["doc_id"], columns=columns)


def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = linededup.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"), wide=True)
    return done.select("doc_id", "n_lines", "n_copies", "n_near", F.sha2("text", 256).alias("text_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_decontaminate, op2_toxicity, op3_secrets, op4_langid, op5_fingerprints, op6_ppm, op7_urls, op8_neardup, op9_sentencepiece, op10_lines)}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL where it can express a query; the others are held against brute force in the tests."""
    return {}
