"""One registered query for each training-data operator, with production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.llm import (
    alignment, decontaminate, fingerprint, infill, jaccard, langid, licenses, lmscore, packing, sharding, tokencounts, tokenfile, toxicity,
)
from gridpulse.llm.common import documents, fold
from gridpulse.scratch import new_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return add


@query("op1_decontamination")
def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.matches(documents(spark, sf_dir), items)


@query("op2_jaccard_join")
def jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(documents(spark, sf_dir))


@query("op3_lm_scores")
def lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lmscore.score(documents(spark, sf_dir))


@query("op4_token_files")
def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token-ids")
    tokenfile.write(documents(spark, sf_dir), path, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return tokenfile.digests(spark, path)


@query("op5_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    model = langid.fit(docs.where(fold("doc_id", 5) != 0))
    found = langid.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


@query("op6_packing")
def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


@query("op7_token_counts")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencounts.count(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


@query("op8_fingerprints")
def fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.neighbours(documents(spark, sf_dir))


@query("op9_toxicity")
def toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(fold("doc_id", 5) != 0).select("doc_id", "toxic")
    model = toxicity.fit(docs, labels)
    found = toxicity.score(docs, model)
    return found.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score",
                        (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op10_license_scan", licenses.sql())
def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


@query("op11_token_alignment")
def token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return alignment.digests(documents(spark, sf_dir), *paths)


@query("op12_infill", infill.sql())
def infilled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.digests(documents(spark, sf_dir))


@query("op13_sharding", sharding.sql(40))
def sharded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digests(sharding.shard(documents(spark, sf_dir), 40))
