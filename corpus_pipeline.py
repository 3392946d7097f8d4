"""Corpus preparation from raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.llm import decontaminate, jaccard, langid, packing, toxicity
from gridpulse.llm.common import documents
from gridpulse.scratch import materialize


def _free(docs: DataFrame, name: str) -> str:
    """``name``, longer where the documents have a column of that name (in any case)."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += " "
    return name


def _numbered(docs: DataFrame, name: str) -> DataFrame:
    """The documents with a number for each row: ids may be missing or shared, and a decision is about a row.

    ``docs`` is a written table (see ``run``), so a row's place in it, and with it the number, is the same in every pass and after a lost executor.
    """
    return docs.withColumn(name, F.monotonically_increasing_id())


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose toxicity is below one half; learns from every labelled document that is still here.

    Each row is scored by its own text: null and empty texts are scored like any other, null and shared ids change nothing but that a label
    counts for every text of its id and one without an id for none; repeated rows all stay or all go; an empty table stays empty;
    a column named like the score is kept as it is.
    """
    model = toxicity.fit(docs.select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    into = _free(docs, "toxic score")
    return toxicity.score(docs, model, into=into).where(F.col(f"`{into}`") < 0.5).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in one of the languages learned from the ``lang`` column; texts without a letter go.

    Each row is judged by its own text: null and empty texts go, null and shared ids change nothing, repeated rows all stay or all go; an empty
    table stays empty; columns named like the results are kept as they are.
    """
    model = langid.fit(docs.select("doc_id", "text", "lang"))
    found, score = _free(docs, "language found"), _free(docs, "language score")
    judged = langid.predict(docs, model, into=found, score=score)
    return judged.where(F.col(f"`{found}`") != langid.UNKNOWN).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of linked texts: the one with the smallest id.

    Rows are linked by their texts alone: two texts that share an id are two rows, copies without an id are copies. A row with an id goes before one
    without; of equal ids the first row stays. Null texts and those without a word are linked to nothing and stay; an empty table stays empty.
    """
    row = _free(docs, "row of stage")
    rows = _numbered(docs, row)
    groups = jaccard.join(rows, id_column=row).select(F.col("doc_id").alias(row), F.col("class_id").alias("class of row"))
    ids = rows.select(F.col(row), F.col("doc_id").alias("id of row"))
    first = F.min(F.struct(F.col("id of row").isNull(), F.col("id of row"), F.col(row).alias("row")))
    kept = ids.join(groups, row).groupBy("class of row").agg(first.alias("first")).select(F.col("first.row").alias(row))
    return rows.join(kept, row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops rows that hold a passage of the benchmark within its error budget.

    A row is judged by its own text: null and shared ids change nothing, null and empty texts stay, repeated rows all stay or all go; an
    empty table stays empty; other columns are kept as they are.
    """
    row = _free(docs, "row of stage")
    rows = _numbered(docs, row)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    hits = decontaminate.matches(rows, items, doc_id=row).select(F.col("doc_id").alias(row)).distinct()
    return rows.join(hits, row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all remaining documents in sequences of 1024 ids.

    Every row is packed, with null and shared ids and repeated rows; null and empty texts are their end id alone; an empty table has no pieces.
    """
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("language_id", drop_unknown_language),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: Trained models and retrieval are not expressible in SQL; tests hold the stages against brute-force versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
