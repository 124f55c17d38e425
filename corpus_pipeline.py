"""The corpus pipeline: from documents to packed sequences, a table in the shared folder per stage."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import packing, pii, simhash, toxicity
from ledgerloom.llm.common import new_folder, or_empty

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic; the model is learned from the table of labels.

    A null or empty text is never toxic; repeated rows are judged alike; an empty table stays empty.
    """
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    toxic = toxicity.score(F.col("text"), model) >= toxicity.THRESHOLD
    return docs.filter(~toxic)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id.

    Texts without words are near-duplicates of each other; rows that repeat are one document.
    """
    return simhash.keep_one(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; ``n_chars`` follows the text if it changed.

    Null texts stay null and rows without personal data stay as they are. Rows that repeat are rows of
    their own, and an empty table stays empty. Other columns may have any name.
    """
    found = pii.spans(or_empty(F.col("text")), pii.fit(docs))
    # A row travels as one column, so that its columns' names meet no others.
    rows = docs.select(F.struct("*").alias("row"), found.alias("found"))
    rows = rows.withColumn("clean", pii.redact(F.col("row.text"), F.col("found")))
    changed = {"text": F.col("clean")}
    if "n_chars" in docs.columns:
        length = F.when(F.size("found") > 0, F.char_length("clean")).otherwise(F.col("row.n_chars"))
        changed["n_chars"] = length.cast(docs.schema["n_chars"].dataType)
    return rows.select(*[changed.get(name, F.col("row").getField(name)).alias(name) for name in docs.columns])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences; null texts are empty texts.

    Rows that repeat are documents of their own, and an empty table has no pieces.
    """
    return packing.pack(packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity_stage),
    ("simhash_near_duplicates", simhash_stage),
    ("personal_data", pii_stage),
    ("best_fit_packing", packing_stage),
]

# No stage can be said in SQL: the tests compare each with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after another over the table of documents."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        folder = new_folder(spark, f"pipeline-{name}")
        stage(spark, rows, sf_dir).write.parquet(folder)
        rows = spark.read.parquet(folder)
    return rows
