"""From raw documents to packed training sequences; every stage is written as Parquet and reread by the next."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import decontam, langid, minhash, packing, secrets
from barloom.llm.common import shared_dir


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or with no language likely, go.

    So do null and empty texts. Rows that repeat are judged each; an empty table stays empty; all columns are kept.
    """
    return langid.keep_identified(docs, langid.train(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the least doc_id stays.

    Null and empty texts, and rows without a doc_id, stay; rows that repeat a doc_id stay or go together.
    """
    gone = minhash.near_duplicates(docs).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go; null and empty texts, and all where the benchmark is empty, stay."""
    found = decontam.leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return docs.join(found.select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts give way to a mark; n_chars is counted anew. Null and empty texts stay as they are."""
    return secrets.redact(docs, words=secrets.dictionary(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept texts as pieces of training sequences; a null text has its end mark alone, repeated rows are packed each."""
    rows = packing.pack(docs)
    return rows.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("language_id", language),
    ("near_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("packing", packed),
]

#: Trained weights and tokenizer ids are beyond SQL; tests/llm/test_pipeline.py holds each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
