"""The registered queries of the text operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import align, annuli, debruijn, decontam, langid, linecrf, minhash, oracles, packing, rules, secrets, suffixes, turns, wrapper


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = packing.pack(_documents(spark, sf_dir))
    return rows.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op3_suffix_merge_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(_documents(spark, sf_dir))


def op4_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(_documents(spark, sf_dir)).drop("class_distance", "common_distance")


def op5_byte_cnn_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    rows = langid.identify(docs, langid.train(docs))
    return rows.select("doc_id", langid.is_held_out().alias("held_out"), "lang_pred", "score")


def op6_line_crf_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    rows = linecrf.score(docs, linecrf.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return rows.select("doc_id", langid.is_held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op7_debruijn_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return debruijn.remove_repeats(_documents(spark, sf_dir))


def op8_wrapper_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrapper.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op9_guess_cost_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return secrets.scan(docs, secrets.dictionary(docs))


def op10_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_documents(spark, sf_dir))


def op11_diagonal_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.digest(_documents(spark, sf_dir))


def op12_pivot_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return annuli.search(annuli.build(vectors), vectors.where("vec_id % 50 = 0"), 5)


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.audit(turns.damage(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_pack_sequences,
        op2_latent_decontamination,
        op3_suffix_merge_dedup,
        op4_divergence_rules,
        op5_byte_cnn_language,
        op6_line_crf_quality,
        op7_debruijn_dedup,
        op8_wrapper_extraction,
        op9_guess_cost_secrets,
        op10_minhash_near_dup,
        op11_diagonal_alignment,
        op12_pivot_top_k,
        op13_turn_repair,
        pipeline,
    )
}

ORACLES: dict[str, str] = {
    "op3_suffix_merge_dedup": oracles.SUFFIX,
    "op4_divergence_rules": oracles.RULES,
    "op7_debruijn_dedup": oracles.DEBRUIJN,
    "op10_minhash_near_dup": oracles.NEAR,
    "op12_pivot_top_k": oracles.TOP_K,
}
