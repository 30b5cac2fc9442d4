"""The corpus operators' queries over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexloom.llm import bitslice, bpe, jaccard, langid, licenses, mixing, pii, rans, repetition, sitequality


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.repetition_rules(_docs(spark, sf_dir))


def op2_bitslice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitslice.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), every=50, k=5)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(_docs(spark, sf_dir))


def op4_sitequality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sitequality.quality(_docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_docs(spark, sf_dir)).select("doc_id", "held_out", "lang_pred", "score")


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(_docs(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_docs(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.digests(_docs(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op9_rans(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return rans.read_tokens(spark, rans.write_tokens(_docs(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), end_id=1))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_docs(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_repetition": op1_repetition,
        "op2_bitslice": op2_bitslice,
        "op3_pii": op3_pii,
        "op4_sitequality": op4_sitequality,
        "op5_langid": op5_langid,
        "op6_jaccard": op6_jaccard,
        "op7_mixing": op7_mixing,
        "op8_bpe": op8_bpe,
        "op9_rans": op9_rans,
        "op10_licenses": op10_licenses,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_repetition": repetition.SQL,
        "op2_bitslice": bitslice.SQL,
        "op6_jaccard": jaccard.SQL,
        "op7_mixing": mixing.SQL,
    }
