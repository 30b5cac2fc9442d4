"""A training corpus in five stages, each by one operator over all its predecessor kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return
the columns they were given, in their order. A stage's result is written as a Parquet
table in the shared folder and read again as the next one's ``docs``.

1. language: documents whose language isn't recognised go.
2. near_copies: of each group of linked documents the one with the least id stays; they
   are linked from a similarity of 0.8 of their five-word shingles on.
3. personal_data: spans of personal data are replaced by their kind in angle brackets;
   where there is a column n_chars it follows the text.
4. mixture: a document is repeated for each epoch that takes it whole; the one on a
   source's cut ends with its last word taken; those not taken go.
5. tokens: the byte-level ids of each text, their number, and the digests of ids and of
   the text they decode to.

Defined cases: as in the operators. A row without an id is never a near copy, since no id
can name it. Rows that repeat an id are told apart by their texts: the near_copies stage
drops those that are near copies of a kept row, and keeps those without a word.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.llm import bpe, jaccard, langid, mixing, pii
from lexloom.llm import shared as S

#: The least certainty of a recognised language; a toss-up between two families and two languages gives 0.25, however many there are.
LEAST_SCORE = 0.3
#: Words of a shingle and tenths of the similarity of near copies.
NEAR_WORDS, NEAR_TENTHS = 5, 8
NEAR_CLASS, NEAR_ROOT = "near_copies_class", "near_copies_root"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_identified(docs, LEAST_SCORE)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = jaccard.jaccard_components(docs, size=NEAR_WORDS, tenths=NEAR_TENTHS)
    # ids to drop, and ids that stand on several rows; both are short beside the documents
    gone = S.durable(found.filter(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct())
    repeated = S.durable(found.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").count().filter("count > 1").select("doc_id"))
    if repeated.isEmpty():
        return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    kept = docs.join(gone.union(repeated).distinct(), "doc_id", "left_anti").select(*docs.columns)
    several = jaccard.with_class(docs.join(repeated, "doc_id", "left_semi").select(*docs.columns), NEAR_CLASS, size=NEAR_WORDS)
    # of each component whose least id is repeated, one row with that id
    least = found.filter(F.col("doc_id") == F.col("component_id")).join(repeated, "doc_id", "left_semi")
    roots = least.filter("root is not null").select("doc_id", F.col("class").alias(NEAR_CLASS), F.col("root").alias(NEAR_ROOT)).distinct()
    told = several.join(roots, ["doc_id", NEAR_CLASS]).dropDuplicates([NEAR_ROOT]).select(*docs.columns)
    wordless = several.filter(F.col(NEAR_CLASS).isNull()).select(*docs.columns)
    return kept.unionByName(told).unionByName(wordless)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.mask_spans(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.take(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language", language),
    ("near_copies", near_copies),
    ("personal_data", personal_data),
    ("mixture", mixture),
    ("tokens", tokens),
]

#: Neither the language machines nor the tokenizer can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = S.stored(docs, f"pipeline-{name}")
    return docs
