"""Measures: retrieval hits, agreement, precision with intervals, order statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexloom.tables import durable


def by_article(ranked: DataFrame, articles: DataFrame, query: str, key: str) -> DataFrame:
    """(query, article, rank): chunks folded to their articles, each at its best chunk's place, ranked anew from 1. articles: (key, article)."""
    placed = ranked.join(articles.filter("article is not null").select(key, "article"), key).groupBy(query, "article").agg(F.min("rank").alias("at"))
    return placed.select(query, "article", F.row_number().over(Window.partitionBy(query).orderBy("at", "article")).cast("long").alias("rank"))


def first_ranks(ranked: DataFrame, gold: DataFrame, query: str, key: str) -> DataFrame:
    """(query, first): the best rank (from 0) of any gold row of each query that has gold; null if none was found."""
    found = ranked.join(gold.select(query, key), [query, key], "left_semi").groupBy(query).agg((F.min("rank") - 1).alias("first"))
    return gold.select(query).distinct().join(found, query, "left")


def retrieval_measures(firsts: DataFrame, cutoffs: tuple = (1, 5, 10, 20, 50)) -> DataFrame:
    """One row: hit@k for each cutoff, and the mean reciprocal rank."""
    hits = [F.round(F.avg(F.when(F.col("first") < k, 1.0).otherwise(0.0)), 4).alias(f"hit_{k}") for k in cutoffs]
    return firsts.agg(F.count("*").alias("n"), *hits, F.round(F.avg(F.coalesce(1 / (F.col("first") + 1), F.lit(0.0))), 4).alias("mrr"))


def kappa(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """One row: observed and expected agreement of two 0/1 ratings, and Cohen's kappa."""
    n = F.count("*")
    agree, pa, pb = F.sum(F.when(F.col(a) == F.col(b), 1.0).otherwise(0.0)) / n, F.avg(F.col(a).cast("double")), F.avg(F.col(b).cast("double"))
    seen = pairs.agg(n.alias("n"), agree.alias("po"), (pa * pb + (1 - pa) * (1 - pb)).alias("pe"))
    return seen.select("n", F.round("po", 6).alias("po"), F.round("pe", 6).alias("pe"), F.round((F.col("po") - F.col("pe")) / (1 - F.col("pe")), 6).alias("kappa"))


def wilson(ok: Column, n: Column, z: float = 1.96) -> tuple[Column, Column]:
    """Bounds of the Wilson score interval."""
    p = ok / n
    middle, half = p + z * z / (2 * n), z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))
    whole = 1 + z * z / n
    return (middle - half) / whole, (middle + half) / whole


def precision_by(rows: DataFrame, group: str, ok: str) -> DataFrame:
    sums = rows.groupBy(group).agg(F.sum(F.col(ok).cast("double")).alias("good"), F.count("*").cast("double").alias("n"))
    low, high = wilson(F.col("good"), F.col("n"))
    return sums.select(group, F.col("n").cast("long").alias("n"), F.round(F.col("good") / F.col("n"), 6).alias("precision"), F.round(low, 6).alias("low"), F.round(high, 6).alias("high"))


def weighted_precision(rows: DataFrame, group: str, ok: str, weights: DataFrame) -> DataFrame:
    """One row: the precision of each group, weighed by the group's number of all (weights: group, n), and the weights' coverage."""
    each = rows.groupBy(group).agg(F.avg(F.col(ok).cast("double")).alias("p"))
    met = weights.select(group, F.col("n").cast("double").alias("n")).join(each, group, "left")
    covered = F.sum(F.when(F.col("p").isNotNull(), F.col("n")))
    return met.agg(F.round(F.sum(F.col("p") * F.col("n")) / covered, 6).alias("precision"), F.round(covered / F.sum("n"), 6).alias("coverage"))


def upper_median(rows: DataFrame, group: str, value: str) -> DataFrame:
    """The element at n // 2 of each group's sorted values: never an interpolated one.

    Distinct values are counted and sorted over range partitions; places are sums of the
    partitions before and of those inside, so no group is one task's rows.
    """
    counts = rows.groupBy(group, value).agg(F.count("*").alias("c"))
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = durable(counts.repartitionByRange(width, F.col(group).asc_nulls_last(), F.col(value).asc_nulls_last()).withColumn("in_part", F.spark_partition_id()))
    sums = parts.groupBy(group, "in_part").agg(F.sum("c").alias("s"))  # a row for each group and partition at most
    before = Window.partitionBy(group).orderBy("in_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col(group).alias("of_group"), F.col("in_part").alias("of_part"), F.coalesce(F.sum("s").over(before), F.lit(0)).alias("below"), F.sum("s").over(Window.partitionBy(group)).alias("in_all"))
    inside = Window.partitionBy(group, "in_part").orderBy(F.col(value).asc_nulls_last())
    placed = parts.withColumn("upto", F.sum("c").over(inside)).join(sums, F.col(group).eqNullSafe(F.col("of_group")) & (F.col("in_part") == F.col("of_part")))
    return placed.filter(F.col("upto") + F.col("below") > F.floor(F.col("in_all") / 2)).groupBy(group).agg(F.min(value).alias("p50"))


# What a new release is held against, how far each figure may fall, and whether in points or as a share.
GATE = [
    ("recall@10 bm25+graph", 0.02, "abs"),
    ("recall@10 bm25", 0.02, "abs"),
    ("mrr@50 bm25+graph", 0.02, "abs"),
    ("queries evaluated", 0.02, "rel"),
    ("laws", 0.02, "rel"),
    ("CITES edges", 0.03, "rel"),
    ("DELEGATES_TO edges", 0.05, "rel"),
    ("REFERS_TO_ATTACHMENT edges", 0.05, "rel"),
    ("law-to-law pairs", 0.03, "rel"),
    ("cross-law citations resolved", 0.03, "rel"),
]


def release_gate(new: DataFrame, base: DataFrame, limits: list[tuple[str, float, str]] = GATE) -> DataFrame:
    """(metric, old, now, fall, passed) for each limit: a figure fails if it is missing on either side or fell too far. new, base: (metric, value)."""
    asked = new.sparkSession.createDataFrame(limits, "metric string, most double, kind string")
    both = asked.join(base.select("metric", F.col("value").cast("double").alias("old")), "metric", "left").join(new.select("metric", F.col("value").cast("double").alias("now")), "metric", "left")
    points = F.col("old") - F.col("now")
    fall = F.when(F.col("kind") == "abs", points).otherwise(F.when(F.col("old") != 0, points / F.col("old")).otherwise(F.when(F.col("now").isNotNull(), 0.0)))
    return both.withColumn("fall", fall).select("metric", "old", "now", F.round("fall", 6).alias("fall"), F.coalesce(F.col("fall") <= F.col("most"), F.lit(False)).alias("passed"))


def drop_gate(new: DataFrame, base: DataFrame, allowed: float) -> DataFrame:
    """(metric, old, now, passed): a metric fails if it is missing or fell by more than the allowed share."""
    both = base.select("metric", F.col("value").alias("old")).join(new.select("metric", F.col("value").alias("now")), "metric", "left")
    return both.withColumn("passed", F.coalesce(F.col("now") >= F.col("old") * (1 - allowed), F.lit(False)))
