"""The retrieval benchmark: gold questions against the search, by text alone and with citations."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.functions.ids import article_of
from lexloom.operators import evaluation, search
from lexloom.tables import durable

CUTOFFS = (1, 5, 10, 20, 50)


def usable_gold(gold: DataFrame, nodes: DataFrame) -> tuple[DataFrame, dict]:
    """((id, query, article) of gold articles that exist, how many records there are, have an answer, and can be used)."""
    given = gold.select("id", "query", F.explode("gold_articles").alias("node")).withColumn("article", article_of(F.col("node"))).filter("article is not null").select("id", "query", "article").distinct()
    there = durable(given.join(nodes.select(F.col("id").alias("article")), "article", "left_semi"))
    count = lambda df: df.select("id").distinct().count()
    return there, {"records": gold.count(), "with_gold": count(given), "usable": count(there)}


def evaluate(engine, gold: DataFrame, depth: int = 100) -> dict:
    """Hits among the first 1 to 50 articles and the mean reciprocal rank, for both methods; all questions are asked at once."""
    there, stats = usable_gold(gold, engine.nodes_)
    asked = there.select("id", "query").distinct()
    out = {"gold": stats, "evaluated": stats["usable"], "methods": {}}
    articles = engine.chunks_.select("node_id", F.col("article_id").alias("article"))
    began = time.perf_counter()
    hits = durable(search.natural_search(engine.chunks_, asked, "node_id", "body", "id", "query", depth, "heading", engine.index_))
    ranked = {"bm25": evaluation.by_article(hits, articles, "id", "node_id"), "bm25+graph": search.graph_search(hits, articles, engine.edges_, "id", "node_id")}
    for name, rows in ranked.items():
        firsts = evaluation.first_ranks(rows.filter(F.col("rank") <= max(CUTOFFS)), there, "id", "article")
        row = evaluation.retrieval_measures(firsts, CUTOFFS).first()
        seconds = (time.perf_counter() - began) / max(stats["usable"], 1)
        out["methods"][name] = {"queries": row["n"]} | {f"recall@{k}": row[f"hit_{k}"] for k in CUTOFFS} | {"mrr@50": row["mrr"], "sec_per_query": round(seconds, 3)}
    return out
