"""Retrieval queries: documents are the corpus, benchmark passages the queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.operators import evaluation, search
from lexloom.operators.bm25 import bm25_top, postings, terms_of
from lexloom.plans.registry import query
from lexloom.session import table
from lexloom.tables import lookup, stored

SCORES = """runs AS (SELECT item_id, unnest(regexp_extract_all(lower(text), '[0-9a-z]{3,}')) AS run, generate_subscripts(regexp_extract_all(lower(text), '[0-9a-z]{3,}'), 1) AS nr FROM benchmark),
grams AS (SELECT item_id, nr, unnest(range(1, length(run) - 1)) AS i, run FROM runs),
seen AS (SELECT item_id, substr(run, i, 3) AS gram, min(nr * 10000 + i) AS spot FROM grams GROUP BY ALL),
qt AS (SELECT item_id, gram FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY spot) AS r FROM seen) WHERE r <= 64),
g AS (SELECT doc_id, greatest(length(text) - 2, 0) AS len, unnest(list_transform(range(1, length(text) - 1), lambda i: substr(lower(text), i, 3))) AS gram FROM documents WHERE length(text) >= 3),
tf AS (SELECT gram, doc_id, len, count(*) AS tf FROM g WHERE gram IN (SELECT gram FROM qt) GROUP BY ALL),
df AS (SELECT gram, count(*) AS df FROM tf GROUP BY gram),
st AS (SELECT count(*) AS n, avg(greatest(length(text) - 2, 0)) AS avgdl FROM documents),
s AS (SELECT item_id, doc_id, round(sum(greatest(ln((n - df + 0.5) / (df + 0.5)), 0.000001) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / avgdl))), 6) AS score
      FROM qt JOIN tf USING (gram) JOIN df USING (gram), st GROUP BY item_id, doc_id),
ranked AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s)"""


def _top(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bm25_top(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"), k)


@query("bm25_topk", f"WITH {SCORES} SELECT item_id, doc_id, score, rank FROM ranked WHERE rank <= 10")
def bm25_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _top(spark, sf_dir, 10)


#: Trigrams of a passage that a document must hold to be looked at.
RARE = 4
GOLD = "gold AS (SELECT item_id, doc_id FROM benchmark b JOIN documents d ON contains(d.text, b.text))"


def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a passage: an equi-join on a few rare trigrams, then a look at the text.

    Each passage is looked for through the trigrams of its own that fewest documents hold;
    a document that holds the passage holds them all.
    """
    from pyspark.sql import Window

    items = table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("passage"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    terms = terms_of(items, "item_id", "passage")
    # read for the counts and for the documents; cutting texts into trigrams takes far longer than reading what it gave
    posted = stored(postings(docs, only=terms).select("gram", "doc_id"))
    counted = terms.join(posted.groupBy("gram").agg(F.count("*").alias("df")), "gram")
    order = Window.partitionBy("item_id")
    rare = counted.withColumn("r", F.row_number().over(order.orderBy("df", "gram"))).filter(F.col("r") <= RARE).withColumn("wanted", F.count("*").over(order))
    met = rare.select("item_id", "gram", "wanted").join(posted, "gram").groupBy("item_id", "doc_id", "wanted").agg(F.count("*").alias("n"))
    maybe = lookup(met.filter("n = wanted").select("item_id", "doc_id"))
    return docs.join(maybe, "doc_id").join(items, "item_id").filter(F.contains("text", F.col("passage"))).select("item_id", "doc_id")


@query("gold_passages", f"WITH {GOLD} SELECT item_id, doc_id FROM gold")
def gold_passages(spark, sf_dir):
    return _gold(spark, sf_dir)


@query(
    "retrieval_measures",
    f"""WITH {SCORES}, {GOLD}, f AS (SELECT q.item_id, min(r.rank) - 1 AS first FROM (SELECT DISTINCT item_id FROM gold) q LEFT JOIN (gold JOIN ranked r USING (item_id, doc_id)) r ON q.item_id = r.item_id AND r.rank <= 50 GROUP BY q.item_id)
SELECT count(*) AS n, round(avg(CASE WHEN first < 1 THEN 1.0 ELSE 0.0 END), 4) AS hit_1, round(avg(CASE WHEN first < 5 THEN 1.0 ELSE 0.0 END), 4) AS hit_5, round(avg(CASE WHEN first < 10 THEN 1.0 ELSE 0.0 END), 4) AS hit_10,
 round(avg(CASE WHEN first < 20 THEN 1.0 ELSE 0.0 END), 4) AS hit_20, round(avg(CASE WHEN first < 50 THEN 1.0 ELSE 0.0 END), 4) AS hit_50, round(avg(coalesce(1.0 / (first + 1), 0.0)), 4) AS mrr FROM f""",
)
def retrieval_measures(spark, sf_dir):
    ranked = _top(spark, sf_dir, 50)
    return evaluation.retrieval_measures(evaluation.first_ranks(ranked, _gold(spark, sf_dir), "item_id", "doc_id"))


@query(
    "keyword_search",
    """WITH t AS (SELECT doc_id, text, length(text) AS len, (length(text) - length(replace(lower(text), 'license', ''))) // 7 AS tf FROM documents), st AS (SELECT count(*) AS n, avg(len) AS a, count(*) FILTER (WHERE tf > 0) AS df FROM t),
f AS (SELECT doc_id, round(greatest(ln((n - df + 0.5) / (df + 0.5)), 0.000001) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / a)), 6) AS score FROM t, st WHERE tf > 0 AND contains(text, 'by'))
SELECT doc_id, score FROM f ORDER BY score DESC, doc_id LIMIT 20""",
)
def keyword_search(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return search.keyword_search(docs, "LICENSE by", "doc_id", "text").select("doc_id", "score")


@query("short_term_search", "SELECT doc_id, round(((length(text) - length(replace(lower(text), 'zu', ''))) // 2 + (length(text) - length(replace(lower(text), 'ü', ''))) // 1) / (length(text) + 50), 6) AS score FROM documents WHERE contains(text, 'zu') AND contains(text, 'ü') ORDER BY score DESC, doc_id LIMIT 20")
def short_term_search(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return search.keyword_search(docs, "zu ü", "doc_id", "text").select("doc_id", "score")


@query(
    "snippets",
    """WITH p AS (SELECT doc_id, text, strpos(text, 'License') - 1 AS spot FROM documents WHERE contains(lower(text), 'license')), q AS (SELECT doc_id, text, greatest(spot, 0) AS spot FROM p)
SELECT doc_id, (CASE WHEN spot > 20 THEN '…' ELSE '' END) || replace(replace(CASE WHEN spot < 20 THEN substr(text, 1, spot + 60) ELSE substr(text, greatest(0, spot - 20) + 1, 80) END, 'License', '【License】'), chr(10), ' ') || '…' AS snippet FROM q""",
)
def snippets(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").filter(F.contains(F.lower("text"), F.lit("license")))
    return docs.select("doc_id", search.snippet(F.col("text"), ["License"]).alias("snippet"))


@query("candidate_names", "SELECT p_partkey, p_name FROM part WHERE contains(p_name, 'a') ORDER BY length(p_name), p_partkey LIMIT 8")
def candidate_names(spark, sf_dir):
    return table(spark, sf_dir, "part").filter(F.contains("p_name", F.lit("a"))).select("p_partkey", "p_name").orderBy(F.length("p_name"), "p_partkey").limit(8)
