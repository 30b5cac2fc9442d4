"""Trees, versions, graphs, deduplication and measures over the driver's tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.operators import dedup, evaluation, graph, versions
from lexloom.plans.registry import query
from lexloom.session import table
from lexloom.tables import durable

TREE = """tree AS (SELECT 'r' || r_regionkey AS id, CAST(NULL AS VARCHAR) AS parent_id, 'Region' AS type FROM region
 UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, 'Nation' FROM nation
 UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, 'Customer' FROM customer
 UNION ALL SELECT 'o' || o_orderkey, 'c' || o_custkey, 'Order' FROM orders
 UNION ALL SELECT DISTINCT 'l' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey, 'o' || l_orderkey, 'Line' FROM lineitem)"""


def tree(spark: SparkSession, d: str, copies: bool = False) -> DataFrame:
    """Regions, nations, customers, orders and their lines as one containment tree. copies: lines that stand twice stay so, for steps that don't tell them apart."""
    levels = [("region", "r", "r_regionkey", None, None, "Region"), ("nation", "n", "n_nationkey", "r", "n_regionkey", "Nation"), ("customer", "c", "c_custkey", "n", "c_nationkey", "Customer"), ("orders", "o", "o_orderkey", "c", "o_custkey", "Order")]
    out = None
    for name, mark, key, above, parent, kind in levels:
        up = F.lit(None).cast("string") if parent is None else F.concat(F.lit(above), F.col(parent).cast("string"))
        part = table(spark, d, name).select(F.concat(F.lit(mark), F.col(key).cast("string")).alias("id"), up.alias("parent_id"), F.lit(kind).alias("type"))
        out = part if out is None else out.unionByName(part)
    line = F.concat(F.lit("l"), F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]))
    keys = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    lines = keys if copies else keys.distinct()  # numbers are shuffled, not the ids made of them
    return out.unionByName(lines.select(line.alias("id"), F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("parent_id"), F.lit("Line").alias("type")))


@query("node_counts", f"WITH {TREE} SELECT type, count(*) AS n FROM tree GROUP BY type")
def node_counts(spark, d):
    return tree(spark, d).groupBy("type").agg(F.count("*").alias("n"))


@query("contains_edges", f"WITH {TREE} SELECT parent_id AS source, id AS target, 'CONTAINS' AS rel FROM tree WHERE parent_id IS NOT NULL")
def contains(spark, d):
    return tree(spark, d).filter("parent_id is not null").select(F.col("parent_id").alias("source"), F.col("id").alias("target"), F.lit("CONTAINS").alias("rel"))


@query("toc_depth", f"WITH RECURSIVE {TREE}, walk AS (SELECT id, CAST(0 AS BIGINT) AS depth FROM tree WHERE parent_id IS NULL UNION ALL SELECT t.id, w.depth + 1 FROM tree t JOIN walk w ON t.parent_id = w.id) SELECT depth, count(*) AS n FROM walk GROUP BY depth")
def toc_depth(spark, d):
    return graph.depths(tree(spark, d, copies=True)).groupBy("depth").agg(F.count("*").alias("n"))


@query("descendants", f"WITH {TREE}, p AS (SELECT CASE type WHEN 'Region' THEN id WHEN 'Nation' THEN parent_id || '_' || id END AS id FROM tree WHERE type IN ('Region', 'Nation')) SELECT id FROM p WHERE id = 'r1' OR starts_with(id, 'r1_')")
def descendants(spark, d):
    ids = tree(spark, d).filter("type in ('Region', 'Nation')").select(F.when(F.col("type") == "Region", F.col("id")).otherwise(F.concat_ws("_", "parent_id", "id")).alias("id"))
    return graph.descendants(ids, "r1")


@query("check_orphans", f"WITH {TREE}, t AS (SELECT * FROM tree WHERE id <> 'n3') SELECT c.id FROM t c LEFT JOIN t p ON c.parent_id = p.id WHERE c.parent_id IS NOT NULL AND p.id IS NULL")
def orphans(spark, d):
    nodes = tree(spark, d).filter("id <> 'n3'")
    low = nodes.filter("parent_id is not null")
    return low.join(nodes.select(F.col("id").alias("parent_id")), "parent_id", "left_anti").select("id")


@query("check_unreachable", f"WITH RECURSIVE {TREE}, t AS (SELECT * FROM tree WHERE id <> 'n3'), walk AS (SELECT id FROM t WHERE parent_id IS NULL UNION ALL SELECT t.id FROM t JOIN walk w ON t.parent_id = w.id) SELECT count(*) AS n FROM t WHERE id NOT IN (SELECT id FROM walk)")
def unreachable(spark, d):
    lost = graph.unreachable(tree(spark, d, copies=True).filter("id <> 'n3'")).groupBy("id").agg(F.count("*").alias("n"))
    return lost.agg(F.coalesce(F.sum(F.when(F.col("id").startswith("l"), 1).otherwise(F.col("n"))), F.lit(0)).alias("n"))


@query("check_many_parents", "SELECT l_partkey AS target, count(DISTINCT l_suppkey) AS parents FROM lineitem GROUP BY l_partkey HAVING count(DISTINCT l_suppkey) > 1")
def many_parents(spark, d):
    return graph.many_parents(table(spark, d, "lineitem").select(F.col("l_suppkey").alias("source"), F.col("l_partkey").alias("target")))


EDGES = """e AS (SELECT c_nationkey AS src, s_nationkey AS tgt FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey),
p AS (SELECT src, tgt, count(*) AS n FROM e WHERE src <> tgt GROUP BY src, tgt)"""


def pairs(spark: SparkSession, d: str) -> DataFrame:
    """Nations of customers and of the suppliers they buy from, as weighted links."""
    items = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey")
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    buyers = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").cast("long").alias("src"))
    sellers = table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").cast("long").alias("tgt"))
    return graph.weighted_pairs(items.join(orders, "l_orderkey").join(buyers, "o_custkey").join(sellers, "l_suppkey").select("src", "tgt"))


@query("law_pairs", f"WITH {EDGES} SELECT CAST(src AS BIGINT) AS src, CAST(tgt AS BIGINT) AS tgt, n FROM p")
def law_pairs(spark, d):
    return pairs(spark, d)


@query("degrees", f"WITH {EDGES} SELECT CAST(coalesce(a.src, b.tgt) AS BIGINT) AS node, coalesce(a.o, 0) AS n_out, coalesce(b.i, 0) AS n_in FROM (SELECT src, count(DISTINCT tgt) AS o FROM p GROUP BY src) a FULL JOIN (SELECT tgt, count(DISTINCT src) AS i FROM p GROUP BY tgt) b ON a.src = b.tgt")
def degrees(spark, d):
    return graph.degrees(pairs(spark, d))


@query("most_cited", f"WITH {EDGES} SELECT CAST(tgt AS BIGINT) AS tgt, count(DISTINCT src) AS cited_by FROM p WHERE n > 5 GROUP BY tgt ORDER BY cited_by DESC, tgt LIMIT 10")
def most_cited(spark, d):
    return graph.most_cited(pairs(spark, d).filter("n > 5"), 10)


@query("neighbours", f"WITH {EDGES} SELECT CAST(tgt AS BIGINT) AS node, n FROM p WHERE src = 3 ORDER BY n DESC, tgt LIMIT 30")
def neighbours(spark, d):
    return graph.neighbours(pairs(spark, d), 3)


PATH = f"""WITH RECURSIVE {EDGES}, m AS (SELECT avg(n) + stddev_pop(n) AS least FROM p), h AS (SELECT src, tgt, n FROM p, m WHERE n >= least),
w AS (SELECT CAST(0 AS BIGINT) AS hops, CAST(0 AS BIGINT) AS node, [CAST(0 AS BIGINT)] AS path, CAST([] AS BIGINT[]) AS cost
 UNION ALL SELECT hops + 1, CAST(h.tgt AS BIGINT), list_append(path, CAST(h.tgt AS BIGINT)), list_append(cost, -h.n) FROM w JOIN h ON h.src = w.node WHERE hops < 4 AND NOT list_contains(path, h.tgt))
SELECT hops, array_to_string(path, '>') AS path FROM w WHERE node = 13 ORDER BY hops, cost, path LIMIT 1"""


@query("citation_path", PATH)
def citation_path(spark, d):
    """The shortest way from nation 0 to nation 13 over the links that are heavier than most."""
    all_ = pairs(spark, d)
    least = all_.agg((F.avg("n") + F.stddev_pop("n")).alias("least"))
    return graph.shortest_path(durable(all_.join(F.broadcast(least)).filter("n >= least").select("src", "tgt", "n")), 0, 13)  # least: one row


@query("expand_scores", f"WITH {EDGES}, h AS (SELECT n_nationkey AS node, CAST(n_nationkey + 1 AS DOUBLE) AS score FROM nation WHERE n_nationkey < 5), a AS (SELECT node, score FROM h UNION ALL SELECT tgt, score * 0.5 FROM h JOIN p ON h.node = p.src) SELECT CAST(node AS BIGINT) AS node, round(sum(score), 6) AS score FROM a GROUP BY node")
def expand_scores(spark, d):
    hits = table(spark, d, "nation").filter("n_nationkey < 5").select(F.col("n_nationkey").cast("long").alias("node"), (F.col("n_nationkey") + 1).cast("double").alias("score"))
    return graph.expand_scores(hits, pairs(spark, d), 0.5).withColumn("score", F.round("score", 6))


@query("supersedes", "SELECT user_id, event_id, previous FROM (SELECT user_id, event_id, lag(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous FROM events) WHERE previous IS NOT NULL")
def supersedes(spark, d):
    return versions.supersedes(table(spark, d, "events").select("user_id", "event_id", "ts"), "user_id", "event_id", ["ts", "event_id"])


def _orders(spark, d):
    return table(spark, d, "orders").select("o_custkey", "o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").alias("day"))


@query(
    "as_of_version",
    """WITH v AS (SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y%m%d') AS day FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY day <= '19950101' DESC, CASE WHEN day <= '19950101' THEN day END DESC, CASE WHEN day <= '19950101' THEN o_orderkey END DESC, day, o_orderkey) AS rn FROM v)
SELECT o_custkey, o_orderkey, day, day <= '19950101' AS in_force FROM r WHERE rn = 1""",
)
def as_of_version(spark, d):
    return versions.as_of(_orders(spark, d), "o_custkey", "day", "o_orderkey", "19950101")


@query(
    "pending_versions",
    """SELECT o_custkey, o_orderkey, day, previous FROM (SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y%m%d') AS day,
 lag(o_orderkey) OVER w AS previous, row_number() OVER w AS nr FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY strftime(o_orderdate, '%Y%m%d'), o_orderkey)) WHERE day > '19950101' AND nr > 1""",
)
def pending_versions(spark, d):
    return versions.pending(_orders(spark, d), "o_custkey", "o_orderkey", "day", "o_orderkey", "19950101")


@query("first_wins", "SELECT doc_id, md5(text) AS digest FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1")
def first_wins(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.md5(F.col("text").cast("binary")).alias("digest"))
    return dedup.first_wins(docs, ["digest"], ["doc_id"])


@query("last_wins", "SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1")
def last_wins(spark, d):
    return dedup.last_wins(table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey")


@query("unambiguous_names", "SELECT md5(text) AS name, min(source) AS source FROM documents GROUP BY text HAVING count(DISTINCT source) = 1")
def unambiguous(spark, d):
    """Whole texts as names, sources as their owners: copies in two sources are ambiguous."""
    return dedup.unambiguous(table(spark, d, "documents").select(F.md5(F.col("text").cast("binary")).alias("name"), "source"), "name", "source")


@query("set_difference", "SELECT DISTINCT source FROM documents WHERE lang = 'fr' EXCEPT SELECT DISTINCT source FROM documents WHERE n_chars > 40000")
def set_difference(spark, d):
    docs = table(spark, d, "documents")
    return docs.filter("lang = 'fr'").select("source").subtract(docs.filter("n_chars > 40000").select("source"))


@query("text_floor", "SELECT lang, CAST(list_sort(list(n_chars))[count(*) // 2 + 1] AS BIGINT) AS p50 FROM documents GROUP BY lang")
def text_floor(spark, d):
    return evaluation.upper_median(table(spark, d, "documents").select("lang", "n_chars"), "lang", "n_chars")


@query(
    "kappa",
    """WITH s AS (SELECT count(*) AS n, sum(CASE WHEN quality = toxic THEN 1.0 ELSE 0.0 END) / count(*) AS po, avg(CAST(quality AS DOUBLE)) AS a, avg(CAST(toxic AS DOUBLE)) AS b FROM labels),
t AS (SELECT n, po, a * b + (1 - a) * (1 - b) AS pe FROM s) SELECT n, round(CAST(po AS DOUBLE), 6) AS po, round(pe, 6) AS pe, round((po - pe) / (1 - pe), 6) AS kappa FROM t""",
)
def kappa(spark, d):
    return evaluation.kappa(table(spark, d, "labels"), "quality", "toxic")


@query(
    "precision_wilson",
    """WITH g AS (SELECT source, CAST(sum(quality) AS DOUBLE) AS good, CAST(count(*) AS DOUBLE) AS n FROM labels JOIN documents USING (doc_id) GROUP BY source), q AS (SELECT *, good / n AS p FROM g)
SELECT source, CAST(n AS BIGINT) AS n, round(p, 6) AS precision, round((p + 1.96 * 1.96 / (2 * n) - 1.96 * sqrt(p * (1 - p) / n + 1.96 * 1.96 / (4 * n * n))) / (1 + 1.96 * 1.96 / n), 6) AS low,
 round((p + 1.96 * 1.96 / (2 * n) + 1.96 * sqrt(p * (1 - p) / n + 1.96 * 1.96 / (4 * n * n))) / (1 + 1.96 * 1.96 / n), 6) AS high FROM q""",
)
def precision_wilson(spark, d):
    rows = table(spark, d, "labels").select("doc_id", "quality").join(table(spark, d, "documents").select("doc_id", "source"), "doc_id")
    return evaluation.precision_by(rows, "source", "quality")


@query(
    "regression_gate",
    """WITH b AS (SELECT lang AS metric, CAST(count(*) AS DOUBLE) AS value FROM documents GROUP BY lang),
n AS (SELECT lang AS metric, CAST(count(DISTINCT source) * 20 AS DOUBLE) AS value FROM documents WHERE lang <> 'es' GROUP BY lang)
SELECT b.metric, b.value AS old, n.value AS now, coalesce(n.value >= b.value * (1 - 0.3333), false) AS passed FROM b LEFT JOIN n USING (metric)""",
)
def regression_gate(spark, d):
    """Documents of each language against twenty for each of its sources; one language is missing on purpose."""
    docs = table(spark, d, "documents").select("source", F.col("lang").alias("metric"))
    base = docs.groupBy("metric").agg(F.count("*").cast("double").alias("value"))
    new = docs.filter("metric <> 'es'").groupBy("metric").agg((F.countDistinct("source") * 20).cast("double").alias("value"))
    return evaluation.drop_gate(new, base, 0.3333)


@query(
    "release_gate",
    """WITH c AS (SELECT (SELECT count(*) FROM orders) AS laws, (SELECT count(*) FROM lineitem) AS cites, (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS pairs),
b AS (SELECT unnest(['laws', 'CITES edges', 'law-to-law pairs', 'recall@10 bm25', 'DELEGATES_TO edges']) AS metric, unnest([laws, cites, laws, 0.5, 0]) AS value FROM c),
n AS (SELECT unnest(['laws', 'CITES edges', 'law-to-law pairs', 'recall@10 bm25', 'DELEGATES_TO edges']) AS metric, unnest([laws * 0.985, cites * 0.5, pairs, 0.485, 7]) AS value FROM c),
g AS (SELECT unnest(['recall@10 bm25+graph', 'recall@10 bm25', 'mrr@50 bm25+graph', 'queries evaluated', 'laws', 'CITES edges', 'DELEGATES_TO edges', 'REFERS_TO_ATTACHMENT edges', 'law-to-law pairs', 'cross-law citations resolved']) AS metric,
 unnest([0.02, 0.02, 0.02, 0.02, 0.02, 0.03, 0.05, 0.05, 0.03, 0.03]) AS most, unnest(['abs', 'abs', 'abs', 'rel', 'rel', 'rel', 'rel', 'rel', 'rel', 'rel']) AS kind),
j AS (SELECT g.metric, most, CAST(b.value AS DOUBLE) AS old, CAST(n.value AS DOUBLE) AS now, CASE WHEN kind = 'abs' THEN CAST(b.value AS DOUBLE) - CAST(n.value AS DOUBLE) WHEN b.value <> 0 THEN (CAST(b.value AS DOUBLE) - CAST(n.value AS DOUBLE)) / CAST(b.value AS DOUBLE) WHEN n.value IS NOT NULL THEN 0.0 END AS fall FROM g LEFT JOIN b USING (metric) LEFT JOIN n USING (metric))
SELECT metric, old, now, round(CAST(fall AS DOUBLE), 6) AS fall, coalesce(fall <= most, false) AS passed FROM j""",
)
def release_gate(spark, d):
    """Ten figures against their limits: some held, one fallen by points, one by half, some missing."""
    one = lambda df, c: df.agg(c.cast("double").alias("value"))
    laws, cites, linked = one(table(spark, d, "orders"), F.count("*")), one(table(spark, d, "lineitem"), F.count("*")), one(table(spark, d, "lineitem"), F.countDistinct("l_orderkey"))

    def rows(parts):
        made = [(df.select(F.lit(name).alias("metric"), (F.col("value") * share).alias("value"))) for name, df, share in parts]
        made += [spark.createDataFrame(few, "metric string, value double")]
        return reduce(DataFrame.unionByName, made)

    few = [("recall@10 bm25", 0.5), ("DELEGATES_TO edges", 0.0)]
    base = rows([("laws", laws, 1.0), ("CITES edges", cites, 1.0), ("law-to-law pairs", laws, 1.0)])
    few = [("recall@10 bm25", 0.485), ("DELEGATES_TO edges", 7.0)]
    return evaluation.release_gate(rows([("laws", laws, 0.985), ("CITES edges", cites, 0.5), ("law-to-law pairs", linked, 1.0)]), base)


@query(
    "weighted_precision",
    """WITH g AS (SELECT source, avg(CAST(quality AS DOUBLE)) AS p FROM labels JOIN documents USING (doc_id) GROUP BY source), w AS (SELECT source, CAST(count(*) AS DOUBLE) AS n FROM documents GROUP BY source)
SELECT round(sum(p * n) / sum(CASE WHEN p IS NOT NULL THEN n END), 6) AS precision, round(sum(CASE WHEN p IS NOT NULL THEN n END) / sum(n), 6) AS coverage FROM w LEFT JOIN g USING (source)""",
)
def weighted_precision(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source")
    rows = table(spark, d, "labels").select("doc_id", "quality").join(docs, "doc_id")
    return evaluation.weighted_precision(rows, "source", "quality", docs.groupBy("source").agg(F.count("*").alias("n")))


@query(
    "link_spans",
    r"""WITH u AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS target, generate_subscripts(regexp_extract_all(html, 'href="([^"]*)"', 1), 1) AS pos FROM pages) SELECT page_id, CAST(pos - 1 AS BIGINT) AS pos, target FROM u""",
)
def link_spans(spark, d):
    found = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))
    return table(spark, d, "pages").select("page_id", F.posexplode(found).alias("pos", "target")).withColumn("pos", F.col("pos").cast("long"))


@query("chunks", "SELECT conv_id, md5(string_agg(role || ': ' || text, chr(10) ORDER BY turn)) AS body, count(*) AS turns FROM conversations GROUP BY conv_id")
def chunks(spark, d):
    """Children joined in order into one text for each parent."""
    rows = table(spark, d, "conversations").select("conv_id", F.struct("turn", F.concat_ws(": ", "role", "text").alias("line")).alias("t"))
    whole = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"), F.count("*").alias("turns"))
    return whole.select("conv_id", F.md5(F.array_join(F.transform("ts", lambda t: t["line"]), "\n").cast("binary")).alias("body"), "turns")
