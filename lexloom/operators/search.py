"""Search units, keyword and natural search, look-ups of citations, and readable text.

Documents searched are chunks: a paragraph with its items, or an attachment, each with a
heading. A term of three or more characters matches as a phrase without case; a shorter
one as a plain substring. Both filters are built-in functions over the chunk table; BM25
counts each term's occurrences the way a trigram index with a phrase query does.
"""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexloom.functions.citations import NUMBER, branches
from lexloom.functions.ids import article_of
from lexloom.functions.numerals import to_int
from lexloom.operators.bm25 import B, K1, LEAST_IDF, bm25_top, indexed

#: A hit in the heading counts twice.
HEADING_WEIGHT, BODY_WEIGHT = 2, 1
SNIPPET = 60


def chunks(nodes: DataFrame) -> DataFrame:
    """(node_id, law_id, article_id, section, heading, body), in document order by seq."""
    text = F.coalesce("text", F.lit(""))
    items = nodes.filter("type = 'Item'").filter(text != "").groupBy(F.col("parent_id").alias("node_id"))
    items = items.agg(F.array_sort(F.collect_list(F.struct("seq", "text"))).alias("items"))
    titles = nodes.filter(F.col("type").isin("Article", "SupplArticle")).select(F.col("id").alias("article_id"), F.col("title").alias("article_title"))
    paragraphs = nodes.filter(F.col("type").isin("Paragraph", "SupplParagraph")).select(F.col("id").alias("node_id"), "law_id", F.col("parent_id").alias("article_id"), "section", "type", "law_title", "paragraph_num", "seq", text.alias("own"))
    whole = paragraphs.join(titles, "article_id", "left").join(items, "node_id", "left")
    name = F.coalesce("article_title", F.lit(""))
    plain = F.concat(F.trim(F.concat_ws(" ", "law_title", name)), F.when(F.col("paragraph_num") > 1, F.concat(F.lit(" 第"), F.col("paragraph_num").cast("string"), F.lit("項"))).otherwise(""))
    heading = F.when((F.col("type") == "SupplParagraph") & ~name.startswith("附則"), F.trim(F.concat_ws(" ", F.col("law_title"), F.lit("附則"), name))).otherwise(plain)
    lines = F.transform(F.coalesce("items", F.array().cast("array<struct<seq:bigint,text:string>>")), lambda x: x["text"])
    body = F.array_join(F.concat(F.array("own"), lines), "\n")
    made = whole.select("node_id", "law_id", "article_id", "section", heading.alias("heading"), body.alias("body"), "seq")
    annexes = nodes.filter("type = 'Attachment'").select(F.col("id").alias("node_id"), "law_id", F.lit(None).cast("string").alias("article_id"), F.lit("main").alias("section"), F.trim(F.concat_ws(" ", "law_title", "title")).alias("heading"), text.alias("body"), "seq")
    return made.unionByName(annexes)


def occurrences(text: Column, term: str) -> Column:
    """How often a term stands in a text, overlaps counted once, without case."""
    return ((F.length(text) - F.length(F.replace(F.lower(text), F.lit(term.lower()), F.lit("")))) / len(term)).cast("int")


def contains(text: Column, term: str) -> Column:
    return F.contains(F.lower(text), F.lit(term.lower())) if len(term) >= 3 else F.contains(text, F.lit(term))


def keyword_search(rows: DataFrame, query: str, key: str, body: str, heading: str | None = None, limit: int = 20, offset: int = 0) -> DataFrame:
    """(key, score, snippet, ...): rows that hold every term, best first.

    With a long term the score is BM25 over the long terms; with short terms alone it is
    their number over the length of the body plus 50.
    """
    terms = [unicodedata.normalize("NFKC", t) for t in query.split()]
    if not terms:
        return rows.limit(0).withColumn("score", F.lit(0.0)).withColumn("snippet", F.lit(""))
    long, cols = [t for t in terms if len(t) >= 3], [body] + [heading] * bool(heading)
    hit = F.lit(True)
    for t in terms:
        here = contains(F.col(body), t)
        hit = hit & (here | contains(F.col(heading), t) if heading else here)
    found = rows.filter(hit)
    size = lambda: sum((F.length(c) for c in cols), F.lit(0))
    if long:
        # one row of statistics over all rows, another for each term: no data grows with them
        stats = rows.agg(F.count("*").alias("n"), F.avg(size()).alias("avg_len"), *[F.sum(F.when(contains(F.col(body), t) | (contains(F.col(heading), t) if heading else F.lit(False)), 1).otherwise(0)).alias(f"df{i}") for i, t in enumerate(long)]).first()
        score = F.lit(0.0)
        for i, t in enumerate(long):
            tf = BODY_WEIGHT * occurrences(F.col(body), t) + (HEADING_WEIGHT * occurrences(F.col(heading), t) if heading else 0)
            idf = F.greatest(F.log((F.lit(stats["n"]) - stats[f"df{i}"] + 0.5) / (F.lit(stats[f"df{i}"]) + 0.5)), F.lit(LEAST_IDF))
            score = score + idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size() / F.lit(stats["avg_len"] or 1.0)))
    else:
        score = sum((occurrences(F.col(body), t) for t in terms), F.lit(0)) / (F.length(body) + 50)
    ranked = found.withColumn("score", F.round(score, 6)).orderBy(F.desc("score"), key).offset(offset).limit(limit)
    return ranked.withColumn("snippet", snippet(F.col(body), terms))


def snippet(body: Column, terms: list[str], width: int = SNIPPET) -> Column:
    """The text around the first term, with terms in brackets."""
    spots = [F.when(F.locate(t, body) > 0, F.locate(t, body) - 1) for t in terms]
    at = F.coalesce(F.least(*spots) if len(spots) > 1 else spots[0], F.lit(0))
    out = F.substring(body, F.greatest(F.lit(0), at - width // 3) + 1, F.lit(width + width // 3))
    out = F.when(at < width // 3, F.substring(body, F.lit(1), at + width)).otherwise(out)
    for t in terms:
        out = F.replace(out, F.lit(t), F.lit(f"【{t}】"))
    return F.concat(F.when(at > width // 3, "…").otherwise(""), F.replace(out, F.lit("\n"), F.lit(" ")), F.lit("…"))


def natural_search(rows: DataFrame, queries: DataFrame, key: str, body: str, qkey: str, text: str, k: int = 100, heading: str | None = None, index: DataFrame | None = None) -> DataFrame:
    """(qkey, key, score, rank): the k best rows of each query by BM25 of any shared trigram, headings weighing HEADING_WEIGHT. index: as ``search_index`` gave it, of these rows."""
    return bm25_top(rows, queries.select(qkey, text), k, key=key, qkey=qkey, text=body, qtext=text, heading=heading, heading_weight=HEADING_WEIGHT, index=index)


def search_index(rows: DataFrame, key: str, body: str, heading: str) -> DataFrame:
    """All trigrams of each row with their weighted frequencies, to be stored beside the chunks."""
    return indexed(rows, None, key, {body: BODY_WEIGHT, heading: HEADING_WEIGHT})


def graph_search(hits: DataFrame, articles: DataFrame, edges: DataFrame, qkey: str, key: str, expand: int = 20, links: int = 50, weight: float = 0.5) -> DataFrame:
    """(qkey, article, rank): articles of ranked hits and those that the best hits cite, by reciprocal ranks.

    An article scores 1 / (59 + rank) of its best hit. Each of the ``expand`` best hits hands
    ``weight`` times its own score to the articles that its first ``links`` citations go to.
    articles: (key, article) of what is searched; edges: EDGE rows.
    """
    reciprocal = 1 / (F.col("rank") + 59)
    placed = hits.join(articles.select(key, "article"), key, "left").withColumn("score", reciprocal)
    own = placed.filter("article is not null").groupBy(qkey, "article").agg(F.max("score").alias("score"))
    first = Window.partitionBy("hit").orderBy("occ_seq", "target")
    cites = edges.filter("rel = 'CITES'").select(F.col("source"), "target", "occ_seq")
    # a chunk's citations are those of its node and of what lies below it
    best = placed.filter(F.col("rank") <= expand).select(qkey, F.col(key).alias("hit"), F.col("article").alias("from"), "score")
    ends = cites.withColumn("hit", F.explode(F.array_distinct(F.array("source", F.regexp_replace("source", "_i[0-9][0-9-]*$", "")))))
    near = ends.join(best.select("hit").distinct(), "hit", "left_semi").withColumn("nr", F.row_number().over(first)).filter(F.col("nr") <= links)
    passed = best.join(near, "hit").withColumn("article", article_of(F.col("target"))).filter(F.col("article").isNotNull() & ~F.col("article").eqNullSafe(F.col("from")))
    passed = passed.groupBy(qkey, "article").agg((F.sum("score") * weight).alias("score"))
    sums = own.unionByName(passed).groupBy(qkey, "article").agg(F.round(F.sum("score"), 9).alias("score"))
    return sums.select(qkey, "article", F.row_number().over(Window.partitionBy(qkey).orderBy(F.desc("score"), "article")).cast("long").alias("rank"))


def filtered(found: DataFrame, laws: DataFrame, law_type: str | None = None, active: bool = True, section: str | None = None, law_id: str | None = None) -> DataFrame:
    """Chunks of laws of a type and in force, of a section, or of one law."""
    if law_id:
        found = found.filter(F.col("law_id") == law_id)
    if section in ("main", "suppl"):
        found = found.filter(F.col("section") == section)
    wanted = laws
    if law_type:
        wanted = wanted.filter(F.col("law_type") == law_type)
    if active:
        wanted = wanted.filter("is_active")
    return found.join(wanted.select("law_id"), "law_id", "left_semi") if law_type or active else found


# ---------------------------------------------------------------- citations as queries

# The forms a citation may be typed in: 第 may be left out, numerals may be of either kind.
_TYPED = re.compile(rf"^(?P<law>.*?)\s*(?P<suppl>附則)?\s*第?(?P<art>{NUMBER})条(?P<eda>(?:の{NUMBER})*)(?:\s*第?(?P<para>{NUMBER})項)?(?:\s*第?(?P<item>{NUMBER})号(?P<ieda>(?:の{NUMBER})*))?\s*$")


def parse_citation(text: str) -> dict | None:
    """law, suppl, article_path, paragraph, item_path of a typed citation; None if it is none."""
    m = _TYPED.match(unicodedata.normalize("NFKC", text).strip())
    if not m or to_int(m["art"]) is None:
        return None
    path = lambda head, rest: "-".join(map(str, [to_int(head), *branches(rest)])) if head else None
    return {"law": m["law"].strip(), "suppl": bool(m["suppl"]), "article_path": path(m["art"], m["eda"]), "paragraph": to_int(m["para"]), "item_path": path(m["item"], m["ieda"])}


def candidate_ids(law_id: str, cited: dict, suppl_tag: str | None = None) -> list[str]:
    """Node ids a citation can mean, the most specific first."""
    if cited["suppl"] and suppl_tag is None:
        return []
    base = f"{law_id}_asup-{suppl_tag}-{cited['article_path']}" if cited["suppl"] else f"{law_id}_a{cited['article_path']}"
    p, i = cited["paragraph"], cited["item_path"]
    if p is None:
        return ([f"{base}_p1_i{i}"] if i else []) + [base]
    return ([f"{base}_p{p}_i{i}"] if i else []) + [f"{base}_p{p}", base]


def first_existing(nodes: DataFrame, ids: list[str]) -> DataFrame:
    """The node of the first id in the list that there is, with its rank."""
    spark: SparkSession = nodes.sparkSession
    wanted = spark.createDataFrame(list(enumerate(ids)), "rank int, id string")
    return nodes.join(F.broadcast(wanted), "id").orderBy("rank").limit(1)  # three rows at most


def readable(nodes: DataFrame, node_id: str) -> str:
    """An article, paragraph, item or attachment as text. One node's own rows come to the driver."""
    below = nodes.filter((F.col("id") == node_id) | F.col("id").startswith(F.lit(node_id + "_"))).orderBy("seq").select("id", "type", "title", "text", "paragraph_num").collect()
    lines = []
    for r in below:
        text = r["text"] or ""
        if r["type"] in ("Article", "SupplArticle"):
            lines.append(r["title"])
        elif r["type"] in ("Paragraph", "SupplParagraph"):
            lines.append((f"{r['paragraph_num']} " if (r["paragraph_num"] or 0) > 1 else "") + text)
        elif r["type"] == "Item" and r["id"] != node_id:
            lines += ["  " + text.replace("\n", "　", 1).replace("\n", "\n    ")] * bool(text)
        elif r["type"] in ("Item", "Attachment"):
            lines.append(text)
    return "\n".join(lines)


def references(edges: DataFrame, nodes: DataFrame, node_id: str, direction: str, rels: list[str] | None = None, limit: int = 200) -> DataFrame:
    """Edges that touch a node or what lies below it, with the other end's title and law."""
    mine, other = ("source", "target") if direction == "out" else ("target", "source")
    touching = edges.filter((F.col(mine) == node_id) | F.col(mine).startswith(F.lit(node_id + "_")))
    if rels:
        touching = touching.filter(F.col("rel").isin(rels))
    ends = nodes.select(F.col("id").alias(other), F.col("title").alias(f"{other}_title"), F.col("law_id").alias(f"{other}_law"), F.col("law_title").alias(f"{other}_law_title"))
    return touching.join(ends, other, "left").orderBy("occ_seq", "source", "target", "rel").limit(limit)


def contents(nodes: DataFrame, law_id: str) -> DataFrame:
    """A law's divisions and articles in order."""
    return nodes.filter((F.col("law_id") == law_id) & F.col("type").isin("Hierarchy", "Article")).select("id", "type", "title", "parent_id", "seq").orderBy("seq")
