"""Graph operators over edge tables: weights, degrees, neighbours, paths, trees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexloom.tables import FEW_ROWS, durable, stored


def weighted_pairs(edges: DataFrame, src: str = "src", tgt: str = "tgt") -> DataFrame:
    """(src, tgt, n): links between different ends, counted."""
    return edges.filter(F.col(src) != F.col(tgt)).groupBy(src, tgt).agg(F.count("*").alias("n"))


def degrees(pairs: DataFrame, src: str = "src", tgt: str = "tgt") -> DataFrame:
    """(node, n_out, n_in): distinct neighbours each way."""
    out = pairs.groupBy(F.col(src).alias("node")).agg(F.countDistinct(tgt).alias("n_out"))
    into = pairs.groupBy(F.col(tgt).alias("node")).agg(F.countDistinct(src).alias("n_in"))
    return out.join(into, "node", "full").select("node", F.coalesce("n_out", F.lit(0)).alias("n_out"), F.coalesce("n_in", F.lit(0)).alias("n_in"))


def most_cited(pairs: DataFrame, k: int, src: str = "src", tgt: str = "tgt") -> DataFrame:
    return pairs.groupBy(tgt).agg(F.countDistinct(src).alias("cited_by")).orderBy(F.desc("cited_by"), tgt).limit(k)


def neighbours(pairs: DataFrame, node, direction: str = "out", k: int = 30) -> DataFrame:
    """A node's neighbours by falling weight, the k heaviest; direction: out (what it cites) or in (what cites it)."""
    mine, other = ("src", "tgt") if direction == "out" else ("tgt", "src")
    return pairs.filter(F.col(mine) == node).select(F.col(other).alias("node"), "n").orderBy(F.desc("n"), "node").limit(k)


def shortest_path(pairs: DataFrame, start, goal, most_hops: int = 4) -> DataFrame:
    """(hops, path): a shortest chain of outgoing links, heavier links first on ties; no row if there is none.

    A breadth-first search by joins: each hop joins the frontier with the links, drops the
    nodes seen before, and keeps one way to each new node. Frontiers stay distributed, and
    are written, so a hop's plan doesn't hold the hops before it.
    """
    spark, kind = pairs.sparkSession, pairs.schema["src"].dataType.simpleString()
    frontier = spark.range(1).select(F.lit(start).cast(kind).alias("node"), F.array(F.lit(start).cast(kind)).alias("path"), F.array().cast("array<bigint>").alias("cost"))
    seen, links = frontier.select("node"), pairs.withColumnRenamed("src", "node")
    best = Window.partitionBy("node").orderBy("cost", "path")
    found = frontier.filter(F.col("node") == F.lit(goal).cast(kind))
    hops = 0
    while start != goal and hops < most_hops:
        hops += 1
        step = frontier.join(links, "node").select(F.col("tgt").alias("node"), F.concat("path", F.array("tgt")).alias("path"), F.concat("cost", F.array(-F.col("n"))).alias("cost"))
        step = step.join(seen, "node", "left_anti").withColumn("rn", F.row_number().over(best)).filter("rn = 1").drop("rn")
        frontier = durable(step)
        found = frontier.filter(F.col("node") == F.lit(goal).cast(kind))
        if frontier.isEmpty() or not found.isEmpty():
            break
        seen = seen.unionByName(frontier.select("node"))
    return found.select(F.lit(hops).cast("long").alias("hops"), F.array_join(F.transform("path", lambda x: x.cast("string")), ">").alias("path"))


def expand_scores(hits: DataFrame, links: DataFrame, weight: float, key: str = "node", score: str = "score", query: str | None = None, top: int | None = None, most_links: int | None = None) -> DataFrame:
    """Scores after one hop: each hit hands the nodes it links to ``weight`` times its score, and their sum joins their own.

    query: a column by which hits are parted. top: only so many of the best hits of each query
    hand on (ties to the smaller key); most_links: each over so many of its links at most, the
    first by the links' column ``occ_seq``. These two limits are what is asked for, as in a top-k.
    """
    by = [query] if query else []
    givers = hits
    if top is not None:
        best = Window.partitionBy(*by).orderBy(F.desc(score), key) if by else Window.orderBy(F.desc(score), key)
        givers = hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top).drop("rank")
    if most_links is not None:
        first = Window.partitionBy("src").orderBy("occ_seq", "tgt")
        links = links.join(givers.select(F.col(key).alias("src")).distinct(), "src", "left_semi").withColumn("nr", F.row_number().over(first)).filter(F.col("nr") <= most_links)
    passed = givers.join(links.select("src", "tgt"), givers[key] == links["src"]).select(*by, F.col("tgt").alias(key), (F.col(score) * weight).alias(score))
    return hits.select(*by, key, score).unionByName(passed).groupBy(*by, key).agg(F.sum(score).alias(score))


def _walked(nodes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(inner nodes' rows, inner nodes with their depth, leaves' rows), rows as (id, parent_id).

    Only inner nodes are walked: those that are someone's parent or a root, or have several
    rows. All others have one row and nobody below, so that their parent tells their depth;
    of most trees they are most nodes. Rows are shuffled once, by id, to tell the two apart.

    Level by level until one is empty. A level is written, so the next one's plan holds only
    it; a node seen before isn't taken again, so a cycle comes to an end.
    """
    rows = nodes.select("id", "parent_id")
    parents = rows.filter(F.col("parent_id").isNotNull()).select(F.col("parent_id").alias("id"), F.lit(True).alias("above")).distinct()
    each = rows.repartition("id").withColumn("several", F.count("*").over(Window.partitionBy("id")) > 1).join(parents, "id", "left")
    told = stored(each.select("id", "parent_id", (F.col("several") | F.col("above").isNotNull() | F.col("parent_id").isNull()).alias("inner")))
    inner, leaves = durable(told.filter("inner").select("id", "parent_id")), told.filter("not inner").select("id", "parent_id")
    level = durable(inner.filter(F.col("parent_id").isNull()).select("id").distinct())
    children, out, depth, size = inner.filter(F.col("parent_id").isNotNull()), None, 0, level.count()
    while size:
        here = level.withColumn("depth", F.lit(depth).cast("long"))
        out, depth = here if out is None else out.unionByName(here), depth + 1
        above = level.select(F.col("id").alias("parent_id"))
        below = children.join(F.broadcast(above) if size <= FEW_ROWS else above, "parent_id").select("id").distinct()
        level = durable(below.join(out.select("id"), "id", "left_anti"))
        size = level.count()
    return inner, out if out is not None else level.withColumn("depth", F.lit(0).cast("long")), leaves


def depths(nodes: DataFrame) -> DataFrame:
    """(id, depth) of every node below a root (null parent): the least number of steps to one."""
    _, seen, leaves = _walked(nodes)
    below = leaves.join(seen.select(F.col("id").alias("parent_id"), (F.col("depth") + 1).alias("depth")), "parent_id")
    return seen.unionByName(below.select("id", "depth"))


def unreachable(nodes: DataFrame) -> DataFrame:
    """Nodes below no root: orphans' subtrees and cycles."""
    inner, seen, leaves = _walked(nodes)
    reached = seen.select("id")
    return inner.join(reached, "id", "left_anti").select("id").unionByName(leaves.join(reached.withColumnRenamed("id", "parent_id"), "parent_id", "left_anti").select("id"))


def descendants(nodes: DataFrame, root: Column | str, sep: str = "_") -> DataFrame:
    """A node and everything whose id continues its id after the separator. startswith reaches the scan as a prefix filter; LIKE would take _ as a wildcard."""
    return nodes.filter((F.col("id") == root) | F.col("id").startswith(F.lit(root + sep) if isinstance(root, str) else F.concat(root, F.lit(sep))))


def many_parents(contains: DataFrame) -> DataFrame:
    """Targets that lie under more than one parent."""
    return contains.groupBy("target").agg(F.countDistinct("source").alias("parents")).filter("parents > 1")
