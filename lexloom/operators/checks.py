"""Integrity checks of a built graph. Each gives one row (check, severity, passed, bad)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.functions.ids import LAW_ID, NODE_ID
from lexloom.operators.evaluation import upper_median
from lexloom.operators.graph import unreachable

# Kinds of nodes and edges, and the floors that quality figures must reach.
TYPES = ["Law", "Article", "Paragraph", "Item", "SupplArticle", "SupplParagraph", "Hierarchy", "Attachment"]
RELATIONS = ["CONTAINS", "CITES", "DELEGATES_TO", "REFERS_TO_ATTACHMENT", "AMENDS"]
RESOLUTION = {"internal": 0.90, "external": 0.60, "referential": 0.85}
LEAST_DELEGATIONS, LEAST_ATTACHMENTS_PER_LAW = 10_000, 0.5
TEXT_FLOORS = {"Paragraph": (1.0, 30), "Item": (1.0, 15), "SupplParagraph": (1.5, 30)}


def _row(bad: DataFrame, check: str, severity: str = "FAIL") -> DataFrame:
    """bad: a table whose one column n counts what is wrong."""
    return bad.select(F.lit(check).alias("check"), F.lit(severity).alias("severity"), (F.col("n") == 0).alias("passed"), F.col("n").cast("long").alias("bad"))


def _count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def id_format(nodes: DataFrame) -> DataFrame:
    return _row(_count(nodes.filter(~(F.col("id").rlike(NODE_ID) | F.col("id").rlike(LAW_ID)))), "V01")


def ends_exist(nodes: DataFrame, contains: DataFrame) -> DataFrame:
    ids = nodes.select("id")
    lost = contains.join(ids, contains["source"] == ids["id"], "left_anti").unionByName(contains.join(ids, contains["target"] == ids["id"], "left_anti"))
    return _row(_count(lost.select("source", "target").distinct()), "V02")


def no_cycle(nodes: DataFrame) -> DataFrame:
    """Nodes that no root reaches though their parents exist."""
    missing = nodes.join(nodes.select(F.col("id").alias("parent_id")), "parent_id", "left_anti").filter("parent_id is not null")
    rooted = nodes.withColumn("parent_id", F.col("parent_id")).join(missing.select("id"), "id", "left_anti").unionByName(missing.withColumn("parent_id", F.lit(None).cast("string")).select(nodes.columns))
    return _row(_count(unreachable(rooted)), "V03")


def one_parent(nodes: DataFrame, contains: DataFrame) -> DataFrame:
    parents = contains.groupBy(F.col("target").alias("id")).agg(F.count("*").alias("c"))
    wrong = nodes.select("id", "type").join(parents, "id", "left").filter((F.coalesce("c", F.lit(0)) > 1) | ((F.col("type") != "Law") & F.col("c").isNull()))
    return _row(_count(wrong), "V04")


def targets_exist(nodes: DataFrame, cites: DataFrame) -> DataFrame:
    return _row(_count(cites.join(nodes.select(F.col("id").alias("target")), "target", "left_anti")), "V05")


def kinds_used(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    spark = nodes.sparkSession
    types = spark.createDataFrame([(t,) for t in TYPES], "kind string").join(nodes.select(F.col("type").alias("kind")), "kind", "left_anti")
    rels = spark.createDataFrame([(r,) for r in RELATIONS], "kind string").join(edges.select(F.col("rel").alias("kind")), "kind", "left_anti")
    return _row(_count(types.unionByName(rels)), "V06", "WARN")


def resolution_rates(outcomes: DataFrame) -> DataFrame:
    """(kind, resolved, total, rate) from (outcome, n)."""
    resolved = lambda k: F.sum(F.when(F.col("outcome").startswith(f"{k}_resolved"), F.col("n")).otherwise(0))
    lost = lambda k: F.sum(F.when(F.col("outcome").startswith(f"{k}_unresolved"), F.col("n")).otherwise(0))
    sums = outcomes.agg(*[f(k).alias(f"{k}_{name}") for k in RESOLUTION for name, f in (("r", resolved), ("u", lost))])
    rows = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"{k}_r").alias("resolved"), (F.col(f"{k}_r") + F.col(f"{k}_u")).alias("total"), F.lit(least).alias("least")) for k, least in RESOLUTION.items()])
    each = sums.select(F.explode(rows).alias("x")).select("x.*")
    return each.withColumn("rate", F.when(F.col("total") > 0, F.col("resolved") / F.col("total")))


def quality(nodes: DataFrame, edges: DataFrame, outcomes: DataFrame) -> DataFrame:
    low = resolution_rates(outcomes).filter("rate < least")
    few = edges.agg(F.sum(F.when(F.col("rel") == "DELEGATES_TO", 1).otherwise(0)).alias("d")).filter(F.coalesce("d", F.lit(0)) < LEAST_DELEGATIONS)
    kinds = nodes.agg(F.sum(F.when(F.col("type") == "Law", 1).otherwise(0)).alias("l"), F.sum(F.when(F.col("type") == "Attachment", 1).otherwise(0)).alias("a"))
    thin = kinds.filter(F.col("a") < F.col("l") * LEAST_ATTACHMENTS_PER_LAW)
    return _row(_count(low.select(F.lit(1)).unionAll(few.select(F.lit(1))).unionAll(thin.select(F.lit(1)))), "V07", "WARN")


def fingerprint(rows: DataFrame) -> DataFrame:
    """One row: a hash of a table that doesn't depend on the order of its rows: the sum and the xor of row hashes, and their number."""
    h = F.xxhash64(*sorted(rows.columns))
    return rows.agg(F.count("*").alias("n"), F.bit_xor(h).alias("x"), F.sum(h.cast("decimal(38,0)")).alias("s")).select(F.sha2(F.concat_ws(",", *[F.col(c).cast("string") for c in "nxs"]).cast("binary"), 256).alias("fingerprint"))


def same_hash(nodes: DataFrame, contains: DataFrame, expected: dict[str, str] | None = None) -> DataFrame:
    """V08: the fingerprints of nodes and containment are those expected, where any are; a build of the same documents must give the same."""
    tables = {"nodes": nodes.select("id", "type", "title", "text", "parent_id"), "contains": contains.select("source", "target")}
    parts = [fingerprint(df).select(F.lit(name).alias("name"), "fingerprint") for name, df in tables.items()]
    wrong = F.lit(False)
    for name, value in (expected or {}).items():
        wrong = wrong | ((F.col("name") == name) & (F.col("fingerprint") != value))
    return _row(_count(parts[0].unionByName(parts[1]).filter(wrong)), "V08")


def counters(outcomes: DataFrame) -> DataFrame:
    return _row(_count(outcomes.filter("n < 0")), "V09")


def unique_ids(nodes: DataFrame) -> DataFrame:
    return _row(_count(nodes.groupBy("id").count().filter("count > 1")), "V10")


def text_floors(nodes: DataFrame) -> DataFrame:
    length = F.length(F.trim(F.coalesce("text", F.lit(""))))
    texts = nodes.filter(F.col("type").isin(list(TEXT_FLOORS))).select("type", length.alias("len"))
    seen = texts.groupBy("type").agg((100.0 * F.avg(F.when(F.col("len") == 0, 1.0).otherwise(0.0))).alias("empty")).join(upper_median(texts, "type", "len"), "type")
    wrong = F.lit(False)
    for kind, (most_empty, least) in TEXT_FLOORS.items():
        wrong = wrong | ((F.col("type") == kind) & ((F.col("empty") > most_empty) | (F.col("p50") < least)))
    return _row(_count(seen.filter(wrong)), "V11")


def all_checks(nodes: DataFrame, contains: DataFrame, edges: DataFrame, outcomes: DataFrame, expected: dict[str, str] | None = None) -> DataFrame:
    every = edges.select("rel").unionByName(contains.select("rel"))
    rows = [id_format(nodes), ends_exist(nodes, contains), no_cycle(nodes), one_parent(nodes, contains), targets_exist(nodes, edges.filter("rel = 'CITES'")), kinds_used(nodes, every), quality(nodes, edges, outcomes), same_hash(nodes, contains, expected), counters(outcomes), unique_ids(nodes), text_floors(nodes)]
    return reduce(DataFrame.unionByName, rows)
