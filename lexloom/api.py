"""The engine: a built corpus saved as tables, and questions to it.

Methods that give many rows return DataFrames; those that look up one thing return dicts,
with an "error" where it isn't found.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.functions.citations import mentions
from lexloom.functions.ids import law_type
from lexloom.operators import build as builds
from lexloom.operators import graph, search
from lexloom.operators.names import resolve_names
from lexloom.operators.versions import as_of  # noqa: F401
from lexloom.sources import release

TABLES = ["nodes", "edges", "mentions", "pending", "names", "chunks", "index", "laws", "pairs"]
#: What can be made again from the others.
DERIVED = ["chunks", "index", "laws", "pairs"]


def _law_rows(nodes: DataFrame) -> DataFrame:
    kind = F.coalesce("listed_type", law_type(F.col("id"))) if "listed_type" in nodes.columns else law_type(F.col("id"))
    url = F.col("url") if "url" in nodes.columns else F.lit(None).cast("string")
    return nodes.filter("type = 'Law'").select(F.col("id").alias("law_id"), "title", kind.alias("law_type"), "is_active", "enforcement_date", "next_enforcement_date", "pending_version_count", url.alias("url"))


def _derived(nodes: DataFrame, edges: DataFrame, chunks: DataFrame) -> dict[str, DataFrame]:
    links = release.external_edges(edges).select(F.substring_index("source", "_", 1).alias("src"), F.substring_index("target", "_", 1).alias("tgt"))
    return {"index": search.search_index(chunks, "node_id", "body", "heading"), "laws": _law_rows(nodes), "pairs": graph.weighted_pairs(links)}


def save(built: builds.Statutes, path: str) -> None:
    """Write a corpus and what is searched in it. Nodes and edges lie sorted by id, so look-ups skip most of the files."""
    nodes, spark = built.nodes, built.nodes.sparkSession
    parts = {"nodes": nodes.repartitionByRange("id").sortWithinPartitions("id"), "edges": built.edges.repartitionByRange("source").sortWithinPartitions("source"), "mentions": built.mentions, "pending": built.pending, "names": built.names}
    for name, df in parts.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")
    unpack(path, spark)


def pack(path: str, to: str, spark: SparkSession) -> None:
    """Copy a corpus without what can be made again from its nodes and edges."""
    for name in TABLES:
        if name not in DERIVED:
            spark.read.parquet(f"{path}/{name}").write.mode("overwrite").option("compression", "zstd").parquet(f"{to}/{name}")


def unpack(path: str, spark: SparkSession) -> int:
    """Make the tables again that ``pack`` leaves out; the number of chunks."""
    nodes, edges = spark.read.parquet(f"{path}/nodes"), spark.read.parquet(f"{path}/edges")
    search.chunks(nodes).write.mode("overwrite").parquet(f"{path}/chunks")
    chunks = spark.read.parquet(f"{path}/chunks")
    for name, df in _derived(nodes, edges, chunks).items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")
    return chunks.count()


class Engine:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        for name in TABLES:
            setattr(self, f"{name}_", spark.read.parquet(f"{path}/{name}"))

    def stats(self) -> dict:
        return {"nodes": {r[0]: r[1] for r in self.nodes_.groupBy("type").count().collect()}, "edges": {r[0]: r[1] for r in self.edges_.groupBy("rel").count().collect()}}

    def resolve_law(self, name: str) -> dict:
        """A law by id or any of its names; several laws whose titles hold the name are an error with candidates."""
        row = self.laws_.filter(F.col("law_id") == name).first()
        if row is None:
            asked = self.spark.createDataFrame([(name, None)], "name string, promulgation string")
            hit = resolve_names(asked, self.names_).first()
            row = self.laws_.filter(F.col("law_id") == hit["law_id"]).first() if hit else None
        if row is None:
            near = self.laws_.filter(F.contains("title", F.lit(name))).orderBy(F.length("title"), "law_id").limit(8).collect()
            if len(near) != 1:
                return {"error": f"law not found: {name}", "candidates": [r["title"] for r in near]}
            row = near[0]
        return row.asDict()

    def node(self, node_id: str) -> dict | None:
        row = self.nodes_.filter(F.col("id") == node_id).first()
        return row.asDict() if row else None

    def children(self, node_id: str) -> DataFrame:
        return self.nodes_.filter(F.col("parent_id") == node_id).orderBy("seq")

    def toc(self, law_id: str) -> DataFrame:
        return search.contents(self.nodes_, law_id)

    def refs(self, node_id: str, direction: str = "both", rels: list[str] | None = None, limit: int = 200) -> dict[str, DataFrame]:
        return {d: search.references(self.edges_, self.nodes_, node_id, d, rels, limit) for d in ("out", "in") if direction in (d, "both")}

    def pending(self, law: str | None = None, until: str | None = None, limit: int = 200) -> DataFrame:
        rows = self.pending_
        if law:
            rows = rows.filter(F.col("law_id") == law)
        if until:
            rows = rows.filter(F.col("enforcement_date") <= until)
        return rows.orderBy("enforcement_date", "law_id").limit(limit)

    def lookup(self, query: str, law: str | None = None) -> dict:
        """A node by id, by a typed citation, or a law by name; the nearest node there is, with a note."""
        query = query.strip()
        node, note = self.node(query), None
        if node is None:
            cited = search.parse_citation(query)
            found = self.resolve_law((cited["law"] or law or "") if cited else query)
            if "error" in found:
                return found
            if cited is None:
                node = self.node(found["law_id"])
            else:
                tag = None
                if cited["suppl"]:
                    first = self.nodes_.filter((F.col("law_id") == found["law_id"]) & (F.col("type") == "SupplArticle") & F.col("suppl_amend_law_num").isNull()).agg(F.min_by("suppl_tag", "seq")).first()[0]
                    if first is None:
                        return {"error": f"{found['title']} has no supplementary provision of its own"}
                    tag = first
                ids = search.candidate_ids(found["law_id"], cited, tag)
                row = search.first_existing(self.nodes_, ids).first()
                if row is None:
                    return {"error": f"{found['title']} has no {ids[0]}"}
                node = row.asDict()
                note = None if row["rank"] == 0 else f"{ids[0]} not found; showing {row['id']}"
        out = {"node": node, "law": self.resolve_law(node["law_id"]), "text": search.readable(self.nodes_, node["id"])}
        return out | ({"note": note} if note else {})

    def search(self, query: str, law: str | None = None, law_type: str | None = None, section: str = "all", include_inactive: bool = False, limit: int = 20, offset: int = 0, natural: bool = False) -> DataFrame:
        law_id = self.resolve_law(law).get("law_id", "") if law else None
        rows = search.filtered(self.chunks_, self.laws_, law_type, not include_inactive, section, law_id)
        if not natural:
            return search.keyword_search(rows, query, "node_id", "body", "heading", limit, offset)
        asked = self.spark.createDataFrame([(0, query)], "q int, text string")
        index = self.index_.join(rows.select("node_id"), "node_id", "left_semi")
        found = search.natural_search(rows, asked, "node_id", "body", "q", "text", offset + limit, "heading", index).filter(F.col("rank") > offset).drop("q", "rank")
        return found.join(rows, "node_id").orderBy(F.desc("score"), "node_id")

    def what_cites(self, law: str, limit: int = 30) -> dict:
        return self._around(law, "in", limit)

    def what_law_cites(self, law: str, limit: int = 30) -> dict:
        return self._around(law, "out", limit)

    def _around(self, law: str, direction: str, limit: int) -> dict:
        found = self.resolve_law(law)
        if "error" in found:
            return found
        rows = graph.neighbours(self.pairs_, found["law_id"], direction, limit).join(self.laws_.select(F.col("law_id").alias("node"), "title"), "node", "left").orderBy(F.desc("n"), "node").collect()
        return {"law": found["title"], "law_id": found["law_id"], "laws": [{"law": r["title"], "law_id": r["node"], "weight": r["n"]} for r in rows]}

    def citation_path(self, a: str, b: str, most_hops: int = 4) -> dict:
        x, y = self.resolve_law(a), self.resolve_law(b)
        if "error" in x or "error" in y:
            return {"error": "law not found"}
        row = graph.shortest_path(self.pairs_, x["law_id"], y["law_id"], most_hops).first()
        return {"from": x["title"], "to": y["title"], "hops": row["hops"] if row else None, "path": row["path"].split(">") if row else None}

    def get_law(self, law: str) -> dict:
        found = self.resolve_law(law)
        if "error" in found:
            return found
        counts = self.pairs_.agg(F.sum(F.when(F.col("src") == found["law_id"], 1).otherwise(0)).alias("cites"), F.sum(F.when(F.col("tgt") == found["law_id"], 1).otherwise(0)).alias("cited_by")).first()
        return found | {"cites_count": counts["cites"] or 0, "cited_by_count": counts["cited_by"] or 0}

    def resolve_citation(self, text: str) -> list[dict]:
        """The laws and articles that a text cites."""
        cited = [m for m in mentions(text) if m.kind == "ext"]
        if not cited:
            return []
        asked = self.spark.createDataFrame([(m.name, None) for m in cited], "name string, promulgation string").distinct()
        hits = {r["name"]: r for r in resolve_names(asked, self.names_.filter("kind in ('canonical', 'alias')")).collect()}
        return [{"cited_text": m.raw, "law_id": hits[m.name]["law_id"] if m.name in hits else None, "article": m.article, "paragraph": m.paragraph, "item": m.item, "suppl": m.suppl, "via": hits[m.name]["via"] if m.name in hits else None} for m in cited]

    def get_provision(self, citation: str) -> dict:
        found = self.lookup(citation)
        if "error" in found:
            return found
        refs = self.refs(found["node"]["id"], rels=["CITES"], limit=40)
        brief = lambda df, end: [{"node": r[end], "title": r[f"{end}_title"], "law": r[f"{end}_law_title"], "raw": r["raw"]} for r in df.collect()]
        return {"law": found["law"]["title"], "node": found["node"]["id"], "text": found["text"], "cites": brief(refs["out"], "target"), "cited_by": brief(refs["in"], "source")}
