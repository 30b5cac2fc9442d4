"""What a step writes and shuffles: each would grow faster than its input, or hold it several times, if done another way."""

from pyspark.sql import functions as F

import corpus
from lexloom.operators import build as builds
from lexloom.operators import graph
from lexloom.plans import search_queries
from lexloom.sources import statutes
from lexloom.tables import release, stored

COLUMNS = "law_id string, mst_id string, enforcement_date string, path string, content string"


def test_build_keeps_mentions_by_column(spark):
    """edges as emitted and nodes are compressed tables, of which a step reads what it uses."""
    built = builds.build(spark.createDataFrame(corpus.documents(), COLUMNS), "20260101")
    assert built.nodes.inputFiles() and built.mentions.inputFiles()


def test_released_tables_are_deleted(spark):
    kept = stored(spark.range(3))
    files = kept.inputFiles()
    release(kept)
    assert files and not any(spark._jvm.java.io.File(f.removeprefix("file://")).exists() for f in files)


def test_leaves_are_not_walked(spark):
    """the walk takes inner nodes only, and nodes with several parents."""
    rows = [("r", None), ("a", "r"), ("b", "r"), ("x", "a"), ("y", "a"), ("m", "b"), ("m", "a"), ("b2", "b"), ("deep", "b2"), ("c1", "c2"), ("c2", "c1"), ("lost", "none"), ("under", "c1"), ("x2", "b"), ("x2", "b")]
    nodes = spark.createDataFrame(rows, "id string, parent_id string")
    inner, _, leaves = graph._walked(nodes)
    assert {r.id for r in leaves.collect()} == {"x", "y", "deep", "lost", "under"}
    assert {r.id for r in inner.collect()} == {"r", "a", "b", "m", "b2", "c1", "c2", "x2"}
    assert sorted(tuple(r) for r in graph.depths(nodes).collect()) == [("a", 1), ("b", 1), ("b2", 2), ("deep", 3), ("m", 2), ("r", 0), ("x", 2), ("x2", 2), ("y", 2)]
    assert sorted(r.id for r in graph.unreachable(nodes).collect()) == ["c1", "c2", "lost", "under"]


def test_counters_come_from_the_reading(spark):
    """counted where a document is read, as its nodes would be."""
    docs = spark.createDataFrame(corpus.documents(), COLUMNS)
    by_nodes = statutes.parse_stats(statutes.parse_documents(docs))
    assert sorted(map(repr, statutes.document_stats(docs).select(by_nodes.columns).collect())) == sorted(map(repr, by_nodes.collect()))


def test_gold_counts_trigrams_once(spark):
    """texts are cut into trigrams once, not for each use of them."""
    found = search_queries._gold(spark, "/root/testdata/sf0.001").select(F.count("*"))
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 0
