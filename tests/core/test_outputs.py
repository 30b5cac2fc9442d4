"""Release figures and files, pages, SQL functions, tools, and the retrieval benchmark."""

import io
import json
import random

import pytest
from corpus import ACT, ORDER, OTHER, documents
from pyspark.sql import functions as F

from lexloom import api
from lexloom.functions.registered import register
from lexloom.operators import bm25, evaluation, gold, graph, resolve, retrieval, search
from lexloom.operators.build import build
from lexloom.server import Tools, answer, serve
from lexloom.sources import pages, release, snapshot
from lexloom.sources import statutes as X

LIST_HEAD = "法令種別,法令番号,法令名,法令名読み,旧法令名,公布日,改正法令名,改正法令番号,改正法令公布日,施行日,施行日備考,法令ID,本文URL,未施行\n"


@pytest.fixture(scope="module")
def law_list(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("list") / "all_law_list.csv"
    rows = [
        f'法律,n1,河川舟運法,よみ,"旧舟法,古舟法",d,改正甲法,第九号,20220101,20190401,備考,{ACT},https://x/law/{ACT}/20190401_000000000000000,',
        f'法律,n1,河川舟運法,よみ,,d,"改正乙法、\n二行",第十号,20220102,20980101,先の備考,{ACT},https://x/law/{ACT}/20980101_509AC0000000002/,○',
        f"政令,n2,河川舟運法施行令,よみ,古舟法,d,,,,20190401,,{ORDER},https://x/law/{ORDER}/20190401_000000000000000,",
        f"政令,n2,河川舟運法施行令,よみ,,d,後の行,,,20190401,,{ORDER},https://x/law/{ORDER}/20190401_000000000000000,",
        "短い,行",
    ]
    path.write_text("﻿" + LIST_HEAD + "\n".join(rows) + "\n", encoding="utf-8")
    return X.read_law_list(spark, str(path))


@pytest.fixture(scope="module")
def built(spark, law_list):
    docs = spark.createDataFrame(documents(), "law_id string, mst_id string, enforcement_date string, path string, content string")
    return build(docs, "20260101", law_list)


@pytest.fixture(scope="module")
def engine(spark, built, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    api.save(built, path)
    return api.Engine(spark, path)


def test_law_list(law_list, built):
    rows = law_list.orderBy("nr").collect()
    assert [r.nr for r in rows] == [0, 1, 2, 3] and rows[1].amend_law_name == "改正乙法、\n二行"
    meta = {(r.law_id, r.mst_id): r for r in X.version_metadata(law_list).collect()}
    assert meta[ORDER, "20190401_000000000000000"].amend_law_name == "後の行"
    assert meta[ACT, "20980101_509AC0000000002"].enforcement_note == "先の備考"
    names = {r.name: (r.law_id, r.kind) for r in built.names.filter("kind = 'old_name'").collect()}
    assert names == {"旧舟法": (ACT, "old_name"), "古舟法": (ORDER, "old_name")}
    (later,) = built.pending.collect()
    assert (later.law_id, later.amend_law_num, later.enforcement_note) == (ACT, "第十号", "先の備考")


def test_counters_of_a_reading(built):
    got = {r.law_id: r for r in built.stats.collect()}
    assert (got[ACT].articles, got[ACT].items, got[ACT].suppl_articles, got[ACT].hierarchy, got[ACT].attachments) == (5, 3, 3, 2, 2)
    assert got["998AC0000000009"].error and got["998AC0000000009"].articles == 0


def test_release_figures(built, tmp_path):
    stats = release.release_stats(built.nodes, built.edges, built.mentions, built.pending, "20260101")
    assert stats["laws"] == 3 and stats["pending_versions"] == 1 and stats["pre_amendment_edges"] == 1
    assert stats["external_edges"] == stats["external_cross_law_edges"] + stats["external_self_edges"] == sum(stats["external_by_via"].values())
    assert stats["nodes"]["attachments"] == 2 and stats["edges_by_rel"]["REFERS_TO_ATTACHMENT"] == 2
    assert stats["resolution_excluded"]["pre_amendment"] == 1 and stats["top_cited_laws"][0][0] == "河川舟運法"
    links = {tuple(r) for r in release.article_links(built.edges, built.nodes).collect()}
    assert (ORDER, "1", ACT, "2") in links and len(links) == stats["article_links"]
    laws = {r.law_id: r for r in release.law_table(built.nodes).collect()}
    assert laws[ACT].type == "法律" and laws[ACT].url.endswith("20190401_000000000000000") and laws[OTHER].type == "act"
    path = tmp_path / "stats.json"
    release.write_json(stats, str(path))
    values = pages.figures(json.loads(path.read_text(encoding="utf-8")))
    text = "laws: <!--v:laws-->?<!--/v-->, <!--v:res.internal-->?<!--/v-->"
    assert pages.outdated(text, values) and "<!--v:laws-->3<!--/v-->" in pages.render(text, values)
    with pytest.raises(KeyError):
        pages.render("<!--v:none-->x<!--/v-->", values)


def test_unresolved_mentions_have_their_context(built):
    lost = {(r.source, r.raw): r.context for r in resolve.unresolved(built.mentions).collect()}
    assert "港湾何某法第五条" in "".join(lost.values())
    via = {(r.outcome, r.via) for r in resolve.outcome_counts(built.mentions).collect()}
    assert ("external_resolved_exact", "defined_abbrev") in via and ("external_unresolved_law", None) in via


def test_files_of_a_release(spark, built, tmp_path):
    nodes = built.nodes.select("id", "type", "text", "seq")
    release.write_jsonl(nodes, str(tmp_path / "nodes"), ["seq"])
    back = release.read_jsonl(spark, str(tmp_path / "nodes"), "id string, type string, text string, seq long")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, nodes.collect()))
    (tmp_path / "cases.jsonl").write_text('{"id": "c1", "shokai": "問", "kankeihrei": ["河川舟運法第3条"]}\n\n', encoding="utf-8")
    assert [r.kankeihrei for r in release.read_cases(spark, str(tmp_path / "cases.jsonl")).collect()] == [["河川舟運法第3条"]]
    release.write_csv(release.law_table(built.nodes), str(tmp_path / "csv/laws"))
    release.write_csv(release.law_to_law(built.edges, built.nodes), str(tmp_path / "csv/cites_law_to_law"))
    laws, pairs, pending = release.read_law_graph(spark, str(tmp_path / "csv"))
    assert laws.count() == 3 and pending.count() == 0 and {(r.src, r.tgt) for r in pairs.collect()} >= {(ORDER, ACT)}
    release.write_csv(release.pending_table(built.pending, built.nodes), str(tmp_path / "csv/pending_versions"))
    assert [r.law_title for r in release.read_law_graph(spark, str(tmp_path / "csv"))[2].collect()] == ["河川舟運法"]


def test_publishing(tmp_path):
    archive = tmp_path / "corpus.tar"
    archive.write_bytes(b"abc" * 1000)
    said = release.manifest(archive, "2026-01-01", "20260101", "1")
    assert said["bytes"] == 3000 and said["xz_bytes"] < 3000
    assert release.publish(said, [tmp_path / said["file"]], tmp_path / "hub") and not release.publish(said, [], tmp_path / "hub")
    assert snapshot.listed_snapshots(str(tmp_path / "hub")) == ["2026-01-01"]
    folder = tmp_path / "hub/2026-01-01"
    assert snapshot.download_checked(json.loads((folder / "MANIFEST.json").read_text()), folder.as_uri(), tmp_path / "back.tar")
    assert (tmp_path / "back.tar").read_bytes() == archive.read_bytes()


def test_aliases(tmp_path):
    (tmp_path / "a.json").write_text('{"_note": "x", "甲": "甲法", "健保法": "別の法"}', encoding="utf-8")
    (tmp_path / "b.json").write_text('{"甲": "乙法", "丙": "丙法"}', encoding="utf-8")
    got = snapshot.load_aliases(str(tmp_path / "a.json"), str(tmp_path / "b.json"))
    assert (got["甲"], got["丙"], got["健保法"], got["農協法"]) == ("甲法", "丙法", "別の法", "農業協同組合法") and "_note" not in got
    (tmp_path / "c.json").write_text('{"甲": "甲法", "甲": "乙法"}', encoding="utf-8")
    with pytest.raises(ValueError):
        snapshot.load_aliases(str(tmp_path / "c.json"))


def test_texts_of_numbers_and_dates(spark):
    row = spark.sql("select '20260401' as d, 'x' as e, 1234567L as n, 0.4975D as x").select(pages.date_text(F.col("d")), pages.date_text(F.col("e")), pages.number_text(F.col("n")), pages.rounded_text(F.col("x"), 3)).first()
    assert tuple(row) == ("2026-04-01", "x", "1,234,567", "0.498") and pages.half_up(0.4975, 3) == "0.498"


def test_explorer(spark):
    laws = spark.createDataFrame([("A", "甲法</script>", "act", None), ("B", "乙法", "act", "20300101")], "law_id string, name string, type string, next_enforcement_date string")
    page = pages.explorer(laws, spark.createDataFrame([("A", "B", 3), ("Z", "B", 1)], "src string, tgt string, n long"))
    assert page.count("</script>") == 1 and '"edges": [[0, 1, 3]]' in page and '"hubs": [1]' in page


def test_functions_in_sql(spark):
    register(spark)
    assert tuple(spark.sql("select numeral('千二百'), numeral('x'), node_kind('L1_a1_p2'), node_kind('法'), is_amending_law('何法の一部を改正する法律'), clean_law_name('又は民法')").first()) == (1200, None, "paragraph", None, True, "民法")
    rows = spark.sql("select kind, name, article from extract_mentions('民法第三条及び第四条')").collect()
    assert [tuple(r) for r in rows] == [("ext", "民法", "3"), ("int", None, "4")]
    assert spark.sql("select abbr from extract_definitions('水先法（以下「法」という。）')").first()[0] == "法"


def test_tools(engine):
    tools = Tools(engine)
    assert len(tools.described()) == 8
    assert tools.call("get_law", {"query": "舟運法"})["law_id"] == ACT
    assert tools.call("what_cites", {"law": ACT})["laws"][0]["law_id"] in (ORDER, OTHER)
    assert tools.call("what_law_cites", {"law": "無名"})["error"] and tools.call("none", {})["error"] and tools.call("get_law", {"x": 1})["error"]
    assert tools.call("pending_amendments", {"law": ACT})["pending"][0]["enforcement_date"] == "20980101"
    assert tools.call("get_provision", {"citation_text": "河川舟運法第三条第二項"})["node"] == f"{ACT}_a3_p2"
    assert tools.call("citation_path", {"a": OTHER, "b": ACT})["hops"] == 2
    assert tools.call("resolve_citation", {"text": "舟運法第一条"})[0]["resolved"]
    hits = tools.call("search_statutes", {"query": "河川舟運法は何か", "natural": True, "limit": 2})["hits"]
    assert len(hits) == 2 and set(hits[0]) == {"node_id", "heading", "snippet"}
    asked = [{"jsonrpc": "2.0", "id": 1, "method": "initialize"}, {"jsonrpc": "2.0", "method": "notifications/initialized"}, {"jsonrpc": "2.0", "id": 2, "method": "tools/list"}, {"jsonrpc": "2.0", "id": 3, "method": "tools/call", "params": {"name": "get_law", "arguments": {"query": "無名"}}}, {"jsonrpc": "2.0", "id": 4, "method": "x"}]
    out = io.StringIO()
    serve(tools, io.StringIO("\n".join([*map(json.dumps, asked), "{", ""])), out)
    said = [json.loads(line) for line in out.getvalue().splitlines()]
    assert [s.get("id") for s in said] == [1, 2, 3, 4, None] and said[2]["result"]["isError"] and said[3]["error"]["code"] == -32601
    assert answer(tools, {"method": "ping"}) is None


def test_retrieval_benchmark(spark, engine):
    rows = [("q1", "河川舟運法の料金", [f"{ACT}_a3_p1"]), ("q2", "港とは何か", [f"{ORDER}_a2"]), ("q3", "x", ["none_a1"]), ("q4", "y", [])]
    asked = spark.createDataFrame([(a, b, None, c, [], [], []) for a, b, c in rows], release.GOLD)
    got = retrieval.evaluate(engine, asked, 100)
    assert got["gold"] == {"records": 4, "with_gold": 3, "usable": 2} and got["evaluated"] == 2
    assert got["methods"]["bm25"]["recall@50"] >= 0.5 and set(got["methods"]) == {"bm25", "bm25+graph"}


def test_graph_search(spark):
    hits = spark.createDataFrame([("q", "L_a1_p1", 1), ("q", "L_a2_p1", 2), ("q", "L_a1_p2", 3), ("q", "L_at-1", 4)], "id string, node_id string, rank int")
    articles = spark.createDataFrame([("L_a1_p1", "L_a1"), ("L_a1_p2", "L_a1"), ("L_a2_p1", "L_a2"), ("L_at-1", None)], "node_id string, article string")
    edges = spark.createDataFrame([("L_a1_p1_i1", "L_a9_p1", "CITES", 1), ("L_a2_p1", "L_a9", "CITES", 2), ("L_a2_p1", "L_a2_p2", "CITES", 3), ("L_a1_p2", "L_a8", "CITES", 4), ("L_a1_p1", "L_a7", "AMENDS", 5)], "source string, target string, rel string, occ_seq long")
    got = [(r.article, r.rank) for r in search.graph_search(hits, articles, edges, "id", "node_id", expand=2).orderBy("rank").collect()]
    # a9 has half of two hits' scores: as much as one of them, and more than the second
    assert got == [("L_a1", 1), ("L_a9", 2), ("L_a2", 3)]


def test_gold_rows(spark, built):
    cases = spark.createDataFrame([("c", None, None, None, "問", "答", ["河川舟運法第3条、第9条"])], release.CASE)
    laws = built.nodes.filter("type = 'Law'").select(F.col("title").alias("name"), F.col("id").alias("law_id"))
    rows = gold.gold_rows(cases, laws, built.nodes.filter("type = 'Article'").select("id"))
    (r,) = rows.collect()
    assert (r.query, r.answer, r.gold_articles, r.unresolved) == ("問", "答", [f"{ACT}_a3"], ["第9条"])
    metrics, lost = gold.gold_statistics(cases, rows)
    assert {m.metric: m.value for m in metrics.collect()}["resolved"] == 1 and [tuple(x) for x in lost.collect()] == [("第9条", 1)]


def test_best_texts_are_those_of_all_scores(spark, monkeypatch):
    """Scores made in tasks against scores joined and summed by the engine; with a heading and a stored index too."""
    rng = random.Random(2)
    text = lambda n: " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "ｅｐｓ", "zeta"]) for _ in range(n))
    docs = spark.createDataFrame([(i, text(rng.randint(0, 30)), text(2)) for i in range(150)] + [(900, None, None)], "doc_id long, text string, head string").repartition(3)
    asked = spark.createDataFrame([(i, text(3)) for i in range(9)] + [(99, "!!")], "item_id long, text string")
    monkeypatch.setattr(bm25, "HELD_SCORES", 64)
    want = bm25.top_k(bm25.bm25_scores(docs, asked), 7)
    rows = lambda df: sorted((r.item_id, r.rank, r.doc_id, round(r.score, 4)) for r in df.collect())
    assert rows(bm25.bm25_top(docs, asked, 7)) == rows(want)
    both = rows(bm25.bm25_top(docs, asked, 7, heading="head"))
    stored = search.search_index(docs, "doc_id", "text", "head")
    assert rows(bm25.bm25_top(docs, asked, 7, heading="head", index=stored)) == both != rows(want)


def test_trees_and_paths(spark):
    chain = [("n0", None)] + [(f"n{i}", f"n{i - 1}") for i in range(1, 20)] + [("c1", "c2"), ("c2", "c1"), ("o", "gone")]
    nodes = spark.createDataFrame(chain, "id string, parent_id string")
    got = {r.id: r.depth for r in graph.depths(nodes).collect()}
    assert got["n19"] == 19 and len(got) == 20
    assert sorted(r.id for r in graph.unreachable(nodes).collect()) == ["c1", "c2", "o"]
    pairs = spark.createDataFrame([(1, 2, 5), (1, 3, 9), (2, 4, 1), (3, 4, 1), (4, 5, 2), (5, 6, 1)], "src long, tgt long, n long")
    assert tuple(graph.shortest_path(pairs, 1, 5).first()) == (3, "1>3>4>5") and tuple(graph.shortest_path(pairs, 1, 1).first()) == (0, "1")
    assert graph.shortest_path(pairs, 1, 6, 3).count() == 0 and graph.shortest_path(pairs, 6, 1).count() == 0


def test_upper_median_of_many_values(spark):
    rng = random.Random(1)
    rows = [("a", rng.randrange(1000)) for _ in range(501)] + [("b", v) for v in (4, 1, 3, 2)] + [(None, 7)]
    got = {r.g: r.p50 for r in evaluation.upper_median(spark.createDataFrame(rows, "g string, v long"), "g", "v").collect()}
    assert got == {"a": sorted(v for g, v in rows if g == "a")[250], "b": 3, None: 7}
