import pytest
from corpus import ACT, ORDER, OTHER, documents
from pyspark.sql import functions as F

from lexloom.functions.citations import clean_name, continues, definitions, mentions, promulgation_key
from lexloom.functions.ids import article_id, article_of, attachment_id, division_id, number_path, parse_id, path_key
from lexloom.functions.numerals import kanji_number, to_int
from lexloom.operators import checks, gold, search
from lexloom.operators.build import build
from lexloom.sources import release
from lexloom.sources.statutes import annex_number, contains_edges


@pytest.fixture(scope="module")
def built(spark):
    docs = spark.createDataFrame(documents(), "law_id string, mst_id string, enforcement_date string, path string, content string")
    return build(docs, "20260101")


NUMERALS = [("10", 10), ("10の2", 10), ("千二百三十", 1230), ("一二", 12), ("十", 10), ("二十", 20), ("百五", 105), ("〇", 0), ("万", None), ("", None), ("一x", None)]


def test_numerals(spark):
    assert [to_int(t) for t, _ in NUMERALS] == [n for _, n in NUMERALS]
    assert to_int("２") == 2
    rows = spark.createDataFrame(NUMERALS, "t string, n int")
    assert rows.select(kanji_number(F.col("t")).alias("got"), "n").filter("not (got <=> n)").count() == 0


def test_ids():
    assert number_path("4_3_2") == "4-3-2" and number_path("十_二") == "10-2" and number_path("x") is None
    assert article_id("L1", "2-2", 3, "1-2", "sp1") == "L1_asup-sp1-2-2_p3_i1-2"
    assert parse_id("L1_asup-sp1-2-2_p3_i1-2") == {"law_id": "L1", "kind": "item", "article_path": "2-2", "paragraph_num": 3, "item_path": "1-2", "suppl_tag": "sp1", "rest": None}
    assert [parse_id(x)["kind"] for x in ("L1", "L1_a1", "L1_a1_p2", "L1_at-style-1", "L1_hP1C2")] == ["law", "article", "paragraph", "attachment", "hierarchy"]
    for bad in (lambda: article_id("", "1"), lambda: article_id("L", "1", None, 2), lambda: attachment_id("L", ""), lambda: division_id("L", "1"), lambda: parse_id("法")):
        with pytest.raises(ValueError):
            bad()


def test_id_columns(spark):
    rows = spark.createDataFrame([("L_a3-2_p1_i1",), ("L_asup-sp1-2_p1",), ("L_at-1",), ("L_hC1",)], "id string")
    assert [r[0] for r in rows.select(article_of(F.col("id"))).collect()] == ["L_a3-2", "L_asup-sp1-2", None, None]
    paths = spark.createDataFrame([("10-2",), ("4-4",), ("4-3-2",), ("11",)], "p string")
    assert [r.p for r in paths.orderBy(path_key(F.col("p"))).collect()] == ["4-3-2", "4-4", "10-2", "11"]


@pytest.mark.parametrize("raw,want", [("別表第一", "1"), ("第一号様式の二", "1-2"), ("様式第２（第五条関係）", "2"), ("別記様式", "0"), ("別図 A", "A")])
def test_annex_numbers(raw, want):
    assert annex_number(raw) == want


def test_citation_parts():
    assert clean_name("第十条の規定により所得税法") == "所得税法" and clean_name("又は民法") == "民法"
    assert continues("、") and continues("（責任準備金）及び") and continues("から") and not continues("の規定は、")
    assert definitions("水先法（昭和二十四年法律第百二十一号。以下「法」という。）") == [("法", "昭和二十四年法律第百二十一号", "水先法")]
    assert definitions("者（以下「申請者」という。）") == []
    assert promulgation_key("（昭和22年法律第26号）") == "昭和22年法律第26号" and promulgation_key("無") is None
    assert mentions(None) == [] and mentions("") == []
    kinds = [m.kind for m in mentions("別表中、別表第二、省令で定める。第三条第一項を次のように改める。各号")]
    assert kinds == ["int", "att", "del", "amd", "ref"]


def test_long_text_without_citations():
    assert mentions("あ" * 20_000) == []


def test_chunks(built):
    got = {r.node_id: r for r in search.chunks(built.nodes).collect()}
    assert got[f"{ACT}_a2_p1"].body.endswith("準用する。\n一\n舟\n一の二\n筏\n二\n前号に準ずるもの及び前各号のもの")
    assert got[f"{ACT}_a3_p2"].heading == "河川舟運法 第3条 第2項" and got[f"{ACT}_asup-sp1-1_p1"].heading == "河川舟運法 附則 第1条"
    assert got[f"{ACT}_at-1"].heading == "河川舟運法 別表第一（第三条関係）"


def test_keyword_search(built):
    rows = search.chunks(built.nodes)
    got = search.keyword_search(rows, "公布の日 施行", "node_id", "body", "heading").collect()
    assert [r.node_id for r in got] == [f"{ACT}_asup-sp1-1_p1"] and "【公布の日】" in got[0].snippet
    short = search.keyword_search(rows, "筏", "node_id", "body", "heading").collect()
    assert [r.node_id for r in short] == [f"{ACT}_a2_p1"]
    assert search.keyword_search(rows, " ", "node_id", "body").count() == 0


def test_natural_search(spark, built):
    rows, asked = search.chunks(built.nodes), spark.createDataFrame([(1, "河川舟運法は何か")], "q int, text string")
    best = search.natural_search(rows, asked, "node_id", "body", "q", "text").orderBy(F.desc("score")).first()
    # six texts name the act; the shortest of them comes first
    assert best.node_id == f"{OTHER}_a1_p1"


def test_typed_citations():
    assert search.parse_citation("民法90条の2第1項第3号") == {"law": "民法", "suppl": False, "article_path": "90-2", "paragraph": 1, "item_path": "3"}
    assert search.parse_citation("所得税法　附則第二条") == {"law": "所得税法", "suppl": True, "article_path": "2", "paragraph": None, "item_path": None}
    assert search.parse_citation("民法") is None
    assert search.candidate_ids("L", search.parse_citation("民法3条1号")) == ["L_a3_p1_i1", "L_a3"]


def test_lookup_and_text(built):
    ids = search.candidate_ids(ACT, search.parse_citation("河川舟運法第三条第九項"))
    assert search.first_existing(built.nodes, ids).first().id == f"{ACT}_a3"
    text = search.readable(built.nodes, f"{ACT}_a2")
    assert text.split("\n")[0] == "第2条" and "  一の二　筏" in text
    assert search.readable(built.nodes, f"{ACT}_a3").split("\n")[2].startswith("2 前項")
    into = search.references(built.edges, built.nodes, f"{ACT}_a3", "in").collect()
    assert f"{ORDER}_a1_p1" in {r.source for r in into} and all(r.target.startswith(f"{ACT}_a3") for r in into)
    assert [r.id for r in search.contents(built.nodes, ACT).collect()][:2] == [f"{ACT}_hC1", f"{ACT}_a1"]


def test_checks(built, spark):
    contains = contains_edges(built.nodes)
    outcomes = built.mentions.groupBy("outcome").agg(F.count("*").alias("n"))
    got = {r.check: r for r in checks.all_checks(built.nodes, contains, built.edges, outcomes).collect()}
    assert len(got) == 11 and all(got[c].passed for c in ("V01", "V02", "V03", "V04", "V05", "V08", "V09", "V10"))
    assert not got["V07"].passed and got["V07"].severity == "WARN"
    loop = spark.createDataFrame([("a", None), ("b", "c"), ("c", "b"), ("d", "zz")], "id string, parent_id string")
    assert checks.no_cycle(loop).first().bad == 2
    assert checks.fingerprint(built.edges).first() == checks.fingerprint(built.edges.repartition(3)).first()


def test_gold(spark):
    lines = ["所得税法第9条、第10条第1項", "同通達第3", "措置法第41条の2", "第2項、災害被害者に対する租税の減免、徴収猶予等に関する法律第2条"]
    cases = spark.createDataFrame([("c", lines)], "id string, kankeihrei array<string>")
    got = gold.entries(cases, ["災害被害者に対する租税の減免、徴収猶予等に関する法律"]).orderBy("nr").collect()
    assert [(r.law, r.path) for r in got] == [("所得税法", "9"), ("所得税法", "10"), ("措置法", "41-2"), ("災害被害者に対する租税の減免、徴収猶予等に関する法律", "2")]


def test_resolve_gold(spark):
    cases = spark.createDataFrame([("c1", ["措置法第1条、第9条、旧法人税法第2条、所得税基本通達第3条"]), ("c2", [])], "id string, kankeihrei array<string>")
    laws = spark.createDataFrame([("租税特別措置法", "L1")], "name string, law_id string")
    got = {r.id: r for r in gold.resolve_gold(cases, laws, spark.createDataFrame([("L1_a1",)], "id string")).collect()}
    assert got["c1"].gold_articles == ["L1_a1"] and got["c1"].unresolved == ["第9条"] and got["c1"].out_of_scope_refs == ["旧法人税法第2条"]
    assert got["c1"].external_refs == ["所得税基本通達第3条"] and got["c2"].gold_articles == []


def test_release(built, tmp_path):
    pairs = release.law_to_law(built.edges, built.nodes).collect()
    assert (pairs[0].src_law_id, pairs[0].tgt_law_id) == (ORDER, ACT)
    release.write_edges(built.edges, f"{tmp_path}/edges")
    assert built.edges.sparkSession.read.json(f"{tmp_path}/edges").count() == built.edges.count()
    release.write_csv(release.law_table(built.nodes), f"{tmp_path}/laws")
    assert built.edges.sparkSession.read.csv(f"{tmp_path}/laws", header=True).count() == 3


def test_fingerprints_tell_builds_apart(built):
    contains = contains_edges(built.nodes)
    same = checks.fingerprint(contains.select("source", "target").repartition(3)).first()[0]
    assert checks.same_hash(built.nodes, contains, {"contains": same}).first().passed
    assert not checks.same_hash(built.nodes, contains, {"contains": "0"}).first().passed
