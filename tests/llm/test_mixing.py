import random
import re

import duckdb
import pytest

from lexloom.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def water(sizes):
    """Targets by repeated resharing."""
    order = sorted([s for s in sizes if s is not None]) + [s for s in sizes if s is None]
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in fixed]
        if not rest:
            return fixed
        share = (total - sum(fixed.values())) / sum(weight[s] for s in rest)
        over = [s for s in rest if share * weight[s] > 3 * sizes[s]]
        if not over:
            return fixed | {s: share * weight[s] for s in rest}
        fixed |= {s: 3 * sizes[s] for s in over}


def rows(seed, n, shares):
    rng = random.Random(seed)
    made = [(i, "w " * rng.randint(0, 40), rng.choices(list(shares), list(shares.values()))[0], "x") for i in range(n)]
    return made + [(None, "a b", "s1", "x"), (n, None, "s2", None), (n + 1, "", None, None)] + made[:3]


@pytest.mark.parametrize("seed,n,shares", [(1, 300, {"s1": 5, "s2": 1, None: 1}), (2, 400, {"a": 100, "b": 1, "é": 1, "Z": 1, "": 1, "c": 0.1}), (3, 5, {"only": 1})])
def test_targets_and_budgets(spark, seed, n, shares):
    data = rows(seed, n, shares)
    docs = spark.createDataFrame(data, "doc_id long, text string, source string, taken string")
    got = mixing.mix_sources(docs).collect()
    assert len(got) == len(data)
    sizes = {}
    for _, text, source, _ in data:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    want = water(sizes)
    for s, target in want.items():
        mine = [r for r in got if r.source == s]
        assert all(abs(r.target - target) < 1e-6 and r.source_size == sizes[s] for r in mine)
        assert abs(sum(r.taken for r in mine) - target) <= 1
    assert all(0 <= r.taken <= 3 * r.size for r in got)
    again = mixing.mix_sources(docs.repartition(3)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    sql = con.sql(mixing.SQL).fetchall()
    assert sorted(sql, key=str) == sorted(((r.doc_id, r.size, r.source_size, r.target, r.taken) for r in got), key=str)


def test_empty_table(spark):
    assert mixing.mix_sources(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0


def test_rows_without_an_id_spread_over_the_ranges(spark):
    docs = spark.range(50_000).selectExpr("cast(null as long) as doc_id", "concat('w ', id, repeat(' x', cast(id % 7 as int))) as text", "'one' as source")
    spread = mixing.sizes(docs).groupBy(mixing.F.substring("rnd", 1, mixing.LEAST_DIGITS)).count().collect()
    assert len(spread) == 256 and max(r["count"] for r in spread) < 400
    got = mixing.mix_sources(docs)
    row = got.agg(mixing.F.sum("taken"), mixing.F.max("source_size")).first()
    assert row[0] == row[1]


def test_texts_are_cut_by_position(spark):
    texts = ["  a\x01\x02cut\x02\x01 b\tc  ", "one two", "x " * 30_000]
    rows = [(i, t, "big", -1, "k") for i, t in enumerate(texts)] + [(9, "z " * 10, "a.b", 5, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long, `a.b` string")
    plan = {r.doc_id: r for r in mixing.mix_sources(docs).collect()}
    got = {}
    for r in mixing.take(docs).collect():
        got.setdefault(r.doc_id, []).append(r)
    for key, text, *_ in rows:
        r = plan[key]
        words = list(WORD.finditer(text))
        want = [text] * r.full + ([text if r.part == r.size else text[: words[r.part - 1].end()]] if r.part else [])
        assert sorted(x.text for x in got.get(key, [])) == sorted(want)
        assert all(x.n_chars == len(x.text) for x in got.get(key, []))
