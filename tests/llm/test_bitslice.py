import math
import random

import numpy as np
import pytest

from lexloom.llm import bitslice


def brute(rows, every, k):
    good = []
    for key, x in rows:
        if key is not None and x is not None and all(v is not None and math.isfinite(v) for v in x):
            good.append((key, [math.floor(256 * v) for v in x]))
    queries = {}
    for key, q in good:
        if key % every == 0:
            queries[key] = min(queries.get(key, q), q)
    out = []
    for qid, q in queries.items():
        scored = sorted((-sum(a * b for a, b in zip(q, v)), key) for key, v in good if key != qid)[:k]
        out += [(qid, i + 1, key, -s) for i, (s, key) in enumerate(scored)]
    return sorted(out)


def rows(seed):
    rng = random.Random(seed)
    made = [(i, [rng.gauss(0, 0.2) for _ in range(12)]) for i in range(300)]
    made += [(300 + i, [round(rng.random(), 1)] * 12) for i in range(120)]  # many ties
    made += [(500, None), (501, [None] * 12), (502, [float("nan")] + [0.0] * 11), (503, [float("inf")] * 12), (None, [0.1] * 12), (600, []), (601, [5000.0, -70000.25]), (650, [-300.0] * 12)]
    return made + made[:20] + [(0, [0.3] * 12)]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(bitslice, "QUERIES", 7)
    data = rows(seed)
    vectors = spark.createDataFrame([(k, x, 1) for k, x in data], "vec_id long, embedding array<double>, score int").repartition(5)
    got = sorted(map(tuple, bitslice.top_k(vectors, 50, 5).collect()))
    assert got == brute(data, 50, 5)


def test_slices_spell_the_scores():
    rng = np.random.default_rng(3)
    values, q = rng.integers(-500, 500, (130, 6)), rng.integers(-40, 40, 6)
    block = bitslice.Block.build(np.arange(130), values)
    slices, plus = block.score_slices(q)
    got = [plus + sum(((int(s[r >> 6]) >> (r & 63)) & 1) << i for i, s in enumerate(slices)) for r in range(130)]
    assert got == (values @ q).tolist()


def test_few_rows_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    assert bitslice.top_k(spark.createDataFrame([], schema), 50, 5).count() == 0
    two = spark.createDataFrame([(0, [1.0]), (1, [2.0])], schema)
    assert [tuple(r) for r in bitslice.top_k(two, 50, 5).collect()] == [(0, 1, 1, 131072)]


def test_what_no_score_could_hold_is_an_error(spark):
    schema = "vec_id long, embedding array<double>, `a.b` int, VEC_ID string"
    fine = [(0, [1.0, -(2.0**30)], 1, "x"), (1, [0.5, 2.0**10], 1, "x")]
    assert [r.score for r in bitslice.top_k(spark.createDataFrame(fine, schema), 50, 5).collect()] == [256 * 128 - 2**38 * 2**18]
    for bad in ([(0, [2.0**54], 1, "x"), (1, [1.0], 1, "x")], [(0, [2.0**40], 1, "x"), (1, [2.0**40], 1, "x")]):
        with pytest.raises(Exception, match="passes 6[24] bits"):
            bitslice.top_k(spark.createDataFrame(bad, schema), 50, 5).collect()
