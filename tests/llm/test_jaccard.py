import glob
import random
import re
import time
from pathlib import Path

import numpy as np
import pytest

from lexloom.llm import jaccard
from lexloom.llm import shared as S
from lexloom.llm.components import connected_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2)))


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 90 * (len(a) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return sorted(((k, len(s), least.get(find(i))) for i, ((k, _), s) in enumerate(zip(rows, sets))), key=str)


def changed(rng, words, times):
    words = list(words)
    for _ in range(times):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(500)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    made = [None, "", " \n", "one", "ONE", "one two", "One two", "a b c", "A  b\tc", "é É b", "É É b"]
    passage = " ".join(text(70))
    made += [" ".join(text(rng.randint(60, 90))) + " " + passage for _ in range(40)]
    for size in (40, 60, 150, 400, 700):
        base = text(size)
        made += [changed(rng, base, rng.randint(0, max(1, size // 40))) for _ in range(40)]
        made += [" ".join(base)] * 5
        made += [" ".join(base[: size - rng.randint(1, size // 12)]) for _ in range(10)]
    chain = text(200)
    for _ in range(12):  # each linked with the next, the ends far apart
        made.append(" ".join(chain))
        chain = chain[5:] + text(5)
    made += [" ".join(text(rng.randint(1, 50))) for _ in range(60)]
    rows = [(i * 3, t) for i, t in enumerate(made)]
    rng.shuffle(rows)
    return rows + [(None, made[30]), (None, None), (rows[0][0], rows[0][1])]


def test_against_brute_force(spark, monkeypatch):
    for seed, block in ((1, 1024), (2, 8)):
        monkeypatch.setattr(jaccard, "BLOCK", block)
        rows = corpus(seed)
        docs = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], "doc_id long, text string, c string, n int")
        got = jaccard.jaccard_components(docs).collect()
        assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows)


def test_a_failed_forest_edge_loses_no_link(spark):
    # with no parities to go by, the forest takes many pairs that aren't linked
    rows = corpus(3)
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), parities=False).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows)


def test_other_shingles_and_similarities(spark):
    for seed, size, tenths in ((4, 5, 8), (5, 2, 6)):
        rows = corpus(seed)
        rng = random.Random(seed)
        base = [f"v{rng.randrange(500)}" for _ in range(300)]
        rows += [(5000 + i, " ".join(base[: 300 - 12 * i])) for i in range(8)]
        sets = [frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset() for w in (WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) for _, t in rows)]
        links = [(i, j) for i, a in enumerate(sets) for j in range(i) if a & sets[j] and 10 * len(a & sets[j]) >= tenths * len(a | sets[j])]
        root = list(range(len(rows)))
        for i, j in links:
            a, b = root[i], root[j]
            root = [a if x == b else x for x in root] if a != b else root
        least = {x: min((k for (k, _), y in zip(rows, root) if y == x and k is not None), default=None) for x in set(root)}
        got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), size=size, tenths=tenths).collect()
        want = [(k, len(s), least[x]) for (k, _), s, x in zip(rows, sets, root)]
        assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == sorted(want, key=str)


def test_packing():
    rng = np.random.default_rng(1)
    for n in (0, 1, 1000):
        values = np.sort(rng.integers(0, 1 << 32, n))
        assert (jaccard._unpack(jaccard._pack(values)) == values).all()
    values = np.array([0, 0, 65535, 65535, 131070, 1 << 31])
    assert (jaccard._unpack(jaccard._pack(values)) == values).all()


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7)], "u long, v long")
    got = {r.node: r.root for r in connected_components(links).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def test_empty_table(spark):
    assert jaccard.jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_a_sieve_in_slices(spark, monkeypatch):
    assert [jaccard._passes(n) for n in (0, 1 << 26, (1 << 26) + 1, 204_000_000, 1 << 40)] == [1, 1, 2, 4, 64]
    monkeypatch.setattr(jaccard, "_passes", lambda tokens: 4)
    rows = corpus(6)
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows)


def test_what_is_done_with_leaves_the_disk(spark):
    shared = S.shared_dir(spark).removeprefix("file:")
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    local = [d.getPath() for d in env.blockManager().diskBlockManager().localDirs()]

    def shuffled():
        return {f for d in local for f in glob.glob(f"{d}/**/shuffle_*", recursive=True)}

    def stored():
        return set(glob.glob(f"{shared}/jaccard-*")) | set(glob.glob(f"{shared}/*/rdd-*"))

    before = shuffled()
    few = S.durable(spark.range(1000).repartition(5, "id"))
    till = time.time() + 20
    while shuffled() - before and time.time() < till:
        time.sleep(0.2)
    assert not shuffled() - before and few.count() == 1000
    before = stored()
    got = jaccard.jaccard_components(spark.createDataFrame(corpus(7), "doc_id long, text string"))
    kept = [f for f in stored() - before if "/jaccard-" in f]
    assert len(kept) == 1 and "/jaccard-classes-" in kept[0]  # no sets, no tokens, no sketches
    assert got.count() == len(corpus(7))


def test_what_the_engine_freed_is_handed_back(spark):
    jvm = spark._jvm
    status = Path(f"/proc/{jvm.java.lang.ProcessHandle.current().pid()}/status")
    if not status.exists():
        pytest.skip("the engine's memory can't be read here")

    def resident():
        return int(re.search(r"RssAnon:\s+(\d+) kB", status.read_text())[1]) / 1024

    S.durable(spark.range(10))
    made = [jvm.java.util.zip.Deflater() for _ in range(1500)]  # each touches some 90 KB of native memory
    for i, one in enumerate(made):
        if i % 20:
            one.end()
    kept = resident()  # the allocator keeps what lies between those that are left
    S.durable(spark.range(10))
    left = resident()
    for one in made[::20]:
        one.end()
    assert kept - left > 50
