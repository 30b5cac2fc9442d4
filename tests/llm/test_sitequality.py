import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexloom.llm import sitequality as Q

SCHEMA = "doc_id long, text string, lang string, source string, kept int"


def text(rng, good):
    words = [f"word{rng.randrange(900)}" for _ in range(rng.randint(20, 60))]
    return " ".join(words) if good else " ".join(w.upper() + rng.choice(["!!", " |", "###"]) for w in words)


def corpus(seed=1):
    rng = random.Random(seed)
    docs, labels, truth = [], [], {}
    for i in range(900):
        host = f"h{int(30 * rng.random() ** 2)}"
        good = rng.random() < (0.2 if host in ("h0", "h3") else 0.95)
        truth[i] = good
        docs.append((i, text(rng, good), rng.choice(["en", "de", None]), host, 1))
        if rng.random() < 0.4:
            labels.append((i, int(good), 0))
    return docs, labels, truth


def test_agrees_with_the_truth(spark):
    docs, labels, truth = corpus()
    got = Q.quality(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(got) == 900
    assert sum(r.kept == truth[r.doc_id] for r in got) > 0.98 * 900
    by = {}
    for r in got:
        by.setdefault(r.host, set()).add(r.host_rate)
    assert all(len(v) == 1 for v in by.values()) and max(by["h0"]) < min(by["h5"])


def test_against_plain_python(spark):
    docs, labels, _ = corpus(2)
    got = {r.doc_id: r for r in Q.quality(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    y, p = dict((k, q) for k, q, _ in labels), {k: r.p_text for k, r in got.items()}
    ev = {k: (1.0, float(y[k])) if k in y else (Q.DISCOUNT, Q.DISCOUNT * p[k]) for k in got}
    hosts, paths = {}, {}
    for k, r in got.items():
        for table, name in ((hosts, r.host), (paths, (r.host, r.path))):
            w, e = table.get(name, (0, 0))
            table[name] = (w + ev[k][0], e + ev[k][1])
    mu = (sum(e for _, e in hosts.values()) + 1) / (sum(w for w, _ in hosts.values()) + 2)

    def shrink(groups, prior):
        spread = sum(w * (e / w - prior(g)) ** 2 for g, (w, e) in groups.items())
        chance = sum(prior(g) * (1 - prior(g)) for g in groups)
        room = sum(w * prior(g) * (1 - prior(g)) for g, (w, _) in groups.items())
        beyond = (spread - chance) / room
        return Q.MOST_SHRINK if beyond <= 1 / (1 + Q.MOST_SHRINK) else min(Q.MOST_SHRINK, max(Q.LEAST_SHRINK, 1 / beyond - 1))

    kh = shrink(hosts, lambda g: mu)
    rate = {h: (e + kh * mu) / (w + kh) for h, (w, e) in hosts.items()}
    kp = shrink(paths, lambda g: rate[g[0]])
    for k, r in got.items():
        w, e = paths[r.host, r.path]
        want = (e - ev[k][1] + kp * rate[r.host]) / (w - ev[k][0] + kp)
        assert abs(r.host_rate - rate[r.host]) < 1e-4 and abs(r.path_rate - min(max(want, 1e-4), 1 - 1e-4)) < 1e-3


def test_sparse_sites_shrink(spark):
    groups = spark.createDataFrame([(g, s, 5.0) for g, s in ((2.0, 5.0), (3.0, 5.0))], "good double, seen double, x double")
    assert Q.shrinkage(groups, "good", "seen", F.lit(0.5)) == Q.MOST_SHRINK
    apart = spark.createDataFrame([(0.0, 50.0), (50.0, 50.0)], "good double, seen double")
    assert Q.shrinkage(apart, "good", "seen", F.lit(0.5)) == Q.LEAST_SHRINK


@pytest.mark.parametrize("with_labels", [True, False])
def test_odd_rows(spark, with_labels):
    docs = corpus(3)[0][:50] + [(None, "a b", None, None, 1), (2000, None, "en", None, 1), (2001, "", None, "h1", 1), (2002, "w " * 200_000, "en", "h1", 1), (5, "again", "en", "h1", 1)]
    labels = [(3, 1, 0), (3, 0, 0), (4, None, 1), (None, 1, 0), (5, 1, 0)] if with_labels else []
    got = Q.quality(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(got) == len(docs)
    assert all(np.isfinite(r.posterior) for r in got)
    if not with_labels:
        assert all(r.kept for r in got)


def test_empty_tables(spark):
    assert Q.quality(spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "doc_id long, quality int")).count() == 0


def test_hosts_and_paths_of_addresses(spark):
    cases = [("https://www.A.example.com/en/25#top", "a.example.com", "en"), ("http://u:p@b.org:80/x/y?z", "b.org", "x"), ("https://c.net?q", "c.net", None), ("nonsense", None, None), (None, None, None)]
    docs = spark.createDataFrame(cases, "url string, h string, p string")
    got = Q.with_site(docs)
    assert got.filter("not (host <=> h and path <=> p)").count() == 0


def test_sparse_sites_shrink_toward_the_global_rate(spark):
    """Pages of many small hosts and one large bad one: a small host's rate stays near that of all, the large one's doesn't."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select(F.col("page_id").alias("doc_id"), "url", F.lit("plain words of a page " * 3).alias("text"))
    docs = Q.with_site(pages)
    count = {r["host"]: r["count"] for r in docs.groupBy("host").count().collect()}
    large = max(count, key=lambda h: (count[h], h))
    small = next(h for h in sorted(count) if count[h] == 1)
    labels = docs.select("doc_id", F.when(F.col("host").isin(large, small), 0).otherwise(1).alias("quality"))
    rates = {r["host"]: r["host_rate"] for r in Q.quality(docs, labels, "host", "path").collect()}
    assert rates[large] < 0.3 < rates[small] < max(rates.values())
