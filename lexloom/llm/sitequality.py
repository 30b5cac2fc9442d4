"""Document quality by hierarchical empirical Bayes over hosts and paths.

A logistic classifier over measurements of the text gives each document's own evidence.
Evidence is then pooled by grouped aggregation: a labelled document counts with its label,
another with DISCOUNT times its classifier's probability. Each host's rate of good
documents is shrunk toward the global rate, and each path's toward its host's; how much is
learned from the data by the method of moments, so sites with few documents fall back on
their prior and rich ones speak for themselves. A document's posterior joins its own
evidence with its path's rate, from which its own share is taken out first.

The classifier is fitted on a hash sample of about SAMPLE labelled ids, and of their
documents at most twice as many; that bound is its only one. Rates and shrinkage cover all
documents.

Pages have hosts and paths in their addresses (``with_site``); where documents carry none, the
query takes their source for a host and, within a source, their language for a path.

Defined cases: a null text is empty; a very long one is measured whole; a null host or path is a host or path of its own.
Several labels of one id are averaged; null labels and ids say nothing. With no labels the
classifier says nothing and every rate is its prior of one half; documents with nothing
against them are kept. Repeated rows are documents each. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.llm import repetition
from lexloom.llm import shared as S

SAMPLE = 20_000
RIDGE, ROUNDS = 1.0, 25
DISCOUNT = 0.25
#: Limits of the shrinkage, in documents.
LEAST_SHRINK, MOST_SHRINK = 2.0, 1000.0
KEEP = 0.5
FEATURES = ["log_words", "symbols", "bars", "marks", "capitals", "digits", "repeats", "dup_lines", "word_length"]


def _is(chars: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars)] = True
    return out


_TABLES = {"bars": _is(b"|"), "marks": _is(b"!"), "capitals": _is(bytes(range(0x41, 0x5B))), "letters": _is(bytes([*range(0x41, 0x5B), *range(0x61, 0x7B)])), "digits": _is(bytes(range(0x30, 0x3A)))}


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of FEATURES for each text of a slice."""
    m = repetition.measure(data, offsets)
    count = {}
    for name, table in _TABLES.items():
        sums = np.concatenate(([0], np.cumsum(table[data])))
        count[name] = sums[offsets[1:]] - sums[offsets[:-1]]
    words, chars = np.maximum(m["n_words"], 1), np.maximum(m["word_chars"], 1)
    columns = {
        "log_words": np.log1p(m["n_words"]),
        "symbols": np.minimum(m["n_symbols"] / words, 1),
        "bars": np.minimum(count["bars"] / words, 1),
        "marks": np.minimum(count["marks"] / words, 1),
        "capitals": count["capitals"] / np.maximum(count["letters"], 1),
        "digits": count["digits"] / chars,
        "repeats": m["dup5_chars"] / chars,
        "dup_lines": m["dup_line_chars"] / chars,
        "word_length": np.minimum(m["word_chars"] / words, 40),
    }
    return np.stack([columns[f] for f in FEATURES], axis=1)


class Classifier:
    """Logistic regression on standardised features; with nothing to learn from it says its base rate."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.rate = float((y.sum() + 1) / (len(y) + 2))
        self.mean, self.scale = np.zeros(len(FEATURES)), np.ones(len(FEATURES))
        self.weights = np.zeros(len(FEATURES) + 1)
        self.weights[-1] = np.log(self.rate / (1 - self.rate))
        if len(y) == 0:
            return
        self.mean, self.scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
        z = self._scaled(x)
        ridge = np.full(z.shape[1], RIDGE)
        ridge[-1] = 1e-6
        for _ in range(ROUNDS):
            p = 1 / (1 + np.exp(-np.clip(z @ self.weights, -30, 30)))
            step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(ridge), z.T @ (y - p) - ridge * self.weights)
            self.weights += step
            if np.abs(step).max() < 1e-8:
                break

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        return np.hstack([np.clip((x - self.mean) / self.scale, -8, 8), np.ones((len(x), 1))])

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._scaled(x) @ self.weights, -12, 12)))


def fit(docs: DataFrame, labels: DataFrame) -> Classifier:
    """labels: (doc_id, y). The sample's ids are broadcast: about SAMPLE of them, whatever the data."""
    n = labels.count()
    drawn = labels.filter(F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1 << 24)) < min(1.0, SAMPLE / max(n, 1)) * (1 << 24))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in S.slices(batch.column(2)):
                x = features(data, offsets)
                yield pa.RecordBatch.from_arrays([*[batch.column(c).slice(i, j - i) for c in (0, 1, 3)], pa.array([r.tobytes() for r in x], pa.binary())], ["doc_id", "y", "dice", "x"])

    met = docs.join(F.broadcast(drawn), "doc_id").select("doc_id", "y", "text", F.xxhash64("doc_id", "text").alias("dice")).mapInArrow(S.trimmed(run), "doc_id long, y double, dice long, x binary")
    rows = met.orderBy("dice", "doc_id", "x").limit(2 * SAMPLE).collect()
    rows = sorted((r["doc_id"], r["y"], bytes(r["x"])) for r in rows)
    x = np.stack([np.frombuffer(r[2]) for r in rows]) if rows else np.zeros((0, len(FEATURES)))
    return Classifier(x, np.array([float(r[1] >= 0.5) for r in rows]))


def shrinkage(groups: DataFrame, good: str, seen: str, prior) -> float:
    """How many documents a group's prior weighs, by the method of moments over groups (beta-binomial).

    prior: a column, each group's prior rate. The spread of rates beyond what chance gives
    groups of their sizes is what tells groups apart; the less of it, the more they shrink.
    """
    rate = F.col(good) / F.col(seen)
    parts = groups.filter(F.col(seen) > 0).agg(
        F.sum(F.col(seen) * (rate - prior) ** 2).alias("spread"),
        F.sum(prior * (1 - prior)).alias("chance"),
        F.sum(F.col(seen) * prior * (1 - prior)).alias("room"),
    )
    spread, chance, room = parts.first()
    if not room:
        return MOST_SHRINK
    beyond = (spread - chance) / room
    return MOST_SHRINK if beyond <= 1 / (1 + MOST_SHRINK) else min(MOST_SHRINK, max(LEAST_SHRINK, 1 / beyond - 1))


def with_site(docs: DataFrame, url: str = "url", host: str = "host", path: str = "path") -> DataFrame:
    """Adds the host and the first part of the path of each address; null where it has none. Case and a leading www. of a host don't count."""
    address = F.col(url)
    name = F.regexp_replace(F.lower(F.regexp_extract(address, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), r"^www\.", "")
    part = F.regexp_extract(address, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^/?#]+)", 1)
    return docs.withColumn(host, F.nullif(name, F.lit(""))).withColumn(path, F.nullif(part, F.lit("")))


def quality(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", key: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """(doc_id, host, path, p_text, host_rate, path_rate, posterior, kept) of every document."""
    rows = S.keyed(docs, key, text, host=host, path=path).select("doc_id", F.col("host").cast("string"), F.col("path").cast("string"), "text")
    known = S.named(labels, doc_id=key, y=label).select(F.col("doc_id").cast("long"), F.col("y").cast("double")).dropna().groupBy("doc_id").agg(F.avg("y").alias("y"))
    model = fit(rows, known)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in S.slices(batch.column(3)):
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(shared.value.probability(features(data, offsets)))], ["doc_id", "host", "path", "p_text"])

    scored = S.durable(rows.mapInArrow(S.trimmed(run), "doc_id long, host string, path string, p_text double"))
    labelled = scored.join(known, "doc_id", "left")
    weight = F.when(F.col("y").isNotNull(), 1.0).otherwise(DISCOUNT)
    evidence = labelled.select("doc_id", "host", "path", "p_text", weight.alias("w"), (weight * F.coalesce("y", "p_text")).alias("e"))
    paths = S.durable(evidence.groupBy("host", "path").agg(F.sum("e").alias("path_good"), F.sum("w").alias("path_seen")))
    hosts = paths.groupBy("host").agg(F.sum("path_good").alias("host_good"), F.sum("path_seen").alias("host_seen"))
    good, seen = hosts.agg(F.sum("host_good"), F.sum("host_seen")).first()
    # fixed order of addition isn't given, so the last digits are dropped
    overall = round((good + 1) / (seen + 2), 9) if seen else 0.5
    by_host = round(shrinkage(hosts, "host_good", "host_seen", F.lit(overall)), 6)
    host_rate = (F.col("host_good") + by_host * overall) / (F.col("host_seen") + by_host)
    sites = paths.withColumnRenamed("host", "h").join(hosts, F.col("h").eqNullSafe(F.col("host"))).withColumn("host_rate", host_rate)
    by_path = round(shrinkage(sites, "path_good", "path_seen", F.col("host_rate")), 6)
    sites = sites.select("h", F.col("path").alias("p"), "path_good", "path_seen", "host_rate")

    # a short table of sites: broadcast if Spark finds it small, else a join that splits hot hosts
    joined = evidence.join(sites, F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("p")))
    others = (F.col("path_good") - F.col("e") + by_path * F.col("host_rate")) / (F.col("path_seen") - F.col("w") + by_path)
    rate = F.least(F.greatest(others, F.lit(1e-4)), F.lit(1 - 1e-4))
    base = float(np.log(model.rate / (1 - model.rate)))
    odds = F.log(F.col("p_text") / (1 - F.col("p_text"))) - base + F.log(rate / (1 - rate))
    posterior = 1 / (1 + F.exp(-odds))
    out = joined.withColumn("path_rate", rate).withColumn("posterior", F.round(posterior, 6))
    return out.select("doc_id", "host", "path", F.round("p_text", 6).alias("p_text"), F.round("host_rate", 6).alias("host_rate"), F.round("path_rate", 6).alias("path_rate"), "posterior", (F.col("posterior") >= KEEP).alias("kept"))
