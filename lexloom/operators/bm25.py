"""BM25 ranking over character trigrams.

A trigram is a 63-bit number, three code points of 21 bits. Counting them per text is
numpy over Arrow batches: as strings, the engine would make an object of every one of them.

``bm25_top`` answers many queries in two passes over the texts' trigrams: the queries, and
how many texts hold each of their trigrams, go to every task (their size is checked); a task
scores its texts in numpy and hands on its k best for each query. So what is shuffled is k
rows for each query and task, not a score for each text and query. Beyond that size, and
where all scores are asked for, ``bm25_scores`` joins and sums in the engine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexloom.functions.grams import compatible, query_terms
from lexloom.tables import durable

K1, B = 1.2, 0.75
#: An inverse document frequency never falls below this.
LEAST_IDF = 1e-6
#: Trigrams of queries up to which they go to every task, as 4 MB at most, to drop the others there.
FEW_GRAMS = 500_000


def gram_code(gram: Column) -> Column:
    """A trigram as a number."""
    at = lambda i: F.ascii(F.substring(gram, i, 1)).cast("long")
    return at(1).bitwiseOR(F.shiftleft(at(2), 21)).bitwiseOR(F.shiftleft(at(3), 42))


def codes(text: str) -> np.ndarray:
    """The trigrams of a text as numbers, in order."""
    c = np.frombuffer(text.encode("utf-32-le"), dtype="<u4").astype(np.int64)
    return c[:-2] | c[1:-1] << 21 | c[2:] << 42 if len(c) > 2 else np.empty(0, np.int64)


def postings(docs: DataFrame, key: str = "doc_id", text: str = "text", only: DataFrame | None = None) -> DataFrame:
    """(key, len, gram, tf) of each text. only: a table of grams; others are dropped, where they are made if it is short."""
    wanted = None
    if only is not None:
        some = only.select("gram").distinct().limit(FEW_GRAMS + 1).toPandas()["gram"].to_numpy(dtype=np.int64)
        wanted = np.sort(some) if len(some) <= FEW_GRAMS else None
    rows = docs.select(docs[key], F.lower(F.coalesce(docs[text], F.lit(""))).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                found = []
                for t in part.column(1).to_pylist():
                    g = codes(t)
                    n = len(g)
                    if shared.value is not None and n and len(shared.value):
                        at = np.minimum(np.searchsorted(shared.value, g), len(shared.value) - 1)
                        g = g[shared.value[at] == g]
                    elif shared.value is not None:
                        g = g[:0]
                    found.append((n, *np.unique(g, return_counts=True)))
                sizes = [len(g) for _, g, _ in found]
                at = np.repeat(np.arange(len(found)), sizes)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(at)), pa.array(np.repeat([n for n, _, _ in found], sizes).astype(np.int64)), pa.array(np.concatenate([g for _, g, _ in found])), pa.array(np.concatenate([c for _, _, c in found]).astype(np.int64))],
                    [key, "len", "gram", "tf"],
                )

    made = rows.mapInArrow(run, f"{key} {docs.schema[key].dataType.simpleString()}, len long, gram long, tf long")
    if only is not None and wanted is None:
        made = made.join(only.select("gram").distinct(), "gram", "left_semi")
    return made


def terms_of(queries: DataFrame, qkey: str, text: str) -> DataFrame:
    """(qkey, gram): the distinct trigrams of each query, the first 64."""
    return queries.select(qkey, compatible(F.col(text)).alias("t")).select(qkey, F.explode(query_terms(F.col("t"))).alias("g")).select(qkey, gram_code(F.col("g")).alias("gram"))


def bm25_scores(docs: DataFrame, queries: DataFrame, key: str = "doc_id", qkey: str = "item_id", text: str = "text", qtext: str | None = None) -> DataFrame:
    """(qkey, key, score) of every document sharing a trigram with a query; any trigram of it counts."""
    terms = terms_of(queries, qkey, qtext or text)
    tf = postings(docs, key, text, terms)
    df = tf.groupBy("gram").agg(F.count("*").alias("df"))
    stats = docs.agg(F.count("*").alias("n"), F.avg(F.greatest(F.length(text) - 2, F.lit(0))).alias("avgdl")).first()
    n, mean = float(stats["n"]), float(stats["avgdl"] or 1.0) or 1.0
    weight = F.greatest(F.log((F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5)), F.lit(LEAST_IDF))
    part = weight * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("len") / F.lit(mean)))
    scored = tf.join(df, "gram").join(terms, "gram").withColumn("part", part)
    return scored.groupBy(qkey, key).agg(F.round(F.sum("part"), 6).alias("score"))


#: Terms of queries up to which they go to every task, as 16 bytes each.
FEW_TERMS = 1_000_000
#: Scores that a task holds at once.
HELD_SCORES = 1 << 22


def indexed(docs: DataFrame, wanted: np.ndarray | None, key: str, columns: dict[str, int]) -> DataFrame:
    """The stored form of what is searched: (key, len, grams, tf) of each text, grams and frequencies as packed arrays.

    wanted: sorted trigrams; grams are then their places, and others are left out. columns:
    the texts of a row with their weights; a hit counts as often as its column weighs.
    """
    shared = docs.sparkSession.sparkContext.broadcast(wanted)
    rows = docs.select(key, *[F.lower(F.coalesce(c, F.lit(""))).alias(c) for c in columns])
    weights = list(columns.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, grams, counts = [], [], []
            for texts in zip(*(c.to_pylist() for c in batch.columns[1:])):
                each = [codes(t) for t in texts]
                g, w = np.concatenate(each), np.repeat(weights, [len(x) for x in each])
                sizes.append(len(g))
                if shared.value is not None and len(g):
                    at = np.minimum(np.searchsorted(shared.value, g), max(len(shared.value) - 1, 0))
                    kept = shared.value[at] == g if len(shared.value) else np.zeros(len(g), dtype=bool)
                    g, w = at[kept], w[kept]
                kinds, which = np.unique(g, return_inverse=True)
                grams.append(kinds.astype("<i8").tobytes())
                counts.append(np.bincount(which, weights=w, minlength=len(kinds)).astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(grams, pa.binary()), pa.array(counts, pa.binary())], [key, "len", "grams", "tf"])

    return rows.mapInArrow(run, f"{key} {docs.schema[key].dataType.simpleString()}, len long, grams binary, tf binary")


def narrowed(index: DataFrame, wanted: np.ndarray, key: str) -> DataFrame:
    """A stored index of all trigrams, with only the wanted ones, as their places."""
    shared = index.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams, counts = [], []
            for g, tf in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                g, tf = np.frombuffer(g, "<i8"), np.frombuffer(tf, "<i4")
                common, left, at = np.intersect1d(g, shared.value, assume_unique=True, return_indices=True)
                grams.append(at.astype("<i8").tobytes())
                counts.append(tf[left].astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(grams, pa.binary()), pa.array(counts, pa.binary())], batch.schema.names)

    return index.select(key, "len", "grams", "tf").mapInArrow(run, index.select(key, "len", "grams", "tf").schema)


def _spread(docs: DataFrame) -> DataFrame:
    """The texts in as many parts as shuffles have, if they are read in fewer: a short table may be one file's one part. A large one has more, and stays as it is."""
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return docs.repartition(width) if docs.rdd.getNumPartitions() < width else docs


def bm25_top(docs: DataFrame, queries: DataFrame, k: int, key: str = "doc_id", qkey: str = "item_id", text: str = "text", qtext: str | None = None, heading: str | None = None, heading_weight: int = 2, index: DataFrame | None = None) -> DataFrame:
    """(qkey, key, score, rank) of each query's k best texts by BM25; any shared trigram counts, ties go to the smaller key.

    heading: a second column, whose hits count ``heading_weight`` times. index: what
    ``indexed`` gave for all trigrams of these rows and columns, stored before.
    """
    terms = terms_of(queries, qkey, qtext or text)
    few = terms.limit(FEW_TERMS + 1).toPandas()
    if len(few) > FEW_TERMS and heading is None and index is None:
        return top_k(bm25_scores(docs, queries, key, qkey, text, qtext), k, key, qkey)
    if len(few) > FEW_TERMS:
        raise ValueError(f"more than {FEW_TERMS} terms of queries at once")
    wanted, which = np.unique(few["gram"].to_numpy(dtype=np.int64), return_inverse=True)
    names, query = np.unique(few[qkey].to_numpy(), return_inverse=True)
    order = np.argsort(which, kind="stable")
    starts = np.searchsorted(which[order], np.arange(len(wanted) + 1))
    columns = {text: 1} | ({heading: heading_weight} if heading else {})
    rows = durable(indexed(_spread(docs.select(key, *columns)), wanted, key, columns) if index is None else narrowed(index, wanted, key))
    stats = rows.agg(F.count("*").alias("n"), F.avg("len").alias("mean")).first()

    def held_by(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(wanted), dtype=np.int64)
        for batch in batches:
            n += np.bincount(np.frombuffer(b"".join(batch.column(2).to_pylist()), "<i8"), minlength=len(wanted))
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], ["at", "df"])

    df = np.zeros(len(wanted), dtype=np.float64)
    for r in rows.mapInArrow(held_by, "at long, df long").groupBy("at").agg(F.sum("df").alias("df")).collect():  # a row for each wanted gram at most
        df[r["at"]] = r["df"]
    idf = np.maximum(np.log((stats["n"] - df + 0.5) / (df + 0.5)), LEAST_IDF) if stats["n"] else df
    shared = rows.sparkSession.sparkContext.broadcast((idf, starts, query[order], len(names), float(stats["mean"] or 1.0) or 1.0))
    key_type, query_type = rows.schema[key].dataType.simpleString(), queries.schema[qkey].dataType.simpleString()
    # a task's best go by the queries' places, which the driver turns back
    best = rows.mapInArrow(lambda batches: _best(batches, shared.value, k), f"{key} {key_type}, query_place long, score double")
    named = rows.sparkSession.createDataFrame([(i, x.item() if hasattr(x, "item") else x) for i, x in enumerate(names)], f"query_place long, {qkey} {query_type}")
    return top_k(best.join(F.broadcast(named), "query_place").select(qkey, key, "score"), k, key, qkey)


def _best(batches: Iterator[pa.RecordBatch], shared: tuple, k: int) -> Iterator[pa.RecordBatch]:
    """The k best texts of these batches for each query."""
    idf, starts, query, n_queries, mean = shared
    top: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, object), np.empty(0))] * n_queries
    held, schema = max(1, HELD_SCORES // max(n_queries, 1)), None
    for whole in batches:
        schema = whole.schema
        for first in range(0, whole.num_rows, held):
            batch = whole.slice(first, held)
            keys, n = np.array(batch.column(0).to_pylist(), dtype=object), batch.num_rows
            lists, tfs = ([np.frombuffer(x, t) for x in batch.column(c).to_pylist()] for c, t in ((2, "<i8"), (3, "<i4")))
            row = np.repeat(np.arange(n), [len(x) for x in lists])
            gram, tf = np.concatenate(lists), np.concatenate(tfs).astype(np.float64)
            length = batch.column(1).to_numpy()[row]
            part = idf[gram] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean))
            asked = starts[gram + 1] - starts[gram]
            scores, hits = np.zeros(n * n_queries), np.zeros(n * n_queries, dtype=bool)
            cuts = np.concatenate(([0], np.cumsum(asked)))
            at = 0
            while at < len(gram):  # a slice of postings and their queries at a time
                end = min(len(gram), max(at + 1, int(np.searchsorted(cuts, cuts[at] + HELD_SCORES, side="right")) - 1))
                m = asked[at:end]
                spot = np.repeat(starts[gram[at:end]] - (cuts[at:end] - cuts[at]), m) + np.arange(cuts[end] - cuts[at])
                cell = np.repeat(row[at:end], m) * n_queries + query[spot]
                scores += np.bincount(cell, weights=np.repeat(part[at:end], m), minlength=len(scores))
                hits[cell] = True
                at = end
            scores, hits = np.round(scores, 6).reshape(n, n_queries), hits.reshape(n, n_queries)
            for q in range(n_queries):
                found = np.flatnonzero(hits[:, q])
                if len(found) > k:
                    # those that tie with the k-th are kept until keys are compared
                    least = np.partition(scores[found, q], len(found) - k)[len(found) - k]
                    found = found[scores[found, q] >= least]
                if len(found):
                    ks, ss = np.concatenate([top[q][0], keys[found]]), np.concatenate([top[q][1], scores[found, q]])
                    chosen = sorted(range(len(ks)), key=lambda i: (-ss[i], ks[i]))[:k]
                    top[q] = ks[chosen], ss[chosen]
    if schema is not None:
        sizes = [len(x) for x, _ in top]
        yield pa.RecordBatch.from_arrays([pa.array([x for ks, _ in top for x in ks], schema.field(0).type), pa.array(np.repeat(np.arange(n_queries), sizes)), pa.array(np.concatenate([x for _, x in top]))], [schema.names[0], "query_place", "score"])


def top_k(scores: DataFrame, k: int, key: str = "doc_id", qkey: str = "item_id") -> DataFrame:
    order = Window.partitionBy(qkey).orderBy(F.desc("score"), F.asc(key))
    return scores.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= k)
