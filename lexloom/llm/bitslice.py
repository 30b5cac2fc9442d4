"""Exact top-k inner products by a bit-sliced index.

Components are quantised to floor(256 x). A block of rows is stored as bitmaps, one for
each bit of each component above the block's least value, a bit for each row. A query's
score of all rows in a block is added up slice by slice: a component's slices enter once
for each set bit of the query's weight, shifted by it (and complemented under a negative
weight), and full adders over whole bitmaps bring every column of equal weight down to one
slice. Selection walks the score's slices from the most significant one down, splitting
the rows into those surely among the k best and those still tied; rows tied at the end are
resolved exactly, by smaller id. No row is scored on its own and nothing is approximated.

Queries and index meet in blocks: query blocks of bounded size, each met by every index
block. Each meeting keeps k rows for each query, so what is shuffled for the last choice
is k rows for each query and index block.

Defined cases: rows without an id, and vectors that are null, or hold a null or non-finite
component, take no part. Scores are 64-bit integers: a finite component that passes 62 bits
when quantised, or one of the k best scores that passes 64, is an error that names the row,
as no number could be returned for it. A shorter vector counts as
0 in the components it lacks. Of rows with the same id as a query none is a candidate for
it; rows that repeat another id are candidates each. An id that repeats as a query is
answered once, with its least vector. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexloom.llm import shared as S

SCALE = 256
ROWS, QUERIES = 1 << 15, 1 << 11
SCHEMA = "query_id long, vec_id long, score long"


def quantised(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, q): the rows that take part, with floor(256 x) of each component."""
    rows = S.named(vectors, vec_id=key, x=vector).select(F.col("vec_id").cast("long"), F.col("x").cast("array<double>"))
    good = F.col("vec_id").isNotNull() & F.col("x").isNotNull() & F.forall("x", lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    beyond = F.raise_error(F.concat(F.lit("a component passes 62 bits when quantised, in vector "), F.col("vec_id").cast("string")))
    return rows.filter(good).select("vec_id", F.transform("x", lambda v: F.when(F.abs(v) < 2.0**54, F.floor(v * SCALE).cast("long")).otherwise(beyond.cast("long"))).alias("q"))


def padded(q: pa.Array) -> np.ndarray:
    """Lists of integers as a matrix, shorter ones filled with 0."""
    q = q.combine_chunks() if isinstance(q, pa.ChunkedArray) else q
    lengths = q.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(q), max(1, int(lengths.max(initial=0)))), dtype=np.int64)
    rows = np.repeat(np.arange(len(q)), lengths)
    at = np.arange(len(rows)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[rows, at] = q.flatten().to_numpy(zero_copy_only=False)
    return out


class Block:
    """The slices of some rows."""

    def __init__(self, ids: np.ndarray, least: np.ndarray, bits: np.ndarray, slices: np.ndarray):
        self.ids, self.least, self.bits = ids, least, bits
        # each slice and, further down, its complement
        self.slices = np.concatenate([slices, ~slices])
        self.first = np.concatenate(([0], np.cumsum(bits)))
        self.valid = _bitmap(np.ones(len(ids), dtype=bool))

    @staticmethod
    def build(ids: np.ndarray, values: np.ndarray) -> Block:
        least = values.min(axis=0)
        above = values - least
        bits = np.array([int(v).bit_length() for v in above.max(axis=0)], dtype=np.int64)
        rows = [_bitmap((above[:, d] >> b) & 1 == 1) for d in range(values.shape[1]) for b in range(bits[d])]
        return Block(ids, least, bits, np.stack(rows) if rows else np.zeros((0, -(-len(ids) // 64)), dtype=np.uint64))

    def score_slices(self, q: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Slices of every row's score, least significant first, and what to add to the number they spell."""
        n, half = min(len(q), len(self.bits)), len(self.slices) // 2
        weights = [int(w) for w in q[:n]]
        plus = sum(w * int(m) for w, m in zip(weights, self.least))
        columns: dict[int, list[int]] = {}
        for d, w in enumerate(weights):
            bits = int(self.bits[d])
            if w < 0:
                plus += w * ((1 << bits) - 1)
            size, shift = abs(w), 0
            base = int(self.first[d]) + (half if w < 0 else 0)
            while size:
                if size & 1:
                    for b in range(bits):
                        columns.setdefault(b + shift, []).append(base + b)
                size >>= 1
                shift += 1
        out, carried = [], []
        for c in range(max(columns, default=-1) + 1) if columns else []:
            total, carried = self._add(columns.get(c, []), carried)
            out.append(total)
        while carried:
            total, carried = self._add([], carried)
            out.append(total)
        return out, plus

    def _add(self, own: list[int], carried: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
        """One slice from all bitmaps of a column, and the carries for the next column."""
        parts = [self.slices[own]] * bool(own) + carried
        m = np.concatenate(parts) if parts else np.zeros((1, len(self.valid)), dtype=np.uint64)
        carries = []
        while len(m) > 2:
            t = len(m) // 3
            a, b, c = m[:t], m[t : 2 * t], m[2 * t : 3 * t]
            x = a ^ b
            carries.append((a & b) | (c & x))
            m = np.concatenate([x ^ c, m[3 * t :]])
        if len(m) == 2:
            carries.append((m[0] & m[1])[None])
            m = (m[0] ^ m[1])[None]
        return m[0], carries

    def best(self, query_id: int, q: np.ndarray, k: int) -> list[tuple[int, int]]:
        """(row id, score) of the k best rows that don't have the query's id."""
        slices, plus = self.score_slices(q)
        sure = np.zeros_like(self.valid)
        tied = self.valid & ~_bitmap(self.ids == query_id)
        for s in reversed(slices):
            both = sure | (tied & s)
            n = int(np.bitwise_count(both).sum())
            if n > k:
                tied = tied & s
            else:
                sure, tied = both, tied & ~s
                if n == k:
                    tied[:] = 0
                    break
        rows = _rows(sure).tolist()
        if len(rows) < k:
            rest = _rows(tied)
            rows += rest[np.argsort(self.ids[rest], kind="stable")][: k - len(rows)].tolist()
        return [(int(self.ids[r]), plus + sum(((int(s[r >> 6]) >> (r & 63)) & 1) << i for i, s in enumerate(slices))) for r in rows]


def _bitmap(flags: np.ndarray) -> np.ndarray:
    packed = np.packbits(flags, bitorder="little")
    return np.frombuffer(packed.tobytes() + bytes(-len(packed) % 8), dtype="<u8").copy()


def _rows(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


INDEX = "block long, n long, ids binary, least binary, bits binary, slices binary"


def build_index(rows: DataFrame) -> DataFrame:
    """Index blocks of at most ROWS rows, made where the rows are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []

        def flush() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            block = Block.build(table.column(0).to_numpy(), padded(table.column(1)))
            cells = [number, len(block.ids), *[a.tobytes() for a in (block.ids, block.least, block.bits, block.slices[: len(block.slices) // 2])]]
            return pa.RecordBatch.from_arrays([pa.array([c], pa.int64() if i < 2 else pa.binary()) for i, c in enumerate(cells)], [f.split()[0] for f in INDEX.split(", ")])

        for batch in batches:
            while batch.num_rows:
                room = ROWS - sum(b.num_rows for b in held)
                held.append(batch.slice(0, room))
                batch = batch.slice(room)
                if sum(b.num_rows for b in held) == ROWS:
                    yield flush()
                    held, number = [], number + 1
        if held:
            yield flush()

    return rows.mapInArrow(S.trimmed(run), INDEX)


def top_k(vectors: DataFrame, every: int, k: int, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by ``every`` its k best rows."""
    spark = vectors.sparkSession
    rows = quantised(vectors, key, vector)
    queries = S.durable(rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("q").alias("q")))
    blocks = max(1, -(-queries.count() // QUERIES))
    # query blocks are copied until they are as many as the tasks, so that few of them still spread the index
    copies = -(-S.shuffle_width(spark) // blocks)
    asked = queries.withColumn("qb", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
    asked = asked.groupBy("qb").agg(F.collect_list("vec_id").alias("qids"), F.collect_list("q").alias("qs"))
    asked = asked.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    index = S.stored(build_index(rows), "bitslice-index")
    index = index.withColumn("qb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))).withColumn("copy", F.pmod(F.xxhash64("block"), F.lit(copies)).cast("int"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                n, ids, least, bits, slices = (batch.column(c)[i].as_py() for c in range(5))
                words = -(-n // 64)
                block = Block(*[np.frombuffer(x, dtype="<i8") for x in (ids, least, bits)], np.frombuffer(slices, dtype="<u8").reshape(-1, words))
                qids, qs = batch.column(5)[i].as_py(), padded(batch.column(6)[i].values)
                found = [(qid, *r) for qid, q in zip(qids, qs) for r in block.best(qid, q, k)]
                for qid, vec_id, score in found:
                    if not -(1 << 63) <= score < 1 << 63:
                        raise OverflowError(f"the score of vectors {qid} and {vec_id} passes 64 bits")
                columns = zip(*found) if found else ((), (), ())
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])

    met = index.join(asked, ["qb", "copy"]).select("n", "ids", "least", "bits", "slices", "qids", "qs").mapInArrow(S.trimmed(run), SCHEMA)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


SQL = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
      FROM e a JOIN e b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p) WHERE rank <= 5
"""
