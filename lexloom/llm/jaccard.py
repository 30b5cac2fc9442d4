"""Jaccard join on word shingles by filters under several global token orders.

Texts with equal shingle sets form a class; everything below works on classes.

1. Common shingles. All shingles are counted by 32 bits of their hash, packed as sorted
   differences; those that repeat, and those that repeat often, go into bitmaps of fixed
   size. They only shape the token orders, so neither collisions nor thresholds can change
   the result.
2. Token orders. Under each of ORDERS orders, shingles that don't repeat come first, then
   those that don't often; within these levels they go by a hash of the order's own. If two sets are linked, they share a token among the first
   n - ceil(t n) + 1 of each, t being the least similarity, under every order.
3. Intersecting the filters. Classes that share a prefix token with another class under
   the first order go on, of these those that share one under the second, and so on.
   The groups are the shared tokens of the first order among the classes left; in a group
   two classes are candidates if their sizes allow a link, and if the parities of their
   shingles' hashes don't already show too large a difference. A candidate pair must share
   a prefix token under every other order too before its sets are compared.
4. A group doesn't emit its pairs, only a spanning forest of its candidates, so a group of
   m near copies gives m - 1 edges. Large groups are cut into blocks, and each pair of
   blocks is a group.
5. The classes with an edge are read once more for all their shingles. Verification by exact intersection of the sets: first one edge for each class, then
   those between classes that aren't connected yet. Where a forest edge fails between
   components, its groups are gone through again and all their candidates between
   different components are verified. So no link between different texts that would
   join two components is lost.

Intermediates are deleted when they are done with, and so are the shuffles that made them.

Shingles are 64-bit hashes; a chance collision inside two compared sets is negligible.

Defined cases: null and wordless texts have no shingles and are linked with nothing, not
even each other. A text of fewer words than a shingle has one, the whole sequence. Rows
with equal ids and texts are in one class. A null id is never a component's id unless all
its ids are null. Columns other than key and text are not read.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lexloom.llm import shared as S
from lexloom.llm.components import connected_components

#: Words of a shingle, and tenths of the similarity from which on texts are linked, unless they are given.
SHINGLE, TENTHS = 3, 9
ORDERS = 3
SEEDS = [np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344), np.uint64(0xA4093822299F31D0)]
BITMAP_BITS = 26
#: A shingle is common from 2 occurrences on, or a higher power of 2 if more than MOST_COMMON would be,
#: and popular from 2 ** POPULAR on. The bitmap need only leave each text some shingles that aren't in it.
MOST_COMMON, POPULAR = int(0.8 * (1 << BITMAP_BITS)), 4
#: Classes in a group that is gone through at once.
BLOCK = 1024
#: Edges up to which they are broadcast to the sets they need, in about 1 MB.
FEW_EDGES = 20_000
#: Rows of the short tables of classes and edges that one task takes.
PART_ROWS = 50_000


def shingles(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each row of a slice."""
    lower = S.LOWER[data]
    starts, ends = S.runs(~S.WHITE[data], offsets)
    rows = S.row_of(starts, offsets)
    words = S.run_hashes(lower, starts, ends)
    hashes, at = S.window_hashes(words, rows, size)
    n = len(offsets) - 1
    first = np.searchsorted(rows, np.arange(n + 1))
    cuts = np.searchsorted(rows[at], np.arange(n + 1)) if len(at) else np.zeros(n + 1, np.int64)
    out = []
    for r in range(n):
        if cuts[r + 1] > cuts[r]:
            out.append(np.unique(hashes[cuts[r] : cuts[r + 1]]))
        elif first[r + 1] > first[r]:  # too short for a shingle
            h = np.uint64(0)
            with np.errstate(over="ignore"):
                for w in words[first[r] : first[r + 1]]:
                    h = h * S.BASE + w
            out.append(S.mix(np.array([h + np.uint64(first[r + 1] - first[r])], dtype=np.uint64)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


# ---------------------------------------------------------------- bitmaps of fixed size


def _bits_set(positions: DataFrame) -> np.ndarray:
    """A bitmap of 2 ** BITMAP_BITS bits from a table of positions; at most 2 ** (BITMAP_BITS - 6) rows reach the driver."""
    words = positions.groupBy(F.shiftright("pos", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, pos & 63)")).alias("b"))
    out = np.zeros(1 << (BITMAP_BITS - 6), dtype=np.int64)
    got = words.toArrow()
    out[got.column("w").to_numpy()] = got.column("b").to_numpy()
    del got
    S.hand_back()
    return out.view(np.uint64)


def _has(bitmap: np.ndarray, positions: np.ndarray) -> np.ndarray:
    return (bitmap[positions >> np.uint64(6)] >> (positions & np.uint64(63))) & np.uint64(1) == 1


def _place(hashes: np.ndarray) -> np.ndarray:
    return hashes >> np.uint64(64 - BITMAP_BITS)


def _pack(values: np.ndarray) -> bytes:
    """Sorted 32-bit values as 16-bit differences; 65535 goes on without ending a value."""
    gaps = np.diff(values.astype(np.int64), prepend=0)
    more = gaps // 65535
    out = np.full(len(gaps) + int(more.sum()), 65535, dtype="<u2")
    out[np.cumsum(more) + np.arange(len(gaps))] = gaps % 65535
    return out.tobytes()


def _unpack(data: bytes) -> np.ndarray:
    gaps = np.frombuffer(data, "<u2")
    return np.cumsum(gaps, dtype=np.int64)[gaps != 65535]


def _buckets(spark: SparkSession, passes: int) -> int:
    return max(passes << 3, 1 << max(6, (S.shuffle_width(spark) - 1).bit_length()))


def repeated_levels(rows: DataFrame, values: Callable[[pa.RecordBatch], Iterator[np.ndarray]], passes: int = 1) -> DataFrame:
    """(bucket, level, n, piece): for each power of 2, a bitmap in pieces of the 64-bit values that occur so often.

    passes: a power of 2; the bitmap has so many times 2 ** BITMAP_BITS bits, and every bucket lies in one of its slices of that size.

    values: lists of values of a batch. They are counted by their first 32 bits, packed as
    sorted differences: about two bytes a value are shuffled, to buckets that are even
    whatever the values, and a value that repeats in a task costs no more than its count.
    """
    spark = rows.sparkSession
    buckets = _buckets(spark, passes)
    places = BITMAP_BITS + passes.bit_length() - 1
    step, bits = (1 << 32) // buckets, (1 << places) // buckets

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0

        def packed() -> pa.RecordBatch:
            all_ = np.sort(np.concatenate(held))
            cuts = np.searchsorted(all_, np.arange(buckets + 1) * step)
            full = [b for b in range(buckets) if cuts[b + 1] > cuts[b]]
            return pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array([_pack(all_[cuts[b] : cuts[b + 1]] - b * step) for b in full], pa.binary())], ["bucket", "gaps"])

        for batch in batches:
            for s in values(batch):
                held.append((s >> np.uint64(32)).astype(np.int64))
                total += len(s)
                if total > 1 << 22:
                    yield packed()
                    held, total = [], 0
        if total:
            yield packed()

    def by_level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:

        def pieces(bucket: int, parts: list[bytes]) -> pa.RecordBatch:
            all_ = np.sort(np.concatenate([_unpack(p) for p in parts]))
            kinds = np.flatnonzero(np.diff(all_, prepend=-1))
            level = np.log2(np.diff(np.append(kinds, len(all_)))).astype(np.int32)
            out = []
            for k in np.unique(level[level > 0]).tolist():
                mine = np.zeros(bits, dtype=bool)
                mine[all_[kinds[level == k]] >> (32 - places)] = True
                out.append((bucket, k, int((level == k).sum()), zlib.compress(np.packbits(mine, bitorder="little").tobytes(), 1)))
            columns = zip(*out) if out else ((), (), (), ())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int64(), pa.binary()))], ["bucket", "level", "n", "piece"])

        now, parts = None, []
        for batch in batches:
            for bucket, gaps in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if bucket != now and parts:
                    yield pieces(now, parts)
                    parts = []
                now = bucket
                parts.append(gaps)
        if parts:
            yield pieces(now, parts)

    packed_rows = rows.mapInArrow(S.trimmed(count), "bucket int, gaps binary")
    return S.durable(packed_rows.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(S.trimmed(by_level), "bucket int, level int, n long, piece binary"))


def bitmaps(levels: DataFrame, *least: int, turn: int = 0, passes: int = 1) -> np.ndarray:
    """For each of the levels given, a bitmap of the values that occur 2 ** level times or more; with passes, the slice of it whose turn it is."""
    out = np.zeros((len(least), 1 << (BITMAP_BITS - 3)), dtype=np.uint8)
    each = _buckets(levels.sparkSession, passes) // passes
    size = out.shape[1] // each
    mine = (F.col("bucket") >= turn * each) & (F.col("bucket") < (turn + 1) * each)
    # a bitmap's size for each level, in four parts: each part is a job of the driver
    for r in levels.filter(mine & (F.col("level") >= min(least))).coalesce(4).toLocalIterator():
        piece = np.frombuffer(zlib.decompress(r["piece"]), dtype=np.uint8)
        at = (r["bucket"] - turn * each) * size
        for k, level in enumerate(least):
            if r["level"] >= level:
                out[k, at : at + size] |= piece
    S.hand_back()
    return out.view(np.uint64)


def popular_shingles(rows: DataFrame, size: int) -> np.ndarray:
    """Two bitmaps, of the common and of the popular shingles of all texts (a table of text)."""

    def of_texts(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for _, _, data, offsets in S.slices(batch.column(0)):
            yield from shingles(data, offsets, size)

    levels = repeated_levels(rows.select("text"), of_texts)
    known = {r[0]: r[1] for r in levels.groupBy("level").agg(F.sum("n")).collect()}  # at most 31 rows
    common = 1
    while sum(n for k, n in known.items() if k >= common) > MOST_COMMON:
        common += 1
    out = bitmaps(levels, common, max(POPULAR, common + 1))
    S.release(levels)
    return out


def repeated_tokens(sketched: DataFrame, prefix: str, passes: int) -> DataFrame:
    """Levels whose bitmap holds every token in the prefixes of two rows or more, and some others."""

    def of_prefixes(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for p in batch.column(0).to_pylist():
            yield np.frombuffer(p, "<u8")

    return repeated_levels(sketched.select(prefix), of_prefixes, passes)


def _passes(tokens: int) -> int:
    """So many that a bitmap of all tokens, in that many slices, has a bit for each, and most tokens that don't repeat miss it. Tokens are counted by 32 bits, so more slices wouldn't help."""
    return min(1 << max(0, -(-tokens // (1 << BITMAP_BITS)) - 1).bit_length(), 1 << (32 - BITMAP_BITS))


# ---------------------------------------------------------------- sketches


def signature_bits(n: int) -> int:
    return 1 << max(9, int(n - 1).bit_length())


def class_name(s: np.ndarray) -> bytes:
    """128 bits that stand for a set."""
    with np.errstate(over="ignore"):
        return np.array([S.mix(s ^ SEEDS[1]).sum(dtype=np.uint64) + np.uint64(len(s)), S.mix(s ^ SEEDS[2]).sum(dtype=np.uint64)], dtype="<u8").tobytes()


def parities(s: np.ndarray) -> bytes:
    bits = signature_bits(len(s))
    odd = np.bincount((S.mix(s ^ SEEDS[0]) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def prefix(s: np.ndarray, popular: np.ndarray, order: int, tenths: int) -> bytes:
    """The tokens that linked sets must share one of, under one of the orders."""
    n = len(s)
    length = n - -(-tenths * n // 10) + 1
    if length >= n:
        return s.astype("<u8").tobytes()
    place = _place(s)
    level = _has(popular[0], place).astype(np.uint64) + _has(popular[1], place).astype(np.uint64)
    rank = (S.mix(s + SEEDS[order - 1]) >> np.uint64(2)) | level << np.uint64(62)
    return s[np.argpartition(rank, length - 1)[:length]].astype("<u8").tobytes()


def sketches(rows: DataFrame, popular, size: int, tenths: int) -> DataFrame:
    """(doc_id, n, c, p1) of every text: its number of shingles, class and prefix under the first order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in S.slices(batch.column(1)):
                sets = shingles(data, offsets, size)
                names = [class_name(s) if len(s) else None for s in sets]
                first = [prefix(s, popular.value, 1, tenths) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array([len(s) for s in sets], pa.int64()), pa.array(names, pa.binary()), pa.array(first, pa.binary())], ["doc_id", "n", "c", "p1"])

    return rows.select("doc_id", "text").mapInArrow(S.trimmed(run), "doc_id long, n long, c binary, p1 binary")


def remade(rows: DataFrame, wanted: DataFrame, popular, size: int, tenths: int, names: list[str]) -> DataFrame:
    """The classes in ``wanted`` (c, doc_id), one row each, made again from their texts: c and of n (size), sig (parities), p2, p3 (the other orders' prefixes) and s (all shingles) those named."""
    place = F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - BITMAP_BITS)
    keep = rows.sparkSession.sparkContext.broadcast(_bits_set(wanted.select(place.alias("pos"))))  # 8 MB, whatever the data
    cell = {"c": class_name, "n": len, "sig": parities, "s": lambda s: s.astype("<u8").tobytes()}
    cell |= {f"p{k}": (lambda s, k=k: prefix(s, popular.value, k, tenths)) for k in range(2, ORDERS + 1)}
    names = ["c", *names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(_has(keep.value, batch.column(1).to_numpy().astype(np.uint64))))
            for _, _, data, offsets in S.slices(batch.column(0)):
                sets = [s for s in shingles(data, offsets, size) if len(s)]
                yield pa.RecordBatch.from_arrays([pa.array([cell[x](s) for s in sets], pa.int64() if x == "n" else pa.binary()) for x in names], names)

    schema = ", ".join(f"{x} {'long' if x == 'n' else 'binary'}" for x in names)
    made = rows.select("text", place.alias("pos")).mapInArrow(S.trimmed(run), schema).dropDuplicates(["c"])
    out = S.stored(made.join(wanted.select("c"), "c", "left_semi"), "jaccard-sets")
    keep.destroy()
    return out


def _shared_tokens(sketched: DataFrame, prefix: str, tokens: int) -> DataFrame:
    """(tok, c, k): the prefix tokens that k >= 2 classes have, with these classes, stored.

    tokens: how many there are. A bitmap drops most tokens that don't repeat before the
    shuffle; it is gone through in slices, one at a time, and a slice has its tokens to
    itself. Classes of a token are counted in partial sums, and meet their count in a join
    whose hot tokens the engine splits.
    """
    spark = sketched.sparkSession
    passes = _passes(tokens)
    levels = repeated_tokens(sketched, prefix, passes)
    out = []
    for turn in range(passes):
        some = spark.sparkContext.broadcast(bitmaps(levels, 1, turn=turn, passes=passes)[0])  # 8 MB, whatever the data

        def flat(batches: Iterator[pa.RecordBatch], turn=turn, some=some) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(0, batch.num_rows, 4096):
                    part = batch.slice(i, 4096)
                    lists = [np.frombuffer(x, "<u8") for x in part.column(1).to_pylist()]
                    toks, at = np.concatenate(lists), np.repeat(np.arange(len(lists)), [len(x) for x in lists])
                    # the first bits tell the slice, the next ones the place in it
                    if passes > 1:
                        mine = (toks >> np.uint64(65 - passes.bit_length())).astype(np.int64) == turn
                        toks, at = toks[mine], at[mine]
                    kept = _has(some.value, _place(toks << np.uint64(passes.bit_length() - 1)))
                    toks, at = toks[kept], at[kept]
                    yield pa.RecordBatch.from_arrays([pa.array(toks.view("<i8")), part.column(0).take(pa.array(at))], ["tok", "c"])

        posted = S.stored(sketched.select("c", prefix).mapInArrow(S.trimmed(flat), "tok long, c binary").distinct(), "jaccard-tokens")
        out.append(S.stored(_counted(posted), "jaccard-shared"))
        S.release(posted)
        some.destroy()
    S.release(levels)
    if passes == 1:
        return out[0]
    whole = S.stored(functools.reduce(DataFrame.unionByName, out), "jaccard-shared")
    S.release(*out)
    return whole


def _counted(posted: DataFrame) -> DataFrame:
    """The rows (tok, c) whose token has two classes or more, with their number k."""
    # written before the join: only a plain shuffle is split where a token is hot
    counts = S.durable(posted.groupBy("tok").agg(F.count("*").alias("k")).filter("k > 1"), PART_ROWS)
    return posted.select("tok", "c").join(counts, "tok")


def _near(n: np.ndarray, m: int, tenths: int) -> np.ndarray:
    """Whether sizes allow a link."""
    return 10 * np.minimum(n, m) >= tenths * np.maximum(n, m)


def _most_apart(n, m, tenths: int):
    """The largest symmetric difference of linked sets of these sizes: 1/19 of their sum at 0.9."""
    return (10 - tenths) * (n + m) // (10 + tenths)


class Group:
    """The classes that share a prefix token, with what tells candidates among them."""

    def __init__(self, names: list[bytes], n: np.ndarray, sigs: list[bytes], tenths: int, parities: bool = True):
        self.names, self.n, self.tenths, self.parities = names, n, tenths, parities
        self.sigs = [np.frombuffer(s, "<u8") for s in sigs]
        self.by_bits: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        lengths = np.array([len(s) for s in self.sigs])
        for k in np.unique(lengths):
            at = np.flatnonzero(lengths == k)
            self.by_bits[int(k)] = (at, np.stack([self.sigs[i] for i in at]))

    def candidates(self, x: int, open_: np.ndarray) -> list[int]:
        """The classes marked open that may be linked with x."""
        mine, found = self.sigs[x], []
        for k, (at, matrix) in self.by_bits.items():
            if not k // 2 <= len(mine) <= 2 * k:
                continue
            some = np.flatnonzero(open_[at] & _near(self.n[at], self.n[x], self.tenths))
            if not len(some):
                continue
            if not self.parities:
                found += at[some].tolist()
                continue
            theirs, own = matrix[some], mine
            if len(own) > k:
                own = own[:k] ^ own[k:]
            elif len(own) < k:
                theirs = theirs[:, : k // 2] ^ theirs[:, k // 2 :]
            apart = np.bitwise_count(theirs ^ own).sum(axis=1)
            found += at[some[apart <= _most_apart(self.n[at[some]], self.n[x], self.tenths)]].tolist()
        return [y for y in found if y != x]


def _forest(g: Group, labels: list) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the group's candidates."""
    open_ = np.ones(len(g.names), dtype=bool)
    edges = []
    for root in range(len(g.names)):
        if not open_[root]:
            continue
        open_[root] = False
        queue = [root]
        while queue and open_.any():
            x = queue.pop()
            reached = g.candidates(x, open_)
            open_[reached] = False
            edges += [(x, y) for y in reached]
            queue += reached
    return edges


def _across(g: Group, labels: list) -> list[tuple[int, int]]:
    """All candidates of the group between different components."""
    every = np.ones(len(g.names), dtype=bool)
    return [(x, y) for x in range(len(g.names)) for y in g.candidates(x, every) if x < y and labels[x] != labels[y]]


def _group_edges(grouped: DataFrame, choose, tenths: int, parities: bool) -> DataFrame:
    """(tok, b, u, v) of what ``choose`` takes of each group; grouped: tok, b, c, n, sig, root, dealt and sorted by tok and b."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def edges(table: pa.Table) -> pa.RecordBatch:
            toks, bs = table.column("tok").to_numpy(), table.column("b").to_numpy()
            cuts = np.flatnonzero((np.diff(toks) != 0) | (np.diff(bs) != 0)) + 1
            cuts = [0, *cuts.tolist(), len(toks)]
            names, n, sigs, roots = (table.column(x).to_pylist() for x in ("c", "n", "sig", "root"))
            n = np.array(n, dtype=np.int64)
            out: list[tuple] = []
            for i, j in zip(cuts, cuts[1:]):
                if j - i > 1:
                    g = Group(names[i:j], n[i:j], sigs[i:j], tenths, parities)
                    out += [(int(toks[i]), int(bs[i]), *sorted((names[i + x], names[i + y]))) for x, y in choose(g, roots[i:j])]
            t, b, u, v = zip(*out) if out else ((), (), (), ())
            return pa.RecordBatch.from_arrays([pa.array(t, pa.int64()), pa.array(b, pa.int64()), pa.array(u, pa.binary()), pa.array(v, pa.binary())], ["tok", "b", "u", "v"])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]) if held is not None else table
            # the last group may go on in the next batch; no group has more than two blocks
            t, b = table.column("tok")[-1].as_py(), table.column("b")[-1].as_py()
            same = np.flatnonzero((table.column("tok").to_numpy() != t) | (table.column("b").to_numpy() != b))
            cut = int(same[-1]) + 1 if len(same) else 0
            if cut:
                yield edges(table.slice(0, cut))
            held = table.slice(cut).combine_chunks()
        if held is not None and held.num_rows:
            yield edges(held)

    return grouped.mapInArrow(S.trimmed(run), "tok long, b long, u binary, v binary")


def _blocks(posted: DataFrame) -> DataFrame:
    """(tok, b, c): groups of at most about two blocks; a larger one is cut, and every pair of its blocks is a group."""
    parts = F.ceil(F.col("k") / BLOCK).cast("long")
    mine = F.pmod(F.xxhash64("c"), parts)
    # the number of a pair of blocks i <= j
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), parts - 1), lambda o: F.least(mine, o) * parts + F.greatest(mine, o))
    return posted.select("tok", "c", F.explode(F.when(F.col("k") <= 2 * BLOCK, F.array(F.lit(0).cast("long"))).otherwise(pairs)).alias("b"))


def _verify(edges: DataFrame, sets: DataFrame, tenths: int) -> DataFrame:
    """(u, v, linked): the pairs that share prefix tokens under every other order, by exact intersection."""
    others = [f"p{k}" for k in range(2, ORDERS + 1)]
    width = len(others) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for row in zip(*(c.to_pylist() for c in batch.columns[2:])):
                a, b = ([np.frombuffer(x, "<u8") for x in half] for half in (row[:width], row[width:]))
                if all(len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(a[:-1], b[:-1])):
                    both = len(np.intersect1d(a[-1], b[-1], assume_unique=True))
                    linked.append(10 * both >= tenths * (len(a[-1]) + len(b[-1]) - both))
                else:
                    linked.append(False)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked, pa.bool_())], ["u", "v", "linked"])

    # few edges go to the sets, many meet them in a shuffle
    few = edges.limit(FEW_EDGES + 1).count() <= FEW_EDGES
    some = F.broadcast(edges) if few else edges
    halves = [some.join(sets.select(F.col("c").alias(end), *[F.col(x).alias(x + end) for x in [*others, "s"]]), end) for end in ("u", "v")]
    met = halves[0].join(halves[1], ["u", "v"])
    columns = [x + end for end in ("u", "v") for x in [*others, "s"]]
    return S.durable(met.select("u", "v", *columns).mapInArrow(S.trimmed(run), "u binary, v binary, linked boolean"), PART_ROWS)


def _between(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """The edges whose ends aren't in one component."""
    a = labels.select(F.col("node").alias("u"), F.col("root").alias("ru"))
    b = labels.select(F.col("node").alias("v"), F.col("root").alias("rv"))
    roots = edges.join(a, "u", "left").join(b, "v", "left")
    return roots.filter(F.coalesce("ru", "u") != F.coalesce("rv", "v")).select(*edges.columns)


def class_links(rows: DataFrame, sketched: DataFrame, popular, size: int, tenths: int, parities: bool = True) -> DataFrame:
    """(u, v): links between classes that connect whatever any links connect."""
    length = F.col("n") - F.ceil(F.col("n") * tenths / 10) + 1
    number = lambda of: of.agg(F.coalesce(F.sum(length), F.lit(0))).first()[0]
    posted = _shared_tokens(sketched, "p1", number(sketched))
    wanted = S.durable(sketched.groupBy("c").agg(F.min("doc_id").alias("doc_id")).join(posted.select("c").distinct(), "c", "left_semi"), PART_ROWS)
    # all shingles only of those that get an edge, later: they take most of the room
    live = remade(rows, wanted, popular, size, tenths, ["n", "sig", *[f"p{k}" for k in range(2, ORDERS + 1)]])
    alive = live.select("c")
    for k in range(2, ORDERS + 1):
        some = live.select("c", "n", f"p{k}").join(alive, "c", "left_semi")
        shared = _shared_tokens(some, f"p{k}", number(some))
        alive = S.durable(shared.select("c").distinct(), PART_ROWS)
        S.release(shared)
    left = S.durable(posted.select("tok", "c").join(alive, "c", "left_semi"), PART_ROWS)
    S.release(posted)
    blocks = S.durable(_blocks(_counted(left)), PART_ROWS)
    S.release(left)
    payload = live.select("c", "n", "sig")

    def groups(of: DataFrame, labels: DataFrame | None) -> DataFrame:
        full = of.join(payload, "c")
        full = full.join(labels.select(F.col("node").alias("c"), "root"), "c", "left").withColumn("root", F.coalesce("root", "c")) if labels is not None else full.withColumn("root", F.lit(None).cast("binary"))
        return full.repartition("tok", "b").sortWithinPartitions("tok", "b", "n", "c")

    emitted = S.durable(_group_edges(groups(blocks, None), _forest, tenths, parities), PART_ROWS)
    edges = S.durable(emitted.select("u", "v").distinct(), PART_ROWS)
    # one edge for each class first; most others then lie inside a component
    first = S.durable(edges.groupBy("v").agg(F.min("u").alias("u")).select("u", "v"), PART_ROWS)
    # whatever may be linked has an edge in the forest of its group
    ends = edges.select(F.explode(F.array("u", "v")).alias("c")).distinct()
    ended = S.durable(wanted.join(ends, "c", "left_semi"), PART_ROWS)
    sets = remade(rows, ended, popular, size, tenths, [*[f"p{k}" for k in range(2, ORDERS + 1)], "s"])
    S.release(wanted, ended)
    checked = _verify(first, sets, tenths)
    labels = connected_components(checked.filter("linked").select("u", "v"))
    more = S.durable(_between(edges.join(checked, ["u", "v"], "left_anti"), labels), PART_ROWS)
    if not more.isEmpty():
        checked = checked.unionByName(_verify(more, sets, tenths))
        labels = connected_components(checked.filter("linked").select("u", "v"))
    failed = S.durable(_between(checked.filter(~F.col("linked")).select("u", "v"), labels), PART_ROWS)
    if not failed.isEmpty():
        again = emitted.join(failed, ["u", "v"], "left_semi").select("tok", "b").distinct()
        across = _group_edges(groups(blocks.join(again, ["tok", "b"], "left_semi"), labels), _across, tenths, parities).select("u", "v").distinct()
        checked = checked.unionByName(_verify(S.durable(across.join(checked, ["u", "v"], "left_anti"), PART_ROWS), sets, tenths))
    out = S.durable(checked.filter("linked").select("u", "v"), PART_ROWS)
    S.release(live, sets, alive, blocks, emitted, edges, first, more, failed)
    return out


def with_class(docs: DataFrame, name: str, text: str = "text", size: int = SHINGLE) -> DataFrame:
    """The documents with the class of each text, as jaccard_components gives it, in a new column."""
    at, columns = S.place(docs.columns, text), [*docs.columns, name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in S.slices(batch.column(at)):
                names = [class_name(s).hex() if len(s) else None for s in shingles(data, offsets, size)]
                yield pa.RecordBatch.from_arrays([*batch.slice(i, j - i).columns, pa.array(names, pa.string())], columns)

    return S.batched(docs).mapInArrow(S.trimmed(run), StructType([*docs.schema.fields, StructField(name, StringType())]))


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text", parities: bool = True, size: int = SHINGLE, tenths: int = TENTHS) -> DataFrame:
    """(doc_id, n_shingles, class, component_id, root) of every document; root: a class that only its component has. parities: False leaves that filter out, with the same result.

    size, tenths: words of a shingle, and tenths of the similarity from which on texts are linked (5 to 10).
    """
    rows = S.keyed(docs, key, text)
    popular = docs.sparkSession.sparkContext.broadcast(popular_shingles(rows, size))  # 16 MB, whatever the data
    sketched = S.stored(sketches(rows, popular, size, tenths), "jaccard-sketches")
    links = class_links(rows, sketched.filter("c is not null"), popular, size, tenths, parities)
    popular.destroy()
    narrow = S.stored(sketched.select("doc_id", "n", "c"), "jaccard-classes")
    S.release(sketched)
    labels = connected_components(links)
    classes = narrow.filter("c is not null").groupBy("c").agg(F.min("doc_id").alias("class_id"))
    linked = classes.join(labels.withColumnRenamed("node", "c"), "c")
    least = linked.groupBy("root").agg(F.min("class_id").alias("least"))
    named = S.durable(classes.join(linked.join(least, "root").select("c", "least", "root"), "c", "left"))
    out = narrow.join(named, "c", "left")
    alone = F.when(F.col("c").isNull(), F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.lower(F.hex("c")).alias("class"), F.coalesce("least", "class_id", alone).alias("component_id"), F.lower(F.hex(F.coalesce("root", "c"))).alias("root"))


SQL = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT rid, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM d WHERE len(ws) >= 3),
a AS (SELECT rid, w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o AS s FROM w WINDOW o AS (PARTITION BY rid ORDER BY p)),
s AS (SELECT DISTINCT rid, s FROM a WHERE s IS NOT NULL UNION ALL SELECT rid, array_to_string(ws, ' ') FROM d WHERE len(ws) BETWEEN 1 AND 2),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
b AS (SELECT x.rid AS u, y.rid AS v, count(*) AS common FROM s x JOIN s y ON x.s = y.s AND x.rid < y.rid GROUP BY ALL),
l AS (SELECT u, v FROM b JOIN n nu ON nu.rid = u JOIN n nv ON nv.rid = v WHERE 100 * common >= 90 * (nu.n + nv.n - common)),
e AS (SELECT u, v FROM l UNION ALL SELECT v, u FROM l),
c AS (SELECT rid, rid AS root FROM d UNION SELECT c.rid, e.v FROM c JOIN e ON e.u = c.root)
SELECT any_value(d.doc_id) AS doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(o.doc_id) AS component_id
FROM c JOIN d ON d.rid = c.rid JOIN d o ON o.rid = c.root LEFT JOIN n ON n.rid = c.rid GROUP BY c.rid
"""
