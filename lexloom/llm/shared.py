"""What the corpus operators share: durable intermediates, and word tables in numpy."""

from __future__ import annotations

import contextlib
import ctypes
import re
import tempfile
import time
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words everywhere here: runs of anything but blank, tab, line feed, vertical tab, form feed, carriage return.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

#: Numpy works on slices of about this many bytes, so that its temporaries stay small; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20
#: Rows of texts or of whole sets that cross to Python at once.
BATCH_ROWS = 1000


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or a local one where it is unset and all runs on this machine (tests)."""
    sc = spark.sparkContext
    known = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if known:
        return known
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="lexloom-"))
    return sc.getCheckpointDir()


#: Where set, Spark deletes what a query shuffled when the query ends, not when the driver's garbage is collected.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Seconds between two collections of the driver's garbage.
COLLECT_S = 4
_collected = [0.0]


@contextlib.contextmanager
def _own_shuffles(df: DataFrame) -> Iterator[DataFrame]:
    """The rows as a query of their own, whose shuffles are deleted when it ends. Only for rows that are written: others may be read again."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        yield df.select("*")
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)
    # plans and metrics of past queries fill the driver's heap, which it would keep at its largest
    if time.monotonic() - _collected[0] > COLLECT_S:
        df.sparkSession._jvm.System.gc()
        _collected[0] = time.monotonic()
    trim_engine(df.sparkSession)


def trim_engine(spark: SparkSession) -> None:
    """Has the driver's JVM hand back what its native code has freed: compilers, codecs and threads leave memory in pieces that the allocator would keep, beside the heap. Nothing where it has no such command (before Java 17.0.9, or without glibc)."""
    jvm = spark._jvm
    args = spark.sparkContext._gateway.new_array(jvm.Object, 4)
    args[0], args[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
    # by reflection, as the server's own class isn't open to Py4J
    invoke = next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")
    with contextlib.suppress(Py4JJavaError):
        invoke.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), args)


def durable(df: DataFrame, part_rows: int | None = None) -> DataFrame:
    """The rows, checkpointed in the shared folder: computed once, and safe when an executor is lost.

    part_rows: read them in parts of about so many rows, four at least. A short table in as
    many parts as the shuffles have costs a file for each part in every later shuffle.
    """
    shared_dir(df.sparkSession)
    with _own_shuffles(df) as rows:
        out = rows.checkpoint(eager=True)
    path = out._jdf.queryExecution().logical().rdd().getCheckpointFile()
    out = out if part_rows is None else out.coalesce(parts_for(out.count(), part_rows))
    out.held_in = path.get() if path.isDefined() else None
    return out


def parts_for(rows: int, part_rows: int) -> int:
    return max(4, -(-rows // part_rows))


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written as a Parquet table in the shared folder and read again. For wide rows: it is compressed."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    with _own_shuffles(df) as rows:
        rows.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.held_in = path
    return out


def release(*done: DataFrame) -> None:
    """Deletes the files of what ``durable`` or ``stored`` returned. Nothing made from it may be computed any more."""
    for df in done:
        if df.held_in is not None:
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.held_in)
            path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def batched(df: DataFrame) -> DataFrame:
    """The rows, with the session's Arrow batches cut to BATCH_ROWS: a batch of texts is held several times over, by the engine and by numpy."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name, "10000")) <= BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))
    return df


def place(columns: list[str], name: str) -> int:
    """Where a column is: the one so named, else one alike but for case."""
    return columns.index(name) if name in columns else [c.lower() for c in columns].index(name.lower())


def named(docs: DataFrame, **wanted: str) -> DataFrame:
    """The wanted columns under new names, cast to nothing yet. Columns that differ by case, or hold dots, don't get in the way."""
    flat = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return flat.select(*[F.col(f"c{place(docs.columns, old)}").alias(new) for new, old in wanted.items()])


def keyed(docs: DataFrame, key: str, text: str, **more: str) -> DataFrame:
    """(doc_id long, text string, ...) of the documents, in batches for Python."""
    return batched(named(docs, doc_id=key, text=text, **more)).withColumns({"doc_id": F.col("doc_id").cast("long"), "text": F.col("text").cast("string")})


def hand_back() -> None:
    """Gives memory that is free in this process back to the machine; it would be kept beside the engine's."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def trimmed(run: Callable) -> Callable:
    """A function of batches that hands freed memory back when its task ends, as workers live on."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            hand_back()

    return whole


def shuffle_width(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def word_count(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


# ---------------------------------------------------------------- numpy over Arrow strings

_MASK = (1 << 64) - 1


def _random_table(seed: int, n: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


#: Random odd 64-bit values of the 256 bytes, and the odd base of the rolling hash.
BYTE_VALUES = _random_table(20240611, 256)
BASE = np.uint64(0x9E3779B97F4A7C15)
WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_POWERS = np.ones(1, dtype=np.uint64)


def powers(n: int) -> np.ndarray:
    """BASE ** 0 .. BASE ** (n - 1), modulo 2 ** 64."""
    global _POWERS
    if len(_POWERS) < n:
        p = np.full(1 << max(12, (n - 1).bit_length()), BASE, dtype=np.uint64)
        p[0] = 1
        _POWERS = np.multiply.accumulate(p)
    return _POWERS[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(text: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets of the rows in them) of consecutive rows; null reads as empty."""
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    text = text.cast(pa.large_string()).fill_null("")
    n = len(text)
    offsets = np.frombuffer(text.buffers()[1], dtype=np.int64)[text.offset : text.offset + n + 1]
    data = np.frombuffer(text.buffers()[2] or b"", dtype=np.uint8)
    i = 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + SLICE_BYTES, side="right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def runs(member: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True that cross no row boundary."""
    if not len(member):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    first = member.copy()
    first[1:] &= ~member[:-1]
    inner = offsets[(offsets > 0) & (offsets < len(member))]
    first[inner] = member[inner]
    last = member.copy()
    last[:-1] &= ~member[1:]
    last[inner - 1] = member[inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each run: a polynomial in BASE over random byte values, then mixed."""
    if not len(starts):
        return np.empty(0, np.uint64)
    lengths = ends - starts
    total = int(lengths.sum())
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    at = np.arange(total) + shift
    value = BYTE_VALUES[data[at]] * powers(int(lengths.max()))[at - np.repeat(starts, lengths)]
    sums = np.add.reduceat(value, np.concatenate(([0], np.cumsum(lengths)[:-1])))
    return mix(sums + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def row_of(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The row in which each position lies."""
    return np.searchsorted(offsets, starts, side="right") - 1


def window_hashes(words: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Rolling hashes of the n-word windows that lie within one row, and the index of each window's first word."""
    m = len(words) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    h = words[:m].copy()
    for j in range(1, n):
        h *= BASE
        h += words[j : j + m]
    at = np.flatnonzero(rows[:m] == rows[n - 1 :])
    return mix(h[at]), at


def sum_by_row(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, weights=values, minlength=n).astype(np.int64)
