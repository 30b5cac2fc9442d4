"""Token ids in binary files, packed by a static range asymmetric numeral system.

Documents are range-partitioned and sorted by id, encoded with the tokenizers library, and
written as files of whole documents. A file has one table of symbol frequencies, shared by
its blocks. A block codes a run of ids over interleaved lanes, each a 64-bit state that
sheds 32-bit words; it is independent of other blocks. Half way through it a checkpoint
holds all lane states and the place in the words, so two workers can decode one block.
Each block carries a crc32 of its ids.

A file is one row's ``content``; rows go through Spark's Parquet writer and its committer,
since the shared folder may be a store that only Spark reaches. Where a document starts in
the whole sequence is the running total of the files before it plus its place in its file.

File layout, little-endian: magic, then u32 counts of documents, ids, symbols and blocks;
document ids (i64) and null flags (u8), lengths (u64), symbols (u32), their frequencies
(u32, adding up to 2 ** PRECISION); and the blocks: u32 ids, lanes, words, checkpoint step,
checkpoint word, crc32, then first states (u64), checkpoint states (u64), words (u32).

Defined cases: null is the empty text, of the end id alone. Documents go by ascending id,
null ids last; equal ids by hash of text, then text. Columns other than key and text are
not read. An empty table gives no files and no rows.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexloom.llm import shared as S
from lexloom.llm.bpe import byte_characters

MAGIC = b"LXRANS01"
PRECISION = 20
LANES, BLOCK_IDS, FILE_IDS = 1024, 1 << 18, 1 << 22
LOW = np.uint64(1 << 31)
FILE_SCHEMA = "part int, file int, n_docs long, n_ids long, content binary"
#: Parts whose running totals are added up in one group.
GROUP = 1024
#: Text chunks kept with their ids in a worker, and bytes above which a chunk isn't kept.
CACHED_CHUNKS, CACHED_BYTES = 600_000, 64


def scaled(counts: np.ndarray) -> np.ndarray:
    """Frequencies of at least 1 that add up to 2 ** PRECISION, in proportion to the counts."""
    total = 1 << PRECISION
    if len(counts) > total:
        raise ValueError("more symbols than the precision has room for")
    spare = total - len(counts)
    f = 1 + (counts.astype(np.float64) * (spare / counts.sum())).astype(np.int64)
    f[np.argmax(f)] += total - f.sum()
    return f


def encode_block(symbols: np.ndarray, freq: np.ndarray, start: np.ndarray) -> bytes:
    """One block of symbol numbers (not ids)."""
    n = len(symbols)
    lanes = min(LANES, n)
    steps = -(-n // lanes)
    middle = steps // 2
    x = np.full(lanes, LOW, dtype=np.uint64)
    shed, at_middle, after = [], x, 0
    shift, limit_shift, word = np.uint64(PRECISION), np.uint64(63 - PRECISION), np.uint64(0xFFFFFFFF)
    for t in range(steps - 1, -1, -1):
        part = symbols[t * lanes : (t + 1) * lanes]
        f, y = freq[part], x[: len(part)]
        full = y >= f << limit_shift
        shed.append((y[full] & word).astype("<u4"))
        y = np.where(full, y >> np.uint64(32), y)
        q = y // f
        x[: len(part)] = (q << shift) + (y - q * f) + start[part]
        if t == middle:
            at_middle, after = x.copy(), sum(map(len, shed))
    words = np.concatenate(shed[::-1])
    head = struct.pack("<5I", n, lanes, len(words), middle, len(words) - after)
    return head + x.astype("<u8").tobytes() + at_middle.astype("<u8").tobytes() + words.tobytes()


def decode_span(x: np.ndarray, words: np.ndarray, n: int, lanes: int, first: int, last: int, slots, freq, start) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of steps first .. last - 1 and the states after, from the lane states before them and the words from there on."""
    out, at, mask, shift = [], 0, np.uint64((1 << PRECISION) - 1), np.uint64(PRECISION)
    x = x.copy()
    for t in range(first, last):
        y = x[: min(lanes, n - t * lanes)]
        slot = y & mask
        s = slots[slot]
        out.append(s)
        z = freq[s] * (y >> shift) + slot - start[s]
        short = np.flatnonzero(z < LOW)
        z[short] = z[short] << np.uint64(32) | words[at : at + len(short)].astype(np.uint64)
        at += len(short)
        x[: len(z)] = z
    return np.concatenate(out) if out else np.empty(0, slots.dtype), x


def decode_block(data: memoryview, at: int, slots, freq, start, half: int | None = None) -> tuple[np.ndarray, int]:
    """The symbols of the block at an offset, and the offset after it. half: 0 or 1 for what lies before or after the checkpoint."""
    n, lanes, n_words, middle, middle_word = struct.unpack_from("<5I", data, at)
    at += 20
    states = np.frombuffer(data, "<u8", 2 * lanes, at)
    words = np.frombuffer(data, "<u4", n_words, at + 16 * lanes)
    steps = -(-n // lanes)
    spans = []
    if half in (None, 0):
        span, end = decode_span(states[:lanes], words[:middle_word], n, lanes, 0, middle, slots, freq, start)
        if (end != states[lanes:]).any():
            raise ValueError("a block's lanes don't reach its checkpoint")
        spans.append(span)
    if half in (None, 1):
        span, end = decode_span(states[lanes:], words[middle_word:], n, lanes, middle, steps, slots, freq, start)
        if (end != LOW).any():
            raise ValueError("a block's lanes don't end where coding began")
        spans.append(span)
    return np.concatenate(spans), at + 16 * lanes + 4 * n_words


def write_file(keys: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    tally = np.bincount(ids)
    symbols = np.flatnonzero(tally)
    number_of = np.zeros(len(tally), dtype=np.uint32)
    number_of[symbols] = np.arange(len(symbols), dtype=np.uint32)
    numbers = number_of[ids]
    freq = scaled(tally[symbols]).astype(np.uint64)
    start = np.concatenate(([0], np.cumsum(freq)[:-1])).astype(np.uint64)
    blocks = []
    for i in range(0, len(ids), BLOCK_IDS):
        blocks.append(struct.pack("<I", zlib.crc32(ids[i : i + BLOCK_IDS].astype("<u4").tobytes())) + encode_block(numbers[i : i + BLOCK_IDS], freq, start))
    head = MAGIC + struct.pack("<4I", len(keys), len(ids), len(symbols), len(blocks))
    known = np.array([k or 0 for k in keys], "<i8").tobytes() + np.array([k is None for k in keys], "u1").tobytes()
    return b"".join([head, known, np.array(lengths, "<u8").tobytes(), symbols.astype("<u4").tobytes(), freq.astype("<u4").tobytes(), *blocks])


def read_file(content: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(document ids, lengths, all ids). A wrong checksum is an error."""
    data = memoryview(content)
    if bytes(data[:8]) != MAGIC:
        raise ValueError("not a token file")
    n_docs, n_ids, n_symbols, n_blocks = struct.unpack_from("<4I", data, 8)
    at = 24
    keys = np.frombuffer(data, "<i8", n_docs, at)
    null = np.frombuffer(data, "u1", n_docs, at + 8 * n_docs)
    at += 9 * n_docs
    lengths = np.frombuffer(data, "<u8", n_docs, at).astype(np.int64)
    at += 8 * n_docs
    symbols = np.frombuffer(data, "<u4", n_symbols, at)
    freq = np.frombuffer(data, "<u4", n_symbols, at + 4 * n_symbols).astype(np.uint64)
    at += 8 * n_symbols
    start = np.concatenate(([0], np.cumsum(freq)[:-1])).astype(np.uint64)
    slots = np.repeat(np.arange(n_symbols, dtype=np.uint32), freq.astype(np.int64))
    parts = []
    for _ in range(n_blocks):
        (crc,) = struct.unpack_from("<I", data, at)
        numbers, at = decode_block(data, at + 4, slots, freq, start)
        part = symbols[numbers]
        if zlib.crc32(part.astype("<u4").tobytes()) != crc:
            raise ValueError("a block's checksum doesn't match its ids")
        parts.append(part)
    ids = np.concatenate(parts) if parts else np.empty(0, np.uint32)
    if len(ids) != n_ids:
        raise ValueError("a file's ids don't add up")
    return [None if z else int(k) for k, z in zip(keys, null)], lengths, ids


class Encoder(dict):
    """Chunks between ASCII white space to the bytes of their ids; each chunk is encoded by the library.

    The vocabulary drops white space, and neither its normalizer nor its splitting looks
    across a blank, so a text's ids are those of its chunks, one after another. Punctuation
    after letters is split off by the vocabulary too, and letters are lowered one by one;
    so a chunk of common Latin letters, which no normal form changes, goes straight to the
    library's merge model, in the byte-level characters that model works on.
    """

    # Latin letters up to U+017F without U+0130, whose lower case is two characters; punctuation without the apostrophe
    PLAIN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]+)([!-&(-/:-@\\[-`{-~]*)").fullmatch

    def __init__(self, content: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(content)
        self.library.no_truncation()
        self.library.no_padding()
        self.merge = self.library.model.tokenize
        self.shown = {b: ord(c) for b, c in enumerate(byte_characters())}

    def __missing__(self, chunk: bytes) -> bytes:
        text = chunk.decode()
        plain = self.PLAIN(text)
        if plain is None:
            ids = np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        else:
            word, marks = plain.groups()
            lower = word.lower().encode()
            if marks or lower != chunk:
                ids = self[lower] + (self[marks.encode()] if marks else b"")
            else:
                tokens = self.merge(chunk.decode("latin-1").translate(self.shown))
                ids = struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens])
        if len(chunk) <= CACHED_BYTES:
            if len(self) >= CACHED_CHUNKS:
                self.clear()
            self[chunk] = ids
        return ids

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.encode().split()))


def _check_vocabulary(content: str) -> None:
    import json

    described = json.loads(content)
    kinds = [x["type"] for x in (described["normalizer"] or {}).get("normalizers", [])]
    splits = (described["pre_tokenizer"] or {}).get("pretokenizers", [])
    drops = bool(splits) and splits[0]["type"] == "Split" and splits[0]["behavior"] == "Removed" and splits[0]["invert"] and not splits[-1].get("add_prefix_space")
    letters = drops and r"[\p{L}]+" in splits[0]["pattern"].get("Regex", "") and splits[-1]["type"] == "ByteLevel"
    if kinds != ["NFC", "Replace", "Lowercase"] or not letters:
        raise ValueError("this vocabulary may look across white space or not split letters off; its texts can't be encoded in chunks")


_ENCODERS: dict[int, Encoder] = {}


def write_tokens(docs: DataFrame, path: str, end_id: int, key: str = "doc_id", text: str = "text") -> str:
    """Write the files of all documents; returns the folder."""
    spark = docs.sparkSession
    with open(path, encoding="utf-8") as f:
        content = f.read()
    _check_vocabulary(content)
    vocabulary = spark.sparkContext.broadcast(content)  # as large as the vocabulary, whatever the data
    number = zlib.crc32(content.encode())
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if number not in _ENCODERS:
            _ENCODERS.clear()
            _ENCODERS[number] = Encoder(vocabulary.value)
        encoder, part, file = _ENCODERS[number], TaskContext.get().partitionId(), 0
        keys, parts, total = [], [], 0

        def flush() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(parts), "<u4")
            packed = write_file(keys, [len(p) // 4 for p in parts], ids)
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "file": pa.array([file], pa.int32()), "n_docs": [len(keys)], "n_ids": [len(ids)], "content": pa.array([packed], pa.binary())})

        for batch in batches:
            for key_, value in zip(batch.column(0), batch.column(1)):
                ids = encoder.encode(value.as_py() or "") + end
                keys.append(key_.as_py())
                parts.append(ids)
                total += len(ids) // 4
                if total >= FILE_IDS:
                    yield flush()
                    keys, parts, total, file = [], [], 0, file + 1
        if keys:
            yield flush()

    rows = S.keyed(docs, key, text)
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text"), F.col("text")]
    ordered = rows.repartitionByRange(S.shuffle_width(spark), *order[:2]).sortWithinPartitions(*order)
    folder = f"{S.shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    ordered.mapInArrow(run, FILE_SCHEMA).write.parquet(folder)
    return folder


def file_starts(files: DataFrame) -> DataFrame:
    """(part, file, before): ids of all files before each one. Totals are added up in groups of parts, then over groups."""
    sized = files.select("part", "file", "n_ids", F.floor(F.col("part") / GROUP).alias("grp"))
    inner = Window.partitionBy("grp").orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)
    groups = sized.groupBy("grp").agg(F.sum("n_ids").alias("ids"))
    outer = Window.orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("grp", F.coalesce(F.sum("ids").over(outer), F.lit(0)).alias("of_groups"))
    within = sized.select("part", "file", "grp", F.coalesce(F.sum("n_ids").over(inner), F.lit(0)).alias("of_files"))
    return within.join(groups, "grp").select("part", "file", (F.col("of_groups") + F.col("of_files")).alias("before"))


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, and ids as bytes if asked for) of every document in the files."""
    files = spark.read.schema(FILE_SCHEMA).parquet(folder)
    names = ["part", "file", "doc_id", "place", "n_tokens", "ids_crc32"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, file, content in zip(*(batch.column(i) for i in range(3))):
                keys, lengths, ids = read_file(content.as_py())
                data = ids.astype("<u4").tobytes()
                ends = np.cumsum(lengths)
                spans = [data[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), lengths.tolist())]
                columns = [pa.array([part.as_py()] * len(keys), pa.int32()), pa.array([file.as_py()] * len(keys), pa.int32()), pa.array(keys, pa.int64()), pa.array(ends - lengths), pa.array(lengths), pa.array(map(zlib.crc32, spans), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(spans, pa.binary())] * with_ids, names)

    schema = "part int, file int, doc_id long, place long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    docs = files.select("part", "file", "content").mapInArrow(run, schema)
    placed = docs.join(file_starts(files), ["part", "file"]).withColumn("start", F.col("before") + F.col("place"))
    return placed.select("doc_id", "start", *names[4:])
