import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lexloom.llm import rans

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("n,kinds", [(1, 1), (2, 2), (1023, 1), (1024, 5), (1025, 900), (70_001, 40_000), (300_000, 3), (600_000, 49_000)])
def test_round_trip(n, kinds):
    rng = np.random.default_rng(n)
    ids = (kinds * rng.random(n) ** 3).astype(np.uint32)
    lengths = [1, n - 1] if n > 1 else [1]
    keys = [None, 5][: len(lengths)]
    content = rans.write_file(keys, lengths, ids)
    got_keys, got_lengths, got = rans.read_file(content)
    assert got_keys == keys and got_lengths.tolist() == lengths and (got == ids).all()
    if kinds == 3:
        assert len(content) < n / 3  # under 1.5 bits an id, with its states


def test_either_half_of_a_block_alone():
    ids = np.random.default_rng(1).integers(0, 50, 5000)
    freq = rans.scaled(np.bincount(ids, minlength=50)).astype(np.uint64)
    start = np.concatenate(([0], np.cumsum(freq)[:-1])).astype(np.uint64)
    slots = np.repeat(np.arange(50, dtype=np.uint32), freq.astype(np.int64))
    data = memoryview(rans.encode_block(ids, freq, start))
    halves = [rans.decode_block(data, 0, slots, freq, start, h)[0] for h in (0, 1)]
    assert all(map(len, halves)) and (np.concatenate(halves) == ids).all()


def test_damage_is_found():
    content = bytearray(rans.write_file([1], [5000], np.random.default_rng(2).integers(0, 300, 5000).astype(np.uint32)))
    content[-900] ^= 4
    with pytest.raises(ValueError):
        rans.read_file(bytes(content))


def test_against_the_library(spark, monkeypatch):
    library = Tokenizer.from_file(PATH)
    rng = random.Random(4)
    marks = ["word", "É", "é", "x's", "<|endoftext|>", "\x1c", "\u0085", " ", "Σ", "İ", "日本", "'ll", "12", "‍", "́"]
    texts = [None, "", " \n", "a", "<|startoftext|>x", "w " * 100_000]
    texts += ["".join(rng.choice(marks) + rng.choice(["", " ", "\n", "\t\x0b\x0c\r"]) for _ in range(rng.randint(1, 60))) for _ in range(300)]
    letters = "abcdeEOTn.,!'éÉßöÑ" + "".join(map(chr, range(0xC0, 0x180)))
    texts += ["".join(rng.choice(letters + "     ") for _ in range(80)) for _ in range(300)]
    rows = [(rng.randrange(-500, 500), t, "x") for t in texts] + [(None, "null key", "y"), (None, None, "y")]
    rows += rows[5:9]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string")
    got = [tuple(r) for r in rans.read_tokens(spark, rans.write_tokens(docs, PATH, 1), with_ids=True).collect()]
    got.sort(key=lambda r: r[1])
    at = 0
    for _, start, n, crc, ids in got:
        assert start == at and len(ids) == 4 * n and zlib.crc32(ids) == crc
        at += n
    keys = [r[0] for r in got]
    assert keys == sorted([k for k, _, _ in rows if k is not None]) + [None, None]
    want = sorted((str(k), np.array(library.encode(t or "", add_special_tokens=False).ids + [1], "<u4").tobytes()) for k, t, _ in rows)
    assert sorted((str(r[0]), bytes(r[4])) for r in got) == want


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert rans.read_tokens(spark, rans.write_tokens(empty, PATH, 1)).count() == 0
