import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lexloom.llm import bpe
from lexloom.llm.bpe import Automaton, Codec, byte_characters, codec_spec, digests, encode_decode

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def codec():
    return Codec(codec_spec(PATH))


def texts():
    rng = random.Random(3)
    made = [None, "", " ", "\n\n  a", "it's we'll I'd 'S", "a  b   c \n", "tail  ", "<|endoftext|>", " x<|endoftext|> <|endoftext|>y", "<|endoftext", "\x1c\x1d a\u0085b c", "é̀ ﻿"]
    made += ["a" * 3000, "ab" * 900, " " * 500 + "x", "\n" * 77, "=" * 400, "0123456789" * 40, "日本語" * 90]
    alphabets = ["abcdefgh etaoin", "eeaatthh \n", "日本語テキスト 한국 ", "0123 .,;:!?'\"-", "àéîõü ß", "\U0001f600\U0001f1e9 x", "tionering "]
    for _ in range(400):
        made.append("".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randint(1, 90))))
    for _ in range(100):
        made.append("".join(chr(c) for c in (rng.randrange(0x3000) for _ in range(60))))
    for _ in range(50):
        made.append("".join(chr(c) for c in (rng.randrange(0x110000) for _ in range(60)) if not 0xD800 <= c < 0xE000))
    return made


def test_same_ids_as_the_library(library, codec):
    for text in texts():
        got = np.frombuffer(codec.encode(text or ""), "<u4").tolist()
        want = library.encode(text or "", add_special_tokens=False).ids
        assert got == want, text
        assert codec.decode(codec.encode(text or "")) == library.decode(want, skip_special_tokens=False)


def test_every_character_is_split_as_in_the_library(library, codec):
    characters = [chr(c) for c in [*range(0xD800), *range(0xE000, 0x110000)]]
    for i in range(0, len(characters), 20000):
        for around in ("a{}a!", "1{}1!", "!{}!a"):
            text = "".join(around.format(c) for c in characters[i : i + 20000])
            want = [text[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(text)]
            assert codec.words(text) == want


def test_query_rows(spark, library):
    rows = [(i, t, 7) for i, t in enumerate(texts()[:60])] + [(None, "x", 1), (3, "it's", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = sorted(map(tuple, digests(docs, PATH).collect()), key=str)
    want = []
    for key, text, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((key, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert {r.decoded for r in encode_decode(docs, PATH).collect()} >= {t or "" for t in texts()[:7]}


def test_empty_table(spark):
    assert digests(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def merged(word, merges):
    """Plain BPE: the earliest merge there is, leftmost first, until there is none."""
    parts = list(word)
    while True:
        known = [(merges.index((a, b)), i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if (a, b) in merges]
        if not known:
            return parts
        _, i = min(known)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def small_vocabulary(rng, n):
    letters = [c for c in byte_characters() if c in "abc"]
    tokens, merges = list(byte_characters()), []
    while len(merges) < n:
        pair = tuple(rng.choice(letters + [a + b for a, b in merges]) for _ in range(2))
        if "".join(pair) not in tokens:
            merges.append(pair)
            tokens.append("".join(pair))
    return {t: i for i, t in enumerate(tokens)}, merges


def test_automaton_of_small_vocabularies_against_plain_merging():
    rng = random.Random(5)
    for n in (1, 3, 8, 20, 40):
        vocabulary, merges = small_vocabulary(rng, n)
        automaton = Automaton(vocabulary, merges)
        for _ in range(300):
            word = "".join(rng.choice("aabc") for _ in range(rng.randint(1, 30)))
            assert automaton.encode(word.encode()) == [vocabulary[t] for t in merged(word, merges)], (merges, word)


def test_arcs_are_those_of_gadgets_made_in_full():
    """The stored splits against states that hold all their arcs, changed merge by merge."""
    rng = random.Random(6)
    vocabulary, merges = small_vocabulary(rng, 25)
    automaton = Automaton(vocabulary, merges)
    states, target = [set(range(256))], dict.fromkeys(range(256), 0)
    for a, b in merges:
        u, v, uv = vocabulary[a], vocabulary[b], vocabulary[a + b]
        if u not in target or v not in states[target[u]]:
            continue
        states.append(states[target[u]] - {v})
        target[uv], target[u] = target[v], len(states) - 1
        for arcs in states:
            if u in arcs:
                arcs.add(uv)
    for state, arcs in enumerate(states):
        assert {label for label in target if automaton.arc(state, label)} == arcs
    assert automaton.target == target


def test_each_byte_takes_one_step_of_the_table(codec, monkeypatch):
    automaton = Automaton(codec_spec(PATH)["vocabulary"], codec_spec(PATH)["merges"])

    class Counting(bpe.Table):
        asked = 0

        def __getitem__(self, key):
            Counting.asked += 1
            return super().__getitem__(key)

    monkeypatch.setattr(bpe, "Table", Counting)
    automaton.clear()
    for word in (b" understanding", b"aaaaaaaaaaaa", "caf\u00e9".encode(), b"x" * 9000):
        Counting.asked = 0
        first = automaton.encode(word)
        assert Counting.asked == len(word) and automaton.encode(word) == first


def test_a_full_table_is_begun_anew(codec, library, monkeypatch):
    monkeypatch.setattr(bpe, "TABLE_STATES", 50)
    monkeypatch.setattr(bpe, "PIECE", 7)
    fresh = Codec(codec_spec(PATH))
    for text in texts()[:150]:
        assert np.frombuffer(fresh.encode(text or ""), "<u4").tolist() == library.encode(text or "", add_special_tokens=False).ids


def test_very_long_texts(codec, library):
    text = "the storm passed over the bay " * 20_000 + "z" * 200_000
    assert np.frombuffer(codec.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert codec.decode(codec.encode(text)) == text


def test_a_merge_that_can_never_happen_changes_nothing():
    merges = [("a", "b"), ("b", "c"), ("ab", "c"), ("a", "bc")]
    vocabulary = {c: i for i, c in enumerate(byte_characters())} | {"ab": 256, "bc": 257, "abc": 258}
    automaton = Automaton(vocabulary, merges)
    for word in ("abc", "aabcbc", "bcabc", "abbcc"):
        assert automaton.encode(word.encode()) == [vocabulary[t] for t in merged(word, merges)]
