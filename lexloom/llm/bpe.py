"""Byte-pair encoding and decoding by an automaton over tokens.

The merges are compiled in order, each as one gadget. At first there is one state with an
arc for every byte. Merging u and v adds the arc uv wherever u and then v could be taken,
and splits the state after u: the arcs u now lead to its copy, which lacks the arc v. The
automaton that remains after the last merge accepts exactly the token sequences that the
merges produce, so a word has one accepted sequence, and so has each of its prefixes. A
state is stored as the arc it lost; its other arcs are those of the state it was split
from (default arcs), or were laid along them later.

To read bytes, that automaton is determinised over the trie of the tokens' bytes: a state
of the byte automaton holds pairs of a token state and the trie node reached since, and
the token that ends here, of which there is exactly one. Its transition table is filled
by the subset construction as bytes are met, so encoding is one table step a byte, without
going back. The labels of the arcs taken are read off from the last place on. Decoding
emits the arc labels, the tokens' bytes.

A text is cut into words as the vocabulary's pre-tokenizer does. Which characters are
letters, digits and white space is asked of the tokenizers library itself: its Unicode
version differs from Python's.

Defined cases: null is the empty text, of no tokens. Repeated rows give repeated results.
A very long text or word takes time in proportion to its length; a full table is begun
anew. The string of an added token in a text becomes that token, as in the library;
vocabularies whose added tokens strip white space, match whole words or normalised text,
or that make one token by two merges, are refused. Columns other than key and text are not
read.
"""

from __future__ import annotations

import functools
import gc
import hashlib
import json
import pickle
import re
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from lexloom.llm import shared as S

#: Words kept with their tokens in a worker, in each of two generations, and characters above which a word isn't kept.
CACHED_WORDS, CACHED_CHARS = 150_000, 48
#: States of the byte automaton that a worker keeps, and bytes of a word between two looks at their number.
TABLE_STATES, PIECE = 100_000, 4096

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def byte_characters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return [chr(b) if b in set(shown) else chr(256 + hidden.index(b)) for b in range(256)]


class Table(dict):
    """State and byte to the next state, made by ``step`` when it is first asked for."""

    def __init__(self, step):
        super().__init__()
        self.step = step

    def __missing__(self, key: int) -> int:
        after = self[key] = self.step(key >> 8, key & 255)
        return after


class Automaton:
    """The token automaton of a list of merges, and the byte automaton that reads it. Labels are token ids."""

    START = 0

    def __init__(self, vocabulary: dict[str, int], merges: list):
        to_byte = {c: b for b, c in enumerate(byte_characters())}
        self.labels = {i: bytes(to_byte[c] for c in token) for token, i in vocabulary.items()}
        # labels: the gadget each was laid by (-1 for bytes), the label it was laid along, and the state its arcs lead to
        self.born = {i: -1 for i, label in self.labels.items() if len(label) == 1}
        self.left: dict[int, int] = {}
        self.target = dict.fromkeys(self.born, self.START)
        # token states: the label whose arcs lead there and, for each such label, the state that was split first
        self.after = array("l", [-1])
        self.beneath = dict.fromkeys(self.born, self.START)
        self.lost: dict[int, int] = {}  # (label, arc) -> the first state after that label without the arc
        for pair in merges:
            u, v = pair.split(" ") if isinstance(pair, str) else pair
            self.add_gadget(vocabulary[u], vocabulary[v], vocabulary[u + v])
        # the trie of the labels' bytes
        self.child: dict[int, int] = {}
        self.ends = array("l", [-1])
        for i in self.born:
            node = 0
            for byte in self.labels[i]:
                node = self.child.setdefault(node << 8 | byte, len(self.ends))
                if node == len(self.ends):
                    self.ends.append(-1)
            self.ends[node] = i
        self.inner = bytearray(len(self.ends))  # nodes from which the trie goes on
        for at in self.child:
            self.inner[at >> 8] = 1
        self.clear()

    def add_gadget(self, u: int, v: int, uv: int) -> None:
        """Merge u and v: arcs uv lead where arcs v did, and arcs u to a split of the state after u, which lacks v.

        Where v can't follow u, since an earlier merge always takes one of them, there is nothing to do.
        """
        if u not in self.born or v not in self.born or not self.arc(self.target[u], v):
            return
        if uv in self.born:
            raise ValueError(f"token {uv} is made by two merges")
        state = len(self.after)  # each gadget splits one state, so a state's number is its gadget's and one more
        self.born[uv], self.left[uv] = state - 1, u
        self.target[uv] = self.beneath[uv] = self.target[v]
        self.after.append(u)
        self.lost[u << 32 | v] = state
        self.target[u] = state

    def arc(self, state: int, label: int) -> bool:
        """Whether a token state has an arc. The start has all."""
        while state != self.START:
            after, at, last = self.after[state], label, state
            while True:
                first = self.lost.get(after << 32 | at)
                if first is not None and first <= last:
                    return False
                laid = self.born[at]
                if laid < 0:
                    break
                # the arc lies along its left part's, as that was in the states there were then
                last, at = min(last, laid + 1), self.left[at]
            state = self.beneath[after]
        return True

    def clear(self) -> None:
        """Empties the byte automaton but for its first state: no bytes, no token."""
        self.table = Table(self.step)
        self.parts = [(-1, 0, self.START)]  # of each state: the token that ends here, then trie nodes and token states
        self.number, self.token = {self.parts[0]: 0}, [-1]

    def step(self, state: int, byte: int) -> int:
        """The state after a byte: the pairs that go on in the trie, and the one of the token that ends here."""
        child, ends, token = self.child.get, self.ends, -1
        after = [token]
        each = iter(self.parts[state])
        next(each)
        for node, taken in zip(each, each):
            node = child(node << 8 | byte)
            if node is not None:
                if self.inner[node]:
                    after += (node, taken)
                if token < 0 and ends[node] >= 0 and (taken == self.START or self.arc(taken, ends[node])):
                    token = ends[node]
        after += (0, self.target[token])
        after[0] = token
        return self._numbered(tuple(after))

    def _numbered(self, state: tuple) -> int:
        made = self.number.get(state)
        if made is None:
            made = self.number[state] = len(self.parts)
            self.parts.append(state)
            self.token.append(state[0])
        return made

    def encode(self, word: bytes) -> list[int]:
        """The accepted tokens of a word, by one step for each byte."""
        state, taken = 0, []
        for i in range(0, len(word), PIECE):
            if len(self.parts) >= TABLE_STATES:
                here = self.parts[state]
                self.clear()
                state = self._numbered(here)
            table, token = self.table, self.token
            taken += [token[state := table[state << 8 | byte]] for byte in word[i : i + PIECE]]
        out, at, labels = [], len(word), self.labels
        while at:
            out.append(taken[at - 1])
            at -= len(labels[out[-1]])
        return out[::-1]


def character_classes(tokenizer) -> dict[str, list]:
    """The letters, digits and white space of the library's pre-tokenizer, as ranges of code points."""
    import regex

    split = tokenizer.pre_tokenizer.pre_tokenize_str
    blocks = [range(a, a + 128) for a in range(0, 0x110000, 128) if not 0xD800 <= a < 0xE000]
    found = {}
    for name, probe, about in (("L", "a", r"\p{L}"), ("N", "1", r"\p{N}"), ("S", "!", r"\s")):
        members = []
        for block in blocks:
            part = regex.findall(about, "".join(map(chr, block)))
            if not part:
                continue
            # white space is what parts two marks; a letter or digit is what joins two of its kind
            pieces = split("".join(f"{probe}{c}{probe}{'!' if probe != '!' else 'a'}" for c in part))
            whole = {at for _, at in pieces}
            for k, c in enumerate(part):
                joined = (4 * k, 4 * k + 3) in whole
                if joined != (name == "S"):
                    members.append(ord(c))
        spans: list[list[int]] = []
        for c in members:
            if spans and c == spans[-1][1] + 1:
                spans[-1][1] = c
            else:
                spans.append([c, c])
        found[name] = spans
    return found


def word_pattern(classes: dict[str, list], below: int = 0x110000) -> re.Pattern:
    """The pre-tokenizer's pattern, for texts whose characters all lie below a code point."""

    def part(spans: list) -> str:
        inside = [(a, min(b, below - 1)) for a, b in spans if a < below]
        return "".join(f"\\U{a:08x}-\\U{b:08x}" if a < b else f"\\U{a:08x}" for a, b in inside)

    letters, digits, white = part(classes["L"]), part(classes["N"]), part(classes["S"])
    rest = f"[^{white}{letters}{digits}]"
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{digits}]+| ?{rest}+|[{white}]+(?![^{white}])|[{white}]+")


class Codec(dict):
    """Words to the little-endian bytes of their ids, filled as words are met.

    When it is full it becomes the older generation and starts anew; a word met again is
    taken over from there, so frequent words stay.
    """

    def __init__(self, spec: dict):
        super().__init__()
        self.automaton = Automaton(spec["vocabulary"], spec["merges"])
        self.older: dict[str, bytes] = {}
        # a pattern over the first 256 characters is much faster, and does for most texts in Latin letters
        self.any_words, self.latin_words = word_pattern(spec["classes"]).findall, word_pattern(spec["classes"], 256).findall
        self.added = {content: np.uint32(i).astype("<u4").tobytes() for content, i in spec["added"].items()}
        self.parts = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")").split if self.added else None
        size = max([*self.automaton.labels, *spec["added"].values()]) + 1
        self.labels = [b""] * size
        for i, label in self.automaton.labels.items():
            self.labels[i] = label
        for content, i in spec["added"].items():
            self.labels[i] = content.encode()

    def words(self, text: str) -> list[str]:
        """The words of a text, as the vocabulary's pre-tokenizer cuts it."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.any_words(text)
        return self.latin_words(text)

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            tokens = self.automaton.encode(word.encode())
            ids = struct.pack(f"<{len(tokens)}I", *tokens)
        if len(word) <= CACHED_CHARS:
            if len(self) >= CACHED_WORDS:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        if not self.added or not any(x in text for x in self.added):
            return b"".join(map(self.__getitem__, self.words(text)))
        out = []
        for part in self.parts(text):
            out.append(self.added[part] if part in self.added else b"".join(map(self.__getitem__, self.words(part))))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        at = np.frombuffer(ids, dtype="<u4").tolist()
        return b"".join(map(self.labels.__getitem__, at)).decode("utf-8", "replace")


def codec_spec(path: str) -> dict:
    """What a worker needs to build the codec of a byte-level BPE file of the tokenizers library. Its size is the vocabulary's."""
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        content = f.read()
    described = json.loads(content)
    model, pre = described["model"], described["pre_tokenizer"]
    plain = pre["type"] == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"] and not described["normalizer"] and not model.get("ignore_merges")
    if model["type"] != "BPE" or not plain:
        raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
    if any(t[flag] for t in described["added_tokens"] for flag in ("lstrip", "rstrip", "single_word", "normalized")):
        raise ValueError(f"{path} has added tokens that match more than their string")
    return {
        "vocabulary": model["vocab"],
        "merges": model["merges"],
        "added": {t["content"]: t["id"] for t in described["added_tokens"]},
        "classes": character_classes(Tokenizer.from_str(content)),
    }


@functools.lru_cache(maxsize=4)
def packed_spec(path: str) -> bytes:
    """The description, packed: the driver and the engine hold a megabyte for it, not the tables."""
    packed = zlib.compress(pickle.dumps(codec_spec(path)))
    gc.collect()
    S.hand_back()
    return packed


_CODECS: dict[int, Codec] = {}


def _codec(shared) -> Codec:
    """The worker's codec of a broadcast description, built once."""
    if shared.id not in _CODECS:
        _CODECS.clear()
        _CODECS[shared.id] = Codec(pickle.loads(zlib.decompress(shared.value)))
    return _CODECS[shared.id]


class _Shared:
    """A broadcast with a number of its own, so that a reused worker knows what it has built."""

    def __init__(self, spark: SparkSession, value):
        self.broadcast = spark.sparkContext.broadcast(value)
        self.id = hash((spark.sparkContext.applicationId, id(self.broadcast), self.broadcast._path))

    @property
    def value(self):
        return self.broadcast.value


def encode_decode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids binary, decoded string) of every text; ids are little-endian unsigned 32-bit integers."""
    shared = _Shared(docs.sparkSession, packed_spec(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared)
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                ids = [codec.encode(t or "") for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary()), pa.array(map(codec.decode, ids), pa.string())], ["doc_id", "ids", "decoded"])

    return S.keyed(docs, key, text).mapInArrow(S.trimmed(run), "doc_id long, ids binary, decoded string")


def digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Numbers and checksums of what ``encode_decode`` gives, without sending the texts back."""
    shared = _Shared(docs.sparkSession, packed_spec(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared)
        for batch in batches:
            counts, sums, decoded = [], [], []
            for value in batch.column(1):
                ids = codec.encode(value.as_py() or "")
                counts.append(len(ids) // 4)
                sums.append(hashlib.sha256(ids).hexdigest())
                decoded.append(hashlib.sha256(codec.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(sums, pa.string()), pa.array(decoded, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return S.keyed(docs, key, text).mapInArrow(S.trimmed(run), SCHEMA)
