"""Language identification by hierarchical discrimination.

A text's features are the hashed byte trigrams of its lower-cased letters, square roots of
their counts, scaled to unit length. One-versus-rest linear support vector machines choose
the language family; inside it one-versus-one machines part each two languages, and the
language with most duels won is chosen. The machines are trained by dual coordinate
descent on a sample that is even over languages: on the driver, or by the executors where
there are more than DRIVER_MACHINES.

The sample is the only bound: all languages are learned, from about SAMPLE training texts
that are drawn by a hash of the id and the text, or LEAST_TEXTS of each language where that
is more; if chance or repeated rows give twice as many, the first by that hash are taken.
Every text is read whole and classified.

Defined cases: a null text and one without a letter are "und" with score 0. Texts whose
language is null, or whose crc32 of the id is 2 modulo 4, teach nothing; a null id counts
as the empty string there. With no training texts at all every text is "und". Ties go to
the language first in code-point order. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.llm import shared as S

SAMPLE, LEAST_TEXTS = 6000, 64
#: Machines up to which the driver fits them itself.
DRIVER_MACHINES = 64
WIDTH = 2048
COST, EPOCHS = 4.0, 12
UNKNOWN = "und"
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double, family string"

# Families of language codes. A code that isn't here is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "celtic": "ga gd cy br",
    "baltic": "lt lv",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz",
    "indic": "hi bn ur mr ne pa gu",
    "semitic": "ar he am mt",
    "sinitic": "zh yue",
}

_FOLD = np.full(256, 0x20, dtype=np.uint8)
_FOLD[0x80:] = np.arange(0x80, 0x100)
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_ASCII_LETTER = np.zeros(256, dtype=bool)
_ASCII_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


def family_of(lang: str) -> str:
    code = lang.lower().replace("_", "-").split("-")[0]
    return next((f for f, codes in FAMILIES.items() if code in codes.split()), code)


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of features for each text of a slice."""
    n = len(offsets) - 1
    b = _FOLD[data].astype(np.uint32)
    # capitals of the second Latin block: the byte after C3 moves up by 32, the multiplication sign doesn't
    capital = np.flatnonzero((data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97) & (data[:-1] == 0xC3)) + 1
    b[capital] += 0x20
    out = np.zeros((n, WIDTH), dtype=np.float32)
    if len(b) >= 3:
        h = (b[:-2] * np.uint32(0x01000193) + b[1:-1] * np.uint32(0x9E3779B1) + b[2:] * np.uint32(0x85EBCA6B)) * np.uint32(0xC2B2AE35)
        rows = np.repeat(np.arange(n), np.diff(offsets))
        whole = (rows[:-2] == rows[2:]) & ~((b[:-2] == 0x20) & (b[1:-1] == 0x20))
        at = rows[:-2][whole] * WIDTH + (h[whole] >> np.uint32(32 - WIDTH.bit_length() + 1))
        out = np.sqrt(np.bincount(at, minlength=n * WIDTH).reshape(n, WIDTH)).astype(np.float32)
    return out / np.maximum(np.sqrt((out * out).sum(axis=1, keepdims=True)), 1e-9)


def has_letter(texts: pa.Array, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(_ASCII_LETTER[data])))
    found = sums[offsets[1:]] > sums[offsets[:-1]]
    for i in np.flatnonzero(~found):
        text = texts[int(i)].as_py()
        found[i] = text is not None and any(c.isalpha() for c in text)
    return found


def svm(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights and bias (last) of a linear machine for labels +1 and -1, by dual coordinate descent on squared hinge loss."""
    w, b, alpha = np.zeros(x.shape[1]), 0.0, np.zeros(len(x))
    share = {s: COST * len(y) / (2 * max(1, (y == s).sum())) for s in (1, -1)}  # both sides weigh alike
    damp = np.array([0.5 / share[int(s)] for s in y])
    scale = np.einsum("ij,ij->i", x, x) + 1 + damp  # the bias is the weight of a feature that is always 1
    order = np.random.Generator(np.random.PCG64(1))
    for _ in range(EPOCHS):
        for i in order.permutation(len(x)):
            g = y[i] * (w @ x[i] + b) - 1 + damp[i] * alpha[i]
            new = max(0.0, alpha[i] - g / scale[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w += step * x[i]
                b += step
                alpha[i] = new
    return np.append(w, b)


def fitted(spark: SparkSession, machine: Callable, total: int, *sample: np.ndarray) -> list[np.ndarray]:
    """The machines 0 .. total - 1 of a sample, fitted by the executors."""
    shared = spark.sparkContext.broadcast(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([machine(k, *shared.value).tobytes()])], ["k", "w"])

    parts = min(total, 4 * max(spark.sparkContext.defaultParallelism, 1))
    found = spark.range(0, total, 1, parts).mapInArrow(run, "k long, w binary").toArrow().to_pylist()
    shared.unpersist()
    by = {r["k"]: np.frombuffer(r["w"], dtype=np.float64) for r in found}
    return [by[k] for k in range(total)]


class Model:
    """Machines for families, and for each two languages of a family."""

    def __init__(self, x: np.ndarray, langs: list[str], spark: SparkSession | None = None):
        self.langs = sorted(set(langs))
        langs_ = np.array(langs)
        of = np.array([family_of(lang) for lang in langs])
        self.families = sorted(set(of))
        self.members = {f: [lang for lang in self.langs if family_of(lang) == f] for f in self.families}
        two = len(self.families) == 2
        families = self.families[: 1 if two else None] if len(self.families) > 1 else []
        pairs = [(a, b) for members in self.members.values() for i, a in enumerate(members) for b in members[i + 1 :]]

        def machine(k: int, x: np.ndarray, langs_: np.ndarray, of: np.ndarray) -> np.ndarray:
            if k < len(families):
                return svm(x, np.where(of == families[k], 1, -1))
            a, b = pairs[k - len(families)]
            some = (langs_ == a) | (langs_ == b)
            return svm(x[some], np.where(langs_[some] == a, 1, -1))

        total = len(families) + len(pairs)
        if spark is None or total <= DRIVER_MACHINES:
            machines = [machine(k, x, langs_, of) for k in range(total)]
        else:
            machines = fitted(spark, machine, total, x, langs_, of)
        self.by_family, self.duels = machines[: len(families)], dict(zip(pairs, machines[len(families) :]))
        if two:
            self.by_family.append(-self.by_family[0])

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray, list[str], np.ndarray]:
        """(languages, scores in 0 .. 1, families, certainties in 0 .. 1) of rows of features.

        A certainty is the chance of the family against the next one times that of the language
        against the one it does worst against, so it doesn't fall with the number of languages.
        """
        margin = lambda w, rows: rows @ w[:-1].astype(np.float32) + w[-1]
        n = len(x)
        if self.by_family:
            margins = np.stack([margin(w, x) for w in self.by_family], axis=1)
            best = margins.argmax(axis=1)
            odds = np.exp(2 * (margins - margins.max(axis=1, keepdims=True)))
            score = 1 / odds.sum(axis=1)
            certain = 1 / (1 + np.partition(odds, -2, axis=1)[:, -2])
        else:
            best, score, certain = np.zeros(n, dtype=np.int64), np.ones(n), np.ones(n)
        langs, families = np.empty(n, dtype=object), np.array(self.families, dtype=object)[best]
        for k, f in enumerate(self.families):
            rows, members = np.flatnonzero(best == k), self.members[f]
            wins, sure = np.zeros((len(rows), len(members))), np.zeros((len(rows), len(members)))
            worst = np.ones((len(rows), len(members)))
            for i, a in enumerate(members):
                for j in range(i + 1, len(members)):
                    p = 1 / (1 + np.exp(-4 * np.clip(margin(self.duels[a, members[j]], x[rows]), -20, 20)))
                    wins[:, i] += p >= 0.5
                    wins[:, j] += p < 0.5
                    sure[:, i] += p
                    sure[:, j] += 1 - p
                    worst[:, i] = np.minimum(worst[:, i], p)
                    worst[:, j] = np.minimum(worst[:, j], 1 - p)
            chosen = (wins + sure / (len(members) + 1)).argmax(axis=1) if len(rows) else np.zeros(0, dtype=np.int64)
            langs[rows] = np.array(members, dtype=object)[chosen]
            certain[rows] *= worst[np.arange(len(rows)), chosen]
            if len(members) > 1:
                score[rows] *= sure[np.arange(len(rows)), chosen] / (len(members) - 1)
        return langs.tolist(), np.clip(score, 0, 1), families.tolist(), np.clip(certain, 0, 1)


def held_out(key: Column) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def train(docs: DataFrame, key: str, text: str, lang: str) -> Model | None:
    """A model from a sample of the texts that aren't held out."""
    known = S.named(docs, k=key, text=text, lang=lang).withColumns({"text": F.col("text").cast("string"), "lang": F.col("lang").cast("string")})
    known = known.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("k")))
    counts = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()  # one row for each language
    if not counts:
        return None
    quota = max(SAMPLE / len(counts), LEAST_TEXTS)
    share = F.create_map(*[F.lit(v) for r in counts for v in (r["lang"], min(1.0, quota / r["count"]))])
    dice = F.xxhash64(F.coalesce(F.col("k").cast("string"), F.lit("")), "text")
    drawn = F.pmod(dice, F.lit(1 << 24)) < share[F.col("lang")] * (1 << 24)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in S.slices(batch.column(1)):
                x = features(data, offsets)
                ok = has_letter(batch.column(1).slice(i, j - i), data, offsets)
                made = pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array([r.tobytes() for r in x], pa.binary()), batch.column(2).slice(i, j - i)], ["lang", "x", "dice"])
                yield made.filter(pa.array(ok))

    # an expected SAMPLE rows of 8 KB, or LEAST_TEXTS for each language, and at most twice as many, whatever the data
    chosen = known.filter(F.coalesce(drawn, F.lit(False))).select("lang", "text", dice.alias("dice")).mapInArrow(S.trimmed(run), "lang string, x binary, dice long")
    sample = chosen.orderBy(F.pmod("dice", F.lit(1 << 24)), "dice", "lang").limit(int(2 * quota * len(counts))).select("lang", "x").toArrow().combine_chunks()
    if not sample.num_rows:
        return None
    langs, cells = sample.column("lang").to_pylist(), sample.column("x").chunk(0)
    # read in place: as objects the rows would be held several times over
    x = np.frombuffer(cells.buffers()[2], dtype=np.float32)[: len(langs) * WIDTH].reshape(-1, WIDTH)
    order = sorted(range(len(langs)), key=lambda i: (langs[i], zlib.crc32(x[i]), i))
    x, langs = x[order], [langs[i] for i in order]
    del sample, cells, order  # the rows are held once while the machines are fitted
    model = Model(x, langs, docs.sparkSession)
    del x
    S.hand_back()
    return model


def classify(batches: Iterator[pa.RecordBatch], model: Model | None, at: int) -> Iterator[tuple[pa.RecordBatch, list, np.ndarray, list, np.ndarray]]:
    """Each part of the batches with its texts' languages, scores, families and certainties; at: the texts' column."""
    for batch in batches:
        for i, j, data, offsets in S.slices(batch.column(at)):
            part = batch.slice(i, j - i)
            ok = has_letter(part.column(at), data, offsets)
            if model is None:
                langs, score, families, certain = [UNKNOWN] * len(ok), np.zeros(len(ok)), [None] * len(ok), np.zeros(len(ok))
            else:
                langs, score, families, certain = model.predict(features(data, offsets))
                langs = [x if y else UNKNOWN for x, y in zip(langs, ok)]
                families = [x if y else None for x, y in zip(families, ok)]
                score = np.where(ok, score, 0.0)
            yield part, langs, score, families, certain


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score, family) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, key, text, lang))  # a few vectors for each pair of languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, langs, score, families, _ in classify(batches, shared.value, 2):
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(langs, pa.string()), pa.array(score), pa.array(families, pa.string())], [f.split()[0] for f in SCHEMA.split(", ")])

    rows = S.keyed(docs, key, text, raw=key).select("doc_id", held_out(F.col("raw")).alias("held_out"), "text")
    return rows.mapInArrow(S.trimmed(run), SCHEMA)


def keep_identified(docs: DataFrame, least: float, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The documents, as they are, whose language is known with a certainty of at least ``least``."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, key, text, lang))
    at = S.place(S.batched(docs).columns, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, langs, _, _, certain in classify(batches, shared.value, at):
            yield part.filter(pa.array([x != UNKNOWN and c >= least for x, c in zip(langs, certain)], pa.bool_()))

    return docs.mapInArrow(S.trimmed(run), docs.schema)
