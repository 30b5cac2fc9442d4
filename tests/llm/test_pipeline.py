import hashlib
import importlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lexloom.llm import mixing, pii

corpus_pipeline = pytest.importorskip("corpus_pipeline")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
WORDS = {"en": "the of and to in is that for it was thing", "fr": "le la et les des en un du une que élève"}


def corpus():
    rng = random.Random(6)
    made = []
    for i in range(240):
        lang = rng.choice(list(WORDS))
        made.append((i, " ".join(rng.choice(WORDS[lang].split()) + rng.choice(["", str(rng.randrange(9))]) for _ in range(rng.randint(12, 90))), lang, f"s{i % 4}"))
    made[7] = (7, made[7][1] + " mail me@example.com or 1.2.3.4", *made[7][2:])
    made += [(300 + i, made[i][1], *made[i][2:]) for i in range(6)]  # exact copies
    made += [(400, None, "en", "s1"), (401, "", "en", "s1"), (402, "12 34", "en", None), (None, "the of and to in is that for", "en", None), (9, made[9][1], *made[9][2:])]
    return [(k, t, lang, s, None if t is None else len(t), "x") for k, t, lang, s in made]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA)


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_copies", "personal_data", "mixture", "tokens"]
    assert importlib.import_module("__spark_entry__").queries()["pipeline"] is corpus_pipeline.run


def test_language_stage(spark, docs):
    out = corpus_pipeline.language(spark, docs, "")
    assert out.columns == docs.columns
    rows = out.collect()
    assert sorted(map(tuple, rows), key=str) == sorted((r for r in corpus() if r[0] not in (400, 401, 402)), key=str)


def test_near_copies_stage(spark, docs):
    out = corpus_pipeline.near_copies(spark, docs, "")
    assert out.columns == docs.columns
    ids = [r.doc_id for r in out.collect()]
    assert sorted(map(str, ids)) == sorted(str(r[0]) for r in corpus()[:-1] if r[0] is None or not 300 <= r[0] < 306)


def test_near_copies_from_four_fifths_on(spark):
    rng = random.Random(8)
    base = [f"w{rng.randrange(900)}" for _ in range(200)]
    texts = [base, base[:170], base[:150], [*base[:100], "new", *base[101:]], [*base[:50], "new", *base[51:100], "new", *base[101:150], "new", *base[151:]]]
    texts.append([f"x{i}" if i % 25 == 0 else w for i, w in enumerate(base)])  # 8 words changed: 156 of 236 shingles
    docs = spark.createDataFrame([(i, " ".join(t), "en", "s", 1, "x") for i, t in enumerate(texts)], SCHEMA)
    assert sorted(r.doc_id for r in corpus_pipeline.near_copies(spark, docs, "").collect()) == [0, 5]


def test_near_copies_of_rows_that_share_an_id(spark):
    rng = random.Random(9)
    a, b, c, d = ([f"w{rng.randrange(9000)}" for _ in range(100)] for _ in range(4))
    rows = [(1, a), (2, a[:98]), (2, b), (3, b[:98]), (3, c), (3, c[:98]), (3, c), (4, d), (4, d[:98]), (5, d[1:]), (4, a[1:]), (6, b[1:]), (7, []), (7, []), (None, c)]
    docs = spark.createDataFrame([(k, " ".join(t), "en", "s", 1, "x") for k, t in rows], SCHEMA)
    got = corpus_pipeline.near_copies(spark, docs, "")
    assert got.columns == docs.columns
    first = {a[2]: "a", b[2]: "b", c[2]: "c", d[2]: "d"}
    kept = sorted(((r.doc_id, next((first[w] for w in r.text.split() if w in first), "")) for r in got.collect()), key=str)
    assert kept == sorted([(1, "a"), (2, "b"), (3, "c"), (4, "d"), (7, ""), (7, ""), (None, "c")], key=str)


def test_personal_data_stage(spark, docs):
    rows = {}
    out = corpus_pipeline.personal_data(spark, docs, "")
    assert out.columns == docs.columns
    got = out.collect()
    assert len(got) == docs.count()
    for r in got:
        rows.setdefault(r.doc_id, r)
        assert (r.text is None and r.n_chars is None) or r.n_chars == len(r.text)
    assert rows[7].text.endswith(" mail <email> or <ip>")
    assert {k: r.text for k, r in rows.items() if k != 7} == {k: t for k, t, *_ in corpus() if k != 7}


def test_masks_lie_where_the_spans_are(spark):
    texts = ["a@b.c", "\U0001f600 a@b.c, 1.2.3.4\x01+1 (217) 555-0199!", "none", "a@b.c" * 3, "x@1.2.3.4 y"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = {r.doc_id: sorted((x["s"], -x["e"], x["kind"]) for x in r.found) for r in pii.find_spans(docs).collect()}
    for r in pii.mask_spans(docs).collect():
        at, want = 0, ""
        for s, e, kind in spans[r.doc_id]:
            if s >= at:
                want += texts[r.doc_id][at:s] + f"<{kind}>"
                at = -e
        assert r.text == want + texts[r.doc_id][at:]


def test_mixture_stage(spark, docs):
    out = corpus_pipeline.mixture(spark, docs, "")
    assert out.columns == docs.columns
    rows = out.collect()
    size = lambda t: len(WORD.findall(t or ""))
    whole = {}
    for k, t, _, s, *_ in corpus():
        whole.setdefault((k, s), set()).add(t)
    taken = {}
    for r in rows:
        taken[r.source] = taken.get(r.source, 0) + size(r.text)
        assert any(t is not None and t.startswith(r.text) for t in whole[r.doc_id, r.source]) and r.n_chars == len(r.text) and r.text
    want = {}
    for r in mixing.mix_sources(docs).collect():
        want[r.source] = want.get(r.source, 0) + r.taken
    assert taken == {k: v for k, v in want.items() if v}


def test_tokens_stage(spark, docs):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = sorted(((r.doc_id, r.ids_sha256) for r in corpus_pipeline.tokens(spark, docs, "").collect()), key=str)
    want = [(k, hashlib.sha256(np.array(library.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes()).hexdigest()) for k, t, *_ in corpus()]
    assert got == sorted(want, key=str)


def test_whole_run(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ids = {r.doc_id for r in got}
    assert got and not ids & {300, 301, 400, 401, 402}


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        assert docs.count() == 0
