import math
import random
import zlib

import numpy as np
import pytest

from lexloom.llm import langid

WORDS = {
    "en": "the of and to in is that for it was thing another where shall",
    "de": "der die und in den von zu das mit sich über für größe straße",
    "fr": "le la et les des en un du une que élève où être français",
    "es": "el los y de que la en las por un año señor mañana español",
}


def rows(n, seed=1):
    rng = random.Random(seed)
    made = []
    for i in range(n):
        lang = rng.choice(list(WORDS))
        made.append((i, " ".join(rng.choice(WORDS[lang].split()) for _ in range(rng.randint(8, 60))).capitalize(), lang, "s", 1.0))
    return made


SCHEMA = "doc_id long, text string, lang string, source string, score double"


def test_held_out_accuracy(spark):
    data = rows(600)
    got = {r.doc_id: r for r in langid.identify(spark.createDataFrame(data, SCHEMA)).collect()}
    assert len(got) == 600
    out = [(got[k], lang) for k, _, lang, *_ in data if zlib.crc32(str(k).encode()) % 4 == 2]
    assert {r.doc_id for r, _ in out} == {k for k, r in got.items() if r.held_out}
    assert sum(r.lang_pred == lang for r, lang in out) >= 0.97 * len(out)
    assert all(0 <= r.score <= 1 and r.family == langid.family_of(r.lang_pred) for r in got.values())


def test_learns_only_from_what_it_may(spark):
    # held-out documents carry wrong languages, and a language that only they have
    data = [(k, t, "xx" if zlib.crc32(str(k).encode()) % 4 == 2 else lang, s, x) for k, t, lang, s, x in rows(400)]
    got = langid.identify(spark.createDataFrame(data, SCHEMA)).collect()
    assert {r.lang_pred for r in got} == set(WORDS)
    moved = [(k, t, lang if zlib.crc32(str(k).encode()) % 4 != 2 else None, "other", None) for k, t, lang, *_ in rows(400)]
    assert sorted(map(str, langid.identify(spark.createDataFrame(moved, SCHEMA)).collect())) == sorted(map(str, got))


def test_odd_rows(spark):
    odd = [(1000, None, "en"), (1001, "", "en"), (1002, "12 !? 34", "fr"), (None, "the of and to in", "en"), (1004, "the of and " * 100_000, None), (1005, "é", None), (1006, "日本", None)]
    data = rows(200) + [(k, t, lang, None, None) for k, t, lang in odd] + rows(200)[:5]
    got = langid.identify(spark.createDataFrame(data, SCHEMA)).collect()
    assert len(got) == len(data)
    by = {r.doc_id: r for r in got}
    assert [by[k].lang_pred for k in (1000, 1001, 1002)] == ["und"] * 3 and by[1000].score == 0
    assert by[None].lang_pred == by[1004].lang_pred == "en"
    assert all(by[k].lang_pred in WORDS for k in (1005, 1006))
    kept = langid.keep_identified(spark.createDataFrame(data, SCHEMA), 0.3)
    assert kept.columns == ["doc_id", "text", "lang", "source", "score"]
    left = {r.doc_id for r in kept.collect()}
    assert not left & {1000, 1001, 1002} and set(range(200)) <= left


def test_every_language_is_learned(spark):
    rng = random.Random(5)
    codes = [f"q{a}{b}" for a in "abcdefgh" for b in "abcdefgh"] + ["en", "en-GB", "en-US", "de", "nl", "fr", "es"]
    words = {c: ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(12)] for c in codes}
    data = [(i, " ".join(rng.choice(words[c]) for _ in range(30)), c) for i, c in enumerate(codes * 14 + codes[:50] * 3)]
    got = {r.doc_id: r for r in langid.identify(spark.createDataFrame(data, "doc_id long, text string, lang string")).collect()}
    assert len(codes) > 64 and {r.lang_pred for r in got.values()} == set(codes)
    assert all(got[k].lang_pred == c for k, _, c in data)


def test_certainty_does_not_fall_with_the_number_of_families():
    model = langid.Model.__new__(langid.Model)
    for n in (3, 40, 400):
        model.langs = model.families = [f"q{i:03}" for i in range(n)]
        model.members, model.duels = {f: [f] for f in model.families}, {}
        bias = [1.0] + [0.0] * (n - 1)  # the best family is ahead of all others by 1
        model.by_family = [np.append(np.zeros(langid.WIDTH), b) for b in bias]
        langs, _, _, certain = model.predict(np.zeros((1, langid.WIDTH), dtype=np.float32))
        assert langs == ["q000"] and abs(certain[0] - 1 / (1 + np.exp(-2))) < 1e-9


@pytest.mark.parametrize("data", [[], [(2, "the of", None, "s", 1.0)], rows(30)[:1]])
def test_little_to_learn_from(spark, data):
    got = langid.identify(spark.createDataFrame(data, SCHEMA)).collect()
    assert len(got) == len(data)


def plain_prediction(model, row):
    """One text's language and score by loops over the machines, as the docstring says."""
    value = lambda w: sum(float(a) * float(b) for a, b in zip(row, w[:-1])) + float(w[-1])
    margins = [value(w) for w in model.by_family] or [0.0]
    family = model.families[max(range(len(margins)), key=lambda k: (margins[k], -k))]
    score = 1 / sum(math.exp(2 * (m - max(margins))) for m in margins)
    members = model.members[family]
    wins, sure = dict.fromkeys(members, 0), dict.fromkeys(members, 0.0)
    for (a, b), w in model.duels.items():
        if a in wins:
            p = 1 / (1 + math.exp(-4 * max(-20.0, min(20.0, value(w)))))
            wins[a if p >= 0.5 else b] += 1
            sure[a] += p
            sure[b] += 1 - p
    best = max(members, key=lambda m: (wins[m] + sure[m] / (len(members) + 1), [-ord(c) for c in m]))
    return best, score * (sure[best] / (len(members) - 1) if len(members) > 1 else 1)


def test_predictions_against_plain_loops():
    rng = np.random.default_rng(4)
    langs = ["en", "de", "nl", "fr", "es", "ru"] * 12
    x = rng.random((len(langs), langid.WIDTH)).astype(np.float32) * (rng.random((len(langs), langid.WIDTH)) < 0.05)
    x[np.arange(len(langs)), [hash_ for hash_ in (sorted(set(langs)).index(v) * 7 for v in langs)]] += 2
    model = langid.Model(x, langs)
    got_langs, scores, _, _ = model.predict(x)
    for i in range(len(langs)):
        want, score = plain_prediction(model, x[i])
        assert got_langs[i] == want and abs(scores[i] - score) < 1e-3


def test_machines_against_a_plain_solver(monkeypatch):
    """The least of ||w||^2 / 2 + sum of C * hinge^2, reached by gradient steps, is what the dual descent reaches."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(60, 8)).astype(np.float32)
    y = np.where(x[:, 0] + 0.3 * rng.normal(size=60) > 0.4, 1, -1)
    cost = np.array([langid.COST * len(y) / (2 * (y == v).sum()) for v in y])
    ones = np.hstack([x, np.ones((len(x), 1))])
    goal = lambda w: 0.5 * w @ w + (cost * np.maximum(0, 1 - y * (ones @ w)) ** 2).sum()
    w, step = np.zeros(9), 1 / (1 + 2 * (cost[:, None] * ones * ones).sum())
    for _ in range(20_000):
        w -= step * (w - 2 * ones.T @ (cost * y * np.maximum(0, 1 - y * (ones @ w))))
    monkeypatch.setattr(langid, "EPOCHS", 3000)
    assert goal(langid.svm(x, y)) <= goal(w) * 1.01


def test_repeated_rows_stay_within_the_sample(spark, monkeypatch):
    """Many rows with one id and one text are drawn together, but no more than twice the sample."""
    monkeypatch.setattr(langid, "SAMPLE", 40)
    monkeypatch.setattr(langid, "LEAST_TEXTS", 10)
    rows = [(None, "the cat sat on the mat and looked at the moon", "en")] * 3000 + [(i, f"der Hund lief durch den Wald und sah {i} Rehe", "de") for i in range(50)]
    seen = []
    monkeypatch.setattr(langid, "Model", lambda x, langs, spark: seen.append(len(langs)))
    langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), "doc_id", "text", "lang")
    assert seen and seen[0] <= 80
