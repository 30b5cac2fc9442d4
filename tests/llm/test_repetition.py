import random
import re
from collections import Counter

from lexloom.llm.repetition import NGRAM_LIMITS, repetition_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    covered = {}
    for n in NGRAM_LIMITS:
        grams = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
        count = Counter(grams)
        covered[n] = {i + j for i, g in enumerate(grams) if count[g] > 1 for j in range(n)}
    out = {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered[5]),
    }
    out |= {f"dup{n}_chars": sum(len(words[i]) for i in c) for n, c in covered.items()}
    out["base_failed"] = out["n_words"] < 10 or 100 * out["n_repeat_words"] > 20 * out["n_words"]
    return out


def texts():
    rng = random.Random(5)
    vocabulary = ["a", "bé", "çü", "x#", "y|", "zz", "日本", "\U0001f600"]
    made = [None, "", " \n\t", "one", "a b c d e f g h i j", "\x0b\x0ca\r\nb"]
    for n in (3, 9, 10, 40, 300):
        made += ["".join(rng.choice(vocabulary) + rng.choice([" ", "  ", "\n", "\t"]) for _ in range(n)) for _ in range(8)]
    made.append("long " * 300_000)
    made.append(" ".join(str(i) for i in range(200_000)))
    return made + made[:8]


def test_against_brute_force(spark):
    rows = [(i, t, "junk") for i, t in enumerate(texts())] + [(None, "a b", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words string")
    got = sorted((r.asDict() for r in repetition_rules(docs).collect()), key=lambda r: (r["doc_id"] is None, r["doc_id"]))
    assert len(got) == len(rows)
    for (_, text, _), row in zip(rows, got):
        want = brute(text)
        assert {k: row[k] for k in want} == want
        assert not (row["base_failed"] and row["kept"])


def test_verdicts(spark):
    clean = " ".join(f"word{i}" for i in range(60))
    cases = [(1, clean), (2, "spam and eggs again here now " * 10), (3, "### a$ b& " * 4 + clean), (4, "few words")]
    cases += [(5, "one two three four\nfive six seven eight nine ten\none two three four"), (6, clean + "\nhere again" * 40)]
    got = {r.doc_id: r.kept for r in repetition_rules(spark.createDataFrame(cases, "doc_id long, text string")).collect()}
    assert got == {1: True, 2: False, 3: False, 4: False, 5: True, 6: False}


def test_empty_table(spark):
    assert repetition_rules(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_names_that_differ_by_case_or_hold_dots(spark):
    docs = spark.createDataFrame([(1, "a b", "c", 2)], "doc_id long, text string, `a.b` string, TEXT int")
    assert [r.n_words for r in repetition_rules(docs).collect()] == [2]
