import random
import textwrap

import pytest

from lexloom.llm.licenses import NOTICE_WORDS, TEMPLATES, Scanner, scan_licenses, wording

NOISE = "thble ingred and of the onthe erwh nting to"


def brute(text):
    """Notices whose words stand one after another in a line, found without compression."""
    found = set()
    for line in (text or "").split("\n"):
        words = wording(line)
        for name, texts in TEMPLATES.items():
            for t in map(wording, texts):
                if len(t) <= NOTICE_WORDS and any(words[i : i + len(t)] == t for i in range(len(words))):
                    found.add(name)
    return found


def test_every_template_is_found_as_itself():
    scanner = Scanner()
    for name, texts in TEMPLATES.items():
        for text in texts:
            _, found = scanner.scan(f"{NOISE}\n{text}\n{NOISE}")
            assert name in {f[0] for f in found}, text
            assert not any(f[4] or f[5] for f in found if f[0] == name)


def test_notices_against_brute_force():
    rng, scanner = random.Random(2), Scanner()
    notices = [t for texts in TEMPLATES.values() for t in texts if len(wording(t)) <= NOTICE_WORDS]
    near = ["Licensed under the Apache License, Version 1.1.", "This work is licensed under the GNU General Public License, version 4.", "A license to dream.", "no warranty here"]
    for _ in range(150):
        lines = [rng.choice([NOISE, rng.choice(notices), rng.choice(near), rng.choice(notices).upper(), "", f"{NOISE} {rng.choice(notices)}"]) for _ in range(rng.randint(1, 5))]
        text = f"\n{NOISE}\n".join(lines)
        assert {f[0] for f in scanner.scan(text)[1]} == brute(text), text


def test_differences_are_reported():
    text = TEMPLATES["ISC"][2].replace("this software for any purpose", "this fine software for any purpose").replace("LOSS OF USE", "USE")
    ((name, _, _, _, missing, added),) = Scanner().scan(text)[1]
    assert name == "ISC" and missing == ["loss", "of"] and added == ["fine"]


PARTED = {
    "MIT": ["The above copyright", "THE SOFTWARE IS PROVIDED"],
    "ISC": ["THE SOFTWARE IS PROVIDED"],
    "BSD-2-Clause": ["Redistributions of source", "Redistributions in binary", "THIS SOFTWARE IS"],
    "BSD-3-Clause": ["Redistributions of source", "Redistributions in binary", "Neither the name", "THIS SOFTWARE IS"],
    "Apache-2.0": ["You may obtain", "http://", "Unless required"],
    "GPL-2.0": ["either version"],
    "GPL-3.0": ["either version"],
    "MPL-2.0": ["If a copy"],
    "LGPL-2.1": ["either version"],
    "LGPL-3.0": ["either version"],
    "AGPL-3.0": ["either version"],
    "Unlicense": ["Anyone is free"],
    "Zlib": ["Permission is granted", "1. The origin", "2. Altered", "3. This notice"],
    "BSL-1.0": ["to use, reproduce"],
}
#: Without these words the text of one license is that of another, or none that speaks of a license.
TELLING = {"lesser", "affero", "license"}


@pytest.mark.parametrize("mark", ["", "# ", " * ", "// "])
def test_long_texts_in_paragraphs(mark):
    scanner, long = Scanner(), {name: t for name, texts in TEMPLATES.items() for t in texts if len(wording(t)) > NOTICE_WORDS}
    assert set(long) == set(PARTED)
    for name, text in long.items():
        text = " ".join(text.split())
        for begin in PARTED[name]:
            assert f" {begin}" in text
            text = text.replace(f" {begin}", f"\n\n{begin}", 1)
        lines = [line for part in text.split("\n") for line in textwrap.wrap(part, 70) or [""]]
        n, found = scanner.scan("\n".join([NOISE, "", *[f"{mark}{line}".rstrip() for line in lines], "", NOISE]))
        assert n == 1 and [(f[0], f[4], f[5]) for f in found] == [(name, [], [])], name


def prose(n, seed=3):
    rng = random.Random(seed)
    return [rng.choice(["the", "of", "and", "to", "in"]) if rng.random() < 0.4 else "".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(3, 9))) for _ in range(n)]


@pytest.mark.parametrize("n", [10, 30, 80, 1000, 20_000])
def test_long_lines_hide_nothing(n):
    words, scanner = prose(n), Scanner()
    for name, texts in TEMPLATES.items():
        for text in texts:
            line = " ".join([*words[: n // 2], text, *words[n // 2 :]])
            assert [(f[0], f[4], f[5]) for f in scanner.scan(line)[1]] == [(name, [], [])], text


def test_any_number_of_notices():
    scanner, apache = Scanner(), TEMPLATES["Apache-2.0"][2]
    every = [(name, t) for name, texts in TEMPLATES.items() for t in texts]
    for sep in ("\n", " ", "\n\n"):
        assert sorted(f[0] for f in scanner.scan(sep.join(t for _, t in every))[1]) == sorted(name for name, _ in every)
        for text in (apache, apache.replace("governing", "that govern"), apache.replace("this file", "these files")):
            found = sorted(scanner.scan(sep.join([text] * 9))[1], key=lambda f: f[2])
            assert [f[0] for f in found] == ["Apache-2.0"] * 9
            assert all(a[3] < b[2] for a, b in zip(found, found[1:]))


def test_notices_over_line_ends():
    scanner = Scanner()
    for name, texts in TEMPLATES.items():
        for text in texts:
            assert [f[0] for f in scanner.scan("\n".join([NOISE, *text.split(), NOISE]))[1]] == [name], text


def test_changed_long_texts_in_prose():
    rng, scanner, words = random.Random(4), Scanner(), prose(400)
    for name, texts in TEMPLATES.items():
        for text in texts:
            said = text.split()
            if len(wording(text)) <= NOTICE_WORDS:
                continue
            fixed = [i for i, w in enumerate(said) if not any(c.isdigit() for c in w) and w.strip(",.").lower() not in TELLING]
            for _ in range(8):
                gone = set(rng.sample(fixed, len(said) // 12))
                new = [x for i, w in enumerate(said) if i not in gone for x in ([w, f"new{i}x"] if rng.random() < 0.1 else [w])]
                found = scanner.scan(" ".join(words[:200] + new + words[200:]))[1]
                assert [f[0] for f in found] == [name] and len(found[0][4]) <= len(gone), text
                at = next((i for i, w in enumerate(said) if any(c.isdigit() for c in w)), None)
                if at is not None:
                    assert not scanner.scan(" ".join(words[:200] + said[:at] + ["9.9"] + said[at + 1 :] + words[200:]))[1]


def test_rows(spark):
    mit = "Released under the MIT License."
    rows = [(1, f"é\U0001f600\n{mit}\nx", "a"), (2, None, "a"), (3, "", "a"), (None, mit, "a"), (4, "word " * 200_000 + "\n" + mit, "a"), (5, "copyright nobody", "a"), (1, f"é\U0001f600\n{mit}\nx", "a")]
    got = [r.asDict() for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string, licenses string")).collect()]
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    start = 3
    assert by[1]["spans"] == f"MIT:{start}:{start + len(mit)}" and by[1]["exact"]
    assert by[4]["licenses"] == by[None]["licenses"] == "MIT"
    assert by[5]["n_blocks"] == 1 and by[5]["licenses"] == "" and not by[5]["exact"]
    assert by[2]["n_blocks"] == by[3]["n_blocks"] == 0


@pytest.mark.parametrize("schema", ["doc_id long, text string"])
def test_empty_table(spark, schema):
    assert scan_licenses(spark.createDataFrame([], schema)).count() == 0


@pytest.mark.parametrize("around", [0, 6, 100, 20_000])
def test_every_template_is_found_inside_a_line(around):
    scanner, words = Scanner(), " ".join(f"w{i}" for i in range(around))
    for name, texts in TEMPLATES.items():
        for text in texts:
            found = scanner.scan(f"{words} {text} {words}")[1]
            assert [f[0] for f in found] == [name], (name, text[:40], [f[0] for f in found])


def test_many_repeats_take_little_time():
    import time

    scanner, began = Scanner(), time.process_time()
    assert len(scanner.scan("Released under the MIT License. " * 8000)[1]) == 8000
    assert scanner.scan("license " * 20_000)[1] == []
    assert time.process_time() - began < 4


def test_blocks_are_cut_then_ranked_then_confirmed(monkeypatch):
    mit, far = "Released under the MIT License.", " ".join(prose(20_000, 5))
    scanner, seen = Scanner(), []
    monkeypatch.setattr(scanner, "scan_words", lambda words: seen.append(len(words)) or Scanner.scan_words(scanner, words))
    n, found = scanner.scan(f"{far} {mit} {far} {mit} {far}")
    assert n == 1 and [f[0] for f in found] == ["MIT", "MIT"]
    assert len(seen) == 2 and all(k <= 2 * scanner.reach + 5 for k in seen)  # not the whole line
    text = "\n".join(t for texts in TEMPLATES.values() for t in texts)
    assert Scanner().scan(text)[1]
    ranking = Scanner()
    monkeypatch.setattr(ranking, "saved", lambda words, template: (0, 0.0))
    assert ranking.scan(text)[1] == []  # what compression doesn't rank isn't confirmed
    cutting = Scanner()
    monkeypatch.setattr(cutting, "blocks", lambda text: iter(()))
    assert cutting.scan(text) == (0, [])
