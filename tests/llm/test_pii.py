import hashlib
import random
import re

from lexloom.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def brute(text):
    found = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub(r"[^0-9]", "", m.group())
            ok = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")), "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                found.append(f"{kind}:{m.start()}:{m.end()}")
    return found


def texts():
    rng = random.Random(9)
    made = [None, "", "plain words only", "a@b.c", "a@b.cd_x@y.z@k.l", "\x01a@b.c\x01", "1.2.3.4.5.6.7.8", "256.1.1.1 001.002.3.0255", "4111 1111 1111 1111", "4111-1111-1111-1112", "+49 (30) 123-45-67.", "+1+1 +1 23456789 x +", "é@x.y \U0001f600a@b.c 4000000000000002"]
    made += ["9" * 50_000, "a" * 50_000 + "@", "x@" + "b.c" * 9_000, "a@b.c " * 1500, "1.2.3.4 " * 1100, "+" * 5000, "+1" + " " * 20_000]
    pieces = ["a", "b9", "@", ".", "-", "+", " ", "12", "4", "(", ")", "%", "_", "255", "\x01", "é", "\n", "0000", "@x.com "]
    for _ in range(400):
        made.append("".join(rng.choice(pieces) for _ in range(rng.randint(1, 60))))
    return made


def test_base_spans_against_brute_force(spark):
    rows = [(i, t, "x") for i, t in enumerate(texts())] + [(None, "a@b.c", "y"), (3, "a@b.c", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, c string")
    got = sorted((r.asDict() for r in pii.digest(docs).collect()), key=lambda r: (r["doc_id"] is None, r["doc_id"]))
    want = sorted(rows, key=lambda r: (r[0] is None, r[0]))
    assert len(got) == len(rows)
    for (_, text, _), row in zip(want, got):
        spans = brute(text)
        assert row["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest(), text
        assert [row[f"n_{k}"] for k in pii.BASE] == [sum(s.startswith(k + ":") for s in spans) for k in pii.BASE]
        assert set(spans) <= set(row["spans"].split(",")) | {""}


def test_added_spans(spark):
    secret, local = "0a1b2c3d" * 5, "call me: (217) 555-0199 now"
    cases = {1: f'see token = "{secret}" there', 2: local, 3: "just words, 12 of them", 4: f"commit {'abcdef00' * 5} merged", 5: "+1 (217) 555-0199"}
    rows = [(k + 10 * i, v) for i in range(30) for k, v in cases.items()]
    got = {r.doc_id: r.spans for r in pii.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == f"secret:13:{13 + len(secret)}"
    assert got[2] == "phone:9:23"
    assert got[3] == "" and got[4] == ""
    assert got[5] == "phone:0:17"


def test_only_functions_of_the_engine(spark):
    docs = spark.createDataFrame([(1, "a@b.c")], "doc_id long, text string")
    plan = pii.scan(docs, "doc_id", "text")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table(spark):
    assert pii.digest(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_the_classifier_outweighs_a_single_vote(spark):
    """A masked address with an ending no gazetteer knows, among many that have one."""
    rows = [(i, f"mail to user{i} [at] firm [dot] com please") for i in range(60)] + [(100, "mail to jane [at] firm [dot] pl please"), (101, "in order to reach us: 217 555 0199 today")]
    rows += [(200 + i, f"phone: 217 555 01{i:02} today") for i in range(40)]
    got = {r.doc_id: r.spans for r in pii.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0].startswith("email:8:") and got[100] == "email:8:31"
    assert got[101] == "phone:22:34"


def test_long_candidates_are_seen(spark):
    rows = [(i, "token: " + "0a1b2c3d" * 5) for i in range(30)] + [(50, "see " + "ab" * 300 + " there"), (51, "mail " + "x" * 80 + " [at] firm [dot] com now")] + [(60 + i, f"mail to user{i} [at] firm [dot] com please") for i in range(30)]
    got = {r.doc_id: r.spans for r in pii.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[50] == "" and got[51] == "email:5:105" and got[0] == "secret:7:47"


def test_masking_leaves_other_columns_alone(spark):
    rows = [(1, "write a@b.com now", 17, "x", "up"), (None, None, None, "y", "up"), (2, "no", 2, None, "up")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, `a.b` string, TEXTS string")
    got = sorted(map(tuple, pii.mask_spans(docs).collect()), key=str)
    assert got == sorted([(1, "write <email> now", 17, "x", "up"), (None, None, None, "y", "up"), (2, "no", 2, None, "up")], key=str)
