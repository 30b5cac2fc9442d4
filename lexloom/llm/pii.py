"""Personal data by weak supervision, with DataFrame functions only.

One scan marks the matches of each kind's pattern and of a pattern of weaker candidates,
and keeps what lies around them; the narrow rows are written once. On every candidate four
labelers vote yes, no or nothing: the kind's own format check, a gazetteer (top-level
domains, issuers, reserved networks, key names), cue words to the left, and the
characters at both ends. Counts of (kind, votes, features) are grouped; there are at most
6 * 3**4 * 4**3 of them whatever the data, so expectation-maximisation over them runs on
the driver. It estimates each labeler's reliability for each kind and each candidate's
probability, and with these as soft labels a naive Bayes span classifier over features
and votes is fitted in closed form. Its log-odds go back into the plan as a literal map.

Spans that pass a base kind's checks always stay, and matches that fail their kind's format
never come back. The classifier alone decides on weaker candidates that overlap no base
span: local phone numbers, masked e-mail addresses, hexadecimal secrets and social security
numbers.

Offsets are code points, end exclusive. Defined cases: null is the empty text, of no
spans. Repeated rows give repeated results. Columns other than key and text are not read.
With no candidates at all the classifier is its prior.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.llm import shared as S

BASE = ["email", "ip", "card", "phone"]
ADDED = ["secret", "ssn"]
KINDS = BASE + ADDED

# The contract's patterns. A possessive quantifier stands where giving back can't help; it
# also keeps Java's matcher from recursing. A match can only begin at the head of a run of
# its first class, or where the last match ended: starting elsewhere in the run would meet
# the same failure, and would take time quadratic in the run.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Weaker candidates, tried in this order at each place.
WEAKER = {
    "secret": r"(?<![0-9A-Za-z])[0-9A-Fa-f]{32,}+(?![0-9A-Za-z])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": r"(?<![0-9+])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]++(?:\x20?[\[(]dot[\])]\x20?[A-Za-z0-9-]++)++",
}
#: Something each pattern needs, looked for first.
NEEDS = {"email": "@", "phone": "+", "ip": "."}

#: Marks that stand around matches; a text's own are replaced by a character no pattern knows.
MARK, INSTEAD = "\x01", "\x02"
LEFT, RIGHT = 24, 4
#: A weaker candidate is accepted from this probability on.
ACCEPT = 0.8
ROUNDS = 25
#: Before any candidate is seen, a labeler is believed to vote like this on true and on false ones, as if so many of each had been.
LEAN = {1: (0.6, 0.15), 0: (0.3, 0.35), -1: (0.1, 0.5)}
LEAN_CANDIDATES = 20

# The gazetteers and cue words.
DOMAINS = "com|net|org|edu|gov|mil|int|info|biz|io|de|fr|es|uk|it|nl|at|ch|be|eu|us|ca|jp|cn|ru|br|au|mx"
ISSUERS = r"^(4|5[1-5]|2[2-7]|3[47]|6)"
RESERVED = r"^(0|127|255)\."
CALLING = r"^\+?(1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
CUES = {
    "email": "mail|contact|write to|adresse|correo",
    "ip": r"\bip\b|server|host|address|addr|client|adresse",
    "card": "card|visa|master|amex|credit|karte|carte|tarjeta",
    "phone": r"phone|\btel|call|mobil|fax|handy|tél",
    "secret": r"token|secret|passw|api.?key|\bkey\b|credential|bearer",
    "ssn": "ssn|social security|tax id",
}
AGAINST = r"\b(version|isbn|pages?|figure|serial|order (no|number|id)|sha1|sha256|md5|commit|checksum)\b"


def _marked(text: Column, pattern: str) -> Column:
    """Matches with their lengths and surroundings: (n code points, the match or null, its left, its right)."""
    pieces = F.split(F.regexp_replace(text, pattern, f"{MARK}$0{MARK}"), MARK, -1)

    def piece(p: Column, i: Column) -> Column:
        match = i % 2 == 1
        return F.struct(F.length(p).alias("n"), F.when(match, p).alias("m"), F.when(~match, F.right(p, F.lit(LEFT))).alias("tail"), F.when(~match, F.left(p, F.lit(RIGHT))).alias("head"))

    return F.transform(pieces, piece)


def scan(docs: DataFrame, key: str, text: str, carry: bool = False) -> DataFrame:
    """One row for each document: its key, and for each pattern the marked pieces (null where nothing can match).

    carry: instead of the key, the whole row as ``row``, its columns named c0, c1 and so on.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    flat = docs.toDF(*names)
    clean = F.translate(F.coalesce(F.col(names[S.place(docs.columns, text)]).cast("string"), F.lit("")), MARK, INSTEAD)
    head = F.struct(*names).alias("row") if carry else F.col(names[S.place(docs.columns, key)]).cast("long").alias("doc_id")
    rows = flat.select(head, clean.alias("text"))
    first = "row" if carry else "doc_id"
    columns = []
    for kind, pattern in PATTERNS.items():
        value = _marked(F.col("text"), pattern)
        columns.append((F.when(F.contains("text", F.lit(NEEDS[kind])), value) if kind in NEEDS else value).alias(kind))
    any_weaker = "|".join(f"(?:{p})" for p in WEAKER.values())
    columns.append(_marked(F.col("text"), any_weaker).alias("weaker"))
    # pieces without a match say nothing
    some = rows.select(first, *columns)
    return some.select(first, *[F.when(F.size(c) > 1, F.col(c)).alias(c) for c in [*PATTERNS, "weaker"]])


def _placed(column: str) -> Column:
    """The matches of marked pieces as (s, e, m, left, right), in time linear in the pieces but for n/512 squared.

    Starts are running totals: inside blocks of 512 pieces, and over the blocks' sums.
    """
    return F.expr(f"""
      filter(flatten(zip_with(
        transform(sequence(0, cast((size({column}) - 1) div 512 as int)), b -> slice({column}, b * 512 + 1, 513)),
        slice(aggregate(
          transform(sequence(0, cast((size({column}) - 1) div 512 as int)), b -> aggregate(slice({column}, b * 512 + 1, 512), 0, (a, x) -> a + x.n)),
          array(0), (a, x) -> array_append(a, element_at(a, -1) + x)), 1, cast((size({column}) - 1) div 512 as int) + 1),
        (blk, start) -> aggregate(sequence(1, least(512, size(blk))),
          named_struct('at', start, 'left', '', 'out', cast(array() as array<struct<s:int,e:int,m:string,left:string,right:string>>)),
          (a, i) -> named_struct(
            'at', a.at + blk[i - 1].n,
            'left', coalesce(blk[i - 1].tail, ''),
            'out', array_append(a.out, named_struct('s', a.at, 'e', a.at + blk[i - 1].n, 'm', blk[i - 1].m, 'left', a.left, 'right', coalesce(get(blk, i).head, '')))),
          a -> a.out))), x -> x.m is not null)""")


def _passes(kind: str, m: Column) -> Column:
    """The contract's check of a match of a base kind."""
    digits = F.regexp_replace(m, "[^0-9]", "")
    part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
    if kind == "ip":
        return m.rlike(rf"^{part}\.{part}\.{part}\.{part}$")
    if kind == "card":
        # the length first: the sum of a very long run needn't be taken
        return F.when(F.length(digits).between(13, 19), F.call_function("luhn_check", digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0).cast("int")


def _candidate(kind: str, x: Column, base: bool) -> Column:
    """A candidate with its votes v1 .. v4 and features f1 .. f3."""
    m, left, right = x["m"], F.lower(x["left"]), x["right"]
    digits = F.regexp_replace(m, "[^0-9]", "")
    never = F.lit(False)
    if base:
        v1 = _vote(_passes(kind, m), ~_passes(kind, m))
    elif kind == "secret":
        form = F.length(m).isin(32, 40, 48, 56, 64, 96, 128) & m.rlike("[0-9]") & m.rlike("[A-Fa-f]")
        v1 = _vote(never, ~form)  # checksums and commits have the same form
    elif kind == "ssn":
        form = ~m.rlike("^(000|666|9)") & ~m.rlike("-00-") & ~m.rlike("0000$")
        v1 = _vote(form, ~form)
    else:
        v1 = _vote(never, never)
    if kind == "email":
        known = F.lower(m).rlike(rf"[.\])\x20]({DOMAINS})$")
        v2 = _vote(known, ~known)
    elif kind == "ip":
        v2 = _vote(~m.rlike(RESERVED), m.rlike(RESERVED))
    elif kind == "card":
        v2 = _vote(digits.rlike(ISSUERS), ~digits.rlike(ISSUERS))
    elif kind == "phone":
        known = digits.rlike(CALLING) if base else digits.rlike("^[2-9]")
        v2 = _vote(known, ~known)
    elif kind == "secret":
        v2 = _vote(left.rlike(r"(token|secret|api.?key|password|bearer)\W{1,5}$"), left.rlike(r"[0-9a-f]\W?$"))
    else:
        v2 = _vote(never, digits.rlike(r"^(078051120|219099999|123456789)$"))
    v3 = _vote(left.rlike(CUES[kind]), left.rlike(AGAINST))
    open_ends = left.rlike(r"[\p{L}0-9_]$") | right.rlike(r"^[\p{L}0-9_]")
    v4 = _vote(~open_ends, open_ends)
    n = F.length(m)
    f1 = F.when(n <= 12, 0).when(n <= 20, 1).when(n <= 40, 2).otherwise(3)
    f2 = F.when(left == "", 0).when(left.rlike(r"\s$"), 1).when(left.rlike(r"[\p{L}0-9]$"), 2).otherwise(3)
    share = F.length(digits) / n
    f3 = F.when(share <= 0.25, 0).when(share <= 0.6, 1).when(share < 1, 2).otherwise(3)
    kept = _passes(kind, m) if base else never
    return F.struct(F.lit(kind).alias("kind"), x["s"].alias("s"), x["e"].alias("e"), kept.alias("base"), v1.alias("v1"), v2.alias("v2"), v3.alias("v3"), v4.alias("v4"), f1.alias("f1"), f2.alias("f2"), f3.alias("f3"))


def candidates(scanned: DataFrame) -> DataFrame:
    """(doc_id, c): all candidates of each document, base kinds first, each kind by start."""
    first = scanned.columns[0]
    placed = scanned.select(first, *[F.when(F.col(c).isNotNull(), _placed(c)).alias(c) for c in [*PATTERNS, "weaker"]])
    empty = "array<struct<kind:string,s:int,e:int,base:boolean,v1:int,v2:int,v3:int,v4:int,f1:int,f2:int,f3:int>>"

    def described(spans: Column, kind: str, base: bool) -> Column:
        return F.coalesce(F.transform(spans, lambda x: _candidate(kind, x, base)), F.array().cast(empty))

    found = [described(F.col(k), k, True) for k in PATTERNS]
    # which of the weaker patterns a match is of
    whole = {"secret": "^[0-9A-Fa-f]{32,}+$", "ssn": r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$", "phone": r"^\(?[0-9]{3}[\x20.)-]+[0-9]{3}[\x20.-][0-9]{4}$", "email": r"[\[(]at[\])]"}

    def of(form: str) -> Column:
        return F.filter(F.col("weaker"), lambda x: x["m"].rlike(form))

    found += [described(of(whole[k]), k, False) for k in WEAKER]
    return placed.select(first, F.concat(*found).alias("c"))


# ---------------------------------------------------------------- the label model, on grouped counts


def reliabilities(counts: list[tuple]) -> dict[str, tuple[float, list[dict]]]:
    """By expectation-maximisation, for each kind: the share of true candidates, and for each
    labeler the chance of each vote given a true and given a false candidate.

    counts: rows (kind, v1, v2, v3, v4, f1, f2, f3, n).
    """
    models = {}
    for kind in KINDS:
        rows: dict[tuple, int] = {}
        for row in counts:
            if row[0] == kind:
                rows[row[1:5]] = rows.get(row[1:5], 0) + row[8]
        chance = {v: 1 / (1 + math.prod(LEAN[x][1] / LEAN[x][0] for x in v)) for v in rows}
        prior, tables = 0.5, [{v: (1 / 3, 1 / 3) for v in (-1, 0, 1)} for _ in range(4)]
        for _ in range(ROUNDS):
            total = sum(rows.values())
            true = sum(n * chance[v] for v, n in rows.items())
            prior = (true + 1) / (total + 2)
            for j, table in enumerate(tables):
                for vote in (-1, 0, 1):
                    t = sum(n * chance[v] for v, n in rows.items() if v[j] == vote)
                    f = sum(n * (1 - chance[v]) for v, n in rows.items() if v[j] == vote)
                    lean = LEAN[vote]
                    table[vote] = ((t + LEAN_CANDIDATES * lean[0]) / (true + LEAN_CANDIDATES), (f + LEAN_CANDIDATES * lean[1]) / (total - true + LEAN_CANDIDATES))
            for v in rows:
                odds = math.log(prior / (1 - prior)) + sum(math.log(tables[j][x][0] / tables[j][x][1]) for j, x in enumerate(v))
                chance[v] = 1 / (1 + math.exp(-max(-60.0, min(60.0, odds))))
        models[kind] = (prior, tables)
    return models


FEATURES = ["v2", "v3", "v4", "f1", "f2", "f3"]


def span_classifier(counts: list[tuple]) -> dict[str, float]:
    """Log-odds by "kind" and "kind|feature|value", fitted to the label model's probabilities."""
    models = reliabilities(counts)
    weights: dict[str, float] = {}
    for kind in KINDS:
        prior, tables = models[kind]
        true = false = 0.0
        seen: dict[tuple, list[float]] = {}
        for row in counts:
            if row[0] != kind:
                continue
            odds = math.log(prior / (1 - prior)) + sum(math.log(tables[j][x][0] / tables[j][x][1]) for j, x in enumerate(row[1:5]))
            p, n = 1 / (1 + math.exp(-max(-60.0, min(60.0, odds)))), row[8]
            true, false = true + n * p, false + n * (1 - p)
            for name, value in zip(FEATURES, row[2:8]):
                pair = seen.setdefault((name, value), [0.0, 0.0])
                pair[0] += n * p
                pair[1] += n * (1 - p)
        weights[kind] = math.log((true + 1) / (false + 1))
        for name in FEATURES:
            for value in (-1, 0, 1, 2, 3):
                t, f = seen.get((name, value), (0.0, 0.0))
                weights[f"{kind}|{name}|{value}"] = math.log((t + 1) / (true + 5)) - math.log((f + 1) / (false + 5))
    return weights


def learn(known: DataFrame) -> dict[str, float]:
    """The span classifier of a table of candidates."""
    each = known.select(F.explode("c").alias("c")).select("c.*")
    counts = [tuple(r) for r in each.groupBy("kind", "v1", "v2", "v3", "v4", "f1", "f2", "f3").count().collect()]
    return span_classifier(sorted(counts))


def accepted(known: DataFrame, weights: dict[str, float]) -> DataFrame:
    """(first column, found): base spans, and the added ones that the classifier accepts, by kind as listed in KINDS, then start."""
    table = F.create_map(*[F.lit(x) for kv in sorted(weights.items()) for x in kv])
    first = known.columns[0]

    def passes(x: Column) -> Column:
        score = table[x["kind"]]
        for name in FEATURES:
            score = score + table[F.concat_ws("|", x["kind"], F.lit(name), x[name].cast("string"))]
        return (x["v1"] >= 0) & ~x["base"] & (score >= math.log(ACCEPT / (1 - ACCEPT)))

    base = known.select(first, F.filter("c", lambda x: x["base"]).alias("b"), F.filter("c", passes).alias("w"))
    clear = F.filter("w", lambda x: ~F.exists("b", lambda y: (x["s"] < y["e"]) & (y["s"] < x["e"])))
    both = base.select(first, F.concat("b", clear).alias("c"))
    ranked = F.transform("c", lambda x: F.struct(F.array_position(F.array(*map(F.lit, KINDS)), x["kind"]).alias("r"), x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind"), x["base"].alias("base")))
    return both.select(first, F.array_sort(ranked).alias("found"))


def find_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, found) of each document; found: array of (kind, s, e, base)."""
    known = S.stored(candidates(S.stored(scan(docs, key, text), "pii-scan")), "pii-candidates")
    return accepted(known, learn(known))


def mask_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", length: str = "n_chars") -> DataFrame:
    """The documents with each span of personal data replaced by its kind in angle brackets.

    The texts are gone through once: rows are written with their candidates, learned from and
    then changed, so they needn't be told apart by an id. A span that begins inside another is
    part of it. A column named as ``length`` follows the text.
    """
    known = S.stored(candidates(scan(docs, key, text, carry=True)), "pii-rows")
    found = accepted(known, learn(known))
    spans = F.array_sort(F.transform("found", lambda x: F.struct(x["s"].alias("s"), (-x["e"]).alias("to"), x["e"].alias("e"), x["kind"].alias("kind"))))
    at = S.place(docs.columns, text)
    whole = F.col(f"row.c{at}")
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def add(done: Column, x: Column) -> Column:
        new = F.array(F.substring(whole, done["at"] + 1, x["s"] - done["at"]), F.concat(F.lit("<"), x["kind"], F.lit(">")))
        return F.struct(F.greatest(done["at"], x["e"]).alias("at"), F.when(x["s"] < done["at"], done["parts"]).otherwise(F.concat(done["parts"], new)).alias("parts"))

    masked = F.aggregate(spans, begin, add, lambda done: F.array_join(F.concat(done["parts"], F.array(F.substring(whole, done["at"] + 1, F.length(whole)))), ""))
    text_now = F.when(F.size("found") > 0, masked).otherwise(whole)
    changed = found.select("row", text_now.alias("changed"))
    follows = docs.columns.index(length) if length in docs.columns else None
    return changed.select(*[(F.col("changed") if i == at else F.length("changed").cast(f.dataType) if i == follows else F.col(f"row.c{i}")).alias(f.name) for i, f in enumerate(docs.schema)])


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def digest(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    found = find_spans(docs, key, text)
    base = F.filter("found", lambda x: x["base"])

    def number(kind: str) -> Column:
        return F.size(F.filter("found", lambda x: x["base"] & (x["kind"] == kind))).cast("long").alias(f"n_{kind}")

    counts = [number(k) for k in BASE]
    return found.select("doc_id", *counts, F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans"))
