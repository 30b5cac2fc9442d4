"""Quality rules by repetition coverage.

Rolling hashes of several n-gram lengths are computed in numpy over the words of each
text; the characters inside duplicated n-grams and duplicated lines are measured against
the characters in words. Every text is judged alone: there is no shuffle, and a task holds
one Arrow batch and the temporaries of one slice of it.

Defined cases: a null text has no words, so all its counts are 0 and its base verdict is
failure; so has an empty one. Repeated rows give repeated results. A very long text is
measured whole, in memory in proportion to it. A null key is returned as null. Columns other than the key and the text are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lexloom.llm import shared as S

#: Lengths of the n-grams, and the largest share of word characters inside duplicated ones.
NGRAM_LIMITS = {5: 0.20, 6: 0.18, 7: 0.16, 8: 0.15, 9: 0.14, 10: 0.13}
#: Largest share of lines equal to an earlier one, of characters in them, and of symbols to words.
LINE_LIMIT, LINE_CHARS_LIMIT, SYMBOL_LIMIT = 0.30, 0.20, 0.10
#: So many lines equal to an earlier one may be chance in any text.
CHANCE_LINES = 1

SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, dup_line_chars long, " + ", ".join(f"dup{n}_chars long" for n in NGRAM_LIMITS)

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _duplicated(keys: np.ndarray) -> np.ndarray:
    """True where a key occurs twice or more."""
    order = np.sort(keys)
    again = np.unique(order[1:][order[1:] == order[:-1]])
    if not len(again):
        return np.zeros(len(keys), dtype=bool)
    at = np.minimum(np.searchsorted(again, keys), len(again) - 1)
    return again[at] == keys


def _covered(starts: np.ndarray, n: int, words: int) -> np.ndarray:
    """True for the words inside any of the n-word windows."""
    change = np.zeros(words + 1, dtype=np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + n, -1)
    return np.cumsum(change[:-1]) > 0


def measure(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The measurements of each row of a slice."""
    n = len(offsets) - 1
    starts, ends = S.runs(~S.WHITE[data], offsets)
    rows = S.row_of(starts, offsets)
    points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    chars = points[ends] - points[starts]
    symbols = np.concatenate(([0], np.cumsum(_SYMBOL[data])))
    out = {
        "n_words": np.bincount(rows, minlength=n).astype(np.int64),
        "word_chars": S.sum_by_row(chars, rows, n),
        "n_symbols": symbols[offsets[1:]] - symbols[offsets[:-1]],
    }

    line_starts, line_ends = S.runs(data != 0x0A, offsets)
    before = np.searchsorted(starts, line_starts)
    worded = np.searchsorted(starts, line_ends) > before
    line_starts, line_ends = line_starts[worded], line_ends[worded]
    line_rows = S.row_of(line_starts, offsets)
    salt = S.mix(np.arange(1, n + 1, dtype=np.uint64))
    keys = S.run_hashes(data, line_starts, line_ends) ^ salt[line_rows]
    _, first = np.unique(keys, return_index=True)
    later = np.ones(len(keys), dtype=bool)
    later[first] = False
    total = np.concatenate(([0], np.cumsum(chars)))
    line_chars = total[np.searchsorted(starts, line_ends)] - total[np.searchsorted(starts, line_starts)]
    out["n_dup_lines"] = np.bincount(line_rows[later], minlength=n).astype(np.int64)
    out["lines"] = np.bincount(line_rows, minlength=n).astype(np.int64)
    out["dup_line_chars"] = S.sum_by_row(line_chars[later], line_rows[later], n)

    words = S.run_hashes(data, starts, ends)
    for length in NGRAM_LIMITS:
        hashes, at = S.window_hashes(words, rows, length)
        twice = at[_duplicated(hashes ^ salt[rows[at]])] if len(at) else at
        covered = _covered(twice, length, len(words))
        out[f"dup{length}_chars"] = S.sum_by_row(chars[covered], rows[covered], n)
        if length == 5:
            out["n_repeat_words"] = np.bincount(rows[covered], minlength=n).astype(np.int64)
    return out


def verdicts(m: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(base_failed, kept)."""
    base = (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])
    words, chars = np.maximum(m["n_words"], 1), np.maximum(m["word_chars"], 1)
    bad = m["n_symbols"] > SYMBOL_LIMIT * words
    for length, limit in NGRAM_LIMITS.items():
        bad |= m[f"dup{length}_chars"] > limit * chars
    lines = (m["n_dup_lines"] > LINE_LIMIT * np.maximum(m["lines"], 1)) | (m["dup_line_chars"] > LINE_CHARS_LIMIT * chars)
    bad |= lines & (m["n_dup_lines"] > CHANCE_LINES)
    return base, ~base & ~bad


def repetition_rules(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of measurements and verdicts for each row of ``docs``."""
    names = [f.split()[0] for f in SCHEMA.split(", ")]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in S.slices(batch.column(1)):
                m = measure(data, offsets)
                m["base_failed"], m["kept"] = verdicts(m)
                m["doc_id"] = batch.column(0).slice(i, j - i)
                yield pa.RecordBatch.from_arrays([pa.array(m[c]) if c != "doc_id" else m[c] for c in names], names)

    return S.keyed(docs, key, text).mapInArrow(S.trimmed(judge), SCHEMA)


def _sql() -> str:
    """The same rows by DuckDB: words and lines as rows, n-grams by lead, their words by a moving maximum."""
    longest = max(NGRAM_LIMITS)
    leads = ", ".join(f"lead(w, {i}) OVER o AS w{i}" for i in range(1, longest))
    grams = ", ".join(f"w || {' || '.join(f"' ' || w{i}" for i in range(1, n))} AS g{n}" for n in NGRAM_LIMITS)
    twice = ", ".join(f"CASE WHEN g{n} IS NOT NULL AND count(*) OVER (PARTITION BY rid, g{n}) > 1 THEN 1 ELSE 0 END AS t{n}" for n in NGRAM_LIMITS)
    inside = ", ".join(f"max(t{n}) OVER (PARTITION BY rid ORDER BY p ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS c{n}" for n in NGRAM_LIMITS)
    sums = ", ".join(f"sum(c * c{n}) AS dup{n}_chars" for n in NGRAM_LIMITS)
    whole = ", ".join(f"CAST(coalesce(dup{n}_chars, 0) AS BIGINT) AS dup{n}_chars" for n in NGRAM_LIMITS)
    over = " OR ".join(f"dup{n}_chars > CAST({limit} AS DOUBLE) * greatest(word_chars, 1)" for n, limit in NGRAM_LIMITS.items())
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM (SELECT rid, regexp_extract_all(text, '[^ 	-]+') AS ws FROM d)),
a AS (SELECT rid, p, w, length(w) AS c, {leads} FROM w WINDOW o AS (PARTITION BY rid ORDER BY p)),
g AS (SELECT rid, p, c, {grams} FROM a),
t AS (SELECT rid, p, c, {twice} FROM g),
k AS (SELECT rid, c, {inside} FROM t),
m AS (SELECT rid, count(*) AS n_words, sum(c) AS word_chars, sum(c5) AS n_repeat_words, {sums} FROM k GROUP BY rid),
l AS (SELECT rid, line, count(*) AS n, length(regexp_replace(line, '[ 	-]', '', 'g')) AS c
      FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^ 	-]') GROUP BY rid, line),
b AS (SELECT rid, sum(n) AS lines, sum(n - 1) AS n_dup_lines, sum((n - 1) * c) AS dup_line_chars FROM l GROUP BY rid),
r AS (SELECT doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars, CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
      CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(dup_line_chars, 0) AS BIGINT) AS dup_line_chars, coalesce(lines, 0) AS lines, {whole}
      FROM d LEFT JOIN m USING (rid) LEFT JOIN b USING (rid)),
v AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
      n_symbols > CAST({SYMBOL_LIMIT} AS DOUBLE) * greatest(n_words, 1) OR {over}
      OR (n_dup_lines > {CHANCE_LINES} AND (n_dup_lines > CAST({LINE_LIMIT} AS DOUBLE) * greatest(lines, 1) OR dup_line_chars > CAST({LINE_CHARS_LIMIT} AS DOUBLE) * greatest(word_chars, 1))) AS bad FROM r)
SELECT * EXCLUDE (lines, bad), NOT base_failed AND NOT bad AS kept FROM v
"""


SQL = _sql()
