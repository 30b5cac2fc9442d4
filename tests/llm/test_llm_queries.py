import zlib

import duckdb
import numpy as np
import pytest

from lexloom.llm import registry

DATA = "/root/testdata/sf0.001"
NAMES = {1: "repetition", 2: "bitslice", 3: "pii", 4: "sitequality", 5: "langid", 6: "jaccard", 7: "mixing", 8: "bpe", 9: "rans", 10: "licenses"}


def test_one_query_for_each_operator():
    assert list(registry.queries()) == [f"op{n}_{x}" for n, x in NAMES.items()]
    assert set(registry.oracle_sql()) == {"op1_repetition", "op2_bitslice", "op6_jaccard", "op7_mixing"}


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_rows_as_sql(spark, name):
    df = registry.queries()[name](spark, DATA)
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    found = con.execute(registry.oracle_sql()[name])
    columns = [c[0] for c in found.description]
    assert sorted(df.columns) == sorted(columns)
    shaped = lambda rows, names: sorted(repr(tuple(r[names.index(c)] for c in sorted(names))) for r in rows)
    assert shaped(df.collect(), df.columns) == shaped(found.fetchall(), columns)


def test_contract_columns(spark):
    want = {
        "op1_repetition": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
        "op2_bitslice": "query_id bigint, rank int, vec_id bigint, score bigint",
        "op3_pii": "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string",
        "op5_langid": "doc_id bigint, held_out boolean, lang_pred string, score double",
        "op6_jaccard": "doc_id bigint, n_shingles bigint, component_id bigint",
        "op7_mixing": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
        "op8_bpe": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
        "op9_rans": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    }
    for name, columns in want.items():
        got = dict(registry.queries()[name](spark, DATA).dtypes)
        assert {c.split()[0]: c.split()[1] for c in columns.split(", ")}.items() <= got.items(), name


def test_held_out_accuracy(spark):
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang").collect()}
    out = [r for r in registry.queries()["op5_langid"](spark, DATA).collect() if r.held_out]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in out)
    assert np.mean([r.lang_pred == docs[r.doc_id] for r in out]) > 0.97
