import duckdb
import pytest

from lexloom.plans import registry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_same_rows_as_sql(spark, name):
    df = registry.queries()[name](spark, DATA)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    found = con.execute(registry.oracle_sql()[name])
    columns = [c[0] for c in found.description]
    assert sorted(df.columns) == sorted(columns)
    shaped = lambda rows, names: sorted(repr(tuple(r[names.index(c)] for c in sorted(names))) for r in rows)
    assert shaped(df.collect(), df.columns) == shaped(found.fetchall(), columns)
