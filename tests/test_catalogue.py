import duckdb
import pytest

import __spark_entry__ as entry
from millrace.plans import catalogue

DATA = "/root/testdata/sf0.01"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(round(r[i], 6) if isinstance(r[i], float) else r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_oracle(spark, db, name):
    got = entry.queries()[name](spark, DATA)
    want = db.sql(entry.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got.collect(), got.columns) == plain(want.fetchall(), want.columns)


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES)))
def test_rows(spark, name):
    assert entry.queries()[name](spark, DATA).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
