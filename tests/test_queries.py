import duckdb
import pytest

from claimlake.plans.queries import ORACLE_SQL, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(str([v[i] for i in order]) for v in values)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    want = duck.execute(ORACLE_SQL[name])
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows([d[0] for d in want.description], want.fetchall())
