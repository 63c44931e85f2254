import duckdb
import pytest

from churnlens.llm.oracle_sql import SQL
from churnlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({SQL[name]})").fetchall()
    assert sorted(map(repr, (tuple(r[c] for c in columns) for r in df.collect()))) == sorted(map(repr, want))


def test_every_operator_has_its_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
