import duckdb
import pytest

from civicflow.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows(spark, sf_dir, name):
    c = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels"):
        c.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    got = QUERIES[name](spark, sf_dir)
    want = c.sql(ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(str, (tuple(r) for r in got.select(*want.columns).collect()))) == sorted(map(str, want.fetchall()))
