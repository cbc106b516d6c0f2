import duckdb
import pytest

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in "documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con
