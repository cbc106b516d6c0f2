"""Every registered query against its SQL, over whole tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from vecshelf.checks.oracles import oracles
from vecshelf.checks.registered import registered

SF = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(v):
        if isinstance(v, float) and not math.isnan(v):
            return 0.0 if v == 0 else v
        return v

    return sorted((tuple(plain(r[i]) for i in order) for r in values), key=repr)


@pytest.mark.parametrize("name", sorted(registered()))
def test_query(spark, duck, name):
    df = registered()[name](spark, SF)
    mine = rows(df.columns, [tuple(r) for r in df.collect()])
    assert mine, "no rows"
    sql = oracles().get(name)
    if sql is None:
        assert name == "fit_head"
        return
    found = duck.execute(sql)
    columns = [d[0] for d in found.description]
    theirs = rows(columns, found.fetchall())
    assert sorted(df.columns) == sorted(columns)
    assert len(mine) == len(theirs)
    different = [(a, b) for a, b in zip(mine, theirs) if a != b]
    assert not different, different[:3]


def test_entry(spark):
    found = entry_point.entry(spark)
    assert found.columns == ["key", "value", "written_at", "expires_at"]
    assert found.count() == 200
