"""Every registered query against its DuckDB twin, on the smallest tables."""

import os

import duckdb
import pytest
from conftest import SF

from sievework.plans import registered

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, SQL = registered()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{SF}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    return float(v) if type(v).__name__ == "Decimal" else v


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(map(plain, r))) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    if name in SQL:
        r = duck.execute(SQL[name])
        at = [d[0] for d in r.description]
        assert sorted(at) == columns
        assert got == sorted(repr(tuple(plain(row[at.index(c)]) for c in columns)) for row in r.fetchall())


def test_inventory_is_complete():
    ids = {n.split("_")[0] for n in QUERIES}
    counts = {"s": 16, "p": 36, "v": 30, "f": 10, "j": 13, "a": 24, "w": 14, "l": 5, "u": 5, "n": 7, "x": 11, "r": 4}
    assert not {f"{k}{i:02d}" for k, n in counts.items() for i in range(1, n + 1)} - ids
