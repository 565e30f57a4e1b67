"""Every library query against its DuckDB SQL."""

import os

import pytest

duckdb = pytest.importorskip("duckdb")
from docloom.plans.oracle import ORACLE_SQL  # noqa: E402
from docloom.plans.registry import QUERIES  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float) or type(v).__name__ == "Decimal":
        return str(round(float(v), 6))
    return str(v)


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    got = sorted(tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect())
    if name in ORACLE_SQL:
        r = con.execute(ORACLE_SQL[name])
        names = [d[0] for d in r.description]
        assert sorted(names) == sorted(df.columns)
        assert got == sorted(tuple(plain(x[names.index(c)]) for c in sorted(names)) for x in r.fetchall())
    else:
        assert got
