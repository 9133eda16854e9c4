"""Every registered query of the library against DuckDB, on the smallest tables."""

import os

import duckdb
import pytest

from leafmill.plans import flows as catalog  # the catalogue, and what runs streams

DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def normal(frame, columns):
    said = lambda v: "null" if v is None or v != v else f"{v:.9g}" if isinstance(v, float) else str(v)[:19]
    return sorted(tuple(said(v).removesuffix(" 00:00:00") for v in row) for row in frame[columns].itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return con


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no tables here")
@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    got = catalog.QUERIES[name](spark, DIR).toPandas()
    if name not in catalog.ORACLES:
        assert len(got.columns)
        return
    expected = duck.sql(catalog.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    columns = sorted(got.columns)
    assert normal(got, columns) == normal(expected, columns)
