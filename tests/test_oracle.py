"""Every registered query against its DuckDB oracle (sf0.001): row count,
column names, column types and an order-insensitive value hash."""

import pytest

from tests.conftest import SF_SMALL
from tools.check_oracle import SPARK2DUCK, digest, duck

import __spark_entry__ as E
from ratewise import registry

NAMES = sorted(registry.QUERIES)


def test_every_query_has_an_oracle():
    assert set(registry.ORACLE) == set(registry.QUERIES)
    assert set(NAMES) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    stypes = {f.name: SPARK2DUCK.get(f.dataType.simpleString()) for f in df.schema.fields}
    otypes = {d[0]: str(d[1]) for d in cur.description}
    assert stypes == otypes
    assert digest(df.columns, rows) == digest(ocols, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["user_id", "favourite_genre", "genre_rating_count"]
    assert df.count() > 0
