"""Queries that SQL can express, against their DuckDB text."""

import pytest

from ratewise.llm.queries import ORACLE, QUERIES
from tests.conftest import SF_SMALL
from tools.check_oracle import SPARK2DUCK, digest, duck


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = duck(SF_SMALL).execute(ORACLE[name])
    cols = [d[0] for d in cur.description]
    assert {f.name: SPARK2DUCK[f.dataType.simpleString()] for f in df.schema.fields} == {
        d[0]: str(d[1]) for d in cur.description}
    assert digest(df.columns, rows) == digest(cols, cur.fetchall())
    assert rows
