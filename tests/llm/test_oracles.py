"""Operators with SQL against DuckDB on the smallest tables."""

import pytest

from tabloom.check import canonical, duck
from tabloom.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    found = QUERIES[name](spark, SMALL)
    con = duck(SMALL)
    cursor = con.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(found.columns)
    assert canonical([tuple(r) for r in found.collect()], found.columns) == canonical(cursor.fetchall(), names)
