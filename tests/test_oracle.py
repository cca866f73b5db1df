"""Every registered query with SQL gives the SQL's rows; the others give rows with a stable schema."""

import pytest

from tabloom.check import compare, duck
from tabloom.queries import REGISTRY

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query(spark, con, name):
    verdict, _ = compare(spark, con, SF, name)
    assert not verdict.startswith("FAIL"), verdict


def test_comparison_sees_differences(spark, con):
    """The harness itself: a wrong value, a missing row and a wrong name are all reported."""
    from tabloom.queries.registry import Query

    good = REGISTRY["a1_group_count"]
    bad = {
        "value": Query(good.run, good.sql.replace("count(user_id)", "count(user_id) + 1")),
        "row": Query(good.run, good.sql + " having event_type <> 'view'"),
        "name": Query(good.run, good.sql.replace("as n", "as m")),
    }
    for label, q in bad.items():
        REGISTRY["_probe"] = q
        try:
            assert compare(spark, con, SF, "_probe")[0].startswith("FAIL"), label
        finally:
            del REGISTRY["_probe"]


def test_entry_contract(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["event_type", "n"]
    assert set(e.oracle_sql()) <= set(e.queries())
