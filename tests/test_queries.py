"""Every registered query on the smallest tables, against its SQL twin where it has one."""

import pytest

import __spark_entry__ as entry
from tagloom.workload.registry import all_queries, all_sql
from check_twins import difference, duck

SF_DIR = "/root/testdata/sf0.001"
SHORT_BANDS = ("age_band", "purchase_cycle", "part_size_bands", "profile_all", "order_tags")
KEYLESS = (*SHORT_BANDS, "als_top5")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", list(all_queries()))
def test_query(spark, con, name):
    df = all_queries()[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # All row work stays in the JVM.
    assert "Python" not in plan and "Pandas" not in plan
    # MLlib scores blocks of users against blocks of products; bands of short rule lists are
    # tested one by one. Nothing else pairs rows without a key.
    assert "CartesianProduct" not in plan
    assert "NestedLoop" not in plan or name in KEYLESS
    sql = all_sql().get(name)
    if sql is None:
        assert df.columns and df.count() > 0
    else:
        assert difference(df, con, sql) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["userId", "tagIds"] and df.count() > 0


def test_every_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
