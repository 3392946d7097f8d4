"""Every registered query that has an SQL twin must agree with it in all rows."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from gridpulse.plans import registry
from tools.check_oracles import compare, connect

SQL = {n: s for n, s in oracle_sql().items() if n in registry.QUERIES}
ROWS_ONLY = [n for n in registry.QUERIES if n not in SQL]


@pytest.fixture(scope="module")
def duck(sf):
    con = connect(sf)
    yield con
    con.close()


@pytest.mark.parametrize("name", SQL)
def test_query_equals_sql(spark, sf, duck, name):
    got = queries()[name](spark, sf).toPandas()
    assert compare(got, duck.execute(SQL[name]).df()) is None


def test_only_model_and_file_facts_lack_sql():
    assert all(n.startswith(("j06", "j07", "j08", "j09", "j10", "j12", "j15", "f07", "a13_metrics_sink", "a17_inventory_bytes", "a18")) for n in ROWS_ONLY), ROWS_ONLY


def test_entry_has_rows_and_a_stable_schema(spark):
    first, second = entry(spark), entry(spark)
    assert first.schema == second.schema
    assert first.count() >= 1
