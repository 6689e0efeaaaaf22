"""Every registered query against its SQL, and the driver contract."""

import pytest
from compare import difference

import __spark_entry__ as entry
from strataframe.workload import QUERIES


def test_every_check_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_returns_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["pais", "anio", "meses_con_datos", "total_fallecidos_covid"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, oracle, name):
    df = entry.queries()[name](spark, sf_dir)
    check = entry.oracle_sql().get(name)
    if check is None:
        assert df.count() > 0
    else:
        assert difference(df, oracle, check) in (None, "no rows")
