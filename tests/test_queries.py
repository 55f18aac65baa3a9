"""Every registered query against its SQL, on the whole small tables."""

import pytest

import __spark_entry__ as driver
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
SQL = driver.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    df = driver.queries()[name](spark, SF)
    got, want, extra, missing = compare(df, con, SQL[name])
    assert got == want
    assert not extra and not missing, (extra[:3], missing[:3])


@pytest.mark.parametrize("name", sorted(set(driver.queries()) - set(SQL)))
def test_runs(spark, name):
    assert driver.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_assembly_has_57_columns():
    from ebbline.catalogue.features import ASSEMBLY
    from ebbline.catalogue.shape import fields

    names = [n for n, _ in fields(" ".join(ASSEMBLY.split()))]
    assert len(names) == len(set(names)) == 57
