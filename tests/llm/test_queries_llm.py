"""Registered queries against their SQL, and that each gives a row per input row."""

import pytest

import __spark_entry__ as driver
from ebbline.llm.queries import QUERIES, SQL
from tests.llm.conftest import SF
from tests.oracle import compare, connect


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    got, want, extra, missing = compare(QUERIES[name](spark, SF), connect(SF), SQL[name])
    assert got == want > 0
    assert not extra and not missing, (extra[:3], missing[:3])


def test_one_query_per_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, len(numbers) + 1))
    assert {*QUERIES, "pipeline"} <= set(driver.queries())
