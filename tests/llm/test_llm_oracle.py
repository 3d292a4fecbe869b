"""Registered queries with SQL against DuckDB; the others are tested by brute force elsewhere."""

import pytest
from compare import DATA, differences, duck

import __spark_entry__ as driver
from tickerloom.llm.queries import ORACLE, QUERIES


def test_registered():
    assert {f"op{n}_" for n in range(1, 14)} <= {q.partition("_")[0] + "_" for q in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(driver.queries())
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_result(spark, name):
    folder = f"{DATA}/sf0.001"
    assert differences(QUERIES[name](spark, folder), duck(folder), ORACLE[name]) == []
