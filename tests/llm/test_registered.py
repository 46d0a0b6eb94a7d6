"""The registered queries over the smallest tables, against SQL where it can express them."""

import compare
import pytest

import __spark_entry__ as entry_module
from sightline.llm import queries

SF = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    names = list(queries.queries())
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)]
    assert set(queries.oracle_sql()) <= set(names)
    assert {*names, "pipeline"} <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query(spark, name):
    got = queries.queries()[name](spark, SF)
    if name in queries.oracle_sql():
        assert compare.differences(got, compare.connect(SF), queries.oracle_sql()[name]) is None
    else:
        assert got.count() > 0
