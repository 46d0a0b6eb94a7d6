"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import contextlib
import io

import compare
import pytest

import __spark_entry__ as entry_module
from sightline.plans import catalog, oracles
from sightline.plans.tables import Tables

SF = "/root/testdata/sf0.001"
QUERIES = catalog.queries()
SQL = oracles.oracle_sql()


# These tables have fewer tasks than the signal pool holds.
NO_ROWS = {"drop_cancelled": "no rows"}


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


def plan_of(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


def test_every_query_has_sql_and_is_registered():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_module.queries()) and set(SQL) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert compare.differences(df, con, SQL[name]) == NO_ROWS.get(name)


@pytest.mark.parametrize("name", ["uniform_sample", "serial_number", "ranked_links", "fragment_chunks"])
def test_numbering_in_ranges(spark, con, name):
    """The same results when every larger key is numbered over many tasks."""
    df = getattr(catalog, name)(Tables(spark, SF, hot_rows=3))
    assert compare.differences(df, con, SQL[name]) is None


def test_filters_reach_the_scan(spark):
    plan = plan_of(QUERIES["recent_signals"](spark, SF))
    assert "EqualTo(event_type,error)" in plan and "TakeOrderedAndProject" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan


def test_top_k_is_cut_before_the_shuffle(spark):
    plan = plan_of(QUERIES["topk_similar"](spark, SF))
    assert plan.count("WindowGroupLimit") == 2


def test_entry(spark):
    assert entry_module.entry(spark).columns == ["bucket_start", "band", "n_entities", "n_samples"]
