"""Registered queries: completeness, a sample against SQL, and the shape of their plans."""

import re

import pytest

import __spark_entry__ as entry
from leadmill import catalog
from tools.check_oracles import compare, open_tables

FOLDER = "/root/testdata/sf0.001"
FAMILIES = {"s": 12, "p": 14, "o": 6, "a": 15, "r": 4, "j": 7, "n": 4, "g": 10, "l": 2, "b": 6, "m": 4, "k": 9, "c": 4, "t": 1}
# parts of another row: J2 in A12, K10 in the rule check of every linkage
SHARED = {"j2"}
SAMPLE = ["a2_group_sum", "a11_pivot_group", "o5_top_channels_by_group", "r4_side_by_side", "t1_website_domain",
          "g1_standardise_country", "b3_split_amounts", "m2_members_with_opportunities", "m3_by_stage_pivoted", "s9_campaign_members",
          "j5_sorted_neighbourhood", "k2_comparator_choice"]


def test_every_operator_has_a_query():
    known = {re.match(r"[a-z]+\d+", name).group() for name in catalog.QUERIES}
    wanted = {f"{letter}{i}" for letter, last in FAMILIES.items() for i in range(1, last + 1)} | {"a0"}
    assert wanted - known == SHARED


def test_every_query_has_sql():
    """Queries of the library all have SQL; those of the training-data operators are checked in tests/llm."""
    assert set(catalog.oracles()) == set(catalog.runners())
    assert set(catalog.runners()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def tables():
    return open_tables(FOLDER)


@pytest.mark.parametrize("name", SAMPLE)
def test_sample_equals_sql(spark, tables, name):
    query = catalog.QUERIES[name]
    said, _, _ = compare(spark, tables, FOLDER, query.run, query.sql)
    assert said in ("ok", "EMPTY")


@pytest.mark.parametrize("name", SAMPLE)
def test_no_cross_or_nested_loop_joins(spark, name):
    df = catalog.QUERIES[name].run(spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_whole_tables_never_meet_in_one_window(spark):
    for name in ("o2_drop_duplicates", "o6_top_row_per_group", "o3_top_channels"):
        plan = catalog.QUERIES[name].run(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert "WindowGroupLimit" in plan and "Exchange SinglePartition" not in plan


def test_only_the_needed_columns_are_scanned(spark):
    plan = catalog.QUERIES["a2_group_sum"].run(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    scanned = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert "l_extendedprice" not in scanned and "l_shipdate" not in scanned


def test_filters_reach_the_scan(spark):
    plan = catalog.QUERIES["p1_filter"].run(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_totalprice,100000.0)" in plan


def test_entry_runs(spark):
    rows = entry.entry(spark).collect()
    assert rows[-1]["OPP_Region"] == "Total Average"
