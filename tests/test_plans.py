"""What the physical plans must look like to hold at scale."""

from __future__ import annotations

import re

from pullgrid.plans import mirror
from pullgrid.plans.queries import QUERIES


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_listings_read_no_line_items(spark, sf):
    text = plan(QUERIES["list_top_batch"](spark, sf))
    assert "lineitem" not in text
    assert "l_orderkey" not in text


def test_top_batch_cuts_before_it_shuffles(spark, sf):
    text = plan(QUERIES["list_top_batch"](spark, sf))
    # two windows (salted, whole), each with a limit below its exchange
    assert text.count("Partial") >= 2
    assert text.count("WindowGroupLimit") >= 4


def test_scans_are_pruned(spark, sf):
    text = plan(QUERIES["list_top_batch"](spark, sf))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    orders = next(s for s in schemas if "o_orderkey" in s)
    assert set(orders.replace(",", " ").split()) == {
        "o_orderkey:bigint",
        "o_custkey:bigint",
        "o_orderdate:timestamp_ntz",
    }


def test_decode_is_one_scan_without_shuffle(spark, sf):
    mirror.host_mirror(spark, sf)
    text = plan(QUERIES["nested_projection"](spark, sf))
    assert "Exchange" not in text
    assert text.count("FileScan") == 1
    assert "ReadSchema: struct<body:string>" in text


def test_summary_aggregates_before_its_shuffle(spark, sf):
    text = plan(QUERIES["repo_summary"](spark, sf))
    assert text.count("Exchange") == 1
    assert "partial_count" in text


def test_no_cross_joins(spark, sf):
    for name in ("pr_table", "work_items", "slice_items", "point_lookup", "dedup_listing"):
        text = plan(QUERIES[name](spark, sf))
        assert "CartesianProduct" not in text
        assert "BroadcastNestedLoopJoin" not in text
