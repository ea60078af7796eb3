"""How the mirrors are built: narrow rows are moved, texts made where they are written."""

from __future__ import annotations

from pyspark.sql import functions as F

from pullgrid.plans import mirror


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_of_an_order_are_not_multiplied(spark, sf):
    """Distinct counts expanded every line three times, hashed and moved the copies."""
    assert "Expand" not in plan(mirror.pulls(spark, sf))
    lines = mirror.table(spark, sf, "lineitem")
    counted = lines.groupBy(F.col("l_orderkey").alias("k")).agg(
        F.count_distinct("l_partkey").cast("int").alias("changed_files"),
        F.count_distinct("l_suppkey").cast("int").alias("comments"),
    )
    found = mirror.pulls(spark, sf).where("commits > 0").select(*counted.columns)
    assert found.exceptAll(counted).isEmpty() and counted.count() == found.count()


def test_facts_are_joined_once_for_all_mirrors(spark, sf):
    """Every mirror and the prior cache joined orders, customers and lines again."""
    mirror.host_mirror(spark, sf)
    facts = mirror.pull_table(spark, sf)
    assert "Exchange" not in plan(facts) and set(facts.columns) == {*mirror.FACTS, *mirror.COUNTS}
    assert mirror._named(facts).select("id", "url", "version").exceptAll(
        mirror.pulls(spark, sf).select("id", "url", "version")
    ).isEmpty()
