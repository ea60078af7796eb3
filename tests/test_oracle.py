"""Every registered query against its SQL restatement, over whole tables."""

from __future__ import annotations

import pytest
from compare import connect, difference
from pyspark.sql import functions as F

from pullgrid.plans.oracle import ORACLE
from pullgrid.plans.queries import QUERIES


@pytest.fixture(scope="module")
def database(sf):
    return connect(sf)


def test_every_query_has_an_answer():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf, database, name):
    assert difference(QUERIES[name](spark, sf), database, ORACLE[name]) == ""


def test_a_planted_wrong_row_is_caught(spark, sf, database):
    good = QUERIES["list_top_batch"](spark, sf)
    rank = F.when(F.col("rank") == 3, 4).otherwise(F.col("rank")).alias("rank")
    assert difference(good.select("full_name", "id", rank), database, ORACLE["list_top_batch"])
    assert difference(good.where("rank <> 3"), database, ORACLE["list_top_batch"])
    assert difference(good.drop("rank"), database, ORACLE["list_top_batch"])
