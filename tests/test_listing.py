from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from pullgrid.operators import listing, ranking, slicing


def plan(spark, batch, size=100):
    repos = spark.createDataFrame([("a/b", batch)], "full_name string, batch int")
    rows = listing.page_plan(repos, size).orderBy("page").collect()
    return [(r["page"], r["per_page"], r["rows_wanted"]) for r in rows]


@pytest.mark.parametrize(
    ("batch", "wanted"),
    [(12, [12]), (100, [100]), (101, [100, 1]), (200, [100, 100]), (245, [100, 100, 45])],
)
def test_page_plan(spark, batch, wanted):
    rows = plan(spark, batch)
    assert [r[2] for r in rows] == wanted
    assert {r[1] for r in rows} == {min(batch, 100)}
    assert [r[0] for r in rows] == list(range(1, len(wanted) + 1))


def test_page_plan_checks(spark):
    with pytest.raises(Exception, match="no repository has a batch of 0"):
        plan(spark, 0)
    with pytest.raises(ValueError, match="holds nothing"):
        plan(spark, 1, 0)
    for name in ("a", "a/b/c", "/b", "a/"):
        repos = spark.createDataFrame([(name, 1)], "full_name string, batch int")
        with pytest.raises(Exception, match="Invalid repository"):
            listing.page_plan(repos).collect()


def element(i, **changes):
    base = {
        "id": i,
        "number": 100 + i,
        "url": "url",
        "updated_at": "2010-11-01T09:38:15Z",
        "created_at": "2010-10-23T12:52:31Z",
    }
    return base | changes


def page(spark, body, wanted=100, status=200):
    row = ("a/b", 2, 100, wanted, status, body if isinstance(body, str) else json.dumps(body))
    return spark.createDataFrame(
        [row],
        "full_name string, page int, per_page int, rows_wanted int, status int, body string",
    )


def test_decode_listing(spark):
    body = [element(1), element(2, updated_at=None, extra=[1])]
    rows = listing.decode_listing(page(spark, body)).orderBy("rank").collect()
    assert [(r["rank"], r["id"], r["number"], r["version"], r["cache_key"]) for r in rows] == [
        (101, 1, 101, "2010-11-01T09:38:15Z", "pr-1-2010-11-01T09=38=15Z.cache"),
        (102, 2, 102, "2010-10-23T12:52:31Z", "pr-2-2010-10-23T12=52=31Z.cache"),
    ]


def test_rows_past_the_batch_are_not_decoded(spark):
    rows = listing.decode_listing(page(spark, [element(1), {"bad": 1}], wanted=1)).collect()
    assert [r["id"] for r in rows] == [1]


@pytest.mark.parametrize(
    ("body", "message"),
    [
        ([{"a": True}], "MISSING_KEY id"),
        ([element(True)], "WRONG_TYPE id"),
        ([element(1), element(2, url=None)], "REQUIRED_NULL url"),
        ([element(1, updated_at=None, created_at=None)], "REQUIRED_NULL created_at"),
        ([5], "NOT_OBJECT"),
        ({"message": "rate limit"}, "NOT_ARRAY in page 2 of a/b"),
        ("", "NOT_ARRAY"),
    ],
)
def test_bad_listing_fails_and_can_be_reported(spark, body, message):
    pages = page(spark, body)
    with pytest.raises(Exception, match=message):
        listing.decode_listing(pages).collect()
    found = listing.reject_listing(pages).collect()
    assert found
    assert {f"{r['rule']} {r['field']}".strip() for r in found} >= {message.split(" in ")[0]}
    assert listing.reject_listing(page(spark, [element(1)])).count() == 0


@pytest.mark.parametrize("status", [500, 404, 302])
def test_listing_status(spark, status):
    with pytest.raises(Exception, match=f"Request failed with code {status}: Error"):
        listing.decode_listing(page(spark, "Error", status=status)).collect()


def test_list_pages_past_the_end_and_unknown_repository(spark, endpoint):
    asked = spark.createDataFrame(
        [("AFRICA/NATION_0", 1), ("AFRICA/NATION_0", 99), ("no/where", 1)],
        "full_name string, page int",
    ).selectExpr("*", "100 AS per_page", "100 AS rows_wanted")
    answers = {(r[0], r[1]): r for r in listing.list_pages(asked, endpoint).collect()}
    assert answers[("AFRICA/NATION_0", 99)]["body"] == "[]"
    assert answers[("no/where", 1)]["status"] == 404
    assert answers[("AFRICA/NATION_0", 1)]["status"] == 200


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows in one repository, with ties in the sort key."""
    random.seed(7)
    names = ["hot/hot"] * 400 + [f"r/{i % 37}" for i in range(800)]
    rows = [(n, i, f"2020-01-{random.randint(1, 9):02d}") for i, n in enumerate(names)]
    random.shuffle(rows)
    return spark.createDataFrame(rows, "full_name string, id bigint, created_at string"), rows


def brute_ranks(rows):
    ranks, seen = {}, {}
    for name, i, created in sorted(rows, key=lambda r: (r[2], r[1]), reverse=True):
        seen[name] = seen.get(name, 0) + 1
        ranks[i] = seen[name]
    return ranks


@pytest.mark.parametrize("batch", [1, 25, 245])
def test_list_top_batch(spark, skewed, batch):
    df, rows = skewed
    expected = {i: r for i, r in brute_ranks(rows).items() if r <= batch}
    found = listing.list_top_batch(df, batch).collect()
    assert {r["id"]: r["rank"] for r in found} == expected


def test_rank_in_group(spark, skewed):
    df, rows = skewed
    order = [F.desc("created_at"), F.desc("id")]
    found = ranking.rank_in_group(df, ["full_name"], F.col("created_at"), order).collect()
    assert {r["id"]: r["rank"] for r in found} == brute_ranks(rows)
    assert len(found) == len(rows)


def test_dedup_listing(spark):
    rows = [(1, 10, "v1"), (1, 10, "v2"), (1, 10, "v2"), (1, 11, "v0"), (2, 10, "v5")]
    df = spark.createDataFrame(rows, "id bigint, number int, version string")
    found = listing.dedup_listing(df).collect()
    assert sorted(map(tuple, found)) == [(1, 10, "v2"), (1, 11, "v0"), (2, 10, "v5")]


@pytest.mark.parametrize(
    ("length", "slices", "sizes"),
    [(6, 3, [2, 2, 2]), (6, 7, [0, 1, 1, 1, 1, 1, 1]), (0, 2, [0, 0])],
)
def test_slice_bounds(length, slices, sizes):
    bounds = slicing.slice_bounds(length, slices)
    assert [high - low for low, high in bounds] == sizes
    assert bounds[0][0] == 0
    assert bounds[-1][1] == length


def test_no_slices(spark):
    with pytest.raises(ValueError, match="cannot hold any work"):
        slicing.slice_bounds(1, 0)
    with pytest.raises(ValueError, match="cannot hold any work"):
        slicing.slice_items(spark.range(1), 0)


@pytest.mark.parametrize("slices", [1, 7, 1200, 1300])
def test_slice_items(spark, skewed, slices):
    df, rows = skewed
    ranks = brute_ranks(rows)
    listed = spark.createDataFrame(
        [(n, i, ranks[i]) for n, i, _ in rows], "full_name string, id bigint, rank bigint"
    )
    found = slicing.slice_items(listed, slices).collect()
    assert sorted(r["position"] for r in found) == list(range(len(rows)))
    bounds = slicing.slice_bounds(len(rows), slices)
    for row in found:
        low, high = bounds[row["slice"]]
        assert low <= row["position"] < high
    # work of one repository stays together and in order
    by_repo = {}
    for row in found:
        by_repo.setdefault(row["full_name"], []).append((row["rank"], row["position"]))
    for pairs in by_repo.values():
        first = min(p for _, p in pairs)
        assert all(position == first + rank - 1 for rank, position in pairs)
