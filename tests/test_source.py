from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import pullgrid
from pullgrid.functions.schema import PULL_REQUEST_SCHEMA
from pullgrid.operators.listing import list_top_batch
from pullgrid.plans import mirror
from pullgrid.sources.options import parse
from pullgrid.sources.pull_requests import (
    PullRequestReader,
    PushdownReader,
    WalksPartition,
)


@pytest.fixture(scope="module", autouse=True)
def registered(spark):
    pullgrid.register(spark)


def read(spark, endpoint, cache, **options):
    reader = spark.read.format("pull_requests").option("endpoint", endpoint)
    return reader.option("cacheDir", str(cache)).options(**options).load()


def test_schema(spark, endpoint, tmp_path):
    df = read(spark, endpoint, tmp_path / "c")
    assert df.schema == PULL_REQUEST_SCHEMA
    assert len(df.columns) == 22
    assert df.columns[15:18] == ["merged", "mergeable", "comments"]
    # looking at the schema leaves nothing behind
    assert not (tmp_path / "c").exists()


def test_default_batch_is_the_newest_25(spark, sf, endpoint, tmp_path):
    df = read(spark, endpoint, tmp_path, user=" AFRICA ", repo="NATION_0")
    listed = mirror.listing(spark, sf).where("full_name = 'AFRICA/NATION_0'")
    expected = {r["id"] for r in list_top_batch(listed, 25).collect()}
    assert {r["id"] for r in df.collect()} == expected
    assert len(expected) == 25


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_partition_count_never_changes_rows(spark, sf, endpoint, tmp_path, partitions):
    repos = ["AFRICA/NATION_0", "ASIA/NATION_2"]
    options = {"repos": ",".join(repos), "batch": 60, "numPartitions": partitions}
    rows = read(spark, endpoint, tmp_path, **options).select("id").collect()
    listed = mirror.listing(spark, sf).where(F.col("full_name").isin(repos))
    expected = [r["id"] for r in list_top_batch(listed, 60).collect()]
    assert sorted(r["id"] for r in rows) == sorted(expected)


def test_listing_is_left_to_tasks(endpoint, tmp_path):
    options = {"user": "AFRICA", "repo": "NATION_0", "endpoint": "/nowhere", "batch": "all"}
    options["cacheDir"] = str(tmp_path)
    parts = PullRequestReader(parse(options, 8)).partitions()
    assert [len(p.walks) for p in parts] == [1] * 8
    assert all(isinstance(p, WalksPartition) for p in parts)


@pytest.mark.parametrize("partitions", [1, 2, 9])
def test_whole_repositories(spark, sf, endpoint, tmp_path, partitions):
    """More pages than tasks, fewer, and a short last page."""
    repos = ["AFRICA/NATION_0", "ASIA/NATION_2"]
    df = read(spark, endpoint, tmp_path, repos=",".join(repos), batch="all", numPartitions=partitions)
    listed = mirror.listing(spark, sf).where(F.col("full_name").isin(repos))
    assert sorted(r["id"] for r in df.select("id").collect()) == sorted(
        r["id"] for r in listed.select("id").collect()
    )


def test_a_missing_token_is_told(tmp_path):
    options = {"endpoint": "https://host.test", "cacheDir": str(tmp_path)}
    with pytest.warns(UserWarning, match="no 'token' option"):
        PullRequestReader(parse(options, 8)).partitions()


def test_cache_is_written_and_read(spark, endpoint, tmp_path):
    options = {"user": "AFRICA", "repo": "NATION_0"}
    first = read(spark, endpoint, tmp_path, **options).orderBy("id").collect()
    files = sorted((tmp_path / "outcome=ok").glob("*.parquet"))
    assert files
    again = read(spark, endpoint, tmp_path, **options).orderBy("id").collect()
    assert again == first
    assert sorted((tmp_path / "outcome=ok").glob("*.parquet")) == files


def test_source_and_operators_share_the_cache(spark, sf, endpoint, tmp_path):
    from pullgrid.operators import cache

    read(spark, endpoint, tmp_path, user="AFRICA", repo="NATION_0").count()
    held = cache.read_cache(spark, str(tmp_path))
    work = mirror.ranked_listing(spark, sf)
    assert cache.cache_hits(work, held).count() == 25
    assert cache.fetch_misses(work, endpoint, str(tmp_path))["fetched"] == 1475
    assert read(spark, "/nowhere/at/all", tmp_path / "x").schema == PULL_REQUEST_SCHEMA


def test_user_schema_is_rejected(spark, endpoint, tmp_path):
    with pytest.raises(Exception, match="User-defined schema is not supported"):
        spark.read.format("pull_requests").schema("id int").option("endpoint", endpoint).option(
            "cacheDir", str(tmp_path)
        ).load().count()
    with pytest.raises(Exception, match="User-defined schema is not supported"):
        spark.readStream.format("pull_requests").schema("id int").load().writeStream.format(
            "noop"
        ).trigger(availableNow=True).start().awaitTermination()


def test_option_errors_surface(spark):
    with pytest.raises(Exception, match="option 'batch' is 0, outside"):
        spark.read.format("pull_requests").option("batch", 0).load()


def test_unknown_repository(spark, endpoint, tmp_path):
    with pytest.raises(Exception, match="Request failed with code 404"):
        read(spark, endpoint, tmp_path, user="no", repo="where").collect()


def faulty_endpoint(spark, sf, tmp_path):
    """Good listing, faulty details."""
    root = tmp_path / "faulty"
    root.mkdir()
    good, bad = mirror.host_mirror(spark, sf), mirror.faulty_mirror(spark, sf)
    (root / "pages").symlink_to(f"{good.removeprefix('file:')}/pages")
    (root / "details").symlink_to(f"{bad.removeprefix('file:')}/details")
    return str(root)


def test_modes(spark, sf, tmp_path):
    endpoint = faulty_endpoint(spark, sf, tmp_path)
    options = {"user": "AFRICA", "repo": "NATION_0", "batch": 1000}
    with pytest.raises(Exception, match="Invalid body|Request failed with code 404"):
        read(spark, endpoint, tmp_path / "a", **options).collect()
    rows = read(spark, endpoint, tmp_path / "b", mode="PERMISSIVE", **options).collect()
    listed = mirror.listing(spark, sf).where("full_name = 'AFRICA/NATION_0'")
    good = listed.where("k % 11 IN (6, 10)").count()
    assert len(rows) == good
    from pullgrid.operators.cache import read_cache

    assert read_cache(spark, str(tmp_path / "b"), "failed").count() == listed.count() - good


def test_sql(spark, endpoint, tmp_path):
    spark.sql(
        f"""CREATE TEMPORARY TABLE some_prs USING pull_requests
        OPTIONS (user "AFRICA", repo "NATION_0", endpoint "{endpoint}", cacheDir "{tmp_path}")"""
    )
    assert spark.sql("SELECT number, title FROM some_prs LIMIT 10").count() == 10
    assert spark.sql("SELECT base.repo.full_name FROM some_prs").distinct().count() == 1


def test_filters_save_requests(endpoint, tmp_path):
    from pyspark.sql.datasource import EqualTo, GreaterThan, In

    options = {"user": "AFRICA", "repo": "NATION_0", "endpoint": endpoint}
    options["cacheDir"] = str(tmp_path)
    listed = lambda r: [w for p in r.partitions() for w in r._work(p)]
    everything = PullRequestReader(parse(options, 8))
    numbers = [item.number for *_, item in listed(everything)]
    reader = PushdownReader(parse(options, 8))
    filters = [In(("number",), tuple(numbers[:3])), GreaterThan(("commits",), 1)]
    assert list(reader.pushFilters(filters)) == filters
    assert sorted(w[-1].number for w in listed(reader)) == sorted(numbers[:3])
    reader = PushdownReader(parse(options, 8))
    list(reader.pushFilters([EqualTo(("base", "repo", "id"), 1)]))
    assert len(listed(reader)) == 25


def test_pushdown_through_spark(spark, endpoint, tmp_path):
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        pullgrid.register(spark)
        df = read(spark, endpoint, tmp_path, user="AFRICA", repo="NATION_0")
        number = df.select(F.max("number")).first()[0]
        other = tmp_path / "other"
        again = read(spark, endpoint, other, user="AFRICA", repo="NATION_0")
        assert again.where(F.col("number") == number).count() == 1
        import pyarrow.dataset as ds

        assert ds.dataset(str(other / "outcome=ok"), format="parquet").count_rows() == 1
        # dates of the listing save requests as well
        cut = df.orderBy(F.desc("created_at")).select("created_at").collect()[4][0]
        dated = tmp_path / "dated"
        newer = read(spark, endpoint, dated, user="AFRICA", repo="NATION_0").where(F.col("created_at") >= F.lit(cut))
        found = newer.count()
        assert found >= 5
        assert ds.dataset(str(dated / "outcome=ok"), format="parquet").count_rows() == found
    finally:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "false")
        pullgrid.register(spark)


def test_ranges_of_listed_dates_save_requests(endpoint, tmp_path):
    from datetime import UTC, datetime

    from pyspark.sql.datasource import GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual

    options = {"user": "AFRICA", "repo": "NATION_0", "endpoint": endpoint, "cacheDir": str(tmp_path)}

    def listed(*filters):
        reader = PushdownReader(parse(options, 8))
        assert list(reader.pushFilters(filters)) == list(filters)
        return [w[-1] for p in reader.partitions() for w in reader._work(p)]

    instant = lambda text: datetime.fromisoformat(text)
    everything = listed()
    created = sorted(instant(i.created_at) for i in everything)
    updated = sorted(instant(i.updated_at) for i in everything if i.updated_at)
    assert len(updated) < len(everything)
    middle = created[12]
    for kind, holds in (
        (GreaterThan, lambda x: x > middle),
        (GreaterThanOrEqual, lambda x: x >= middle),
        (LessThan, lambda x: x < middle),
        (LessThanOrEqual, lambda x: x <= middle),
    ):
        assert len(listed(kind(("created_at",), middle))) == sum(map(holds, created))
    # an item without the date fails any range of it
    assert len(listed(LessThanOrEqual(("updated_at",), updated[-1]))) == len(updated)
    both = listed(GreaterThan(("created_at",), created[3]), LessThan(("created_at",), created[-3]))
    assert {instant(i.created_at) for i in both} <= set(created[4:-3])
    # what the listing does not know is left to Spark
    assert len(listed(GreaterThan(("closed_at",), datetime(2100, 1, 1, tzinfo=UTC)))) == 25


def test_bodies_as_text(spark, sf, endpoint, tmp_path):
    from pullgrid.sources.pull_requests import BODY_SCHEMA

    options = {"endpoint": endpoint, "user": "AFRICA", "repo": "NATION_0", "cacheDir": str(tmp_path)}
    raw = spark.read.format("pull_request_bodies").options(**options).load()
    assert raw.schema == BODY_SCHEMA
    rows = raw.collect()
    assert sorted(r["rank"] for r in rows) == list(range(1, 26))
    typed = read(spark, endpoint, tmp_path, user="AFRICA", repo="NATION_0").orderBy("id").collect()
    table = pullgrid.pull_requests(spark, **options)
    assert table.schema == PULL_REQUEST_SCHEMA or [f.name for f in table.schema] == PULL_REQUEST_SCHEMA.names
    assert table.orderBy("id").collect() == typed
    pullgrid.create_view(spark, "prs_by_text", **options)
    top = spark.sql("SELECT number, base.repo.full_name AS n FROM prs_by_text ORDER BY id DESC LIMIT 3")
    assert [r["number"] for r in top.collect()] == [r["number"] for r in typed[::-1][:3]]
    with pytest.raises(Exception, match="cannot be read as a stream"):
        spark.readStream.format("pull_request_bodies").options(**options).load().writeStream.format(
            "noop"
        ).trigger(availableNow=True).start().awaitTermination()


def test_modes_of_text_bodies(spark, sf, tmp_path):
    endpoint = faulty_endpoint(spark, sf, tmp_path)
    options = {"endpoint": endpoint, "user": "AFRICA", "repo": "NATION_0", "batch": 1000}
    with pytest.raises(Exception, match="Invalid body|Request failed with code 404"):
        pullgrid.pull_requests(spark, cacheDir=str(tmp_path / "a"), **options).collect()
    rows = pullgrid.pull_requests(spark, cacheDir=str(tmp_path / "b"), mode="PERMISSIVE", **options)
    listed = mirror.listing(spark, sf).where("full_name = 'AFRICA/NATION_0'")
    assert rows.count() == listed.where("k % 11 IN (6, 10)").count()


def test_a_cluster_needs_a_shared_folder():
    from pullgrid.sources.options import DEFAULT_CACHE_DIR

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        parse({}, 8, None)
    named = parse({"cacheDir": "hdfs://x/c"}, 8, None)
    assert named.cache_dir == "hdfs://x/c" and named.listing_dir.startswith("hdfs://x/c-listing/")
    assert parse({}, 8).cache_dir == DEFAULT_CACHE_DIR
