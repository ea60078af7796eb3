from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from pullgrid.operators import body_store, cache, fetch
from pullgrid.plans import mirror


@pytest.fixture(scope="module")
def work(spark, sf):
    return mirror.ranked_listing(spark, sf)


def test_second_run_fetches_nothing(spark, work, endpoint, tmp_path):
    held = str(tmp_path / "cache")
    assert cache.fetch_misses(work, endpoint, held) == {"fetched": 1500, "failed": 0}
    assert cache.fetch_misses(work, endpoint, held) == {"fetched": 0, "failed": 0}
    rows = cache.fetch_through_cache(work, endpoint, held)
    assert rows.count() == 1500
    # nothing is asked of a host that has nothing new
    gone = cache.fetch_through_cache(work, "https://127.0.0.1:1", held)
    assert gone.count() == 1500


def test_stale_versions_are_misses(spark, sf, work):
    held = cache.read_cache(spark, mirror.warm_cache(spark, sf))
    assert cache.cache_hits(work, held).count() == 500
    assert cache.cache_misses(work, held).count() == 1000


def test_bad_bodies_do_not_poison_the_cache(spark, sf, work, tmp_path):
    faulty, held = mirror.faulty_mirror(spark, sf), str(tmp_path / "cache")
    with pytest.raises(RuntimeError, match="Invalid body|Request failed with code 404"):
        cache.fetch_misses(work, faulty, held)
    # what was good is kept, and only that
    assert cache.read_cache(spark, held).count() == 272
    rejected = cache.read_cache(spark, held, "failed")
    assert rejected.where("reason = 'HTTP_404'").count() == 136
    assert rejected.count() == 1228
    # a later run against a healthy host recovers everything
    good = mirror.host_mirror(spark, sf)
    assert cache.fetch_misses(work, good, held) == {"fetched": 1228, "failed": 0}
    assert cache.fetch_through_cache(work, good, held).count() == 1500


def test_permissive_returns_what_is_good(spark, sf, work, tmp_path):
    faulty, held = mirror.faulty_mirror(spark, sf), str(tmp_path / "cache")
    rows = cache.fetch_through_cache(work, faulty, held, mode="PERMISSIVE")
    assert rows.count() == 272
    assert rows.where("user IS NULL").count() == 136


def body(spark, sf):
    return mirror.details(spark, sf).select("body").first()["body"]


def test_newest_row_of_a_key_wins(spark, sf, tmp_path):
    text = body(spark, sf)
    later = json.dumps(json.loads(text) | {"title": "later"})
    rows = spark.createDataFrame(
        [(1, "v", later, 2, 200, None, "ok"), (1, "v", text, 1, 200, None, "ok")],
        cache.CACHE_SCHEMA,
    )
    cache.write_cache(rows, str(tmp_path))
    found = cache.cached_pulls(cache.read_cache(spark, str(tmp_path))).collect()
    assert [r["title"] for r in found] == ["later"]


def test_file_cache_is_readable(spark, sf, tmp_path):
    text = body(spark, sf)
    (tmp_path / "pr-7-2000-01-01T21=45=32Z.cache").write_text(text + "\n")
    (tmp_path / "other.txt").write_text("x")
    rows = cache.read_file_cache(spark, str(tmp_path))
    found = rows.collect()
    assert [(r["id"], r["version"]) for r in found] == [(7, "2000-01-01T21:45:32Z")]
    assert rows.columns == cache.CACHE_SCHEMA.names
    assert cache.cached_pulls(rows).count() == 1


def test_splits_read_no_bodies(spark, sf, work):
    held = cache.read_cache(spark, mirror.warm_cache(spark, sf))
    for split in (cache.cache_hits, cache.cache_misses):
        plan = split(work, held)._jdf.queryExecution().executedPlan().toString()
        scan = [line for line in plan.splitlines() if "fetched" in line or "pullgrid-cache" in line]
        assert scan
        assert not any("body" in line for line in scan)


def test_cached_columns_are_pruned_before_the_shuffle(spark, sf):
    held = cache.read_cache(spark, mirror.warm_cache(spark, sf))
    rows = cache.cached_pulls(held).select("title")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    # above the exchange neither the body nor other fields travel
    top = plan[: plan.index("Exchange")]
    assert "__body" not in top


def test_point_lookup(spark, endpoint):
    keys = spark.createDataFrame(
        [("AFRICA/NATION_0", 100000000), ("no/where", 1)], "full_name string, number int"
    )
    found = fetch.point_lookup(keys, endpoint, mirror.HOST).collect()
    assert {(r["full_name"], r["status"], r["reason"]) for r in found} == {
        ("AFRICA/NATION_0", 404, "HTTP_404"),
        ("no/where", 404, "HTTP_404"),
    }
    for bad in [("a/b/c", 1), ("a", 1), ("/b", 1), ("a/b", -1)]:
        one = spark.createDataFrame([bad], "full_name string, number int")
        with pytest.raises(Exception, match="Invalid key"):
            fetch.point_lookup(one, endpoint, mirror.HOST).collect()


def test_latest_snapshot_of_a_hot_id(spark):
    rows = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("id"),
        F.format_string("%05d", "id").alias("version"),
    )
    found = {r["id"]: r["version"] for r in cache.latest_snapshot(rows).collect()}
    assert len(found) == 3334
    assert found[0] == "04998"


def test_cache_folder_through_hadoop(spark, tmp_path):
    from pullgrid.folders import ready_dir

    path = tmp_path / "a" / "b"
    assert ready_dir(spark, str(path)) == f"file:{path}"
    assert path.stat().st_mode & 0o777 == 0o777
    (tmp_path / "file").write_text("x")
    with pytest.raises(ValueError, match="is not a directory"):
        ready_dir(spark, str(tmp_path / "file"))
    (tmp_path / "locked").mkdir(mode=0o444)
    with pytest.raises(ValueError, match="no right to read and write"):
        ready_dir(spark, str(tmp_path / "locked"))


def test_absent_and_damaged_entries(spark, tmp_path):
    assert cache.read_cache(spark, str(tmp_path / "new")).count() == 0
    rows = spark.createDataFrame([(1, "v", "{", 2, 200, None, "ok")], cache.CACHE_SCHEMA)
    cache.write_cache(rows, str(tmp_path / "new"))
    with pytest.raises(Exception, match="Invalid body: MALFORMED"):
        cache.cached_pulls(cache.read_cache(spark, str(tmp_path / "new"))).collect()


def test_an_unasked_damaged_row_harms_nothing_and_an_asked_one_is_a_miss(spark, sf, endpoint, tmp_path):
    from pullgrid.plans import mirror

    work = mirror.ranked_listing(spark, sf).where("k < 4")
    rows = work.select("id", "version").orderBy("id").collect()
    held = str(tmp_path / "held")
    bad = [
        (rows[0]["id"], rows[0]["version"], "{", 0, 200, None, "ok"),
        (1, "2020-01-01T00:00:00Z", "{", 0, 200, None, "ok"),
    ]
    cache.write_cache(spark.createDataFrame(bad, cache.CACHE_SCHEMA), held)
    got = cache.fetch_through_cache(work, endpoint, held)
    assert {r["id"] for r in got.select("id").collect()} == {r["id"] for r in rows}
    assert cache.read_cache(spark, held).where("fetched_ms > 0").count() == 4


def test_versions_order_by_the_instant_they_name(spark):
    rows = [(1, "2020-01-01T10:00:00+05:00", "old"), (1, "2020-01-01T09:00:00Z", "new")]
    found = cache.latest_snapshot(spark.createDataFrame(rows, "id long, version string, state string"))
    assert [r["state"] for r in found.collect()] == ["new"]


def test_rows_of_a_micro_batch_are_never_broadcast(spark, sf, endpoint, tmp_path):
    """A micro-batch has the statistics of the manifests it was read from, however long it is."""
    root = str(tmp_path)
    listed = mirror.ranked_listing(spark, sf)
    cache.fetch_misses(listed, endpoint, root)
    few = spark.createDataFrame(listed.select("id", "version", "rank").head(3))
    rows = cache.decode_held(few, root, ["rank"]).select("id", "rank", "title")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "ShuffledHashJoin" in plan
    assert rows.count() == 3


def test_keys_of_a_micro_batch_are_never_broadcast(spark, sf, endpoint, tmp_path):
    """Nor where it is settled which row of the cache answers for a key, however many parts there are."""
    root = str(tmp_path)
    listed = mirror.ranked_listing(spark, sf)
    cache.fetch_misses(listed, endpoint, root)
    body_store.compact(spark, root)
    cache.fetch_misses(listed.withColumn("version", F.lit("2030-01-01T00:00:00Z")), endpoint, root, by_version=False)
    few = spark.createDataFrame(listed.select("id", "version").head(3))
    parts = body_store.sources(spark, body_store.open_store(spark, root))
    places = cache._newest_places(few, parts)
    plan = places._jdf.queryExecution().executedPlan().toString()
    assert len(parts) == 2 and plan.count("ShuffledHashJoin") == 2 and "BroadcastExchange" not in plan
    assert places.count() == 3


def test_bodies_are_joined_without_a_sort(spark, sf, endpoint, tmp_path):
    """Neither a mirror's bodies nor those of the cache are sorted: a sort of them spills."""
    root = str(tmp_path)
    listed = mirror.ranked_listing(spark, sf)
    answers = fetch.fetch(listed, endpoint)
    cache.fetch_misses(listed, endpoint, root)
    held = cache.asked_bodies(listed, body_store.open_store(spark, root))
    for rows in (answers, held):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert not [line for line in plan.splitlines() if "Sort [" in line and "body" in line]
        assert "SortMergeJoin" not in plan.split("ShuffledHashJoin")[0]
        assert rows.where("body IS NOT NULL").count() == 1500
