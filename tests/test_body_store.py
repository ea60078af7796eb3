"""Buckets, generations, compaction and retention of the body cache."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pullgrid.operators import body_store, cache
from pullgrid.plans import mirror


def rows(spark, held):
    """(id, version, fetched_ms) -> good cache rows."""
    full = [(i, v, f"{i} {v} {ms}", ms, 200, None, "ok") for i, v, ms in held]
    return spark.createDataFrame(full, cache.CACHE_SCHEMA)


def content(spark, root):
    found = cache.read_cache(spark, root).select("id", "version", "fetched_ms").collect()
    return sorted(tuple(r) for r in found)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def unbroadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_compaction_keeps_a_key_once_in_one_file_per_bucket(spark, tmp_path):
    root = str(tmp_path)
    cache.write_cache(rows(spark, [(i, "v", 1) for i in range(100)]), root)
    cache.write_cache(rows(spark, [(i, "v", 2) for i in range(0, 100, 3)] + [(7, "w", 1)]), root)
    assert len(content(spark, root)) == 135
    after = body_store.compact(spark, root)
    expected = sorted([(i, "v", 2 if i % 3 == 0 else 1) for i in range(100)] + [(7, "w", 1)])
    assert content(spark, root) == expected
    files = list((tmp_path / after.base.name).glob("*.parquet"))
    assert len(files) == after.base.buckets
    # a compacted cache can be appended to and compacted again
    cache.write_cache(rows(spark, [(7, "x", 9)]), root)
    body_store.compact(spark, root)
    assert content(spark, root) == sorted([*expected, (7, "x", 9)])


def test_rows_are_sorted_in_their_bucket(spark, tmp_path):
    import pyarrow.parquet as pq

    from pullgrid.sources.cached_bodies import bucket_of

    held = [(i * 7919 % 1000 - 500, v, 1) for i in range(1000) for v in ("b", "a")]
    cache.write_cache(rows(spark, held), str(tmp_path))
    base = body_store.compact(spark, str(tmp_path)).base
    for file in (tmp_path / base.name).glob("*.parquet"):
        table = pq.read_table(file, columns=["id", "version"])
        keys = [tuple(r.values()) for r in table.to_pylist()]
        assert keys == sorted(keys)
        number = int(file.name.split("_")[-1].split(".")[0])
        assert set(bucket_of(table.column("id").to_numpy(), base.buckets)) <= {number}


def test_a_lookup_opens_one_bucket(spark, tmp_path):
    cache.write_cache(rows(spark, [(i, "v", 1) for i in range(100)]), str(tmp_path))
    base = body_store.compact(spark, str(tmp_path), buckets=16).base
    assert base.buckets == 16
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        base_rows = body_store.sources(spark, body_store.open_store(spark, str(tmp_path)))[0]
        text = plan(base_rows.where("id = 42"))
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert "SelectedBucketsCount: 1 out of 16" in text


def test_asked_bodies_are_not_shuffled(spark, tmp_path, unbroadcast):
    """Base, delta and both joins: only items move."""
    root = str(tmp_path)
    cache.write_cache(rows(spark, [(i, "v", 1) for i in range(100)]), root)
    body_store.compact(spark, root)
    cache.write_cache(rows(spark, [(i, "w", 2) for i in range(50)]), root)
    asked = spark.createDataFrame([(i, "w") for i in range(80)], "id long, version string")
    store = body_store.open_store(spark, root)
    for found in (cache.asked_bodies(asked, store), cache.missing_from(asked, store)):
        text = plan(found)
        assert text.count("Bucketed: true") == 2
        # a scan of buckets stands below a sort, a filter and a projection, never an exchange
        lines = text.splitlines()
        for at in (n for n, line in enumerate(lines) if "Bucketed: true" in line):
            depth, above = lines[at].index("FileScan"), []
            for line in reversed(lines[:at]):
                start = len(line) - len(line.lstrip(" :+-*"))
                if start < depth:
                    depth = start
                    above.append(line[start:].split(" ")[0])
            joined = next(n for n, name in enumerate(above) if "Join" in name)
            assert "Exchange" not in above[:joined]
    assert cache.asked_bodies(asked, store).count() == 50
    assert "body" not in plan(cache.missing_from(asked, store))


def test_a_compaction_shuffles_once_or_not_at_all(spark, tmp_path, monkeypatch):
    root, plans, made = str(tmp_path), [], body_store._bucketed

    def seen(session, place, folder, write=None):
        if write is not None:
            plans.append(plan(write))
        return made(session, place, folder, write)

    for version in "abc":
        cache.write_cache(rows(spark, [(i, version, 1) for i in range(50)] + [(0, "a", 5)]), root)
        monkeypatch.setattr(body_store, "_bucketed", seen)
        after = body_store.compact(spark, root)
        monkeypatch.setattr(body_store, "_bucketed", made)
        assert plans[-1].count("Exchange") == (version > "a")
        assert len(list((tmp_path / after.base.name).glob("*.parquet"))) == after.base.buckets
    assert len(content(spark, root)) == 150


def test_groupings_over_base_and_delta_are_right(spark, sf, endpoint, tmp_path):
    """What a union of bucketed tables would get wrong."""
    root = str(tmp_path)
    work = mirror.ranked_listing(spark, sf)
    cache.fetch_misses(work, endpoint, root)
    body_store.compact(spark, root)
    cache.write_cache(cache.read_cache(spark, root).withColumn("fetched_ms", F.lit(1 << 50)), root)
    held = cache.read_cache(spark, root)
    assert (held.count(), held.select("id", "version").distinct().count()) == (3000, 1500)
    store = body_store.open_store(spark, root)
    found = cache.asked_bodies(work, store)
    assert found.groupBy("id").count().count() == found.count() == 1500
    assert found.where("fetched_ms < 1 << 50").count() == 0
    decoded = cache.decode_held(work, root, ["rank"])
    assert decoded.count() == decoded.select("id").distinct().count() == 1500
    assert cache.missing_from(work, store).count() == 0
    assert cache.fetch_through_cache(work, "https://127.0.0.1:1", root).count() == 1500
    assert cache.cached_pulls(held).count() == 1500


def test_readers_of_an_older_generation_go_on(spark, tmp_path):
    root = str(tmp_path)
    cache.write_cache(rows(spark, [(i, "v", 1) for i in range(20)]), root)
    before = cache.read_cache(spark, root)
    body_store.compact(spark, root)
    assert body_store.expire(spark, root, older_than=3600) == []
    assert before.count() == 20
    gone = body_store.expire(spark, root, older_than=-1)
    assert len(gone) == 1 and gone[0].startswith("delta-0")
    assert len(content(spark, root)) == 20
    assert body_store.expire(spark, root, older_than=-1) == []


def test_appends_during_a_compaction_are_kept(spark, tmp_path, monkeypatch):
    root, made = str(tmp_path), body_store._bucketed
    cache.write_cache(rows(spark, [(1, "v", 1)]), root)

    def slow(session, place, folder, write=None):
        if folder.name.startswith("base") and write is not None:
            monkeypatch.setattr(body_store, "_bucketed", made)
            cache.write_cache(rows(spark, [(2, "v", 1)]), root)
        return made(session, place, folder, write)

    monkeypatch.setattr(body_store, "_bucketed", slow)
    body_store.compact(spark, root)
    assert content(spark, root) == [(1, "v", 1), (2, "v", 1)]


def test_two_compactions_at_once_end_in_one(spark, tmp_path):
    root = str(tmp_path)
    store = body_store.open_store(spark, root)
    body_store._commit(spark, body_store.replace(store, number=1))
    with pytest.raises(RuntimeError, match="made by someone else"):
        body_store._commit(spark, body_store.replace(store, number=1))
    # a manifest that is not whole yet does not count
    (tmp_path / "generations" / "2.json").write_text('{"base": null')
    assert body_store.newest_generation(spark, store.root).number == 1


def test_retention_keeps_the_newest_versions_by_instant(spark, tmp_path):
    root = str(tmp_path)
    held = [
        (1, "2020-01-01T10:00:00+05:00", 9),
        (1, "2020-01-01T09:00:00Z", 1),
        (1, "2019-01-01T09:00:00Z", 5),
        (2, "2018-01-01T00:00:00Z", 1),
    ]
    cache.write_cache(rows(spark, held), root)
    body_store.compact(spark, root, keep=2)
    assert {r[:2] for r in content(spark, root)} == {h[:2] for h in held if "2019" not in h[1]}
    body_store.compact(spark, root, keep=1)
    assert content(spark, root) == [held[1], held[3]] or sorted(content(spark, root)) == sorted([held[1], held[3]])


def test_the_quarantine_outlives_a_compaction(spark, tmp_path):
    root = str(tmp_path)
    bad = [(3, "v", "{", 1, 200, "MALFORMED", "failed"), (4, "v", None, 1, 404, "HTTP_404", "failed")]
    cache.write_cache(spark.createDataFrame(bad, cache.CACHE_SCHEMA), root)
    for _ in range(2):
        assert cache.read_cache(spark, root).count() == 0
        assert cache.read_cache(spark, root, "failed").count() == 2
        body_store.compact(spark, root)


def test_files_of_the_data_source_are_absorbed(spark, sf, endpoint, tmp_path):
    import pullgrid

    pullgrid.register(spark)
    root = str(tmp_path)
    options = {"endpoint": endpoint, "user": "AFRICA", "repo": "NATION_0", "cacheDir": root}

    def read():
        return spark.read.format("pull_requests").options(**options).load().count()

    assert read() == 25
    after = body_store.compact(spark, root)
    assert after.absorbed and len(content(spark, root)) == 25
    files = sorted(p.name for p in (tmp_path / "outcome=ok").glob("*.parquet"))
    # tasks find the bodies in the buckets, and write nothing
    assert read() == 25
    assert sorted(p.name for p in (tmp_path / "outcome=ok").glob("*.parquet")) == files
    assert body_store.expire(spark, root, older_than=-1)
    assert not list((tmp_path / "outcome=ok").glob("*.parquet"))
    assert read() == 25 and len(content(spark, root)) == 25


def test_a_host_that_moved_on_is_asked_once(spark, sf, tmp_path):
    root, endpoint = str(tmp_path), mirror.moved_mirror(spark, sf)
    early = mirror.listed_at(spark, sf, 1)
    late = mirror.listed_at(spark, sf, mirror.TICKS)
    held = cache.fetch_through_cache(early, endpoint, root, by_version=False)
    moved = held.where("carried <> version").count()
    assert moved == early.where("k % 4 > 0").count() > 0
    # both the listed and the carried version find the body
    assert cache.fetch_misses(early, endpoint, root, by_version=False)["fetched"] == 0
    assert cache.fetch_misses(late, endpoint, root, by_version=False)["fetched"] == 0
    stored = cache.read_cache(spark, root)
    assert stored.count() == early.count()
    assert stored.where("version < listed").count() == 0
    body_store.compact(spark, root)
    assert cache.cache_misses(early, cache.read_cache(spark, root)).count() == 0
    assert cache.cache_misses(late, cache.read_cache(spark, root)).count() == 0


def test_the_same_version_is_taken_before_an_alias(spark, tmp_path):
    root = str(tmp_path)
    alias = rows(spark, [(1, "2", 9)]).withColumn("listed", F.lit("1"))
    cache.write_cache(alias, root)
    cache.write_cache(rows(spark, [(1, "1", 3)]), root)
    asked = spark.createDataFrame([(1, "1"), (1, "2")], "id long, version string")
    for _ in range(2):
        found = cache.newest_asked(cache.read_cache(spark, root), asked).collect()
        assert {(r.version, r.carried) for r in found} == {("1", "1"), ("2", "2")}
        store = body_store.open_store(spark, root)
        assert sorted(cache.asked_bodies(asked, store).collect()) == sorted(found)
        # the same over a base and a delta
        body_store.compact(spark, root)
        cache.write_cache(rows(spark, [(1, "1", 2), (2, "9", 1)]), root)


def test_a_compaction_sorts_bodies_once_and_settles_on_keys(spark, tmp_path, monkeypatch):
    """Windows over whole rows sorted (and spilled) each body three times."""
    root, plans, made = str(tmp_path), [], body_store._bucketed

    def seen(session, place, folder, write=None):
        if write is not None:
            plans.append(plan(write))
        return made(session, place, folder, write)

    given = [(i, v, t) for i in range(40) for v, t in (("2020-01-01T00:00:00Z", 1), ("2021-01-01T00:00:00Z", 2))]
    cache.write_cache(rows(spark, [*given, (7, "2021-01-01T00:00:00Z", 9), (None, "v", 1)]), root)
    monkeypatch.setattr(body_store, "_bucketed", seen)
    body_store.compact(spark, root, keep=1)
    assert "Window" not in plans[-1] and "Sort " not in plans[-1]
    held = [(i, "2021-01-01T00:00:00Z", 9 if i == 7 else 2) for i in range(40)]
    found = cache.read_cache(spark, root).select("id", "version", "fetched_ms").collect()
    assert sorted(map(tuple, found), key=str) == sorted([*held, (None, "v", 1)], key=str)


def plans_of(monkeypatch, name):
    """The plans of what is written from now on."""
    plans, made = [], getattr(body_store, name)

    def seen(*given, **named):
        written = given[-1] if name == "_laid" else (given[3:] or [None])[0]
        if written is not None and not isinstance(written, int):
            plans.append(plan(written))
        return made(*given, **named)

    monkeypatch.setattr(body_store, name, seen)
    return plans


def in_their_buckets(folder, buckets):
    import pyarrow.parquet as pq

    from pullgrid.sources.cached_bodies import bucket_of

    for file in folder.glob("*.parquet"):
        number = int(file.name.split("_")[-1].split(".")[0])
        table = pq.read_table(file, columns=["id", "version"])
        keys = [tuple(r.values()) for r in table.to_pylist()]
        assert keys == sorted(keys)
        assert set(bucket_of(table.column("id").to_numpy(), buckets)) <= {number}


def test_a_fetched_body_is_shuffled_once(spark, sf, endpoint, tmp_path, monkeypatch):
    """For its request and its place together: the second shuffle was by id again."""
    monkeypatch.setattr(cache, "FEW_ASKED", 0)
    root, work = str(tmp_path), mirror.ranked_listing(spark, sf)
    plans = plans_of(monkeypatch, "_bucketed")
    assert cache.fetch_misses(work, endpoint, root) == {"fetched": 1500, "failed": 0}
    assert plans[-1].count("Exchange ") == 2 and "ShuffledHashJoin" in plans[-1]
    store = body_store.open_store(spark, root)
    in_their_buckets(tmp_path / store.deltas[-1].name, store.buckets)
    assert cache.fetch_misses(work, endpoint, root) == {"fetched": 0, "failed": 0}
    decoded = cache.decode_held(work, root, ["rank"])
    assert decoded.count() == decoded.select("id").distinct().count() == 1500


def test_answers_that_do_not_name_their_id_are_met_by_address(spark, sf, endpoint, tmp_path, monkeypatch):
    from pullgrid.operators import fetch

    work = mirror.ranked_listing(spark, sf)
    odd = F.col("id") % 4
    held = fetch.mirror_table(spark, endpoint, "details")
    body = (
        F.when(odd == 1, F.regexp_replace("body", '^.."id":[0-9]+', '{"id":7'))
        .when(odd == 2, F.regexp_replace("body", '"id":[0-9]+,', ""))
        .otherwise(F.col("body"))
    )
    changed = held.where(odd < 3).withColumn("body", body)
    changed.write.partitionBy("owner", "repo").parquet(str(tmp_path / "odd" / "details"))
    found = []
    for few in (10**9, 0):
        monkeypatch.setattr(cache, "FEW_ASKED", few)
        root = str(tmp_path / f"cache-{few}")
        counts = cache.fetch_misses(work, str(tmp_path / "odd"), root, mode="PERMISSIVE")
        rows = body_store.stored(spark, body_store.open_store(spark, root))
        found.append((counts, sorted(map(tuple, rows.drop("fetched_ms").collect()), key=str)))
    assert found[0] == found[1]
    assert found[1][0]["fetched"] == len(found[1][1]) == 1500
    # a host with faults: what is bad is kept apart, and FAILFAST raises after all is asked
    with pytest.raises(RuntimeError, match="Invalid body|Request failed with code 404"):
        cache.fetch_misses(work, mirror.faulty_mirror(spark, sf), str(tmp_path / "faulty"))
    assert cache.read_cache(spark, str(tmp_path / "faulty")).count() == 272
    assert cache.read_cache(spark, str(tmp_path / "faulty"), "failed").count() == 1228


@pytest.mark.parametrize("buckets", [1, 8, 12, 200, 211, 600])
def test_partitions_of_an_append_agree_with_its_buckets(buckets):
    for rows in (1, 250_000, 94_500_000, 10**9):
        width = body_store.placing(buckets, rows)
        assert width % buckets == 0 or buckets % width == 0
        assert rows <= width * body_store.ROWS_PER_BUCKET


def test_a_single_folder_is_cut_into_more_buckets_in_place(spark, tmp_path, monkeypatch, unbroadcast):
    """Keys and bodies were shuffled for it, also those that do not stay."""
    monkeypatch.setattr(body_store, "ROWS_PER_BUCKET", 10)
    root, years = str(tmp_path), ("2020-01-01T00:00:00Z", "2021-01-01T00:00:00Z")
    cache.write_cache(rows(spark, [(i * 7919 % 1000, v, 1) for i in range(300) for v in years]), root)
    plans = plans_of(monkeypatch, "_laid")
    base = body_store.compact(spark, root, keep=1).base
    assert base.buckets == 64
    kept, bodies = [p for p in plans if "row_index" in p]
    assert "Exchange" not in kept and "Exchange" not in bodies
    in_their_buckets(tmp_path / base.name, 64)
    assert content(spark, root) == sorted((i * 7919 % 1000, years[1], 1) for i in range(300))
