from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import pullgrid
from pullgrid.functions.schema import PULL_REQUEST_SCHEMA
from pullgrid.plans import mirror
from pullgrid.sources import listing_log
from pullgrid.sources.options import POLL_SECONDS, parse
from pullgrid.sources.pull_requests import PullRequestStreamReader
from pullgrid.streaming import changes, log

REPO = {"user": "AFRICA", "repo": "NATION_0"}


@pytest.fixture(scope="module", autouse=True)
def registered(spark):
    pullgrid.register(spark)


def reader(endpoint, tmp_path, **options):
    options = REPO | {"endpoint": endpoint} | options
    options |= {"listingDir": str(tmp_path / "log"), "cacheDir": str(tmp_path / "cache")}
    return PullRequestStreamReader(parse(options, 4), PULL_REQUEST_SCHEMA)


def test_poll_interval_is_59_seconds():
    assert POLL_SECONDS == 59


def test_polls_only_after_the_interval(endpoint, tmp_path):
    slow = reader(endpoint, tmp_path)
    assert slow.latestOffset() == {"tick": 1}
    assert slow.latestOffset() == {"tick": 1}
    fast = reader(endpoint, tmp_path, pollInterval="0")
    assert fast.latestOffset() == {"tick": 2}
    assert slow.latestOffset() == {"tick": 2}


def test_a_new_query_starts_with_the_current_listing(endpoint, tmp_path):
    one = reader(endpoint, tmp_path, pollInterval="0")
    for _ in range(3):
        end = one.latestOffset()
    assert one.initialOffset() == {"tick": 2}
    assert reader(endpoint, tmp_path, startingTick="0").initialOffset() == {"tick": 0}
    parts = one.partitions(one.initialOffset(), end)
    assert {p.tick for p in parts} == {3}
    assert one.partitions(end, end) == []


def test_slices_cover_a_snapshot_once(endpoint, tmp_path):
    one = reader(endpoint, tmp_path, batch="1000")
    row = {"full_name": "AFRICA/NATION_0", "rank": 1, "id": 1, "number": 1, "url": "u", "version": "v"}
    listing_log.write_tick(str(tmp_path / "log"), 1, [row | {"id": k} for k in range(103)])
    parts = one.partitions({"tick": 0}, one.latestOffset())
    sizes = [sum(high - low for *_, low, high in p.segments) for p in parts]
    assert max(sizes) - min(sizes) <= 1
    ids = [w[-1].id for p in parts for w in one._work(p)]
    assert len(ids) == len(set(ids)) == sum(sizes) == 103


def test_tasks_list_a_tick_and_a_second_attempt_finds_the_first(endpoint, tmp_path, monkeypatch):
    from pullgrid.sources import pull_requests

    log_dir = str(tmp_path / "log")
    one = reader(endpoint, tmp_path, batch="all", numPartitions="3")
    end = one.latestOffset()
    # the driver has listed nothing
    assert [p.name for p in (tmp_path / "log" / "tick=1").iterdir()] == ["begun"]
    parts = one.partitions({"tick": 0}, end)
    assert len(parts) == 3 and all(isinstance(p, pull_requests.ListPartition) for p in parts)
    first = [sorted(w[-1].id for w in one._work(p)) for p in parts[:2]]
    with pytest.raises(RuntimeError, match="no complete tick 1"):
        listing_log.parts_of(log_dir, 1)
    # the host has changed: attempts that run again, also of another session, keep to the log
    asked = []

    def moved(options, user, repo, page):
        asked.append(page)
        return [], True

    monkeypatch.setattr(pull_requests, "list_page", moved)
    again = reader(endpoint, tmp_path, batch="all", numPartitions="7")
    same = again.partitions({"tick": 0}, end)
    assert sum(len(p.walks) for p in same) == 3
    ids = sorted(w[-1].id for p in same for w in again._work(p))
    assert ids == sorted(i for held in first for i in held) and len(asked) == 1
    # the last walk made it complete, and now it is read from the files
    assert len(listing_log.parts_of(log_dir, 1)) == 3
    planned = again.partitions({"tick": 0}, end)
    assert all(isinstance(p, pull_requests.LogPartition) for p in planned)
    assert sorted(w[-1].id for p in planned for w in again._work(p)) == ids


def test_recording_a_tick_twice_keeps_the_first(spark, tmp_path):
    rows = [("a/b", 1, 1, 1, "u", "v")]
    shape = "full_name string, rank long, id long, number int, url string, version string"
    log_dir = str(tmp_path / "log")
    assert log.record_tick(spark.createDataFrame(rows, shape), log_dir, 1)
    assert not log.record_tick(spark.createDataFrame(rows * 2, shape), log_dir, 1)
    assert log.read_tick(spark, log_dir, 1).count() == 1
    assert log.record_tick(spark.createDataFrame([], shape), log_dir, 2)
    assert log.read_tick(spark, log_dir, 2).count() == 0
    assert log.complete_ticks(spark, log_dir) == [1, 2]


SNAPSHOT = "full_name string, rank long, id long, number int, url string, version string"


def test_differences_name_what_is_gone(spark):
    before = [("a/b", 1, 1, 1, "u1", "1"), ("a/b", 2, 2, 2, "u2", "1"), ("c/d", 1, 1, 9, "u9", "1")]
    after = [("a/b", 1, 2, 2, "u2", "2"), ("a/b", 2, 3, 3, "u3", "1"), ("a/b", 3, 2, 2, "u2", "1"),
             ("c/d", 1, 1, 9, "u9", "1")]
    rows = log.tick_difference(
        spark.createDataFrame(before, SNAPSHOT), spark.createDataFrame(after, SNAPSHOT)
    )
    assert sorted((r["full_name"], r["id"], r["number"], r["change"], r["version"], r["was"]) for r in rows.collect()) == [
        ("a/b", 1, 1, "gone", None, "1"),
        ("a/b", 2, 2, "update", "2", "1"),
        ("a/b", 3, 3, "insert", "1", None),
    ]
    first = log.tick_difference(None, spark.createDataFrame(before, SNAPSHOT)).collect()
    assert {r["change"] for r in first} == {"insert"} and len(first) == 3


def test_bounded_changes_forget_what_is_no_longer_listed(spark, tmp_path):
    """Ids 0 to 9 are always listed, 1000 others at one tick each; one comes back."""
    shape = "id long, version string, tick int"
    version = lambda n: f"2020-01-0{n}T00:00:00Z"
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    expected, sizes = set(), []
    for tick in range(1, 9):
        rows = [(k, version(1 if tick < 5 else 2), tick) for k in range(10)]
        rows += [(tick * 1000 + k, version(1), tick) for k in range(100)]
        rows += [(7, version(1), tick)] * 2  # an older version listed again
        if tick == 8:
            rows.append((1000, version(1), tick))
        expected |= {(i, v, tick) for i, v, _ in rows if i >= 1000}
        expected |= {(k, version(1 if tick == 1 else 2), tick) for k in range(10) if tick in (1, 5)}
        spark.createDataFrame(rows, shape).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(shape).parquet(source)
        timed = stream.withColumn("at", F.timestamp_seconds(F.col("tick") * 60))
        query = (
            changes.bounded_changes(timed, "at", 60, buckets=16)
            .writeStream.format("parquet")
            .option("checkpointLocation", str(tmp_path / "checkpoint"))
            .trigger(availableNow=True)
            .start(out)
        )
        query.awaitTermination()
        sizes.append(query.lastProgress["stateOperators"][0]["memoryUsedBytes"])
    found = [tuple(r) for r in spark.read.parquet(out).select("id", "version", "tick").collect()]
    assert sorted(found) == sorted(expected)
    # state does not grow with the history
    assert max(sizes[5:]) <= 1.2 * max(sizes[2:5])


def test_memory_holds_what_was_listed_lately():
    held, emitted = {}, 0
    for tick in range(1, 50):
        rows = [(tick * 60, 1, 5, "v", tick)] + [(tick * 60, tick * 1000 + k, 5, "v", tick) for k in range(100)]
        emitted += len(changes.remember(held, rows, span=60))
        held = changes.forget(held, tick * 60 - 120)
        assert len(held) <= 1 + 3 * 100
    assert emitted == 1 + 49 * 100
    # late and equal versions are no change; a later one is; a gap beyond the span is
    held = {}
    steps = [(0, 5, "b"), (10, 4, "c"), (20, 5, "b"), (30, 6, "a"), (91, 6, "a"), (100, 5, "z")]
    new = [changes.remember(held, [(at, 1, i, v, 0)], span=60) for at, i, v in steps]
    assert [len(n) for n in new] == [1, 0, 0, 1, 1, 0]


@pytest.mark.parametrize("cut", [1, 2])
def test_the_later_tick_stays_however_rows_are_cut(spark, tmp_path, cut):
    rows = [(1, 10, "early", 1), (1, 10, "late", 2)]
    steps = [rows] if cut == 1 else [rows[:1], rows[1:]]
    for name, order in (("forward", steps), ("backward", steps[::-1])):
        table, checkpoint = str(tmp_path / name), str(tmp_path / f"{name}-checkpoint")
        schema = batches(
            spark, tmp_path, f"{name}-in", order, lambda s: changes.start_upsert(s, table, checkpoint)
        )
        held = changes.current_state(spark, table, schema).collect()
        assert [r["state"] for r in held] == ["late"]


def test_text_versions_order_by_instant(spark, tmp_path):
    shape = "id bigint, version string, state string"
    held, schema = str(tmp_path / "table"), None
    for number, version in enumerate(["2020-01-01T09:00:00Z", "2020-01-01T10:00:00+05:00", "junk"]):
        rows = spark.createDataFrame([(1, version, str(number))], shape)
        changes.upsert_writer(held, rows.schema)(rows, number)
        schema = rows.schema
    assert [r["state"] for r in changes.current_state(spark, held, schema).collect()] == ["0"]


def test_incomplete_ticks_do_not_count(endpoint, tmp_path):
    one = reader(endpoint, tmp_path)
    one.latestOffset()
    (tmp_path / "log" / "tick=2").mkdir()
    assert listing_log.last_tick(str(tmp_path / "log"))[0] == 1
    with pytest.raises(RuntimeError, match="no complete tick 2"):
        listing_log.plan_tick(str(tmp_path / "log"), 2, 1)


def test_two_pollers_keep_one_snapshot(endpoint, tmp_path):
    log_dir = str(tmp_path / "log")
    row = {"full_name": "a/b", "rank": 1, "id": 1, "number": 1, "url": "u", "version": "v"}
    listing_log.write_tick(log_dir, 1, [row])
    listing_log.write_tick(log_dir, 1, [row | {"id": 2}, row | {"id": 3}])
    ((segments,),) = (listing_log.plan_tick(log_dir, 1, 1),)
    (batch,) = listing_log.read_segments(log_dir, segments)
    assert [r["id"] for r in batch.to_pylist()] == [1]
    assert [p.name for p in (tmp_path / "log").iterdir()] == ["tick=1"]


def test_a_log_of_other_repositories_is_refused(endpoint, tmp_path):
    reader(endpoint, tmp_path).latestOffset()
    other = reader(endpoint, tmp_path, user="ASIA", repo="NATION_2", pollInterval="0")
    with pytest.raises(ValueError, match="belongs to other repositories"):
        other.latestOffset()


def test_restart_neither_loses_nor_repeats(spark, endpoint, tmp_path):
    def run(query_ticks):
        stream = (
            spark.readStream.format("pull_requests")
            .options(**REPO, endpoint=endpoint, includeTick=True, startingTick=0)
            .options(listingDir=str(tmp_path / "log"), cacheDir=str(tmp_path / "cache"))
            .option("pollInterval", 0 if query_ticks else 1e9)
            .load()
        )
        stream.select("id", "tick").writeStream.format("parquet").option(
            "checkpointLocation", str(tmp_path / "checkpoint")
        ).trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()

    for polling in (True, True, False, True):
        run(polling)
    rows = spark.read.parquet(str(tmp_path / "out")).groupBy("tick", "id").count().collect()
    ticks = {r["tick"] for r in rows}
    assert ticks == set(range(1, max(ticks) + 1))
    assert len(rows) == 25 * len(ticks)
    assert {r["count"] for r in rows} == {1}


def batches(spark, tmp_path, name, steps, start):
    """Run ``start`` on a file stream, one file per micro-batch."""
    shape = "id bigint, version bigint, state string, tick int"
    source = tmp_path / name
    for number, rows in enumerate(steps):
        spark.createDataFrame(rows, shape).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(shape).parquet(str(source))
        start(stream).awaitTermination()
    return stream.schema


STEPS = [
    [(1, 10, "open", 1), (2, 10, "open", 1), (1, 10, "open", 1)],
    [(1, 10, "open", 2), (2, 11, "closed", 2)],
    [(1, 12, "closed", 3), (2, 11, "closed", 3), (3, 1, "open", 3)],
    [(2, 10, "open", 4), (3, 1, "open", 4)],
    [],
]


def test_changes(spark, tmp_path):
    sink, checkpoint = str(tmp_path / "sink"), str(tmp_path / "checkpoint")
    schema = batches(
        spark, tmp_path, "in", STEPS, lambda s: changes.start_changes(s, sink, checkpoint)
    )
    rows = changes.read_changes(spark, sink, schema).collect()
    assert sorted((r["id"], r["version"], r["tick"]) for r in rows) == [
        (1, 10, 1),
        (1, 12, 3),
        (2, 10, 1),
        (2, 11, 2),
        (3, 1, 3),
    ]


@pytest.mark.parametrize("compact_every", [2, 100])
def test_upsert(spark, tmp_path, compact_every):
    table, checkpoint = str(tmp_path / "table"), str(tmp_path / "checkpoint")
    schema = batches(
        spark,
        tmp_path,
        "in",
        STEPS,
        lambda s: changes.start_upsert(s, table, checkpoint, compact_every),
    )
    rows = changes.current_state(spark, table, schema).collect()
    assert sorted((r["id"], r["version"], r["state"]) for r in rows) == [
        (1, 12, "closed"),
        (2, 11, "closed"),
        (3, 1, "open"),
    ]
    bases = list((tmp_path / "table").glob("base/upto=*"))
    assert bool(bases) == (compact_every == 2)


def test_of_equal_versions_the_later_tick_stays(spark, tmp_path):
    steps = [[(1, 10, "early", 1), (1, 10, "late", 2)]]
    table, checkpoint = str(tmp_path / "table"), str(tmp_path / "checkpoint")
    schema = batches(
        spark, tmp_path, "in", steps, lambda s: changes.start_upsert(s, table, checkpoint)
    )
    assert [r["state"] for r in changes.current_state(spark, table, schema).collect()] == ["late"]


def test_ingest_fetches_each_version_once(spark, sf, tmp_path):
    """Tick by tick, with a fresh query each time, against the recorded log."""
    endpoint = mirror.tick_mirror(spark, sf)
    recorded = mirror.tick_log(spark, sf).removeprefix("file:")
    growing = tmp_path / "log"
    growing.mkdir()
    held = str(tmp_path / "cache")
    from pullgrid.operators.cache import read_cache

    versions = mirror.tick_versions(spark, sf)
    for tick in range(1, mirror.TICKS + 1):
        (growing / f"tick={tick}").symlink_to(f"{recorded}/tick={tick}")
        listed = log.listing_stream(spark, str(growing))
        log.start_ingest(listed, endpoint, held, str(tmp_path / "checkpoint")).awaitTermination()
        keys = read_cache(spark, held).groupBy("id", "version").count()
        expected = versions.where(F.col("tick") <= tick).select("id", "version").distinct()
        assert keys.where("count > 1").count() == 0
        assert keys.count() == expected.count()
        assert keys.join(expected, ["id", "version"], "left_anti").count() == 0


def test_decoded_stream_fetches_a_version_once(spark, sf, tmp_path):
    """All ticks in one micro-batch: every listed row is written, every version fetched once."""
    from pullgrid.operators.cache import read_cache

    out, held = str(tmp_path / "out"), str(tmp_path / "cache")

    def write(rows, batch_id):
        rows.select("id", "tick", "state").write.mode("overwrite").parquet(f"{out}/b={batch_id}")

    listed = log.listing_stream(spark, mirror.tick_log(spark, sf))
    endpoint, checkpoint = mirror.tick_mirror(spark, sf), str(tmp_path / "checkpoint")
    log.start_decoded(listed, endpoint, held, checkpoint, write).awaitTermination()
    versions = mirror.tick_versions(spark, sf)
    assert spark.read.parquet(out).count() == versions.count()
    distinct = versions.select("id", "version").distinct().count()
    assert read_cache(spark, held).count() == distinct


def test_state_buckets_grow_with_the_listing(spark, sf, monkeypatch):
    """A bucket is held whole by a Python worker."""
    from pullgrid.plans import queries

    assert changes.state_buckets(0) == changes.state_buckets(640_000) == 64
    assert changes.state_buckets(50_000_000) == 5_000
    given, made = [], changes.bounded_changes

    def seen(listed, at, horizon, buckets=changes.STATE_BUCKETS):
        given.append(buckets)
        return made(listed, at, horizon, buckets)

    monkeypatch.setattr(changes, "bounded_changes", seen)
    monkeypatch.setattr(changes, "IDS_PER_BUCKET", 25)
    rows = queries.stream_changes_bounded(spark, sf)
    assert given[0] >= 2 * 1000 / 25 and rows.count() == 2750


def test_pull_requests_are_ranked_once_for_all_ticks(spark, sf):
    text = mirror.listed_at(spark, sf, 2)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in text and "Join" not in text


def test_what_ticks_repeat_is_read_by_one_task(spark, sf, tmp_path, monkeypatch):
    """So that it collapses before it is shuffled; files were dealt to any task."""
    monkeypatch.setattr(log, "ROWS_PER_FILE", 50)
    root, out = str(tmp_path / "log"), str(tmp_path / "out")
    for tick in (1, 2, 3):
        listed = mirror.listed_at(spark, sf, tick)
        assert "Exchange" not in listed._jdf.queryExecution().executedPlan().toString()
        log.record_tick(listed, root, tick, placed=True)
        assert log.read_tick(spark, root, tick).select("id", "version").exceptAll(listed.select("id", "version")).isEmpty()

    def write(batch, _):
        batch.select("full_name", "rank", "tick", F.spark_partition_id().alias("task")).write.parquet(out)

    stream = log.listing_stream(spark, root).writeStream.foreachBatch(write).trigger(availableNow=True)
    stream.option("checkpointLocation", str(tmp_path / "checkpoint")).start().awaitTermination()
    tasks = spark.read.parquet(out).groupBy("full_name", "rank").agg(
        F.count_distinct("task").alias("tasks"), F.count_distinct("tick").alias("ticks")
    )
    assert tasks.count() == 1500 and tasks.where("tasks > 1 OR ticks < 3").count() == 0
    assert spark.read.parquet(out).select("task").distinct().count() > 4
