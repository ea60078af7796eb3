"""The body cache, keyed by (id, version).

Only validated bodies are ever ``ok``, and only those are read back, so a bad body
cannot poison later runs; the failed ones are the quarantine. A body is kept under the
version it carries: a host that has moved on since the listing answers with a newer one.
The version that was listed is kept beside it and finds the same body. ``body_store``
says where rows lie.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pullgrid.folders import PACKED, scratch_dir, there
from pullgrid.functions.decode import assemble, checked_leaves, decode_leaves
from pullgrid.functions.schema import PULL_REQUEST_SCHEMA, plain_schema
from pullgrid.operators import body_store
from pullgrid.operators.body_store import Generation, open_store
from pullgrid.operators.fetch import fetch, fetch_placed, judged, request_failure
from pullgrid.operators.listing import newest_version
from pullgrid.operators.ranking import newest_per_key
from pullgrid.sources.transport import UNASKED, is_mirror

CACHE_SCHEMA = plain_schema(
    id=T.LongType(),
    version=T.StringType(),
    body=T.StringType(),
    fetched_ms=T.LongType(),
    status=T.IntegerType(),
    reason=T.StringType(),
    outcome=T.StringType(),
)
KEY = ["id", "version"]
# so many urls and versions take some megabytes as a hash table
FEW_ASKED = 20_000


def read_cache(spark: SparkSession, cache_dir: str, outcome: str = "ok") -> DataFrame:
    """Cache rows as stored, and the version each was ``listed`` under. A key written twice
    appears twice.

    Reading makes no folder: without one there are no rows.
    """
    if not there(spark, cache_dir):
        return spark.createDataFrame([], CACHE_SCHEMA).withColumn("listed", F.col("version"))
    store = open_store(spark, cache_dir)
    read = body_store.rejected if outcome == "failed" else body_store.good
    rows = read(spark, store).withColumn("outcome", F.lit(outcome))
    return rows.select(*CACHE_SCHEMA.names, "listed")


def read_file_cache(spark: SparkSession, directory: str) -> DataFrame:
    """A directory of ``pr-<id>-<date>.cache`` text files, as cache rows."""
    pattern = r"pr-(-?[0-9]+)-(.+)\.cache$"
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    name = F.url_decode(name)
    return (
        spark.read.option("wholetext", True)
        .option("pathGlobFilter", "pr-*.cache")
        .text(directory)
        .select(
            F.regexp_extract(name, pattern, 1).cast("long").alias("id"),
            F.translate(F.regexp_extract(name, pattern, 2), "=", ":").alias("version"),
            F.col("value").alias("body"),
            F.unix_millis("_metadata.file_modification_time").alias("fetched_ms"),
            F.lit(200).alias("status"),
            F.lit(None).cast("string").alias("reason"),
            F.lit("ok").alias("outcome"),
        )
    )


def write_cache(
    rows: DataFrame, cache_dir: str, finish: Callable[[DataFrame], DataFrame] = lambda rows: rows
) -> None:
    """Append rows by their ``outcome``; ``listed``, where it is given, finds a body too.

    ``finish`` makes cache rows of ``rows``, which have an id and a version, where they are
    written: a body that can be made of a few columns is then neither shuffled nor sorted.
    """

    def whole(placed: DataFrame) -> DataFrame:
        made = finish(placed)
        if "listed" not in made.columns:
            made = made.withColumn("listed", F.col("version"))
        # a row with a reason is one of the quarantine
        reason = F.when(F.col("outcome") == "failed", F.coalesce("reason", F.lit("FAILED")))
        return made.withColumn("reason", reason)

    body_store.append(rows, open_store(rows.sparkSession, cache_dir), finish=whole)


def _answered(asked_version: Column, cached: DataFrame) -> Column:
    """Whether a cache row answers for a version: it carries it, or was fetched for it.

    Beside an equal id this is no further join key, so rows stay in their buckets.
    """
    listed = cached["listed"] if "listed" in cached.columns else cached["version"]
    return F.array_contains(F.array(cached["version"], listed), asked_version)


def _meeting(items: DataFrame, cached: DataFrame) -> Column:
    return (items["id"] == cached["id"]) & _answered(items["version"], cached)


def _keys(cached: DataFrame) -> DataFrame:
    return cached.select(*KEY, *[c for c in ("listed",) if c in cached.columns])


def cache_hits(items: DataFrame, cached: DataFrame) -> DataFrame:
    """Items whose current version is cached. Reads no bodies."""
    keys = _keys(cached)
    return items.join(keys, _meeting(items, keys), "left_semi")


def cache_misses(items: DataFrame, cached: DataFrame) -> DataFrame:
    """Items whose current version is not cached. Reads no bodies."""
    keys = _keys(cached)
    return items.join(keys, _meeting(items, keys), "left_anti")


def _newest_leaves(cached: DataFrame) -> DataFrame:
    """Checked flat columns of the newest row per key.

    Decoding comes first, so only the columns a query reads are shuffled, not
    the bodies.
    """
    named = cached.withColumnsRenamed({"id": "__id", "body": "__json"})
    keep = ["__id", "version", "fetched_ms"]
    leaves = decode_leaves(named, "__json", PULL_REQUEST_SCHEMA, keep)
    return newest_per_key(leaves, ["__id", "version"], [F.desc("fetched_ms")])


def missing_from(items: DataFrame, store: Generation) -> DataFrame:
    """Items whose version no part of the cache holds: key columns of the cache stay in place."""
    for rows in body_store.sources(items.sparkSession, store):
        items = cache_misses(items, rows)
    return items


def _place() -> list[Column]:
    """Where a row of the cache is: its file, whose name no other file has, and its number there."""
    return [F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row")]


def asked_bodies(asked: DataFrame, store: Generation) -> DataFrame:
    """``newest_asked`` of a whole cache, without moving a body from its bucket.

    Which row of the cache answers for a key is settled on key columns. Then each part is
    asked for its own: what is asked of a bucket is hashed, and the bodies stream past it
    without being sorted.
    """
    spark = asked.sparkSession
    parts = body_store.sources(spark, store)
    path = scratch_dir(spark, "places")
    _newest_places(asked, parts).write.options(**PACKED).parquet(path)
    settled = spark.read.schema("id bigint, version string, part int, file string, row bigint").parquet(path)
    out = None
    for number, rows in enumerate(parts):
        own = _bodies_at(rows, settled.where(F.col("part") == number))
        out = own if out is None else out.unionByName(own)
    return out


def _newest_places(asked: DataFrame, parts: list[DataFrame]) -> DataFrame:
    """Which row of which part answers for each asked key."""
    # never a broadcast: rows of a micro-batch have the statistics of the manifests they come from
    once = asked.select(*KEY).distinct().hint("shuffle_hash")
    places = None
    for number, rows in enumerate(parts):
        keys = _renamed(rows.select("id", "version", "listed", "fetched_ms", *_place()))
        exact = (F.col("carried") == once["version"]).alias("exact")
        met = once.join(keys, _found_in(once, keys)).select(
            once["id"],
            once["version"],
            F.struct(exact, "fetched_ms", F.lit(number).alias("part"), "file", "row").alias("place"),
        )
        places = met if places is None else places.unionByName(met)
    newest = places.groupBy(*KEY).agg(F.max("place").alias("place"))
    return newest.select(*KEY, "place.part", "place.file", "place.row")


def _bodies_at(rows: DataFrame, settled: DataFrame) -> DataFrame:
    """The rows at settled places of one part. Beside the id the place is no join key, so
    that rows stay in their buckets."""
    wanted = settled.select(
        F.col("id").alias("__id"), F.col("version").alias("__version"), F.struct("file", "row").alias("__place")
    )
    held = rows.select(
        "id", F.col("version").alias("carried"), "body", "fetched_ms", F.struct(*_place()).alias("__at")
    )
    there_too = F.array_contains(F.array("__at"), F.col("__place"))
    met = held.join(wanted.hint("shuffle_hash"), (F.col("id") == F.col("__id")) & there_too)
    return met.select("id", F.col("__version").alias("version"), "carried", "body", "fetched_ms")


def _renamed(rows: DataFrame) -> DataFrame:
    return rows.withColumnsRenamed({"id": "__held", "version": "carried"})


def _found_in(once: DataFrame, keys: DataFrame) -> Column:
    versions = F.array(keys["carried"], keys["listed"])
    return (once["id"] == keys["__held"]) & F.array_contains(versions, once["version"])


def newest_asked(cached: DataFrame, asked: DataFrame) -> DataFrame:
    """Per asked (id, version) the cache row that answers: the same version, then the newest.

    Columns: the asked ``id`` and ``version``, ``carried`` (the body's own version), ``body``,
    ``fetched_ms``. For any table of cache rows; ``asked_bodies`` is the way for a whole cache.
    """
    once = asked.select(F.col("id").alias("__id"), F.col("version").alias("__version")).distinct()
    listed = cached["listed"] if "listed" in cached.columns else cached["version"]
    rows = cached.select("id", F.col("version").alias("carried"), listed.alias("__listed"), "body", "fetched_ms")
    met = rows.join(
        once,
        (rows["id"] == once["__id"])
        & F.array_contains(F.array(rows["carried"], rows["__listed"]), once["__version"]),
    )
    order = [F.desc(F.col("carried") == F.col("__version")), F.desc("fetched_ms")]
    return newest_per_key(met, ["__id", "__version"], order).select(
        F.col("__id").alias("id"), F.col("__version").alias("version"), "carried", "body", "fetched_ms"
    )


def cached_pulls(cached: DataFrame) -> DataFrame:
    """Decoded cache rows, newest per key."""
    keep = ["__id", "version", "fetched_ms"]
    return assemble(_newest_leaves(cached), PULL_REQUEST_SCHEMA, keep)


def fetch_misses(
    items: DataFrame,
    endpoint: str,
    cache_dir: str,
    mode: str = "FAILFAST",
    token: str | None = None,
    retries: int = 2,
    budget: int | None = None,
    by_version: bool = True,
) -> dict[str, int]:
    """Fetch what the cache lacks and append it. Returns the counts of the run.

    Good bodies are kept even when others fail, so a rerun does not spend
    requests on them again; FAILFAST raises after the write. With a ``budget`` all tasks
    together make that many requests at most, and the counts say how many were made and
    how many items were not asked for. ``by_version``: a mirror answers for the version
    that was listed; otherwise with what it has now, as a host does.
    """
    spark = items.sparkSession
    store = open_store(spark, cache_dir)
    missing = missing_from(items, store).select("url", *KEY)
    return _fetch_all(missing, endpoint, store, mode, token, retries, budget, by_version)


def _fetch_all(
    missing: DataFrame,
    endpoint: str,
    store: Generation,
    mode: str,
    token: str | None,
    retries: int,
    budget: int | None = None,
    by_version: bool = True,
) -> dict[str, int]:
    if budget is None:
        missing, n = _listed_once(missing)
        if is_mirror(endpoint) and by_version and n > FEW_ASKED:
            return _fetch_placed(missing, n, endpoint, store, mode)
        answers = fetch(missing, endpoint, token, retries, by_version=by_version, few=n <= FEW_ASKED)
        return _told(mode, _append(judged(answers), store))
    return _fetch_within(missing, endpoint, store, mode, token, retries, budget, by_version)


def _fetch_placed(missing: DataFrame, n: int, endpoint: str, store: Generation, mode: str) -> dict[str, int]:
    """Fetch from a mirror with one shuffle of bodies, for the request and the cache together.

    What is not answered where its id lies is asked for again as any request is.
    """
    unmet, now = Observation(), int(time.time() * 1000)
    met = fetch_placed(missing, endpoint, body_store.placing(store.buckets, n))
    met = met.observe(unmet, F.count_if(F.col("status").isNull()).alias("n"))
    counts = [_append(judged(met.where("status IS NOT NULL")), store, now, placed=True)]
    if unmet.get["n"]:
        kept = body_store.stored(missing.sparkSession, store).where(F.col("fetched_ms") == now)
        done = kept.select("id", F.col("listed").alias("version"))
        rest, n = _listed_once(missing.join(done, KEY, "left_anti"))
        counts.append(_append(judged(fetch(rest, endpoint, few=n <= FEW_ASKED)), store))
    return _told(mode, *counts)


def _told(mode: str, *counts: dict) -> dict[str, int]:
    """The counts of a run's appends together; FAILFAST raises if an answer was bad."""
    total = {name: sum(c[name] for c in counts) for name in ("fetched", "failed")}
    if total["failed"] and mode.upper() == "FAILFAST":
        raise RuntimeError(max(c["message"] for c in counts if c["message"]))
    return total


def _listed_once(missing: DataFrame) -> tuple[DataFrame, int]:
    """(what is to be fetched, as a table; how much it is)."""
    path = scratch_dir(missing.sparkSession, "missing")
    missing.write.options(**PACKED).parquet(path)
    listed = missing.sparkSession.read.schema(missing.schema).parquet(path)
    return listed, listed.count()


def _fetch_within(missing, endpoint, store, mode, token, retries, budget, by_version) -> dict[str, int]:
    """Rounds of requests: each deals what is left of the budget to its tasks.

    A task that needs less than its share leaves the rest to the next round; one that needs
    more leaves items to it. A round that could ask for nothing is followed by one of a
    single task.
    """
    spark = missing.sparkSession
    path = scratch_dir(spark, "asked")
    missing.select("url", *KEY).write.parquet(path)
    pending = spark.read.schema(missing.select("url", *KEY).schema).parquet(path)
    left, width, total = budget, None, {"fetched": 0, "failed": 0}
    unasked = pending.count()
    while unasked and left > 0:
        tasks = min(width or spark.sparkContext.defaultParallelism, unasked, left)
        answers = judged(fetch(pending, endpoint, token, retries, tasks, left, by_version))
        path = scratch_dir(spark, "answers")
        answers.drop("row").write.options(**PACKED).parquet(path)
        answers = spark.read.schema(answers.drop("row").schema).parquet(path)
        done = answers.where(F.col("status") != UNASKED)
        counts = _append(done, store)
        for name in total:
            total[name] += counts[name]
        if counts["failed"] and mode.upper() == "FAILFAST":
            raise RuntimeError(counts["message"])
        made = answers.agg(F.coalesce(F.sum("attempts"), F.lit(0))).first()[0]
        left -= made
        pending = answers.where(F.col("status") == UNASKED).select("url", *KEY)
        width = None if made else 1
        unasked -= counts["fetched"]
    return total | {"requests": budget - left, "unasked": unasked}


def _append(answers: DataFrame, store: Generation, now: int | None = None, placed: bool = False) -> dict:
    """Keep good answers under the version they carry; those with a reason are the quarantine.

    Returns how many were fetched and how many failed, and a ``message`` of one that did.
    """
    message = F.when(
        F.col("reason").startswith("HTTP_"), request_failure(F.col("status"), F.col("body"))
    ).otherwise(F.concat(F.lit("Invalid body: "), F.col("reason")))
    carried = F.coalesce(
        F.get_json_object("body", "$.updated_at"), F.get_json_object("body", "$.created_at")
    )
    failed = F.col("outcome") == "failed"
    own = F.when(failed, F.col("version")).otherwise(F.coalesce(carried, "version"))
    # one time for the whole run
    kept = answers.withColumns(
        {"fetched_ms": F.lit(now or int(time.time() * 1000)), "listed": F.col("version"), "version": own}
    )
    seen = Observation()
    counted = [
        F.count(F.lit(1)).alias("fetched"),
        F.count_if(failed).alias("failed"),
        F.max(F.when(failed, message)).alias("message"),
    ]
    body_store.append(kept, store, lambda rows: rows.observe(seen, *counted), placed=placed)
    return seen.get


def fetch_through_cache(
    items: DataFrame,
    endpoint: str,
    cache_dir: str,
    mode: str = "FAILFAST",
    token: str | None = None,
    retries: int = 2,
    by_version: bool = True,
) -> DataFrame:
    """Every listed item decoded, from the cache where possible.

    The misses are fetched and written first; what was asked for is then decoded once, from
    one generation of the cache, and written as typed columns, so a lost executor never
    repeats a request and a reader reads the columns it wants. An asked row that no
    longer decodes counts as a miss. Beside ``fetched_ms`` there is ``carried``, the version
    of the body: a newer one than listed if the host had moved on.
    """
    spark = items.sparkSession
    store = open_store(spark, cache_dir)
    # the listing is asked for once, however many steps follow
    path = scratch_dir(spark, "items")
    wanted = items.select("full_name", "rank", "url", *KEY)
    wanted.write.options(**PACKED).parquet(path)
    wanted = spark.read.schema(wanted.schema).parquet(path)
    once = wanted.groupBy(*KEY).agg(F.min("url").alias("url"))
    _fetch_all(
        missing_from(once, store).select("url", *KEY),
        endpoint, store, mode, token, retries, by_version=by_version,
    )
    leaves, broken = _decode_asked(once, store)
    if broken:
        again = once.join(leaves.where("NOT __ok").select(*KEY), KEY, "left_semi")
        _fetch_all(again.select("url", *KEY), endpoint, store, mode, token, retries, by_version=by_version)
        mended, _ = _decode_asked(again, store)
        leaves = leaves.where("__ok").unionByName(mended)
    leaves = leaves.where("__ok").withColumnsRenamed({"id": "__id", "version": "__version"})
    own = wanted.select(F.col("id").alias("__id"), F.col("version").alias("__version"), "full_name", "rank")
    rows = assemble(
        own.hint("shuffle_hash").join(leaves, ["__id", "__version"]),
        PULL_REQUEST_SCHEMA,
        ["full_name", "rank", "__version", "carried", "fetched_ms"],
    )
    return rows.withColumnRenamed("__version", "version")


def _decode_asked(asked: DataFrame, store: Generation) -> tuple[DataFrame, int]:
    """(flat columns of the asked rows, ``__ok`` or not, as a table; how many are not)."""
    spark = asked.sparkSession
    held = asked_bodies(asked, store)
    named = held.withColumnRenamed("body", "__json")
    keep = [*KEY, "carried", "fetched_ms"]
    looked = checked_leaves(named, "__json", PULL_REQUEST_SCHEMA, keep)
    seen = Observation()
    path = scratch_dir(spark, "decoded")
    watched = looked.observe(seen, F.count_if(~F.col("__ok")).alias("broken"))
    watched.write.options(**PACKED).parquet(path)
    return spark.read.schema(looked.schema).parquet(path), seen.get["broken"]


def decode_held(items: DataFrame, cache_dir: str, keep: list[str]) -> DataFrame:
    """Decoded rows of the items the cache holds; a version listed often is decoded once.

    ``keep``: columns of ``items``, and ``fetched_ms``, that stand beside the decoded ones.
    """
    spark = items.sparkSession
    store = open_store(spark, cache_dir)
    held = asked_bodies(items, store)
    named = held.withColumnsRenamed({"id": "__id", "body": "__json"})
    leaves = decode_leaves(named, "__json", PULL_REQUEST_SCHEMA, ["__id", "version", "fetched_ms"])
    own = [c for c in keep if c not in ("version", "fetched_ms")]
    # never a broadcast: rows of a micro-batch have the statistics of the manifests they come from
    wanted = items.select(F.col("id").alias("__id"), "version", *own).hint("shuffle_hash")
    return assemble(wanted.join(leaves, ["__id", "version"]), PULL_REQUEST_SCHEMA, keep)


def latest_snapshot(versions: DataFrame) -> DataFrame:
    """The current row of every pull request from a table of its versions."""
    order = newest_version() + ([F.desc("tick")] if "tick" in versions.columns else [])
    return newest_per_key(versions, ["id"], order)
