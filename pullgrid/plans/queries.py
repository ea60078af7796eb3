"""The registered queries. Every one reads all rows of the tables it uses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pullgrid.functions.decode import decode_strict, decode_violations
from pullgrid.functions.schema import PULL_REQUEST_SCHEMA, plain_schema
from pullgrid.operators import body_store, cache, fetch, listing, slicing
from pullgrid.plans import mirror
from pullgrid.folders import scratch_dir
from pullgrid.session import create_view, pull_requests
from pullgrid.streaming import changes, log

BATCH = 245
SLICES = 7


def _seconds(name: str) -> Column:
    return F.unix_seconds(F.col(name)).alias(name)


def flat(df: DataFrame) -> DataFrame:
    """All leaves of the table; timestamps as seconds since the epoch."""
    repo = F.col("base.repo")
    return df.select(
        "id",
        "url",
        "html_url",
        "diff_url",
        "patch_url",
        "number",
        "state",
        "title",
        "body",
        *[_seconds(c) for c in ("created_at", "updated_at", "closed_at", "merged_at")],
        F.col("base.ref").alias("base_ref"),
        F.col("base.sha").alias("base_sha"),
        *[
            repo.getField(c).alias(f"repo_{c}")
            for c in ("id", "name", "full_name", "description", "private", "url", "html_url")
        ],
        *[F.col("user").getField(c).alias(f"user_{c}") for c in ("login", "id", "url", "html_url")],
        "merged",
        "mergeable",
        "comments",
        "commits",
        "additions",
        "deletions",
        "changed_files",
    )


def _all_repos(spark: SparkSession, sf_dir: str) -> str:
    # one row per nation: a fixed 25
    names = mirror.repos(spark, sf_dir).select("full_name").collect()
    return ",".join(sorted(r["full_name"] for r in names))


def _whole_host(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """All repositories, each listed to its end, through a cache that is empty."""
    return {
        "endpoint": mirror.host_mirror(spark, sf_dir),
        "repos": _all_repos(spark, sf_dir),
        "batch": "all",
        "cacheDir": scratch_dir(spark, "scan-cache"),
    }


def _page_counts(spark: SparkSession, endpoint: str) -> DataFrame:
    """(full_name, batch) of all repositories, each to its end."""
    return (
        fetch.mirror_table(spark, endpoint, "pages")
        .groupBy(F.concat_ws("/", "owner", "repo").alias("full_name"))
        .agg((F.max("page") * 100).alias("batch"))
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Work items of the whole host, through page plan, listing requests and decode."""
    endpoint = mirror.host_mirror(spark, sf_dir)
    plan = listing.page_plan(_page_counts(spark, endpoint))
    return listing.decode_listing(listing.list_pages(plan, endpoint))


def decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stored body, strictly decoded."""
    details = fetch.mirror_table(spark, mirror.host_mirror(spark, sf_dir), "details")
    return decode_strict(details.select("body"), "body", PULL_REQUEST_SCHEMA)


def pr_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(pull_requests(spark, **_whole_host(spark, sf_dir)))


def pr_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = items(spark, sf_dir).select("url", "version")
    answers = fetch.fetch(work, mirror.host_mirror(spark, sf_dir))
    return flat(fetch.decode_responses(answers, []))


def page_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing.page_plan(mirror.repos(spark, sf_dir).select("full_name", "batch"))


def list_top_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = mirror.listing(spark, sf_dir).select("full_name", "id", "created_at")
    return listing.list_top_batch(listed, BATCH).select("full_name", "id", "rank")


def work_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items(spark, sf_dir).select("full_name", "rank", "id", "number", "version", "cache_key")


def slice_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = items(spark, sf_dir).select("full_name", "rank", "id")
    return (
        slicing.slice_items(work, SLICES)
        .groupBy("slice")
        .agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("min_id"), F.max("id").alias("max_id"))
    )


def _split(spark: SparkSession, sf_dir: str, operator) -> DataFrame:
    work = mirror.listing(spark, sf_dir).select("id", "number", "version")
    held = cache.read_cache(spark, mirror.warm_cache(spark, sf_dir))
    return operator(work, held).select("id", "number", "version")


def cache_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir, cache.cache_hits)


def cache_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir, cache.cache_misses)


def fetch_through_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    endpoint = mirror.host_mirror(spark, sf_dir)
    held = mirror.fresh_cache(spark, sf_dir)
    rows = cache.fetch_through_cache(items(spark, sf_dir), endpoint, held)
    # rows cached before this run carry time 0
    origin = F.when(F.col("fetched_ms") == 0, F.lit("cache")).otherwise(F.lit("fetch"))
    return rows.select(
        "full_name", "rank", "id", "number", "version", "commits", origin.alias("origin")
    )


def decode_strict_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(decoded(spark, sf_dir))


def _faulty_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = mirror.listing(spark, sf_dir).select("id", "url", "version")
    return fetch.fetch(work, mirror.faulty_mirror(spark, sf_dir))


def violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    answered = _faulty_answers(spark, sf_dir).where(fetch.is_success(F.col("status")))
    found = decode_violations(answered, "body", PULL_REQUEST_SCHEMA)
    return (
        found.select(F.inline("violations"))
        .groupBy("rule", "field")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def fetch_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = fetch.judged(_faulty_answers(spark, sf_dir))
    return answers.select("id", "status", "outcome", "reason")


def point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = mirror.listing(spark, sf_dir).select("full_name", "number")
    unknown = mirror.repos(spark, sf_dir).select(
        "full_name", (100000000 + F.col("n_nationkey")).cast("int").alias("number")
    )
    endpoint = mirror.host_mirror(spark, sf_dir)
    found = fetch.point_lookup(known.unionByName(unknown), endpoint, mirror.HOST)
    return found.select(
        "full_name",
        "number",
        "status",
        (F.col("outcome") == "ok").alias("found"),
        F.col("row.id").alias("id"),
        F.col("row.title").alias("title"),
    )


def dedup_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = mirror.ranked_listing(spark, sf_dir).select("id", "number", "version", "rank")
    again = F.when(F.col("rank").between(91, 135), F.lit(2)).otherwise(F.lit(1))
    overlapping = listed.select(
        "id", "number", "version", F.explode(F.sequence(F.lit(1), again)).alias("copy")
    )
    return listing.dedup_listing(overlapping).select("id", "number", "version")


def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = F.when(F.col("o_orderstatus") == "F", F.lit("closed")).otherwise(F.lit("open"))
    versions = mirror.tick_versions(spark, sf_dir).select(
        "id", "version", "tick", state.alias("state")
    )
    return cache.latest_snapshot(versions).select("id", "version", "state")


def nested_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decoded(spark, sf_dir).select(
        "number",
        "title",
        "state",
        "base.repo.full_name",
        "user.login",
        "commits",
        "additions",
        "deletions",
    )


def filter_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decoded(spark, sf_dir).where("commits > 10").select("id", "number", "title", "commits")


def top_prs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decoded(spark, sf_dir).select("id", "number", "title").orderBy(F.desc("id")).limit(10)


def sql_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    create_view(spark, "prs", **_whole_host(spark, sf_dir))
    return spark.sql("SELECT number, title FROM prs ORDER BY created_at DESC, id DESC LIMIT 10")


def _run(query) -> None:
    query.awaitTermination()


def stream_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every listed row of every tick, decoded."""
    out = scratch_dir(spark, "full")

    def write(rows: DataFrame, batch_id: int) -> None:
        narrow = rows.select(F.col("tick").cast("long").alias("tick"), "id", "additions")
        narrow.write.mode("overwrite").parquet(f"{out}/rows/batch={batch_id}")

    endpoint = mirror.tick_mirror(spark, sf_dir)
    listed = log.listing_stream(spark, mirror.tick_log(spark, sf_dir))
    _run(log.start_decoded(listed, endpoint, f"{out}/cache", f"{out}/checkpoint", write))
    return (
        spark.read.schema("tick bigint, id bigint, additions int")
        .parquet(f"{out}/rows")
        .groupBy("tick")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("additions").alias("additions"),
            F.min("id").alias("min_id"),
            F.max("id").alias("max_id"),
        )
    )


_VERSIONS = plain_schema(
    id=T.LongType(), version=T.LongType(), state=T.StringType(), tick=T.LongType()
)


def _run_decoded(spark: SparkSession, sf_dir: str, out: str, write: changes.Writer) -> None:
    """The recorded ticks as a file stream, decoded, with second-resolution versions."""
    version = F.unix_seconds(F.coalesce("updated_at", "created_at")).alias("version")

    def narrow(rows: DataFrame, batch_id: int) -> None:
        tick = F.col("tick").cast("long").alias("tick")
        write(rows.select("id", version, "state", tick), batch_id)

    endpoint = mirror.tick_mirror(spark, sf_dir)
    listed = log.listing_stream(spark, mirror.tick_log(spark, sf_dir))
    _run(log.start_decoded(listed, endpoint, f"{out}/cache", f"{out}/checkpoint", narrow))


def stream_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, schema = scratch_dir(spark, "changes"), _VERSIONS
    _run_decoded(spark, sf_dir, out, changes.changes_writer(f"{out}/rows", schema))
    return changes.read_changes(spark, f"{out}/rows", schema).select("id", "version", "tick")


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, schema = scratch_dir(spark, "upsert"), _VERSIONS
    _run_decoded(spark, sf_dir, out, changes.upsert_writer(f"{out}/table", schema))
    return changes.current_state(spark, f"{out}/table", schema).select("id", "version", "state")


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = _ingested(spark, sf_dir, scratch_dir(spark, "ingest"))
    return cache.read_cache(spark, held).select("id", "version", "status")


def _ingested(spark: SparkSession, sf_dir: str, out: str) -> str:
    """A cache that holds every version of every tick."""
    endpoint = mirror.tick_mirror(spark, sf_dir)
    listed = log.listing_stream(spark, mirror.tick_log(spark, sf_dir))
    _run(log.start_ingest(listed, endpoint, f"{out}/cache", f"{out}/checkpoint"))
    return f"{out}/cache"


def cache_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prior cache, a third of it written again later, merged into one base."""
    root = mirror.fresh_cache(spark, sf_dir)
    held = cache.read_cache(spark, mirror.warm_cache(spark, sf_dir))
    again = held.where((F.col("id") - mirror.FIRST_ID) % 3 == 0)
    cache.write_cache(again.withColumn("fetched_ms", F.lit(1).cast("long")), root)
    body_store.compact(spark, root)
    return cache.read_cache(spark, root).select("id", "version", "fetched_ms")


def cache_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cache of all versions, cut down to the newest of each id."""
    root = _ingested(spark, sf_dir, scratch_dir(spark, "retention"))
    body_store.compact(spark, root, keep=1)
    return cache.read_cache(spark, root).select("id", "version")


def fetch_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A host that has moved on since its listing: what was listed, what came, what is known later."""
    root, endpoint = scratch_dir(spark, "versions"), mirror.moved_mirror(spark, sf_dir)
    early = mirror.listed_at(spark, sf_dir, 1)
    rows = cache.fetch_through_cache(early, endpoint, root, by_version=False)
    late = mirror.listed_at(spark, sf_dir, mirror.TICKS).select("id", "version")
    known = cache.cache_hits(late, cache.read_cache(spark, root)).select(
        "id", F.lit(True).alias("known_later")
    )
    return rows.select("id", "version", "carried").join(known, "id", "left")


def file_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text entries of an older cache, decoded."""
    rows = cache.read_file_cache(spark, mirror.entry_files(spark, sf_dir))
    return cache.cached_pulls(rows).select("id", "version", "number", "title", "merged")


def listing_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = listing.reject_listing(mirror.faulty_pages(spark, sf_dir))
    return found.groupBy("rule", "field").agg(F.count(F.lit(1)).alias("n"))


def text_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stands behind a document, and keys that an object repeats."""
    found = decode_violations(mirror.torn_details(spark, sf_dir), "body", PULL_REQUEST_SCHEMA)
    rule = F.coalesce(F.get(F.col("violations"), F.lit(0))["rule"], F.lit("none"))
    return found.groupBy(rule.alias("rule")).agg(F.count(F.lit(1)).alias("n"))


def poll_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole host, listed by tasks and recorded as one tick."""
    endpoint, listing_dir = mirror.host_mirror(spark, sf_dir), scratch_dir(spark, "poll")
    log.poll_tick(_page_counts(spark, endpoint), endpoint, listing_dir, 1)
    return log.read_tick(spark, listing_dir, 1).select("full_name", "rank", "id", "version")


def stream_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tick against the one before, with what is gone."""
    out = scratch_dir(spark, "diff")

    def write(rows: DataFrame, tick: int) -> None:
        rows.drop("tick").write.mode("overwrite").parquet(f"{out}/rows/tick={tick}")

    _run(log.start_difference(spark, mirror.gap_log(spark, sf_dir), write, f"{out}/checkpoint"))
    rows = spark.read.schema("id bigint, change string, version string, was string, tick bigint")
    return rows.parquet(f"{out}/rows").select("tick", "id", "change", "version", "was")


def stream_changes_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New versions; an id that was not listed for longer than a tick counts as new."""
    out = scratch_dir(spark, "bounded")
    root = mirror.gap_log(spark, sf_dir)
    listed = log.listing_stream(spark, root, ticks_per_batch=1)
    # two ticks lie within the horizon
    buckets = changes.state_buckets(2 * log.widest_tick(spark, root))
    timed = listed.withColumn("at", F.timestamp_seconds(F.col("tick") * 60))
    _run(
        changes.bounded_changes(timed, "at", 60, buckets)
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{out}/rows")
    )
    return spark.read.schema("id bigint, version string, tick bigint").parquet(f"{out}/rows")


def repo_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    prs = F.count(F.lit(1))
    merged = F.count_if("merged")
    return (
        decoded(spark, sf_dir)
        .groupBy(F.col("base.repo.full_name").alias("full_name"))
        .agg(
            prs.alias("prs"),
            merged.alias("merged"),
            (merged.cast("double") / prs).alias("merge_rate"),
            F.sum("additions").alias("additions"),
            F.sum("deletions").alias("deletions"),
            F.sum("commits").alias("commits"),
        )
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "pr_scan": pr_scan,
    "pr_table": pr_table,
    "page_plan": page_plan,
    "list_top_batch": list_top_batch,
    "work_items": work_items,
    "slice_items": slice_items,
    "cache_hits": cache_hits,
    "cache_misses": cache_misses,
    "fetch_through_cache": fetch_through_cache,
    "decode_strict": decode_strict_rows,
    "decode_violations": violations,
    "fetch_quarantine": fetch_quarantine,
    "point_lookup": point_lookup,
    "dedup_listing": dedup_listing,
    "latest_snapshot": latest_snapshot,
    "nested_projection": nested_projection,
    "filter_commits": filter_commits,
    "top_prs": top_prs,
    "sql_view": sql_view,
    "stream_full": stream_full,
    "stream_changes": stream_changes,
    "stream_upsert": stream_upsert,
    "stream_ingest": stream_ingest,
    "repo_summary": repo_summary,
    "cache_compact": cache_compact,
    "cache_retention": cache_retention,
    "fetch_versions": fetch_versions,
    "file_cache": file_cache,
    "listing_violations": listing_violations,
    "text_violations": text_violations,
    "poll_listing": poll_listing,
    "stream_diff": stream_diff,
    "stream_changes_bounded": stream_changes_bounded,
}
