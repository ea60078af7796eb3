"""The listing log as Spark tables and as a stream of its complete ticks."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pullgrid.folders import PACKED, create_once, names_in, qualified, ready_dir, text_of, there
from pullgrid.functions.schema import plain_schema
from pullgrid.operators.cache import decode_held, fetch_misses
from pullgrid.operators.listing import decode_listing, list_pages, page_plan
from pullgrid.operators.ranking import newest_per_key
from pullgrid.shipping import ship_package
from pullgrid.sources.listing_log import MANIFEST, manifest_text
from pullgrid.sources.storage import open_dir

LOG_SCHEMA = plain_schema(
    full_name=T.StringType(),
    rank=T.LongType(),
    id=T.LongType(),
    number=T.IntegerType(),
    url=T.StringType(),
    version=T.StringType(),
    tick=T.IntegerType(),
)
LOG_COLUMNS = LOG_SCHEMA.names[:-1]
Write = Callable[[DataFrame, int], None]
# the least that a task of a stream reads
ROWS_PER_FILE = 250_000


def record_tick(items: DataFrame, listing_dir: str, tick: int, placed: bool = False) -> bool:
    """Write a snapshot of any size as one tick, from the executors.

    The files lie in a folder of this run; a manifest, made only if absent, makes them the
    tick. Whether they are: another run may have been first. ``placed`` items lie by
    repository and rank already, and are written where they are.
    """
    spark = items.sparkSession
    folder = f"{ready_dir(spark, listing_dir).rstrip('/')}/tick={tick}"
    run = f"run-{uuid.uuid4().hex}"
    # files hold neighbouring rows, so a slice of one asks for few repositories
    rows = items.select(*LOG_COLUMNS)
    if not placed:
        rows = rows.hint("rebalance", "full_name").sortWithinPartitions("full_name", "rank")
    rows.write.options(**PACKED, maxRecordsPerFile=ROWS_PER_FILE).parquet(f"{folder}/{run}")
    names = sorted(n for n in names_in(spark, f"{folder}/{run}") if n.endswith(".parquet"))
    return create_once(spark, f"{folder}/{MANIFEST}", manifest_text([f"{run}/{n}" for n in names]))


def poll_tick(
    repos: DataFrame, endpoint: str, listing_dir: str, tick: int, token: str | None = None, retries: int = 2
) -> bool:
    """List (full_name, batch) repositories in tasks and record the answer as one tick."""
    pages = list_pages(page_plan(repos), endpoint, token, retries)
    return record_tick(decode_listing(pages), listing_dir, tick)


def complete_ticks(spark: SparkSession, listing_dir: str) -> list[int]:
    """Ticks with a manifest, ascending."""
    names = [n for n in names_in(spark, listing_dir) if n.startswith("tick=")]
    return sorted(int(n[5:]) for n in names if there(spark, f"{listing_dir}/{n}/{MANIFEST}"))


def _parts(spark: SparkSession, listing_dir: str, tick: int) -> list[str]:
    return json.loads(text_of(spark, f"{listing_dir}/tick={tick}/{MANIFEST}"))["parts"]


def read_tick(spark: SparkSession, listing_dir: str, tick: int) -> DataFrame:
    """The snapshot of a complete tick."""
    folder = f"{qualified(spark, listing_dir)}/tick={tick}"
    parts = _parts(spark, listing_dir, tick)
    schema = T.StructType(LOG_SCHEMA.fields[:-1])
    if not parts:
        return spark.createDataFrame([], LOG_SCHEMA)
    rows = spark.read.schema(schema).parquet(*[f"{folder}/{p}" for p in parts])
    return rows.withColumn("tick", F.lit(tick))


def widest_tick(spark: SparkSession, listing_dir: str) -> int:
    """Rows of the longest complete tick, from file footers alone."""
    ticks = complete_ticks(spark, listing_dir)
    return max((read_tick(spark, listing_dir, tick).count() for tick in ticks), default=0)


def manifest_stream(spark: SparkSession, listing_dir: str, ticks_per_batch: int = 1000) -> DataFrame:
    """(parts, tick) of every complete tick; Spark's file source tracks what was read."""
    return (
        spark.readStream.schema("parts array<string>, tick int")
        .option("pathGlobFilter", MANIFEST)
        .option("maxFilesPerTrigger", ticks_per_batch)
        .json(listing_dir)
    )


def listing_stream(spark: SparkSession, listing_dir: str, ticks_per_batch: int = 1000) -> DataFrame:
    """The rows of complete ticks as a stream; tasks read the files a manifest names."""
    ship_package(spark)
    root = qualified(spark, listing_dir)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = open_dir(root)
        for batch in batches:
            for part, tick in zip(*(batch.column(c).to_pylist() for c in ("part", "tick")), strict=True):
                with pq.ParquetFile(fs.open_input_file(f"{path}/tick={tick}/{part}")) as source:
                    for rows in source.iter_batches(10_000, columns=LOG_COLUMNS):
                        ticks = pa.array([tick], pa.int32()).take(pa.array([0] * rows.num_rows))
                        yield pa.RecordBatch.from_arrays([*rows.columns, ticks], LOG_SCHEMA.names)

    parts = manifest_stream(spark, listing_dir, ticks_per_batch).select(F.posexplode("parts").alias("at", "part"), "tick")
    # a manifest is one row; its files are dealt to as many tasks as the newest tick has, those at
    # the same place of several ticks to one: what such ticks repeat collapses before it is shuffled
    files = [_parts(spark, root, tick) for tick in complete_ticks(spark, listing_dir)[-1:]]
    tasks = max(spark.sparkContext.defaultParallelism, *map(len, files), 1)
    dealt = parts.repartitionById(tasks, F.pmod("at", F.lit(tasks)).cast("int"))
    return dealt.select("part", "tick").mapInArrow(read, LOG_SCHEMA)


def _each_batch(stream: DataFrame, run, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def start_ingest(
    listed: DataFrame,
    endpoint: str,
    cache_dir: str,
    checkpoint: str,
    mode: str = "FAILFAST",
    token: str | None = None,
    retries: int = 2,
    trigger: dict | None = None,
    budget: int | None = None,
) -> StreamingQuery:
    """Fetch every version the log lists that the cache does not hold yet.

    The split against the cache runs before any fetch, so a tick that repeats
    the last one costs no request. A replayed micro-batch finds its own rows in
    the cache and fetches nothing. ``budget``: requests of one micro-batch at most; what it
    leaves is asked for when a later tick lists it again.
    """

    def run(batch: DataFrame, _: int) -> None:
        once = newest_per_key(batch, ["id", "version"], [F.desc("tick")])
        fetch_misses(once, endpoint, cache_dir, mode, token, retries, budget)

    return _each_batch(listed, run, checkpoint, trigger)


def start_decoded(
    listed: DataFrame,
    endpoint: str,
    cache_dir: str,
    checkpoint: str,
    write: Write,
    mode: str = "FAILFAST",
    token: str | None = None,
    retries: int = 2,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Hand every listed row, decoded and with its ``tick``, to ``write``.

    Versions a micro-batch lists at several ticks are fetched and decoded once; what the
    cache holds is not fetched at all.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        once = newest_per_key(batch, ["id", "version"], [F.desc("tick")])
        fetch_misses(once, endpoint, cache_dir, mode, token, retries)
        write(decode_held(batch, cache_dir, ["tick"]), batch_id)

    return _each_batch(listed, run, checkpoint, trigger)


def tick_difference(before: DataFrame | None, after: DataFrame) -> DataFrame:
    """(full_name, id, number, url, change, version, was): what a snapshot changed.

    ``change`` is insert, update (another version) or gone. Keys are (full_name, id); a key
    listed twice in a snapshot counts once, under its newest version. Only listing rows
    are compared, never bodies.
    """
    key = ["full_name", "id"]
    order = [F.try_to_timestamp("version").desc(), F.desc("version"), F.asc("rank")]

    def once(rows: DataFrame, prefix: str) -> DataFrame:
        held = newest_per_key(rows, key, order)
        return held.select(*key, *[F.col(c).alias(prefix + c) for c in ("number", "url", "version")])

    now = once(after, "")
    if before is None:
        then = now.limit(0).select(*key, *[F.col(c).alias(f"was_{c}") for c in ("number", "url", "version")])
    else:
        then = once(before, "was_")
    met = now.withColumn("here", F.lit(True)).join(then.withColumn("there", F.lit(True)), key, "full")
    change = (
        F.when(F.col("there").isNull(), "insert")
        .when(F.col("here").isNull(), "gone")
        .when(~F.col("version").eqNullSafe(F.col("was_version")), "update")
    )
    return met.withColumn("change", change).where("change IS NOT NULL").select(
        *key,
        F.coalesce("number", "was_number").alias("number"),
        F.coalesce("url", "was_url").alias("url"),
        "change",
        "version",
        F.col("was_version").alias("was"),
    )


def start_difference(
    spark: SparkSession,
    listing_dir: str,
    write: Write,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Hand the difference of every complete tick to the one before it to ``write(rows, tick)``.

    Both snapshots come from the log, so nothing is kept in stream state, the order in which
    ticks arrive does not matter, and a replayed tick gives the same rows.
    """

    def run(batch: DataFrame, _: int) -> None:
        # a row per tick of the micro-batch
        for tick in sorted(r.tick for r in batch.select("tick").collect()):
            earlier = [t for t in complete_ticks(spark, listing_dir) if t < tick]
            before = read_tick(spark, listing_dir, earlier[-1]) if earlier else None
            after = read_tick(spark, listing_dir, tick)
            write(tick_difference(before, after).withColumn("tick", F.lit(tick)), tick)

    return _each_batch(manifest_stream(spark, listing_dir), run, checkpoint, trigger)
