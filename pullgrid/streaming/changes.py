"""From a stream that re-emits everything to changes and to current state.

``changes_writer`` looks at all it has written; ``bounded_changes`` remembers only ids that
were listed lately. Both sinks are directories of one sub-directory per micro-batch. A replayed
micro-batch overwrites its own directory and looks only at earlier ones, so
its output is the same however often it runs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pullgrid.folders import complete_dirs, ready_dir
from pullgrid.operators.ranking import newest_per_key

BATCH = "batch_id"
KEY = ["id", "version"]
Writer = Callable[[DataFrame, int], None]


def _sink_rows(spark: SparkSession, directory: str, schema: T.StructType) -> DataFrame:
    full = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    return spark.read.schema(full).parquet(ready_dir(spark, directory))


def _start(stream: DataFrame, run, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def changes_writer(sink: str, schema: T.StructType) -> Writer:
    """Appends each (id, version) of its micro-batches once, ever, to ``sink``.

    The history is the sink itself: an anti join on its two key columns, with
    no limit on how far back a repeat may lie. Nothing is kept in stream state.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        seen = _sink_rows(batch.sparkSession, sink, schema).where(F.col(BATCH) < batch_id)
        order = [F.asc("tick")] if "tick" in batch.columns else [F.asc("id")]
        once = newest_per_key(batch, KEY, order)
        fresh = once.join(seen.select(*KEY), KEY, "left_anti")
        fresh.select(*schema.names).write.mode("overwrite").parquet(f"{sink}/{BATCH}={batch_id}")

    return run


Seen = dict[int, tuple[int, str, int]]  # id -> (instant of its version, version, last listed)
_STATE = "id array<bigint>, instant array<bigint>, version array<string>, seen array<bigint>"
STATE_BUCKETS, IDS_PER_BUCKET = 64, 10_000


def state_buckets(ids: int) -> int:
    """Buckets for a stream that lists so many ids within its horizon: a bucket's state is
    held whole by a Python worker, so it must not grow with the stream."""
    return max(STATE_BUCKETS, -(-ids // IDS_PER_BUCKET))


def remember(held: Seen, rows: Iterable[tuple[int, int, int, str, int]], span: int) -> list[tuple]:
    """The (id, version, tick) among (time, id, instant, version, tick) rows that are new.

    ``held`` is brought up to date. An id that was not listed for longer than ``span`` is
    forgotten, so whatever comes next of it is new.
    """
    out = []
    for at, key, instant, version, tick in sorted(rows):
        known = held.get(key)
        if known is not None and at - known[2] > span:
            known = None
        if known is None or (instant, version) > known[:2]:
            out.append((key, version, tick))
            held[key] = (instant, version, at)
        else:
            held[key] = (*known[:2], max(at, known[2]))
    return out


def forget(held: Seen, before: int) -> Seen:
    """What was listed at or after a time."""
    return {key: known for key, known in held.items() if known[2] >= before}


def bounded_changes(
    listed: DataFrame, at: str, horizon_seconds: int, buckets: int = STATE_BUCKETS
) -> DataFrame:
    """A streaming table of new versions: (id, version, tick) of rows with a time ``at``.

    State holds the ids that were listed within the horizon of event time, however long the
    stream runs: timers free those that are no longer listed. A row is a change if its
    id is not remembered or its version names a later instant than the one remembered.
    So an id that comes back after the horizon counts as new. Rows older than the
    watermark (the horizon behind the newest) are late and dropped.

    Ids are hashed to ``buckets``, each one group of state; ``state_buckets`` tells how
    many a number of ids needs. Keep the number for as long as the checkpoint.
    """
    span, horizon = horizon_seconds * 1_000_000, f"{horizon_seconds} seconds"

    def step(_, frames, state):
        import pandas as pd

        held: Seen = {}
        if state.exists:
            ids, instants, versions, times = state.get
            held = dict(zip(ids, zip(instants, versions, times, strict=True), strict=True))
        out = []
        if not state.hasTimedOut:
            rows = pd.concat(list(frames))
            columns = (rows[c].tolist() for c in ("at_us", "id", "version_us", "version", "tick"))
            out = remember(held, zip(*columns, strict=True), span)
        watermark = state.getCurrentWatermarkMs()
        held = forget(held, watermark * 1000 - span)
        if held:
            parts = zip(*((k, *v) for k, v in held.items()), strict=True)
            state.update(tuple(list(p) for p in parts))
            oldest = min(known[2] for known in held.values())
            state.setTimeoutTimestamp(max((oldest + span) // 1000, watermark) + 1)
        else:
            state.remove()
        yield pd.DataFrame(out, columns=["id", "version", "tick"])

    timed = listed.withWatermark(at, horizon).select(
        F.pmod(F.xxhash64("id"), F.lit(buckets)).alias("bucket"),
        "id",
        "version",
        F.col("tick").cast("long").alias("tick"),
        F.unix_micros(at).alias("at_us"),
        # a version that names no instant is older than all that do
        F.coalesce(F.unix_micros(F.try_to_timestamp("version")), F.lit(-(1 << 62))).alias("version_us"),
        at,
    )
    return (
        timed.where("id IS NOT NULL AND version IS NOT NULL")
        .groupBy("bucket")
        .applyInPandasWithState(
            step, "id bigint, version string, tick bigint", _STATE, "append", "EventTimeTimeout"
        )
    )


def start_changes(
    stream: DataFrame, sink: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """``changes_writer`` on a stream."""
    return _start(stream, changes_writer(sink, stream.schema), checkpoint, trigger)


def read_changes(spark: SparkSession, sink: str, schema: T.StructType) -> DataFrame:
    return _sink_rows(spark, sink, schema)


def _history(
    spark: SparkSession, table: str, schema: T.StructType, before: int | None = None
) -> DataFrame:
    """The last base plus the deltas after it, as they were before a batch."""
    bases = complete_dirs(spark, f"{table}/base", "upto")
    base = max((n for n in bases if before is None or n < before), default=-1)
    deltas = _sink_rows(spark, f"{table}/delta", schema).where(F.col(BATCH) > base)
    if before is not None:
        deltas = deltas.where(F.col(BATCH) < before)
    rows = deltas.drop(BATCH)
    if base >= 0:
        rows = rows.unionByName(spark.read.schema(schema).parquet(f"{table}/base/upto={base}"))
    return rows


def _place(schema: T.StructType) -> Column:
    """What orders the rows of an id: the version, and among equal ones the tick.

    A version written as text counts by the instant it names.
    """
    version = [F.col("version")]
    if isinstance(schema["version"].dataType, T.StringType):
        version.insert(0, F.try_to_timestamp("version").alias("instant"))
    return F.struct(*version, *(["tick"] if "tick" in schema.names else []))


def current_state(
    spark: SparkSession, table: str, schema: T.StructType, before: int | None = None
) -> DataFrame:
    """The newest version of every id."""
    history = _history(spark, table, schema, before)
    return newest_per_key(history, ["id"], [F.desc(_place(schema))])


def upsert_writer(table: str, schema: T.StructType, compact_every: int = 16) -> Writer:
    """Keeps the newest version of every id of its micro-batches in ``table``.

    A micro-batch writes only rows that differ from the current state; every
    ``compact_every`` batches the state is written out as a new base, so a read
    merges a bounded number of deltas and no batch rewrites the table.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        newest = newest_per_key(batch, ["id"], [F.desc(_place(schema))])
        # key columns of the table, aggregated before their shuffle; the same order decides
        # inside a micro-batch and between two
        history = _history(spark, table, schema, before=batch_id)
        held = history.groupBy("id").agg(F.max(_place(schema)).alias("__held"))
        changed = newest.join(held, "id", "left").where(
            F.col("__held").isNull() | (F.col("__held") < _place(schema))
        )
        delta = f"{table}/delta/{BATCH}={batch_id}"
        changed.select(*schema.names).write.mode("overwrite").parquet(delta)
        if batch_id % compact_every == compact_every - 1:
            merged = current_state(spark, table, schema, before=batch_id + 1)
            merged.write.mode("overwrite").parquet(f"{table}/base/upto={batch_id}")

    return run


def start_upsert(
    stream: DataFrame,
    table: str,
    checkpoint: str,
    compact_every: int = 16,
    trigger: dict | None = None,
) -> StreamingQuery:
    """``upsert_writer`` on a stream."""
    return _start(stream, upsert_writer(table, stream.schema, compact_every), checkpoint, trigger)
