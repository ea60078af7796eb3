"""Where cached bodies lie: generations of hash buckets over the id.

    generations/<n>.json    the n-th generation; made only if absent, never changed
    base-<n>-<token>        one sorted file per bucket, written by a compaction; a key once
    delta-<n>-<token>       bucketed files that Spark jobs have appended since
    outcome=ok              plain files that tasks of the data source have appended
    outcome=failed          the quarantine

Base and deltas are bucketed by id as Spark buckets tables, so a join on the id moves the
items and leaves every body where it is, and a look at one id opens one bucket. Readers
hold on to the generation they began with; a compaction writes new files and a new
manifest, and ``expire`` removes what no newer generation names, after a while.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pullgrid.folders import PACKED, create_once, names_in, ready_dir, remove, scratch_dir, text_of, there
from pullgrid.functions.schema import plain_schema
from pullgrid.operators.ranking import newest_per_key, top_per_group

STORED = plain_schema(
    id=T.LongType(),
    version=T.StringType(),
    body=T.StringType(),
    fetched_ms=T.LongType(),
    status=T.IntegerType(),
    reason=T.StringType(),
    listed=T.StringType(),
)
LOOSE, FAILED, MANIFESTS = "outcome=ok", "outcome=failed", "generations"
ROWS_PER_BUCKET, ROWS_PER_TASK = 500_000, 100_000
# spark.shuffle.sort.bypassMergeThreshold
UNSORTED_SHUFFLE = 200
# a row group is the least that a task of the data source reads for one id
ROW_GROUP_BYTES = 16 << 20


@dataclass(frozen=True)
class Folder:
    name: str
    buckets: int


@dataclass(frozen=True)
class Generation:
    """What readers of the cache see; appends go to the last delta."""

    root: str
    number: int
    base: Folder | None
    deltas: tuple[Folder, ...]
    absorbed: tuple[str, ...] = ()  # plain files whose rows are in the base

    @property
    def folders(self) -> list[Folder]:
        return [*([self.base] if self.base else []), *self.deltas]

    @property
    def buckets(self) -> int:
        return self.deltas[-1].buckets

    def text(self) -> str:
        pair = lambda f: f and [f.name, f.buckets]
        content = {"base": pair(self.base), "deltas": [pair(f) for f in self.deltas]}
        return json.dumps(content | {"absorbed": list(self.absorbed)}) + "\n"


def parse_generation(root: str, number: int, text: str) -> Generation | None:
    """A manifest's content; none if it is not written whole yet."""
    if not text.endswith("\n"):
        return None
    held = json.loads(text)
    base = Folder(*held["base"]) if held["base"] else None
    deltas = tuple(Folder(*f) for f in held["deltas"])
    return Generation(root, number, base, deltas, tuple(held["absorbed"]))


def numbers(names) -> list[int]:
    """Generation numbers among file names, newest first."""
    return sorted((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), reverse=True)


def _read(spark: SparkSession, root: str, number: int) -> Generation | None:
    return parse_generation(root, number, text_of(spark, f"{root}/{MANIFESTS}/{number}.json"))


def newest_generation(spark: SparkSession, root: str) -> Generation | None:
    for number in numbers(names_in(spark, f"{root}/{MANIFESTS}")):
        found = _read(spark, root, number)
        if found:
            return found
    return None


def _new(kind: str, number: int, buckets: int) -> Folder:
    return Folder(f"{kind}-{number}-{uuid.uuid4().hex[:12]}", buckets)


def _commit(spark: SparkSession, wanted: Generation) -> Generation:
    if not create_once(spark, f"{wanted.root}/{MANIFESTS}/{wanted.number}.json", wanted.text()):
        raise RuntimeError(f"generation {wanted.number} of {wanted.root} was made by someone else")
    return wanted


def open_store(spark: SparkSession, root: str, buckets: int | None = None) -> Generation:
    """The newest generation; the first one is made where there is none."""
    root = ready_dir(spark, root).rstrip("/")
    found = newest_generation(spark, root)
    if found:
        return found
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    first = Generation(root, 0, None, (_new("delta", 0, count),))
    try:
        return _commit(spark, first)
    except RuntimeError:
        return newest_generation(spark, root) or first


def _bucketed(spark: SparkSession, root: str, folder: Folder, write: DataFrame | None = None) -> DataFrame:
    """A folder of the store as a bucketed table."""
    return _laid(spark, f"{root}/{folder.name}", STORED, ["id", "version"], folder.buckets, write)


def _laid(
    spark: SparkSession,
    location: str,
    schema: T.StructType,
    order: list[str],
    buckets: int,
    write: DataFrame | None = None,
) -> DataFrame:
    """A folder as a table bucketed by the first column of its order: declared, resolved (or
    appended to) and forgotten."""
    name = f"pullgrid_bodies_{uuid.uuid4().hex}"
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"""CREATE TABLE {name} ({columns}) USING parquet
        OPTIONS ('mapreduce.fileoutputcommitter.algorithm.version' = '2',
                 'parquet.block.size' = '{ROW_GROUP_BYTES}', 'compression' = '{PACKED["compression"]}')
        CLUSTERED BY ({order[0]}) SORTED BY ({", ".join(order)}) INTO {buckets} BUCKETS
        LOCATION '{location}'"""
    )
    try:
        if write is not None:
            write.select(*schema.names).write.insertInto(name)
        return spark.table(name)
    finally:
        # its files stay: the location is the store's
        spark.sql(f"DROP TABLE {name}")


def _loose_files(spark: SparkSession, generation: Generation) -> list[str]:
    names = names_in(spark, f"{generation.root}/{LOOSE}")
    done = set(generation.absorbed)
    return sorted(n for n in names if not n.startswith((".", "_")) and n not in done)


def _read_loose(spark: SparkSession, generation: Generation, names: list[str]) -> DataFrame:
    paths = [f"{generation.root}/{LOOSE}/{n}" for n in names]
    return spark.read.schema(STORED).parquet(*paths)


def sources(spark: SparkSession, generation: Generation) -> list[DataFrame]:
    """Good rows of base, deltas and plain files, each for itself.

    A join with one of them on the id leaves its buckets in place, and a look at one id
    opens one bucket. They are never united: Spark 4.1.2 takes a union of bucketed tables
    for one that lies by bucket and then reads it otherwise, so that a grouping over it
    gives wrong results.
    """
    held = [_bucketed(spark, generation.root, f) for f in generation.folders]
    loose = _loose_files(spark, generation)
    if loose:
        held.append(_read_loose(spark, generation, loose))
    named = F.coalesce("listed", "version")
    return [rows.where("reason IS NULL").withColumn("listed", named) for rows in held]


def stored(spark: SparkSession, generation: Generation) -> DataFrame:
    """All rows of a generation as they were written; a key written again appears again.

    Read as plain files, whatever their buckets.
    """
    folders = [f"{generation.root}/{f.name}" for f in generation.folders]
    loose = [f"{generation.root}/{LOOSE}/{n}" for n in _loose_files(spark, generation)]
    paths = [p for p in folders if there(spark, p)] + loose
    if not paths:
        return spark.createDataFrame([], STORED)
    rows = spark.read.schema(STORED).parquet(*paths)
    return rows.withColumn("listed", F.coalesce("listed", "version"))


def good(spark: SparkSession, generation: Generation) -> DataFrame:
    return stored(spark, generation).where("reason IS NULL")


def rejected(spark: SparkSession, generation: Generation) -> DataFrame:
    """The quarantine: rows with a reason."""
    rows = stored(spark, generation).where("reason IS NOT NULL")
    path = f"{generation.root}/{FAILED}"
    if names_in(spark, path):
        plain = spark.read.schema(STORED).parquet(path)
        rows = rows.unionByName(plain.withColumn("listed", F.coalesce("listed", "version")))
    return rows


def append(
    rows: DataFrame,
    generation: Generation,
    watch: Callable[[DataFrame], DataFrame] | None = None,
    finish: Callable[[DataFrame], DataFrame] | None = None,
    placed: bool = False,
) -> None:
    """Append rows. What a finished task wrote stays, even if the job fails later:
    a fetched body costs a request, and a key written twice is resolved on read.

    ``watch`` may observe the rows, and ``finish`` add to them where they are written. AQE cuts
    large buckets, so what a task sorts does not grow with the input: a bucket has as many files.
    ``placed`` rows lie by id already, in as many partitions as ``placing`` says.
    """
    n = generation.buckets
    spread = rows if placed else rows.hint("rebalance", n, "id")
    spread = watch(spread) if watch else spread
    # as the write wants them, so that it sorts nothing itself
    ordered = spread.sortWithinPartitions(F.pmod(F.hash("id"), F.lit(n)), "id", "version")
    ordered = finish(ordered) if finish else ordered
    _bucketed(rows.sparkSession, generation.root, generation.deltas[-1], ordered)


def placing(buckets: int, rows: int) -> int:
    """Partitions by id for rows that are to be appended: each bucket lies in one, or each in
    one bucket. A task sorts ``ROWS_PER_TASK`` rows, and ``ROWS_PER_BUCKET`` if that makes
    no more than ``UNSORTED_SHUFFLE`` partitions: those are shuffled straight to their
    files, and a task that reads bodies does not collect and spill them for it.
    """
    wanted = max(min(buckets, UNSORTED_SHUFFLE), -(-rows // ROWS_PER_TASK))
    least = max(min(buckets, UNSORTED_SHUFFLE) // 4, -(-rows // ROWS_PER_BUCKET), 1)
    few = [w for w in range(least, UNSORTED_SHUFFLE + 1) if buckets % w == 0 or w % buckets == 0]
    return next((w for w in few if w >= wanted), few[-1] if few else buckets * -(-wanted // buckets))


def compact(
    spark: SparkSession, root: str, keep: int | None = None, buckets: int | None = None
) -> Generation:
    """Merge base, deltas and plain files into a new base: a key once, the newest fetch.

    ``keep``: only the newest versions of an id stay, so many of them; all by default. New
    appends go to a new delta from the start, so none of them is missed. Which rows stay is
    settled on key columns; bodies are shuffled and sorted once. Where there is a single folder,
    neither keys nor bodies are shuffled: more buckets are made by cutting those it has.
    """
    start = open_store(spark, root)
    number = start.number + 1
    opened = replace(start, number=number, deltas=(*start.deltas, _new("delta", number, start.buckets)))
    _commit(spark, opened)
    loose = _loose_files(spark, opened)
    before = replace(opened, deltas=opened.deltas[:-1])
    everything = stored(spark, before)
    counts = [F.count_if(F.col("reason").isNull()), F.count("reason"), F.count_if(F.col("id").isNull())]
    total, n_failed, n_unnamed = everything.agg(*counts).first()
    if n_failed:
        failed = everything.where("reason IS NOT NULL")
        failed.write.mode("append").parquet(f"{start.root}/{FAILED}")
    full = [f for f in before.folders if there(spark, f"{start.root}/{f.name}")]
    held = full[0].buckets if len(full) == 1 else start.buckets
    wanted = buckets or max(start.buckets, held << (-(-total // (held * ROWS_PER_BUCKET)) - 1).bit_length())
    if len(full) == 1 and not loose and wanted % held == 0:
        alone = _bucketed(spark, start.root, full[0])
        rows, kept = alone.where("reason IS NULL"), _kept_places(alone, held, keep, placed=True)
    else:
        rows = everything.where("reason IS NULL").selectExpr(*_AT_PLACE).repartition(wanted, "id")
        kept = _kept_places(everything, wanted, keep)
    base = _new("base", number + 1, wanted)
    _bucketed(spark, start.root, base, _at_places(rows, kept, n_unnamed > 0))
    present = names_in(spark, f"{start.root}/{LOOSE}")
    done = tuple(n for n in (*opened.absorbed, *loose) if n in present)
    deltas = opened.deltas[-1:]
    if wanted != start.buckets:
        deltas = (*deltas, _new("delta", number + 1, wanted))
    return _commit(spark, Generation(start.root, number + 1, base, deltas, done))


_AT_PLACE = [*STORED.names, "struct(_metadata.file_name, _metadata.row_index) AS __at"]


_PLACES = plain_schema(held=T.LongType(), file=T.StringType(), row=T.LongType())


def _kept_places(
    everything: DataFrame, buckets: int, keep: int | None, placed: bool = False
) -> DataFrame:
    """Where the rows lie that a compaction keeps, by bucket. Reads no bodies, and moves no
    keys that are ``placed`` in these buckets."""
    keys = everything.selectExpr("id", "version", "reason", "fetched_ms", _AT_PLACE[-1])
    keys = keys if placed else keys.repartition(buckets, "id")
    order = [F.asc_nulls_first("reason"), F.desc("fetched_ms")]
    once = newest_per_key(keys, ["id", "version"], order).where("reason IS NULL")
    if keep is not None:
        order = [F.desc(F.struct(F.try_to_timestamp("version"), "version"))]
        once = top_per_group(once, ["id"], order, keep)
    places = once.selectExpr("id AS held", "__at.file_name AS file", "__at.row_index AS row")
    spark = everything.sparkSession
    return _laid(spark, scratch_dir(spark, "kept"), _PLACES, ["held"], buckets, places)


def _at_places(rows: DataFrame, kept: DataFrame, unnamed: bool) -> DataFrame:
    """The rows that lie at these places: bodies stream past hashed places, in their buckets.

    Beside the id the place is no join key, so that rows stay in their buckets; only rows
    that are ``unnamed``, without an id, make them move.
    """
    held = rows if "__at" in rows.columns else rows.selectExpr(*_AT_PLACE)
    same = F.col("id").eqNullSafe(F.col("held")) if unnamed else F.col("id") == F.col("held")
    there_too = F.array_contains(F.array("__at"), F.struct(F.col("file").alias("file_name"), F.col("row").alias("row_index")))
    met = held.join(kept.hint("shuffle_hash"), same & there_too)
    return met.withColumn("listed", F.coalesce("listed", "version"))


def expire(spark: SparkSession, root: str, older_than: float = 86_400.0) -> list[str]:
    """Remove what the newest generation no longer names; returns the names.

    Only what was superseded ``older_than`` seconds ago goes: no reader may run longer.
    """
    if not there(spark, root):
        return []
    root = ready_dir(spark, root).rstrip("/")
    newest = newest_generation(spark, root)
    written = names_in(spark, f"{root}/{MANIFESTS}")
    limit = (time.time() - older_than) * 1000
    # a generation is superseded when the next one is made
    old = [n for n in numbers(written) if f"{n + 1}.json" in written and written[f"{n + 1}.json"] <= limit]
    live = {f.name for f in newest.folders} if newest else set()
    gone = []
    for number in old:
        held = _read(spark, root, number)
        gone += [f.name for f in held.folders if f.name not in live and f.name not in gone]
    present = names_in(spark, root)
    gone = [n for n in gone if n in present]
    loose = names_in(spark, f"{root}/{LOOSE}")
    if newest and old and newest.number - 1 in old:
        gone += [f"{LOOSE}/{n}" for n in newest.absorbed if n in loose]
    for name in gone:
        remove(spark, f"{root}/{name}")
    return gone
