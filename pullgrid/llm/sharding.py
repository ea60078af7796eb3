"""Sharding by rendezvous hashing over weighted shards.

Every shard bids for a record with -weight / ln(u), where u in (0, 1) is a hash of the
record's key and the shard; the highest bid takes it, ties go to the lower shard. A
bid depends on its own shard only, so a further shard takes records into itself and
moves none between the others, and a shard's share follows its weight.

Slots number each shard's records without gaps. A shard may hold any number of rows,
so it is cut into buckets by a hash of key and text: a bucket is numbered by a
window, and a running sum over bucket counts (shards x buckets rows, so bounded)
gives each bucket its first slot. Texts are read but never moved.

Defined results. Null text: size 1, checksum 0. Null ``doc_id``: a key like any other.
Repeated rows share a shard and get a slot each. No rows: no rows. Other columns
pass through the operator whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pullgrid.llm.common import partitions, table

SHARDS = 8
BUCKETS = 1024  # per shard: bounds what is broadcast


def _bid(key: Column, shard: int, weight: float) -> Column:
    # 53 bits of the hash, moved off both ends of (0, 1)
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(shard), key), 11).cast("double")
    return -F.lit(float(weight)) / F.log((bits + 0.5) / F.lit(float(1 << 53)))


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard, 0 to len(weights) - 1, whose bid for the key is highest."""
    bids = [
        F.struct(_bid(key, s, w).alias("bid"), F.lit(-s).alias("shard"))
        for s, w in enumerate(weights)
    ]
    best = F.greatest(*bids) if len(bids) > 1 else bids[0]
    return (-best["shard"]).cast("int")


def shard(docs: DataFrame, weights: Sequence[float], carried: list[str] | None = None) -> DataFrame:
    """(row, size, text_crc32, shard, slot) per record; ``row`` holds the carried columns."""
    text = F.coalesce("text", F.lit(""))
    sized = docs.select(
        F.struct(*(carried or docs.columns)).alias("row"),
        F.col("doc_id").alias("key"),
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        rendezvous(F.col("doc_id"), weights).alias("shard"),
    )
    bucket = F.pmod(F.xxhash64("key", "text_crc32", "size"), F.lit(BUCKETS)).cast("int")
    placed = sized.withColumn("bucket", bucket)
    counts = placed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = (
        Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    firsts = counts.select(
        "shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")
    )
    inside = Window.partitionBy("shard", "bucket").orderBy("key", "text_crc32", "size")
    numbered = placed.repartition(partitions(docs.sparkSession), "shard", "bucket").withColumn(
        "at", F.row_number().over(inside) - 1
    )
    return numbered.join(F.broadcast(firsts), ["shard", "bucket"]).select(
        "row", "key", "size", "text_crc32", "shard", (F.col("first") + F.col("at")).alias("slot")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard(table(spark, sf_dir, "documents"), [1.0] * SHARDS, ["doc_id"])
    return placed.select(
        F.col("row.doc_id").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        rendezvous(F.col("key"), [1.0] * (SHARDS + 1)).alias("grown_shard"),
    )
