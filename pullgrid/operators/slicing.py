"""Contiguous, balanced slices of ranked work."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pullgrid.folders import scratch_dir


def slice_bounds(length: int, slices: int) -> list[tuple[int, int]]:
    """Half-open bounds of every slice of a list; empty slices are legal."""
    if slices < 1:
        raise ValueError(f"{slices} slices cannot hold any work")
    return [(i * length // slices, (i + 1) * length // slices) for i in range(slices)]


def slice_items(items: DataFrame, slices: int) -> DataFrame:
    """Add ``slice`` in [0, slices) to (full_name, rank) rows with dense ranks.

    Work is ordered by repository and rank. Rows ahead of a repository come
    from per-repository counts, summed in two levels (hash prefix, then name),
    so neither the rows nor the repositories pass through one task. The counts
    are written to the shared folder: the rows are then read once more only,
    and Spark knows the size of what it might broadcast.
    """
    if slices < 1:
        raise ValueError(f"{slices} slices cannot hold any work")
    # 3 hex digits: at most 4096 first-level rows
    prefix = F.substring(F.md5("full_name"), 1, 3)
    spark = items.sparkSession
    counts = scratch_dir(spark, "slice-counts")
    counted = items.groupBy("full_name").agg(F.count(F.lit(1)).alias("__n"))
    counted.withColumn("__prefix", prefix).write.parquet(counts)
    per_repo = spark.read.parquet(counts)
    level1 = (
        per_repo.groupBy("__prefix")
        .agg(F.sum("__n").alias("__m"))
        .select(
            "__prefix",
            (F.sum("__m").over(Window.orderBy("__prefix")) - F.col("__m")).alias("__before"),
            F.sum("__m").over(Window.partitionBy()).alias("__total"),
        )
    )
    within = Window.partitionBy("__prefix").orderBy("full_name")
    offsets = per_repo.withColumn("__in", F.sum("__n").over(within) - F.col("__n")).join(
        level1, "__prefix"
    )
    offsets = offsets.select(
        "full_name", (F.col("__before") + F.col("__in")).alias("__offset"), "__total"
    )
    position = F.col("__offset") + F.col("rank") - 1
    return (
        items.join(offsets, "full_name")
        .withColumn("slice", F.expr(f"(({slices} * (__offset + rank) - 1) div __total)"))
        .withColumn("position", position)
        .drop("__offset", "__total")
    )
