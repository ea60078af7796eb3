"""Top rows and dense ranks per group that stay exact when one group is huge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    n: int,
    salt_on: Sequence[str] = (),
    salts: int = 64,
    rank: str = "rank",
) -> DataFrame:
    """The first ``n`` rows of every group, ranked from 1.

    Tasks keep at most ``n`` rows per group before the shuffle (Spark's window
    group limit). With ``salt_on`` the candidates of a group are then cut down
    in ``salts`` independent parts, so no task sorts all candidates of a hot
    group. Both steps only drop rows that ``n`` better ones precede.
    """
    if salt_on:
        df = df.withColumn("__salt", F.pmod(F.xxhash64(*salt_on), F.lit(salts)))
        part = Window.partitionBy(*keys, "__salt").orderBy(*order)
        df = df.withColumn("__part_rank", F.row_number().over(part))
        df = df.where(F.col("__part_rank") <= n).drop("__part_rank", "__salt")
    whole = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(whole)).where(F.col(rank) <= n)


def rank_in_group(
    df: DataFrame,
    keys: Sequence[str],
    bucket: Column,
    order: Sequence[Column],
    rank: str = "rank",
) -> DataFrame:
    """Dense rank from 1 over whole groups, without sorting a group in one task.

    ``bucket`` must agree with the leading sort key: all rows of a greater
    bucket come before those of a smaller one. Rows are numbered inside
    (group, bucket); one count per bucket gives the number of rows ahead.
    """
    df = df.withColumn("__bucket", bucket)
    ahead = (
        df.groupBy(*keys, "__bucket")
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumn(
            "__ahead",
            F.sum("__n").over(Window.partitionBy(*keys).orderBy(F.desc("__bucket")))
            - F.col("__n"),
        )
        .drop("__n")
    )
    inside = Window.partitionBy(*keys, "__bucket").orderBy(*order)
    return (
        df.withColumn("__inside", F.row_number().over(inside))
        .join(ahead, [*keys, "__bucket"])
        .withColumn(rank, F.col("__ahead") + F.col("__inside"))
        .drop("__bucket", "__inside", "__ahead")
    )


def newest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order``. Copies collapse before the shuffle."""
    return top_per_group(df, keys, order, 1, rank="__newest").drop("__newest")
