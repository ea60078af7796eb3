"""What several operators share: inputs, shared scratch tables, word splitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pullgrid.folders import scratch_dir
from pullgrid.shipping import ship_package

# white space between words: space, tab, line feed, vertical tab, form feed, return
BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared folder and read back: cuts lineage, survives lost executors."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all other letters untouched; plain ASCII takes the quick way."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


BROADCAST_IDS = 1_000_000  # eight bytes each
ROW = "__row_key"


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """The documents with a key of their own for every row, written so that it stays the same."""
    return written(docs.withColumn(ROW, F.monotonically_increasing_id()), name)


def by_row(rows: DataFrame) -> DataFrame:
    """(doc_id, text) of numbered documents, with the row's key as ``doc_id``."""
    return rows.select(F.col(ROW).alias("doc_id"), "text")


def without(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """The numbered documents whose key is not in the written table ``gone`` (doc_id), without it.

    Few keys are broadcast, so texts stay where they are; more are joined by key.
    """
    gone = gone.select(F.col("doc_id").alias("gone_key"))
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    return rows.join(gone, F.col(ROW) == F.col("gone_key"), "left_anti").drop(ROW)
