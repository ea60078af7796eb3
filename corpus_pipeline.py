"""A training corpus from ``documents``: filter, dedup, decontaminate, encode.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet in the shared folder and read again as the next stage's documents. All but the
last return the columns of documents. Decisions are exact and made on all rows that the
stage before has kept; the cutoffs, copies and leaks are found anew on them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pullgrid.llm import bpe, latent_leaks, line_dedup, ngram_join, quality_rules
from pullgrid.llm.common import ROW, by_row, numbered, table, without, written

BROADCAST_GROUPS = 200_000


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the cutoffs of their stratum."""
    judged = quality_rules.judge(docs, table(spark, sf_dir, "labels"))
    return judged.where("kept").select("row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document has; their length follows."""
    cut = line_dedup.dedup_lines(docs)
    changed = F.col("n_dropped") > 0
    new = {
        "text": F.when(changed, F.col("kept")).otherwise(F.col("row.text")),
        "n_chars": F.when(changed, F.char_length("kept")).otherwise(F.col("row.n_chars")),
    }
    types = dict(docs.dtypes)
    return cut.select(
        *[new.get(c, F.col(f"row.`{c}`")).cast(types[c]).alias(c) for c in docs.columns]
    )


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: the one with the least id, null ids last.

    Rows are told apart by a key of their own, so null and repeated ids count like others.
    """
    rows = numbered(docs, "rows")
    found = ngram_join.jaccard_components(by_row(rows)).withColumnRenamed("doc_id", "row_key")
    # ties of an id go to the text's hash: rows that agree in both are alike
    order = F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64("text"), ROW)
    places = rows.select(F.col(ROW).alias("place_key"), order.alias("place"))
    met = found.join(places, F.col("row_key") == F.col("place_key"))
    members = written(met.select("row_key", "component_id", "place"), "members")
    sized = members.groupBy("component_id").agg(F.min("place").alias("first"), F.count("*").alias("held"))
    firsts = written(sized.where("held > 1").select("component_id", "first"), "firsts")
    if firsts.count() <= BROADCAST_GROUPS:
        firsts = F.broadcast(firsts)
    later = members.join(firsts, "component_id").where(f"place.{ROW} <> first.{ROW}")
    return without(rows, written(later.select(F.col("row_key").alias("doc_id")), "copies"))


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item, whatever their ids."""
    rows = numbered(docs, "rows")
    found = latent_leaks.leaks(by_row(rows), table(spark, sf_dir, "benchmark"))
    return without(rows, written(found.select("doc_id").distinct(), "leaks"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256) of every document left."""
    import public_tokenizers

    encoded = bpe.encode(
        docs, public_tokenizers.path("byte_bpe_50k.json"), ["doc_id"], output="ids"
    )
    return encoded.select(
        F.col("row.doc_id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", leaks),
    ("BPE encoding and decoding", tokens),
]

# binomial cutoffs, components, latent search and merging in turn: tested by brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
