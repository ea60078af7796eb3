"""Line dedup: range-partitioned line hashes, first occurrences, keep bitmaps.

Every line becomes a 128-bit hash with its document and position. Hashes are
range-partitioned and sorted by document and position, and a window streams over
each run of equal hashes: its first document keeps the line, the others lose it.
A hash with more lines than a run may have is cut into salted runs first; each
run decides its own losers, and only the runs' first documents meet again. What
comes back per document is a bitmap of kept lines in 64-bit words, without the
words in which nothing is dropped; text moves once, to meet its bitmap.

Defined results. Null or empty text: one empty line, kept. Null ``doc_id``: the
document is left as it is and claims no line. Rows that repeat a ``doc_id`` count
as one document for the rule and keep a bitmap each. No rows: no rows. Other
columns pass through whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pullgrid.llm.common import BLANKS, ascii_lower, partitions, table, written

BUCKETS = 4096  # of hashes: only lines in crowded ones are counted by hash
RUN_LINES = 1_000_000  # a run that is longer is cut, whatever share of all lines it has
HOT_SHARE = 0.002  # so is one with more than this share of all lines
BROADCAST_HASHES = 1_000_000


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.trim(line, F.lit(BLANKS)))


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc, tag, pos, h1, h2) of every line long enough; ``tag`` tells rows of one doc_id apart."""
    lines = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select(
        F.col("doc_id").alias("doc"),
        F.xxhash64("text").alias("tag"),
        F.posexplode(split_lines(F.col("text"))).alias("pos", "line"),
    )
    keyed = lines.select("doc", "tag", "pos", line_key(F.col("line")).alias("key"))
    return keyed.where(F.char_length("key") >= min_chars).select(
        "doc",
        "tag",
        "pos",
        F.xxhash64("key").alias("h1"),
        F.xxhash64(F.lit(1), F.col("key")).alias("h2"),
    )


def hot_hashes(lines: DataFrame) -> DataFrame:
    """(hash, salts): hashes with more lines than a run may have, and the runs they are cut into.

    Lines are counted by bucket first. A bucket within the limit holds no hot hash, so only
    the lines of the others are counted by hash, before any line is dealt by it.
    """
    bucket = F.pmod("h1", F.lit(BUCKETS))
    counts = lines.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))  # over BUCKETS rows at most
    limit = F.greatest(F.lit(1.0), F.least(F.lit(float(RUN_LINES)), HOT_SHARE * total))
    crowded = written(
        counts.withColumn("limit", limit).where(F.col("n") > F.col("limit")).select("bucket", "limit"),
        "crowded",
    )
    inside = lines.join(F.broadcast(crowded), bucket == F.col("bucket"))
    held = inside.groupBy("h1", "limit").agg(F.count("*").alias("n")).where(F.col("n") > F.col("limit"))
    salts = F.ceil(F.col("n") / F.col("limit")).cast("int")
    return written(held.select(F.col("h1").alias("hash"), salts.alias("salts")), "hot")


def _with_salt(lines: DataFrame) -> DataFrame:
    hot = hot_hashes(lines)
    # at most as many as limits fit into all lines; more than can be broadcast: joined by hash
    if hot.count() <= BROADCAST_HASHES:
        hot = F.broadcast(hot)
    salt = F.pmod(F.xxhash64("doc", "tag", "pos"), F.col("salts"))
    return (
        lines.join(hot, F.col("h1") == F.col("hash"), "left")
        .withColumn("salt", F.coalesce(salt, F.lit(-1)))
        .drop("hash", "salts")
    )


def dropped_lines(lines: DataFrame) -> DataFrame:
    """(doc, tag, pos) of the lines that lose: their hash is in an earlier document."""
    run = Window.partitionBy("h1", "h2", "salt").orderBy("doc", "pos")
    ranged = _with_salt(lines).repartitionByRange(
        partitions(lines.sparkSession), "h1", "salt"
    )
    seen = ranged.withColumn("first_doc", F.first("doc").over(run))
    # the first document of a salted run may still lose to another run of its hash
    heads = seen.where("doc = first_doc AND salt >= 0")
    owners = heads.groupBy("h1", "h2").agg(F.min("doc").alias("owner"))
    late = heads.join(owners, ["h1", "h2"]).where("doc <> owner")
    lost = seen.where("doc <> first_doc").select("doc", "tag", "pos")
    return lost.unionByName(late.select("doc", "tag", "pos"))


def drop_bitmaps(lost: DataFrame) -> DataFrame:
    """(doc, tag, n_dropped, bitmap): 64-bit keep words of those words that lose a line."""
    word = lost.groupBy("doc", "tag", F.expr("pos div 64").cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("gone")
    )
    return word.groupBy("doc", "tag").agg(
        F.sum(F.bit_count("gone")).cast("long").alias("n_dropped"),
        F.collect_list(F.struct("word", F.bitwise_not("gone").alias("keep"))).alias("bitmap"),
    )


def keep_bitmaps(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    return drop_bitmaps(dropped_lines(written(line_hashes(docs, min_chars), "lines")))


def dedup_lines(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """(row, n_dropped, kept) per document: its columns as a struct, and the text that stays."""
    bitmaps = keep_bitmaps(docs, min_chars)
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    same = (F.col("row.doc_id") == F.col("doc")) & (F.xxhash64("row.text") == F.col("tag"))
    by_word = F.map_from_entries("bitmap")
    whole_word = F.lit(-1).cast("long")
    # the sparse words laid out once per text, so that a line finds its bit at once
    words = F.transform(
        F.sequence(F.lit(0), F.array_max(F.map_keys(by_word))),
        lambda w: F.coalesce(F.element_at(by_word, w), whole_word),
    )
    met = rows.join(bitmaps, same, "left")
    at = lambda dense, i: F.coalesce(F.get(dense, F.shiftright(i, 6)), whole_word)
    bit = lambda dense, i: F.getbit(at(dense, i), F.pmod(i, F.lit(64)))
    lines = split_lines(F.col("row.text"))
    # one layout per text: as a lambda's variable it is not computed again for each line
    cut = F.transform(
        F.array(words), lambda dense: F.filter(lines, lambda _, i: bit(dense, i) == 1)
    )[0]
    kept = F.when(F.col("bitmap").isNull(), F.coalesce("row.text", F.lit(""))).otherwise(
        F.array_join(cut, "\n")
    )
    return met.select(
        "row", F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"), kept.alias("kept")
    )


def line_count(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    return (F.char_length(text) - F.char_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast(
        "long"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).select(
        F.col("row.doc_id").alias("doc_id"),
        line_count(F.col("row.text")).alias("n_lines"),
        "n_dropped",
        F.sha2("kept", 256).alias("kept_sha256"),
    )


SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents
), keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), owners AS (
  SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) > 1
), judged AS (
  SELECT k.*, o.owner IS NOT NULL AND o.owner <> k.doc_id AS lost
  FROM keyed k LEFT JOIN owners o USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
