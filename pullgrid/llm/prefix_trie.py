"""Prefix trie of conversations by a van Emde Boas recursion over depth.

A problem is a trie of some height below a named root. It is cut at half its height: the
prefixes that reach the cut are named by their content, the upper half stays a problem
of its root, and every named prefix is the root of a lower one. Both halves are solved
at the same time, so a trie of depth d takes log2(d / BLOCK) rounds over all problems.

* Sequences are cut into aligned blocks of ``BLOCK`` turns. Going up, two neighbouring
  blocks give the name of the stretch they cover. Going down, the left half of a stretch
  inherits its root and the right half's root is named by root and left half. A join or
  group on the way holds two rows, however long a conversation is.
* The last ``log2(BLOCK)`` cuts are made inside a row, on arrays, by the same recursion.
* Rows under one root name are the members of one node. A node's smallest member owns it,
  so a conversation owns a stretch at the end of its own path. Totals are grafted the same
  way upward: the left half of a stretch receives what is owned in the right half, and
  what its members carry sums to a node's subtree.

Nodes, children and members are counted with partial sums. The parent's smallest member
is the first of its run among children sorted over all partitions, so a node may have any
number of children. The member list of a node is hashed from pieces joined in parallel.

Names are 128-bit fingerprints: two different prefixes share one with a chance near
pairs / 2^128, that is never.

Defined results. Null role or text: empty. Null ``conv_id``: names no conversation, left
out. Null turns come first; equal turns, and repeated rows, are ordered by a fingerprint
of role and text and all count. A conversation without turns is a member of the root
alone. No rows: no nodes. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pullgrid.llm.common import partitions, table, written
from pullgrid.llm.runs import in_ranges, placed_in_runs, run_starts
from pullgrid.llm.words import mixed
from pullgrid.shipping import ship_package

BLOCK = 32  # turns of a block, a power of two
CHUNK = 1024  # rows of a conversation that meet one row of its plan
ROOT = (0, 0)  # the name of the empty prefix
HEADS, HOSTS, MOST = 6, 100, 5  # fixed values of the query: h < HEADS turns of a host

_draws = np.random.default_rng(20_241_113).integers(1, 1 << 63, (2, 4), np.uint64)
_STEP = _draws * np.uint64(2) + np.uint64(1)

TURN = "conv_id long, place long, t1 long, t2 long, chars long"


def _both(*columns: Column | str) -> tuple[Column, Column]:
    """Two independent 64-bit fingerprints."""
    return F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns)


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, t1, t2, chars): every turn's fingerprint at its place, from 0."""
    ship_package(conversations.sparkSession)
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    t1, t2 = _both(role, text)
    narrow = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        t1.alias("t1"),
        t2.alias("t2"),
        F.char_length(text).cast("long").alias("chars"),
    )
    # written first: the ranges are sampled from it, without the texts
    rows = written(narrow, "turns")
    placed = placed_in_runs(rows, ["conv_id"], ["turn", "t1", "t2"], "conv_id", "turn-places")
    return placed.select("conv_id", F.col("at").alias("place"), "t1", "t2", "chars")


def lengths_of(turns: DataFrame) -> DataFrame:
    return turns.groupBy("conv_id").agg((F.max("place") + 1).alias("length"))


# -- the recursion over blocks ------------------------------------------------------


def _rounds(blocks: DataFrame) -> int:
    return int(blocks.agg(F.coalesce(F.max("block"), F.lit(0))).first()[0]).bit_length()


def _halves(block: str = "block") -> tuple[Column, Column]:
    return F.col(block) % 2 == 0, F.col(block) % 2 == 1


def _block_roots(blocks: DataFrame) -> DataFrame:
    """(conv_id, block, r1, r2) of every block: the name of all turns before it.

    ``blocks``: (conv_id, block, n1, n2), the name of the turns in it. The last block of a
    conversation may be short; its name is never used.
    """
    left, right = _halves()
    levels, current = [], blocks
    for _ in range(_rounds(blocks)):
        pairs = current.groupBy("conv_id", F.shiftright("block", 1).alias("block")).agg(
            *[F.max(F.when(left, F.col(c))).alias(f"l{c}") for c in ("n1", "n2")],
            *[F.max(F.when(right, F.col(c))).alias(f"r{c}") for c in ("n1", "n2")],
        )
        levels.append(written(pairs, "halves"))
        n1, n2 = _both("ln1", "ln2", "rn1", "rn2")
        current = levels[-1].select("conv_id", "block", n1.alias("n1"), n2.alias("n2"))
    top = blocks.where("block = 0")
    roots = top.select("conv_id", "block", *[F.lit(v).cast("long").alias(c) for c, v in zip(("r1", "r2"), ROOT)])
    for pairs in reversed(levels):
        n1, n2 = _both("r1", "r2", "ln1", "ln2")
        upper = F.struct((F.col("block") * 2).alias("b"), F.col("r1").alias("x1"), F.col("r2").alias("x2"))
        lower = F.struct((F.col("block") * 2 + 1).alias("b"), n1.alias("x1"), n2.alias("x2"))
        both = F.when(F.col("rn1").isNull(), F.array(upper)).otherwise(F.array(upper, lower))
        met = roots.join(pairs, ["conv_id", "block"])
        roots = met.select("conv_id", F.inline(both)).toDF("conv_id", "block", "r1", "r2")
    return roots


def _grafts(blocks: DataFrame) -> DataFrame:
    """(conv_id, block, leaves, saved): what is owned in later blocks of the conversation.

    ``blocks``: (conv_id, block, leaves, saved), what is owned in it.
    """
    right = _halves()[1]
    names = ("leaves", "saved")
    levels, current = [], blocks
    for _ in range(_rounds(blocks)):
        pairs = current.groupBy("conv_id", F.shiftright("block", 1).alias("block")).agg(
            *[F.sum(c).alias(c) for c in names],
            *[F.sum(F.when(right, F.col(c))).alias(f"r{c}") for c in names],
        )
        levels.append(written(pairs, "halves"))
        current = levels[-1].select("conv_id", "block", *names)
    top = blocks.where("block = 0")
    below = top.select("conv_id", "block", *[F.lit(0).cast("long").alias(f"below_{c}") for c in names])
    for pairs in reversed(levels):
        grafted = [(F.col(f"below_{c}") + F.coalesce(f"r{c}", F.lit(0))).alias(f"x{c}") for c in names]
        upper = F.struct((F.col("block") * 2).alias("b"), *grafted)
        kept = [F.col(f"below_{c}").alias(f"x{c}") for c in names]
        lower = F.struct((F.col("block") * 2 + 1).alias("b"), *kept)
        both = F.when(F.col("rleaves").isNull(), F.array(upper)).otherwise(F.array(upper, lower))
        met = below.join(pairs, ["conv_id", "block"])
        below = met.select("conv_id", F.inline(both)).toDF(
            "conv_id", "block", *[f"below_{c}" for c in names]
        )
    return below


# -- the recursion inside a block ---------------------------------------------------

Name = tuple[np.ndarray, np.ndarray]


def _named(first: Name, second: Name) -> Name:
    lanes = [
        mixed(first[0] * s[0] + first[1] * s[1] + second[0] * s[2] + second[1] * s[3]) for s in _STEP
    ]
    return lanes[0], lanes[1]


def prefix_names(turns: Name, root: Name) -> Name:
    """Names of the prefixes before every column of turns, for many rows at once.

    The stretch of columns is cut in half: the upper half keeps the root, the lower one's
    root is named by the root and the upper half's content.
    """
    out = (np.zeros_like(turns[0]), np.zeros_like(turns[1]))

    def solve(low: int, high: int, above: Name) -> Name:
        """Fills the names of a stretch and returns the name of its content."""
        if high - low == 1:
            for lane in (0, 1):
                out[lane][:, low] = above[lane]
            return turns[0][:, low], turns[1][:, low]
        middle = (low + high) // 2
        upper = solve(low, middle, above)
        return _named(upper, solve(middle, high, _named(above, upper)))

    solve(0, turns[0].shape[1], root)
    return out


def _name_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        entries = batch.column("entries")
        bounds = entries.offsets.to_numpy().astype(np.int64)
        values = entries.values.slice(bounds[0], bounds[-1] - bounds[0])
        row = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
        at = values.field("at").to_numpy(zero_copy_only=False)
        grids = []
        for lane in ("t1", "t2"):
            grid = np.zeros((batch.num_rows, BLOCK), np.uint64)
            grid[row, at] = pc.fill_null(values.field(lane), 0).to_numpy(zero_copy_only=False).view(np.uint64)
            grids.append(grid)
        root = tuple(batch.column(c).to_numpy().view(np.uint64) for c in ("r1", "r2"))
        names = prefix_names((grids[0], grids[1]), root)
        fields = [values.field(c) for c in ("at", "t1", "t2", "chars")]
        own = [pa.array(n[row, at].view(np.int64)) for n in names]
        rows = pa.StructArray.from_arrays([*own, *fields], ["r1", "r2", "at", "t1", "t2", "chars"])
        offsets = pa.array((bounds - bounds[0]).astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), batch.column("block"), pa.ListArray.from_arrays(offsets, rows)],
            ["conv_id", "block", "entries"],
        )


_ENTRIES = "array<struct<r1:bigint,r2:bigint,at:int,t1:bigint,t2:bigint,chars:bigint>>"


def named_blocks(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """(conv_id, block, entries): turns with the names of the prefixes before them.

    Behind its last turn every conversation has an entry without one, whose name is that
    of the whole conversation.
    """
    ends = lengths.select(
        "conv_id",
        F.col("length").cast("long").alias("place"),
        *[F.lit(None).cast("long").alias(c) for c in ("t1", "t2", "chars")],
    )
    rows = turns.select("conv_id", "place", "t1", "t2", "chars").unionByName(ends)
    entry = F.struct((F.col("place") % BLOCK).cast("int").alias("at"), "t1", "t2", "chars")
    cut = rows.groupBy("conv_id", F.expr(f"place div {BLOCK}").alias("block")).agg(
        F.array_sort(F.collect_list(entry)).alias("entries")
    )
    blocks = written(cut, "blocks")
    # only conversations of several blocks need rounds between rows
    long_ones = lengths.where(F.col("length") >= BLOCK).select("conv_id")
    n1, n2 = _both(F.transform("entries", lambda e: F.struct(e["t1"], e["t2"])))
    named = written(
        blocks.select("conv_id", "block", n1.alias("n1"), n2.alias("n2")).join(
            long_ones, "conv_id", "left_semi"
        ),
        "block-names",
    )
    roots = _block_roots(named)
    rooted = blocks.join(roots, ["conv_id", "block"], "left").select(
        "conv_id", "block", "entries", *[F.coalesce(c, F.lit(v)).cast("long").alias(c) for c, v in zip(("r1", "r2"), ROOT)]
    )
    return written(
        rooted.mapInArrow(_name_rows, f"conv_id long, block long, entries {_ENTRIES}"), "named"
    )


# -- nodes --------------------------------------------------------------------------


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (r1, r2, conv_id) -> one row per run of a batch, with its ids joined by commas."""
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(c).to_numpy() for c in ("r1", "r2")]
        starts = np.flatnonzero(run_starts(keys, None)).astype(np.int32)
        bounds = pa.array(np.append(starts, np.int32(batch.num_rows)))
        texts = pa.ListArray.from_arrays(bounds, batch.column("conv_id").cast(pa.string()))
        at = pa.array(starts)
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c).take(at) for c in ("r1", "r2", "conv_id")], pc.binary_join(texts, ",")],
            ["r1", "r2", "first", "ids"],
        )


def _hashed_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (r1, r2, first, ids) -> the digest of each run's pieces, joined by commas."""
    open_key, digest = None, None

    def closed() -> pa.RecordBatch:
        r1, r2 = open_key
        return pa.RecordBatch.from_pydict(
            {"r1": pa.array([r1], pa.int64()), "r2": pa.array([r2], pa.int64()), "ends_sha256": [digest.hexdigest()]}
        )

    for batch in batches:
        done = []
        columns = [batch.column(c).to_pylist() for c in ("r1", "r2", "ids")]
        for r1, r2, ids in zip(*columns, strict=True):
            if (r1, r2) == open_key:
                digest.update(b"," + ids.encode())
                continue
            if open_key is not None:
                done.append(closed())
            open_key, digest = (r1, r2), hashlib.sha256(ids.encode())
        if done:
            yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
    if open_key is not None:
        yield closed()


def _member_digests(ends: DataFrame) -> DataFrame:
    """(r1, r2, ends_sha256) of the conversations that end under each name."""
    pieces = in_ranges(ends, ["r1", "r2", "conv_id"]).mapInArrow(
        _joined_ids, "r1 long, r2 long, first long, ids string"
    )
    spread = pieces.repartition(partitions(ends.sparkSession), "r1", "r2")
    return spread.sortWithinPartitions("r1", "r2", "first").mapInArrow(
        _hashed_ids, "r1 long, r2 long, ends_sha256 string"
    )


def prefix_trie(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """The nodes of the trie of all conversations.

    ``turns``: (conv_id, place, t1, t2, chars), places from 0 without gaps. ``lengths``:
    (conv_id, length) of every conversation, those without turns included.
    """
    name = ["r1", "r2"]
    blocks = named_blocks(turns, lengths)
    rows = blocks.select("conv_id", (F.col("block") * BLOCK).alias("start"), F.inline("entries"))
    rows = rows.withColumn("place", F.col("start") + F.col("at"))
    # members of a node by what they do next: one group per child, one for those that end
    nexts = rows.groupBy(*name, "t1", "t2").agg(
        F.count("*").alias("n"),
        F.min("conv_id").alias("conv_id"),
        F.max("place").alias("depth"),
        F.max("chars").alias("chars"),
    )
    nexts = nexts.select(*name, "conv_id", "n", "depth", "chars", F.col("t1").isNotNull().alias("goes_on"))
    led = written(placed_in_runs(nexts, name, ["conv_id"], "conv_id", "next-turns"), "children")
    children = led.where("goes_on").select(
        "conv_id",
        (F.col("depth") + 1).alias("depth"),
        F.col("lead").alias("parent_conv_id"),
        F.col("chars").alias("own_chars"),
    )
    nodes = led.groupBy(*name).agg(
        F.min("conv_id").alias("conv_id"),
        F.max("depth").alias("depth"),
        F.sum("n").alias("n_convs"),
        F.count_if("goes_on").alias("n_children"),
    )
    # (smallest member, depth) names a node too, which is how it meets its place as a child
    known = written(
        nodes.join(children, ["conv_id", "depth"], "left").select(
            *name,
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            (F.col("n_children") == 0).cast("long").alias("leaves"),
            ((F.col("n_convs") - 1) * F.coalesce("own_chars", F.lit(0))).alias("saved"),
        ),
        "nodes",
    )
    totals = _subtree_totals(blocks, known)
    ends = rows.where("t1 IS NULL").select(*name, "conv_id")
    digests = _member_digests(ends)
    return (
        known.select(*name, "conv_id", "depth", "parent_conv_id", "n_convs", "n_children")
        .join(totals, name, "left")
        .join(digests, name, "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            F.coalesce("n_leaves", F.lit(0)).alias("n_leaves"),
            F.coalesce("saved_tokens", F.lit(0)).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )


def _subtree_totals(blocks: DataFrame, known: DataFrame) -> DataFrame:
    """(r1, r2, n_leaves, saved_tokens): sums of what is owned at and below each node."""
    owned = known.where("leaves > 0 OR saved > 0").groupBy(
        "conv_id", F.expr(f"depth div {BLOCK}").alias("block")
    ).agg(
        F.sum("leaves").alias("leaves"),
        F.sum("saved").alias("saved"),
        # a node per turn of the block at most
        F.collect_list(
            F.struct((F.col("depth") % BLOCK).cast("int").alias("at"), "leaves", "saved")
        ).alias("own"),
    )
    owned = written(owned, "owned")
    # conversations of several blocks, and of them those that own something
    several = blocks.where("block > 0").select("conv_id").distinct()
    owners = owned.select("conv_id").distinct().join(several, "conv_id", "left_semi")
    zero = F.lit(0).cast("long")
    sums = owned.select("conv_id", "block", "leaves", "saved")
    long_ones = written(
        blocks.select("conv_id", "block")
        .join(owners, "conv_id", "left_semi")
        .join(sums, ["conv_id", "block"], "left")
        .select("conv_id", "block", *[F.coalesce(c, zero).alias(c) for c in ("leaves", "saved")]),
        "owned-blocks",
    )
    below = _grafts(long_ones)
    carried = owned.select("conv_id", "block", "own").join(below, ["conv_id", "block"], "full")
    met = blocks.join(carried, ["conv_id", "block"])
    own = F.coalesce("own", F.array().cast("array<struct<at:int,leaves:bigint,saved:bigint>>"))

    def from_here(entry: Column, what: str) -> Column:
        later = F.filter(own, lambda o: o["at"] >= entry["at"])
        return F.aggregate(later, F.coalesce(f"below_{what}", zero), lambda s, o: s + o[what])

    each = F.transform(
        "entries",
        lambda e: F.struct(
            e["r1"].alias("r1"),
            e["r2"].alias("r2"),
            from_here(e, "leaves").alias("leaves"),
            from_here(e, "saved").alias("saved"),
        ),
    )
    return (
        met.select(F.inline(each))
        .where("leaves > 0 OR saved > 0")
        .groupBy("r1", "r2")
        .agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    )


# -- the registered query -----------------------------------------------------------


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, lengths): every conversation with the head of its host before its own rest.

    c takes the first h = crc32(c) % 6 turns of conversation c - c % 100, then its own
    turns after the first h.
    """
    key = F.col("conv_id")
    skipped = (F.crc32(key.cast("string").cast("binary")) % HEADS).cast("long")
    held = F.struct("place", "t1", "t2", "chars")
    heads = (
        turns.where((key % HOSTS == 0) & (F.col("place") < MOST))
        .groupBy(key.alias("host"))
        .agg(F.array_sort(F.collect_list(held)).alias("heads"))
    )
    own = lengths_of(turns).withColumn("h", skipped).withColumn("host", key - key % HOSTS)
    plan = written(
        own.join(heads, "host", "left").select(
            "conv_id",
            "h",
            F.col("length").alias("n_own"),
            F.slice(F.coalesce("heads", F.array().cast(f"array<struct<{_HELD}>>")), F.lit(1), F.col("h").cast("int")).alias("heads"),
        ),
        "plan",
    )
    taken = F.size("heads").cast("long")
    lengths = plan.select(
        "conv_id", (taken + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))).alias("length")
    )
    first = plan.select("conv_id", F.inline("heads"))
    # a long conversation meets its plan in chunks, each with a copy of the one row
    chunks = plan.select(
        "conv_id",
        (taken - F.col("h")).alias("shift"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n_own - 1) div {CHUNK}"))).alias("chunk"),
    )
    rest = (
        turns.where(F.col("place") >= skipped)
        .withColumn("chunk", F.expr(f"place div {CHUNK}"))
        .join(chunks, ["conv_id", "chunk"])
        .select("conv_id", (F.col("place") + F.col("shift")).alias("place"), "t1", "t2", "chars")
    )
    return first.unionByName(rest), lengths


_HELD = "place:bigint,t1:bigint,t2:bigint,chars:bigint"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = turns_of(table(spark, sf_dir, "conversations"))
    return prefix_trie(*rebuilt(written(turns, "placed")))


SQL = """
WITH turns AS (
  SELECT conv_id,
         row_number() OVER (PARTITION BY conv_id
                            ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place,
         md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS mark,
         length(coalesce(text, '')) AS chars
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, conv_id - conv_id % 100 AS host, count(*) AS n_own,
         xor(4294967295, list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
           lambda crc, byte: list_reduce(
             list_prepend(xor(crc, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
             lambda a, _: xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END)))) % 6 AS h
  FROM turns GROUP BY conv_id
), sizes AS (
  SELECT c.conv_id, c.h, least(c.h, coalesce(o.n_own, 0)) AS taken
  FROM convs c LEFT JOIN convs o ON o.conv_id = c.host
), rebuilt AS (
  SELECT c.conv_id, t.place, t.mark, t.chars
  FROM convs c JOIN turns t ON t.conv_id = c.host AND t.place <= c.h
  UNION ALL
  SELECT t.conv_id, t.place - s.h + s.taken, t.mark, t.chars
  FROM turns t JOIN sizes s ON t.conv_id = s.conv_id AND t.place > s.h
), prefixes AS (
  SELECT conv_id, place AS depth, chars,
         md5(string_agg(mark, ',') OVER (PARTITION BY conv_id ORDER BY place)) AS name
  FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, 'root' FROM convs
), lengths AS (
  SELECT conv_id, max(depth) AS length FROM prefixes GROUP BY conv_id
), nodes AS (
  SELECT depth, name, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars
  FROM prefixes GROUP BY depth, name
), children AS (
  SELECT n.*, p.name AS parent_name
  FROM nodes n JOIN prefixes p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1
), parents AS (
  SELECT c.depth, c.name, p.conv_id AS parent_conv_id
  FROM children c JOIN nodes p ON p.name = c.parent_name AND p.depth = c.depth - 1
), fertile AS (
  SELECT depth - 1 AS depth, parent_name AS name, count(*) AS n_children
  FROM children GROUP BY ALL
), below AS (
  SELECT v.depth, v.name, sum((u.n_convs - 1) * u.chars) AS saved,
         count(*) FILTER (WHERE f.n_children IS NULL) AS leaves
  FROM prefixes v JOIN nodes u ON u.conv_id = v.conv_id AND u.depth >= v.depth
       LEFT JOIN fertile f ON f.depth = u.depth AND f.name = u.name
  GROUP BY v.depth, v.name
), ends AS (
  SELECT p.depth, p.name, string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id) AS ids
  FROM prefixes p JOIN lengths l ON l.conv_id = p.conv_id AND l.length = p.depth
  GROUP BY p.depth, p.name
)
SELECT n.conv_id, n.depth, p.parent_conv_id, n.n_convs,
       coalesce(f.n_children, 0) AS n_children, b.leaves AS n_leaves,
       CAST(b.saved AS BIGINT) AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM nodes n
     LEFT JOIN parents p ON p.depth = n.depth AND p.name = n.name
     LEFT JOIN fertile f ON f.depth = n.depth AND f.name = n.name
     LEFT JOIN below b ON b.depth = n.depth AND b.name = n.name
     LEFT JOIN ends e ON e.depth = n.depth AND e.name = n.name
"""
