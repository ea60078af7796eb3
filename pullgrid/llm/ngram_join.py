"""N-gram Jaccard join as a blocked sparse product of documents by n-grams.

1. *Column blocks.* Every document becomes its set of five-word shingles. The columns
   of the incidence matrix are cut into blocks by hash; a task sends each block the
   shingles it holds, as packed numbers, with shingles that several of its documents
   hold sent once. A block finds the columns with a single entry. A document links to
   another only if three quarters of its shingles are in other documents too, so most
   documents end here.
2. *Copies.* Documents with equal sets become one node.
3. *Row blocks.* Nodes that share a min-hash with the same popular node are a family: it
   holds most links. A family is cut into parts of bounded size, and each two parts are
   multiplied as incidence matrices, which counts every overlap; what comes back is not
   the pairs but one edge per node that connects the same components.
4. *Product.* Links that may be missing lie between different components and families, so
   only shingles that occur in two components count, and only nodes of which they make up
   three quarters. Of those the rarest few that a match must touch are multiplied:
   matches are summed per pair, and a pair is discarded once its count and what is left
   behind its last match cannot reach the bound given by the two sizes.
5. Remaining pairs are counted in full: 100 * intersection >= 75 * union.
6. *Links*, where asked for: all links lie within components. Each is cut into parts of
   bounded size like a family, every two parts are multiplied once, and a task returns one
   number per node: the documents behind the sets that it links to. Pairs are never rows.

Steps 1 and 4 drop only what cannot link; no group, bucket or candidate list is capped.

Defined results. Null, empty or blank text: no shingles, a component by itself. Null
``doc_id``: counted, linked with nothing, null component. Rows that repeat a ``doc_id``
are told apart by their text; equal rows fall together in a component, and each counts
as a link of the others. No rows: no rows. Other columns are carried by the caller.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pullgrid.llm.common import partitions, table, written
from pullgrid.llm.components import components
from pullgrid.llm.ragged import offsets
from pullgrid.llm.slices import raw_bytes, text_slices
from pullgrid.llm.words import distinct_per_text, mixed, shingle_hashes, words_of
from pullgrid.shipping import ship_package

SHINGLE = 5
SIMILARITY = 75  # per cent
BLOCKS_PER_PARTITION = 4
CHUNK_SHINGLES = 4_000_000
CHUNK_DOCS = 60_000  # below 2^16: a document's place in its chunk takes two bytes
MIN_HASHES = 8
TILE_NODES, TILE_SHINGLES = 1_000, 300_000
DENSE_FROM, DENSE_COLUMNS = 32, 4_096
BROADCAST_ROWS = 500_000
CROWD, CROWD_SHARE = 500, 100_000  # a key is crowded beyond 500 rows and one in 100,000 of all
_SEEDS = np.random.default_rng(7).integers(1, 1 << 62, MIN_HASHES).astype(np.uint64)


def _sets(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    flat, ends = raw_bytes(batch.column("text"))
    return distinct_per_text(*shingle_hashes(words_of(flat, ends), SHINGLE))


def _signature(own: np.ndarray) -> bytes:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest()


# ---- 1. column blocks -------------------------------------------------------------------

_WIRE = (
    "chunk long, block int, fps binary, owners binary, several binary, "
    "ids array<long>, sigs binary, sizes binary, shared binary"
)
_NAMES = [c.split(" ")[0] for c in _WIRE.split(", ")]


def _wire(**columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    types = {"chunk": pa.int64(), "block": pa.int32(), "ids": pa.list_(pa.int64())}
    return pa.RecordBatch.from_arrays(
        [pa.array(columns.get(c, [None] * n), types.get(c, pa.binary())) for c in _NAMES], _NAMES
    )


def _steps(sorted_: np.ndarray) -> bytes:
    """Ascending 24-bit numbers as differences: two bytes each if all fit, else four."""
    steps = np.diff(sorted_, prepend=sorted_[:1])
    head = np.array(sorted_[:1], "<u4").tobytes()
    return head + steps.astype("<u2" if not len(steps) or steps.max() < 1 << 16 else "<u4").tobytes()


def _numbers(steps: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.int64)
    kind = "<u2" if len(steps) - 4 == 2 * n else "<u4"
    body = np.frombuffer(steps, kind, offset=4).astype(np.int64)
    return int(np.frombuffer(steps, "<u4", 1)[0]) + np.cumsum(body)


def _chunk_rows(chunk: int, blocks: int, docs: list, sets: list[np.ndarray]) -> pa.RecordBatch:
    """What a chunk of documents sends: one row per block, and one about its documents."""
    sizes = np.array([len(s) for s in sets], np.int64)
    hashes = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    block = ((hashes >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    key = (block << np.uint64(24)) | (hashes & np.uint64(0xFFFFFF))
    order = np.argsort(key)
    key, owner = key[order], owner[order]
    same = np.zeros(len(key) + 1, bool)
    same[1:-1] = key[1:] == key[:-1]
    several = same[:-1] | same[1:]
    shared = np.bincount(owner[several], minlength=len(sets))
    first_of_several = several & ~same[:-1]
    single = ~several
    cuts = np.arange(blocks + 1, dtype=np.uint64) << np.uint64(24)
    fp = (key & np.uint64(0xFFFFFF)).astype(np.int64)

    def by_block(mask):
        values = fp[mask]
        return values, np.searchsorted(key[mask], cuts)

    ones, one_cuts = by_block(single)
    more, more_cuts = by_block(first_of_several)
    one_owner = owner[single].astype("<u2")
    spans = list(zip(one_cuts[:-1], one_cuts[1:], more_cuts[:-1], more_cuts[1:], strict=True))
    used = [b for b, (a, z, c, y) in enumerate(spans) if z > a or y > c]
    rows = {
        "chunk": [chunk] * (len(used) + 1),
        "block": [*used, chunk % blocks],
        "fps": [_steps(ones[spans[b][0] : spans[b][1]]) for b in used] + [None],
        "owners": [one_owner[spans[b][0] : spans[b][1]].tobytes() for b in used] + [None],
        "several": [more[spans[b][2] : spans[b][3]].astype("<u4").tobytes() for b in used] + [None],
        "ids": [None] * len(used) + [docs],
        "sigs": [None] * len(used) + [b"".join(_signature(s) for s in sets)],
        "sizes": [None] * len(used) + [sizes.astype("<u4").tobytes()],
        "shared": [None] * len(used) + [shared.astype("<u4").tobytes()],
    }
    return _wire(**rows)


def _send(blocks: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, docs, sets, held = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in text_slices(batches):
            hashes, ends = _sets(batch)
            docs += batch.column("doc_id").to_pylist()
            sets += [hashes[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
            held += len(hashes)
            while held >= CHUNK_SHINGLES or len(docs) >= CHUNK_DOCS:
                now = min(len(docs), CHUNK_DOCS)
                yield _chunk_rows(chunk, blocks, docs[:now], sets[:now])
                docs, sets = docs[now:], sets[now:]
                held = sum(len(s) for s in sets)
                chunk += 1
        if docs:
            yield _chunk_rows(chunk, blocks, docs, sets)

    return run


def _rows_of(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, list[dict]]]:
    rows = (row for batch in batches for row in batch.to_pylist())
    for value, group in groupby(rows, key=lambda r: r[key]):
        yield value, list(group)


def _count_block(rows: list[dict]) -> pa.RecordBatch:
    """Of each chunk's documents, how many single entries here are in other chunks too."""
    parts = [r for r in rows if r["ids"] is None]
    about = [r for r in rows if r["ids"] is not None]
    owners = [np.frombuffer(r["owners"], "<u2") for r in parts]
    fps = [_numbers(r["fps"], len(o)) for r, o in zip(parts, owners, strict=True)]
    several = [np.frombuffer(r["several"], "<u4").astype(np.int64) for r in parts]
    flat = np.concatenate([np.zeros(0, np.int64), *fps])
    part = np.repeat(np.arange(len(parts)), [len(f) for f in fps])
    known = np.zeros(1 << 24, bool)
    known[np.concatenate([np.zeros(0, np.int64), *several])] = True
    order = np.argsort(flat, kind="stable")
    equal = flat[order][1:] == flat[order][:-1]
    known[flat[order][1:][equal]] = True
    hit = known[flat]
    owner = np.concatenate([np.zeros(0, "<u2"), *owners]).astype(np.int64)
    code, counts = np.unique(part[hit] << 16 | owner[hit], return_counts=True)
    cuts = np.searchsorted(code, np.arange(len(parts) + 1) << 16)
    told = [k for k in range(len(parts)) if cuts[k + 1] > cuts[k]]
    at = lambda k: slice(cuts[k], cuts[k + 1])
    columns = {
        "chunk": [parts[k]["chunk"] for k in told],
        "owners": [(code[at(k)] & 0xFFFF).astype("<u2").tobytes() for k in told],
        "shared": [counts[at(k)].astype("<u4").tobytes() for k in told],
    }
    for name in _NAMES:
        columns[name] = columns.get(name, [None] * len(told)) + [r[name] for r in about]
    return _wire(**columns)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, rows in _rows_of(batches, "block"):
        yield _count_block(rows)


def _sum_chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, rows in _rows_of(batches, "chunk"):
        about = next(r for r in rows if r["ids"] is not None)
        shared = np.frombuffer(about["shared"], "<u4").astype(np.int64)
        for row in rows:
            if row["ids"] is None:
                shared[np.frombuffer(row["owners"], "<u2")] += np.frombuffer(row["shared"], "<u4")
        sigs = about["sigs"]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(about["ids"], pa.int64()),
                pa.array([sigs[k : k + 16] for k in range(0, len(sigs), 16)], pa.binary()),
                pa.array(np.frombuffer(about["sizes"], "<u4").astype(np.int64)),
                pa.array(shared),
            ],
            ["doc_id", "sig", "n", "shared"],
        )


def sketch(docs: DataFrame) -> DataFrame:
    """(doc_id, sig, n, shared): set signature, set size, shingles that other documents may hold."""
    ship_package(docs.sparkSession)
    n = partitions(docs.sparkSession)
    sent = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _send(n * BLOCKS_PER_PARTITION), _WIRE
    )
    counted = sent.repartition(n, "block").sortWithinPartitions("block").mapInArrow(_count, _WIRE)
    return (
        counted.repartition(n, "chunk")
        .sortWithinPartitions("chunk")
        .mapInArrow(_sum_chunk, "doc_id long, sig binary, n long, shared long")
    )


# ---- 2. nodes -----------------------------------------------------------------------------


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches):
        hashes, ends = _sets(batch)
        sigs = batch.column("sig").to_pylist()
        keep = [k for k in range(len(sigs)) if _signature(hashes[ends[k] : ends[k + 1]]) == sigs[k]]
        if not keep:
            continue
        keys = [np.minimum.reduceat(mixed(hashes ^ s), ends[:-1][keep]) for s in _SEEDS]
        own = [hashes[ends[k] : ends[k + 1]].view(np.int64) for k in keep]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([sigs[k] for k in keep], pa.binary()),
                pa.array([len(s) for s in own], pa.int64()),
                pa.ListArray.from_arrays(
                    pa.array(offsets(np.array([len(s) for s in own])).astype(np.int32)),
                    pa.array(np.concatenate(own)),
                ),
                pa.array(list(np.stack(keys, 1).view(np.int64)), pa.list_(pa.int64())),
            ],
            ["sig", "n", "shingles", "keys"],
        )


def nodes(docs: DataFrame, sketched: DataFrame) -> DataFrame:
    """(node, sig, n, shingles, keys): the sets that may have a link, one of equal ones."""
    may = sketched.where(f"doc_id IS NOT NULL AND n > 0 AND 100 * shared >= {SIMILARITY} * n")
    first = may.groupBy("sig").agg(F.min("doc_id").alias("first_id"))
    first = written(first, "survivors")
    if first.count() <= BROADCAST_ROWS:
        first = F.broadcast(first)
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    chosen = texts.join(first, F.col("id") == F.col("first_id")).select("sig", "text")
    sets = chosen.mapInArrow(
        _set_rows, "sig binary, n long, shingles array<long>, keys array<long>"
    )
    return written(sets.withColumn("node", F.monotonically_increasing_id()), "sets")


# ---- 3. to 5. links -------------------------------------------------------------------------


def _may_match(a: str, b: str) -> Column:
    return 100 * F.least(a, b) >= SIMILARITY * F.greatest(a, b)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) whose sets are similar enough, counted in full."""
    side = lambda x, y: sets.select(
        F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("shingles").alias(y)
    )
    met = pairs.join(side("u", "left"), "u").join(side("v", "right"), "v")
    both = met.withColumn("both", F.size(F.array_intersect("left", "right")))
    union = F.col("n_u") + F.col("n_v") - F.col("both")
    return both.where(100 * F.col("both") >= SIMILARITY * union).select("u", "v")


def _told(rows: DataFrame, facts: DataFrame, crowded: DataFrame) -> DataFrame:
    """What is known of a key, told to its rows; the rows of a crowded key stay where they are."""
    keys = ["k", "key"]
    crowd = F.broadcast(crowded.select(*keys))
    popular = rows.join(F.broadcast(facts.join(crowd, keys, "left_semi")), keys)
    others = rows.join(crowd, keys, "left_anti").join(facts.join(crowd, keys, "left_anti"), keys)
    return popular.unionByName(others)


def families(sets: DataFrame) -> DataFrame:
    """(node, family): the most popular of the nodes that lead one of its min-hashes.

    Popular is who shares its min-hashes with many, as the original of edited copies does.
    Keys are counted before rows are dealt by them: at most ``CROWD_SHARE`` are crowded,
    and what is known of those is broadcast.
    """
    keyed = sets.select("node", F.posexplode("keys").alias("k", "key"))
    counts = keyed.groupBy("k", "key").agg(F.count("*").alias("held")).where("held > 1")
    held = written(counts, "held")
    rows = held.agg(F.coalesce(F.sum("held"), F.lit(0))).first()[0]
    crowded = held.where(F.col("held") > max(CROWD, rows // CROWD_SHARE))
    shared = written(_told(keyed, held, crowded), "keys")
    popular = shared.groupBy("node").agg(F.sum("held").alias("popular"))
    leaders = written(
        shared.join(popular, "node")
        .groupBy("k", "key")
        .agg(F.max(F.struct("popular", "node")).alias("leader")),
        "leaders",
    )
    return (
        _told(shared, leaders, crowded)
        .groupBy("node")
        .agg(F.max("leader")["node"].alias("family"))
    )


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """How many shingles each two of the sets share: the product of their incidence rows."""
    size = len(sets)
    row = np.repeat(np.arange(size), [len(s) for s in sets])
    _, column, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    total = np.zeros((size, size), np.float32)
    # columns that many hold: dense blocks; the others: their few pairs, one by one
    many = np.flatnonzero(held > DENSE_FROM)
    place = np.full(len(held), -1)
    place[many] = np.arange(len(many))
    for start in range(0, len(many), DENSE_COLUMNS):
        width = min(DENSE_COLUMNS, len(many) - start)
        own = (place[column] >= start) & (place[column] < start + width)
        block = np.zeros((size, width), np.float32)
        block[row[own], place[column[own]] - start] = 1
        total += block @ block.T
    few = (held[column] > 1) & (place[column] < 0)
    order = np.argsort(column[few], kind="stable")
    row, column = row[few][order], column[few][order]
    for step in range(1, DENSE_FROM):
        same = np.flatnonzero(column[step:] == column[:-step]) if step < len(column) else []
        if not len(same):
            break
        code = row[same] * size + row[same + step]
        total += np.bincount(code, minlength=size * size).reshape(size, size)
        code = row[same + step] * size + row[same]
        total += np.bincount(code, minlength=size * size).reshape(size, size)
    return total


def _multiplied(tile: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """The tile's rows by node, and which two of them are linked."""
    tile = tile.sort_by("node")
    sets = [s.values.to_numpy() for s in tile.column("shingles")]
    n = np.array([len(s) for s in sets], np.float64)
    both = overlaps(sets).astype(np.float64)
    return tile, 100 * both >= SIMILARITY * (n[:, None] + n[None, :] - both)


def _tile_links(tile: pa.Table) -> pa.Table:
    """(u, v) that connect a tile's nodes as their links do: each node and the least it reaches."""
    tile, linked = _multiplied(tile)
    nodes_, size = tile.column("node").to_numpy(), len(linked)
    label = np.arange(size)
    while True:
        least = np.where(linked, label[None, :], size).min(1)
        least = np.minimum(label, least)
        least = least[least]
        if (least == label).all():
            break
        label = least
    moved = np.flatnonzero(label != np.arange(size))
    return pa.table({"u": nodes_[moved], "v": nodes_[label[moved]]})


def _tile_counts(tile: pa.Table) -> pa.Table:
    """(node, linked): documents of other nodes it links to, each pair of nodes in one tile."""
    tile, linked = _multiplied(tile)
    part, copies = tile.column("part").to_numpy(), tile.column("copies").to_numpy()
    np.fill_diagonal(linked, False)
    if part.min() < part.max():
        # links inside a part are counted in the tile that the part has to itself
        linked &= part[:, None] != part[None, :]
    total = np.where(linked, copies[None, :], 0).sum(1)
    return pa.table({"node": tile.column("node"), "linked": pa.array(total, pa.int64())})


def tiles(sets: DataFrame, group: str) -> DataFrame:
    """The rows of each group with two or more, once for every two parts that it is cut into.

    A part has a bounded size; a row's ``tile`` names the group and the two parts.
    """
    sizes = sets.groupBy(group).agg(F.count("*").alias("held"), F.sum("n").alias("total"))
    parts = sizes.where("held > 1").select(
        group,
        F.ceil(F.greatest(F.col("held") / TILE_NODES, F.col("total") / TILE_SHINGLES))
        .cast("int")
        .alias("parts"),
    )
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    placed = sets.join(parts, group).select("*", part.alias("part"), other.alias("other"))
    a, b = F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b")
    return placed.withColumn("tile", F.struct(group, a, b))


def family_links(sets: DataFrame) -> DataFrame:
    """Links within families, found tile by tile."""
    rows = tiles(sets.select("node", "family", "n", "shingles"), "family")
    rows = rows.select("node", "shingles", "tile")
    return rows.groupBy("tile").applyInArrow(_tile_links, "u long, v long")


def link_counts(sets: DataFrame) -> DataFrame:
    """(node, linked) of sets (node, label, n, shingles, copies) that share a component."""
    rows = tiles(sets, "label").select("node", "shingles", "copies", "part", "tile")
    counted = rows.groupBy("tile").applyInArrow(_tile_counts, "node long, linked long")
    return counted.groupBy("node").agg(F.sum("linked").alias("linked"))


def _labelled(sets: DataFrame, links: DataFrame) -> DataFrame:
    labels = components(links).select(F.col("node").alias("member"), "label")
    met = sets.join(labels, F.col("node") == F.col("member"), "left")
    return met.withColumn("label", F.coalesce("label", "node")).drop("member")


def product_pairs(sets: DataFrame) -> DataFrame:
    """(u, v) of different components and families that sizes and counted matches still allow."""
    entries = sets.select("node", "label", "family", "n", F.explode("shingles").alias("s"))
    crossing = (
        entries.groupBy("s")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("held"))
        .where("low <> high")
        .select("s", "held")
    )
    columns = entries.join(crossing, "s")
    # ascending by how often a shingle is held: what a match must touch comes first
    rows = columns.groupBy("node", "label", "family", "n").agg(
        F.array_sort(F.collect_list(F.struct("held", "s"))).alias("row")
    )
    crosses = F.size("row").cast("long")
    must = F.ceil(SIMILARITY * F.col("n") / 100)
    rows = rows.where(crosses >= must).withColumn("crosses", crosses)
    entry = rows.select(
        "node",
        "label",
        "family",
        "n",
        "crosses",
        F.posexplode(F.slice("row", F.lit(1), (F.col("crosses") - must + 1).cast("int"))).alias(
            "at", "cell"
        ),
    ).select("node", "label", "family", "n", "crosses", "at", F.col("cell.s").alias("s"))
    named = lambda x: entry.select("s", *[F.col(c).alias(f"{c}_{x}") for c in entry.columns if c != "s"])
    matches = named("u").join(named("v"), "s").where(
        (F.col("node_u") < F.col("node_v"))
        & (F.col("label_u") != F.col("label_v"))
        & (F.col("family_u") != F.col("family_v"))
        & _may_match("n_u", "n_v")
    )
    summed = matches.groupBy("node_u", "node_v", "n_u", "n_v", "crosses_u", "crosses_v").agg(
        F.count("*").alias("hits"), F.max("at_u").alias("last_u"), F.max("at_v").alias("last_v")
    )
    rest = F.least(
        F.col("crosses_u") - F.col("last_u") - 1, F.col("crosses_v") - F.col("last_v") - 1
    )
    enough = (100 + SIMILARITY) * (F.col("hits") + rest) >= SIMILARITY * (F.col("n_u") + F.col("n_v"))
    return summed.where(enough).select(F.col("node_u").alias("u"), F.col("node_v").alias("v"))


def jaccard_components(docs: DataFrame, links: bool = False) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs``; with ``links``, n_links too."""
    sketched = written(sketch(docs), "sketch")
    sets = nodes(docs, sketched)
    member = families(sets).withColumnRenamed("node", "member")
    sets = sets.join(member, F.col("node") == F.col("member"), "left").drop("member", "keys")
    sets = written(sets.withColumn("family", F.coalesce("family", "node")), "families")
    within = written(family_links(sets), "within")
    labelled = written(_labelled(sets, within), "labels")
    more = verified(product_pairs(labelled), labelled)
    final = _labelled(labelled.drop("label"), within.unionByName(more))
    known = sketched.where("doc_id IS NOT NULL AND n > 0")
    held = known.groupBy("sig").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies"))
    # the least document of each component, told to each of its signatures
    groups = written(final.select("node", "sig", "label").join(held, "sig"), "groups")
    least = groups.groupBy("label").agg(F.min("first_id").alias("component_id"))
    # rows that repeat a document give its set twice: one node speaks for it
    of_sig = groups.groupBy("sig").agg(
        F.min("node").alias("node"), F.min("label").alias("label"), F.min("copies").alias("copies")
    )
    facts = [F.col("sig").alias("group_sig"), "component_id"]
    if links:
        rows = of_sig.select("node", "label", "copies").join(sets.select("node", "n", "shingles"), "node")
        of_sig = of_sig.join(written(link_counts(rows), "counts"), "node", "left")
        # of equal rows each has the others
        facts.append((F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"))
    known_sigs = written(of_sig.join(least, "label").select(*facts), "facts")
    # few sets are told to all rows, so those of a large group of copies stay where they are
    if known_sigs.count() <= BROADCAST_ROWS:
        known_sigs = F.broadcast(known_sigs)
    met = sketched.join(known_sigs, F.col("sig") == F.col("group_sig"), "left")
    linked = F.col("doc_id").isNotNull() & (F.col("n") > 0)
    component = F.when(linked, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id"))
    out = ["doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")]
    if links:
        out.append(F.when(linked, F.coalesce("n_links", F.lit(0))).otherwise(F.lit(0)).alias("n_links"))
    return met.select(*out)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), links=True)


SQL = """
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM split
), entries AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
  SELECT a.doc_id AS u, b.doc_id AS v FROM entries a JOIN entries b USING (g)
  WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sets
  UNION SELECT r.doc_id, l.v FROM reach r JOIN links l ON r.other = l.u
)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(r.other) AS component_id,
       coalesce(any_value(l.n_links), 0)::BIGINT AS n_links
FROM sets s JOIN reach r USING (doc_id)
LEFT JOIN (SELECT u, count(*) AS n_links FROM links GROUP BY u) l ON l.u = s.doc_id
GROUP BY s.doc_id, s.s
"""
