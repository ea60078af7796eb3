"""Best-fit packing of documents into sequences by exact complements.

Documents are encoded and cut into pieces of a sequence's length at most; only longer
documents are cut, and only their first piece may be shorter. What a plan needs to know
of the pieces is how many there are of each length, a table of ``MOST`` rows at most, so
the plan is made on the driver, whatever the corpus:

1. From the longest length down, the gap it leaves is looked up among the sums of one,
   two and three lengths that are still available. A combination that fills the gap
   exactly is used as often as its lengths' counts allow.
2. What no combination fills goes, longest first, where it leaves the least room.
3. Of a few shares, the one with the fewest sequences counts.

The plan is a list of patterns (lengths side by side) and how many sequences each has.
Every step uses up a length or a pattern, so there are a few thousand at most. The
pieces of a length are numbered over range partitions (``runs``), and the number says
which sequence and which offset of the plan a piece gets: nothing is gathered by length
or by sequence, and a length may have any number of pieces.

Defined results. Null or empty text: the end id alone. Null ``doc_id``: like any other.
Repeated rows are packed each by itself. No rows: no rows. A special token's string
becomes its id, as the library does. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pullgrid.llm.common import table, written
from pullgrid.llm.ragged import offsets
from pullgrid.llm.runs import placed_in_runs
from pullgrid.llm.slices import text_slices
from pullgrid.llm.token_files import library_encoder
from pullgrid.shipping import ship_package

MOST = 1024
END_ID = 2
SHARES = (0.5, 0.8, 0.95, 0.98)  # of a gap, for the longest length in it
_RANKS = 48  # bits of a piece's number among those of its length

Pattern = tuple[tuple[int, ...], int]  # lengths side by side, sequences of this kind


# -- the plan, on counts alone ------------------------------------------------------


class Available:
    """How many pieces of each length are not placed yet."""

    def __init__(self, counts: dict[int, int], most: int):
        self.most = most
        self.left = np.zeros(most + 1, np.int64)
        for length, n in counts.items():
            self.left[length] = n

    def uses(self, lengths: tuple[int, ...]) -> int:
        """How often a combination can be taken."""
        return min(int(self.left[n]) // k for n, k in Counter(lengths).items())

    def take(self, lengths: tuple[int, ...]) -> Pattern:
        uses = self.uses(lengths)
        for n in lengths:
            self.left[n] -= uses
        return lengths, uses

    def complement(self, longest: int, share: float) -> tuple[int, ...] | None:
        """Up to three available lengths that fill the gap beside ``longest``.

        The first of them holds ``share`` of the gap or more: short lengths fill many gaps
        and are worth keeping.
        """
        gap = self.most - longest
        least = share * gap
        if gap == 0:
            return ()
        if self.uses((longest, gap)):
            return (gap,)
        has = self.left > 0
        for b in self._pairs(has, gap):
            if b < least:
                return None
            if self.uses((longest, b, gap - b)):
                return b, gap - b
        # sums of two available lengths, then the lengths whose rest of the gap is such a sum
        sums = np.convolve(has, has)[: self.most + 1] > 0
        thirds = np.flatnonzero(has[1:gap] & sums[gap - 1 : 0 : -1]) + 1
        for b in thirds[::-1]:
            if b < max(least, gap / 3):
                break
            for c in self._pairs(has, gap - int(b)):
                if c <= b and self.uses((longest, int(b), c, gap - int(b) - c)):
                    return int(b), c, gap - int(b) - c
        return None

    @staticmethod
    def _pairs(has: np.ndarray, total: int) -> Iterator[int]:
        """The longer one of two available lengths of this sum, longest first."""
        low = np.arange(1, total // 2 + 1)
        for c in low[has[low] & has[total - low]]:
            yield total - int(c)


def exact_fills(held: Available, share: float) -> Iterator[Pattern]:
    """Patterns without a gap, until no combination of up to four lengths makes one."""
    for longest in range(held.most, 0, -1):
        while held.left[longest]:
            rest = held.complement(longest, share)
            if rest is None:
                break
            yield held.take((longest, *rest))


def best_fits(held: Available) -> Iterator[Pattern]:
    """Patterns of what is left: longest first, into the least gap that holds it."""
    most, open_ = held.most, {}  # gap -> [pattern, sequences]
    for length in range(most, 0, -1):
        n = int(held.left[length])
        while n:
            gap = min((g for g in open_ if g >= length), default=most)
            groups = open_.get(gap, [])
            lengths, sequences = groups.pop() if groups else ((), n)
            if not groups:
                open_.pop(gap, None)
            each = gap // length
            filled = min(sequences, n // each)
            used = [(filled, each)]
            if filled < sequences and n - filled * each:
                used.append((1, min(each, n - filled * each)))
            for some, copies in used:
                if some:
                    pattern = lengths + (length,) * copies
                    open_.setdefault(gap - length * copies, []).append((pattern, some))
                    n -= some * copies
                    sequences -= some
            if lengths and sequences:
                open_.setdefault(gap, []).append((lengths, sequences))
        held.left[length] = 0
    for groups in open_.values():
        yield from groups


def plan(counts: dict[int, int], most: int = MOST) -> list[Pattern]:
    """Patterns that place every piece once: the fewest sequences of the plans for ``SHARES``."""
    plans = []
    for share in SHARES:
        held = Available(counts, most)
        plans.append([*exact_fills(held, share), *best_fits(held)])
    return min(plans, key=lambda patterns: sum(n for _, n in patterns))


def places(patterns: list[Pattern]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first number with its length above it, sequence less number, offset), sorted.

    The pieces of one length are numbered; each stretch of numbers goes to one slot of one
    pattern's sequences.
    """
    used, rows, first = Counter(), [], 0
    for lengths, sequences in patterns:
        at = 0
        for length in lengths:
            rows.append(((length << _RANKS) + used[length], first - used[length], at))
            used[length] += sequences
            at += length
        first += sequences
    rows.sort()
    out = np.array(rows, np.int64).reshape(-1, 3)
    return out[:, 0], out[:, 1], out[:, 2]


# -- pieces -------------------------------------------------------------------------


def cut_lengths(sizes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, piece, length) of all pieces of documents of these sizes."""
    counts = -(-sizes // most)
    doc = np.repeat(np.arange(len(sizes)), counts)
    piece = np.arange(len(doc)) - np.repeat(offsets(counts)[:-1], counts)
    first = sizes - most * (counts - 1)
    return doc, piece, np.where(piece == 0, first[doc], most)


def pieces_of(
    docs: DataFrame, tokenizer: str, end_id: int = END_ID, most: int = MOST, with_ids: bool = False
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every piece, and its ids if wanted."""
    ship_package(docs.sparkSession)
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = library_encoder(tokenizer)
        for batch in text_slices(batches):
            ids, counts = encode(batch.column("text"))
            sizes = counts + 1
            ends = offsets(sizes)
            flat = np.full(ends[-1], end_id, "<u4")
            inner = np.ones(len(flat), bool)
            inner[ends[1:] - 1] = False
            flat[inner] = ids
            doc, piece, lengths = cut_lengths(sizes, most)
            bounds = offsets(lengths)
            raw = memoryview(flat).cast("B")
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            columns = [
                batch.column("doc_id").take(pa.array(doc)),
                pa.array(piece.astype(np.int32)),
                pa.array(bounds[:-1] - ends[doc]),
                pa.array(lengths),
                pa.array(crc, pa.int64()),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                held = pa.array(flat.astype(np.int32))
                columns.append(pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), held))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, schema + (", ids array<int>" if with_ids else ""))


def pack(pieces: DataFrame, most: int = MOST) -> DataFrame:
    """The pieces plus ``sequence_id`` and ``offset``; reads ``length`` and ``doc_id``.

    Lengths lie between 1 and ``most``. Other columns pass through.
    """
    held = written(pieces, "pieces")
    # a row per length
    counts = dict(held.groupBy("length").count().collect())
    firsts, shifts, ats = places(plan(counts, most))
    numbered = placed_in_runs(held, ["length"], ["doc_id"], "length", "piece-places")
    own = [f"`{c}`" for c in pieces.columns]
    numbered = numbered.selectExpr(*own, "at AS __number")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = batch.column("__number").to_numpy()
            key = (batch.column("length").to_numpy().astype(np.int64) << _RANKS) + number
            slot = np.searchsorted(firsts, key, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(shifts[slot] + number), pa.array(ats[slot])],
                [*batch.schema.names[:-1], "sequence_id", "offset"],
            )

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return numbered.mapInArrow(run, f"{kept}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, parts) of packed pieces with ids: a sequence's length of them at most."""
    part = F.struct("offset", "doc_id", "piece", "length", "ids")
    held = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    return held.select(
        "sequence_id",
        F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"),
        F.transform("parts", lambda p: p.dropFields("ids")).alias("parts"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    packed = pack(pieces_of(docs, public_tokenizers.path("byte_bpe_50k.json")))
    return packed.withColumn("piece", F.col("piece").cast("int"))
