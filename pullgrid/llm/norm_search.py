"""Ranked lexical search as maximum inner products over buckets of equal length.

A document's impacts and an item's weights are vectors over the items' terms; the score
is their inner product, so only terms of items are kept and a document's length is that
of what is left of it. The longest vectors can score highest:

1. Vectors are range-partitioned by length, longest first, and written: a partition is
   a run of buckets, and files know their longest and shortest vectors.
2. The longest ``SEED_SHARE`` are searched first; the score of each item's k-th best is
   a bound for the others. Vectors so short that no item can reach its bound (length of
   item times length of vector, by Cauchy-Schwarz) are not even read.
3. Along a partition, an item leaves the search at the first bucket whose longest vector
   cannot reach its bound. Inside a bucket the heaviest coordinates of the item that
   hold ``FOCUS`` of its squared length are multiplied, and Cauchy-Schwarz bounds the
   rest; pairs that stay below the item's bound are gone.
4. Survivors are scored again over all terms in 64-bit integers. Every task keeps k per
   item, which tightens its bounds, and the best of all tasks are ranked.

Bounds are doubles and get slack beyond their rounding, so nothing that ranks is lost. Items
come in blocks of about ``BLOCK_TERMS`` terms, which travel with the tasks; a block
makes one pass over the texts, and all its items meet a bucket together.

A term is known by 64 bits of a hash (``words``).

Defined results. Null or empty text, or one without terms: in no count and no result.
Null ``doc_id``: a document like any other, before others of its score. Rows that repeat
a ``doc_id`` or a text are documents of their own. Rows that repeat an ``item_id``, null
included, are one item with all their terms. Items without terms or matches: no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pullgrid.llm.common import table, written
from pullgrid.llm.ragged import gather, offsets
from pullgrid.llm.runs import in_ranges
from pullgrid.llm.slices import raw_bytes, text_slices
from pullgrid.llm.words import words_of
from pullgrid.operators.ranking import top_per_group

BEST = 20
BLOCK_TERMS = 2_000_000  # of a block of items, 16 bytes each
SEED_SHARE = 0.05
FOCUS = 0.75
BUCKET = 1024  # vectors
TOGETHER = 256  # items that meet a bucket at once
SLACK = 1 + 1e-9

# bytes of no term: ASCII but letters and digits
APART = np.zeros(256, bool)
APART[:128] = True
for _first, _last in ("09", "AZ", "az"):
    APART[ord(_first) : ord(_last) + 1] = False


def _terms(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(term hashes of all texts end to end, number of terms of each text)."""
    found = words_of(*raw_bytes(batch.column("text")), APART)
    return found.hashes, found.counts


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches):
        hashes, counts = _terms(batch)
        owner = pa.array(np.repeat(np.arange(batch.num_rows), counts))
        ids = batch.column("item_id").take(owner)
        yield pa.RecordBatch.from_arrays([ids, pa.array(hashes.view(np.int64))], ["item_id", "term"])


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term, n): how often each item holds each of its terms."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    found = rows.mapInArrow(_item_terms, "item_id long, term long")
    return found.groupBy("item_id", "term").agg(F.count("*").alias("n"))


def vectors(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """(doc_id, n, terms, tfs): of all terms the number, and the counts of those in the vocabulary.

    ``vocabulary``: sorted term hashes; ``terms`` are places in it, ascending.
    """
    size = len(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            hashes, counts = _terms(batch)
            place = np.minimum(np.searchsorted(vocabulary, hashes), size - 1)
            known = vocabulary[place] == hashes
            doc = np.repeat(np.arange(batch.num_rows), counts)[known]
            key, tfs = np.unique(doc * size + place[known], return_counts=True)
            bounds = np.searchsorted(key, np.arange(batch.num_rows + 1) * size).astype(np.int32)
            lists = [pa.array((key % size).astype(np.int32)), pa.array(tfs.astype(np.int32))]
            out = [pa.ListArray.from_arrays(pa.array(bounds), values) for values in lists]
            rows = pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts.astype(np.int64)), *out],
                ["doc_id", "n", "terms", "tfs"],
            )
            yield rows.filter(pa.array(counts > 0))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>")


def impacts(held: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """(doc_id, length, terms, impacts), sorted over all partitions by length, longest first."""
    m = F.expr(f"100 - 25 + ((25 * n * {n_docs}L) div {max(n_terms, 1)}L)")
    x = F.expr("transform(tfs, t -> cast((1000000000L * t) div (1000L * t + 12 * m) AS int))")
    squares = F.aggregate("impacts", F.lit(0.0), lambda s, v: s + v.cast("double") * v)
    rows = (
        held.where(F.size("terms") > 0)
        .withColumn("m", m)
        .withColumn("impacts", x)
        .select("doc_id", F.sqrt(squares).alias("length"), "terms", "impacts")
    )
    return in_ranges(rows, [F.desc("length")])


# -- items, as every task holds them ------------------------------------------------


@dataclass
class Items:
    """A block of items: terms end to end, by falling weight in each item."""

    ids: list[int | None]
    bounds: np.ndarray
    terms: np.ndarray  # places in the vocabulary
    weights: np.ndarray  # weight times occurrences
    least: np.ndarray  # scores an item's rows must reach

    @property
    def lengths(self) -> np.ndarray:
        return np.sqrt(np.add.reduceat(self.weights.astype(float) ** 2, self.bounds[:-1]))

    def part(self, low: int, high: int) -> Items:
        a, b = self.bounds[low], self.bounds[high]
        return Items(
            self.ids[low:high],
            self.bounds[low : high + 1] - a,
            self.terms[a:b],
            self.weights[a:b],
            self.least[low:high],
        )


def weigh(
    rows: list[tuple[int | None, int, int]], vocabulary: np.ndarray, found: dict[int, int], n_docs: int
) -> Items:
    """Items of (item_id, term hash, n) rows; terms without weight or documents are left out."""
    grouped: dict[int | None, list[tuple[int, int]]] = {}
    for item, term, n in rows:
        place = int(np.searchsorted(vocabulary, np.uint64(term & (1 << 64) - 1)))
        df = found.get(place, 0)
        weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) if df else 0
        if weight > 0:
            grouped.setdefault(item, []).append((weight * n, place))
    for held in grouped.values():
        held.sort(reverse=True)
    flat = [t for held in grouped.values() for t in held]
    return Items(
        list(grouped),
        offsets(np.array([len(h) for h in grouped.values()], np.int64)),
        np.array([t[1] for t in flat], np.int64),
        np.array([t[0] for t in flat], np.int64),
        np.ones(len(grouped), np.int64),
    )


class Focus:
    """The heaviest coordinates of some items, by term, and the length of the rest."""

    def __init__(self, items: Items, size: int):
        squares = items.weights.astype(float) ** 2
        sums = offsets_float(squares)
        item = np.repeat(np.arange(len(items.ids)), np.diff(items.bounds))
        before = sums[:-1] - sums[items.bounds[:-1]][item]
        whole = items.lengths**2
        inside = before < FOCUS * whole[item]
        order = np.argsort(items.terms[inside], kind="stable")
        self.item, self.weight = item[inside][order], items.weights[inside][order].astype(float)
        self.starts = np.searchsorted(items.terms[inside][order], np.arange(size + 1))
        held = np.bincount(item[inside], squares[inside], len(items.ids))
        self.rest = np.sqrt(np.maximum(whole - held, 0)) * SLACK


def offsets_float(values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values) + 1)
    np.cumsum(values, out=out[1:])
    return out


class Search:
    """The best rows of some items among the vectors of a partition, longest first."""

    def __init__(self, items: Items, size: int, best: int):
        self.items, self.size, self.best = items, size, best
        self.lengths = items.lengths * SLACK
        self.focus = Focus(items, size)
        self.least = items.least.copy()
        # (item, score, known id, id) of the rows kept
        self.kept = [np.zeros(0, np.int64) for _ in range(4)]

    def survivors(self, doc: np.ndarray, term: np.ndarray, x: np.ndarray, length: np.ndarray):
        """(document, item) pairs that the bounds let through."""
        active = np.flatnonzero(self.lengths * length[0] >= self.least)
        if not len(active):
            return active, active
        n, width = len(length), len(self.items.ids)
        focus = self.focus
        starts = focus.starts[term]
        many = focus.starts[term + 1] - starts
        cell = np.repeat(doc, many) * width + gather(focus.item, starts, many)
        value = np.repeat(x.astype(float), many)
        inner = np.bincount(cell, value * gather(focus.weight, starts, many), n * width)
        met = np.bincount(cell, value * value, n * width).reshape(n, width)[:, active]
        rest = np.sqrt(np.maximum((length**2)[:, None] * SLACK - met, 0))
        bound = inner.reshape(n, width)[:, active] + focus.rest[active] * rest
        row, column = np.nonzero(bound * SLACK >= self.least[active])
        return row, active[column]

    def add(self, ids: pa.Array, doc, term, x, length) -> None:
        row, item = self.survivors(doc, term, x, length)
        if not len(row):
            return
        score = self.scores(doc, term, x, row, item)
        good = score >= self.least[item]
        row, item, score = row[good], item[good], score[good]
        known = ids.is_valid().to_numpy(zero_copy_only=False)[row].astype(np.int64)
        number = ids.fill_null(0).to_numpy(zero_copy_only=False)[row]
        held = [np.concatenate(p) for p in zip(self.kept, (item, score, known, number), strict=True)]
        order = np.lexsort((held[3], held[2], -held[1], held[0]))
        held = [h[order] for h in held]
        starts = np.searchsorted(held[0], np.arange(len(self.items.ids)))
        rank = np.arange(len(held[0])) - starts[held[0]]
        self.kept = [h[rank < self.best] for h in held]
        last = held[0][rank == self.best - 1]
        self.least[last] = np.maximum(self.least[last], held[1][rank == self.best - 1])

    def scores(self, doc, term, x, row: np.ndarray, item: np.ndarray) -> np.ndarray:
        """Exact scores of pairs; a document's terms ascend, so its entries are found by place."""
        key, out = doc * self.size + term, np.zeros(len(row), np.int64)
        counts = np.diff(self.items.bounds)[item]
        ends = np.cumsum(counts)
        low = 0
        while low < len(row):
            # a bounded number of terms at a time
            high = max(low + 1, int(np.searchsorted(ends, ends[low] - counts[low] + 2_000_000, "right")))
            some = slice(low, high)
            starts, many = self.items.bounds[:-1][item[some]], counts[some]
            wanted = np.repeat(row[some], many) * self.size + gather(self.items.terms, starts, many)
            at = np.minimum(np.searchsorted(key, wanted), len(key) - 1)
            product = np.where(key[at] == wanted, x[at], 0) * gather(self.items.weights, starts, many)
            out[some] = np.add.reduceat(product, offsets(many)[:-1])
            low = high
        return out


def search(ordered: DataFrame, items: Items, size: int, best: int) -> DataFrame:
    """(item_id, doc_id, score): of every task the best rows of every item."""
    held = ordered.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = held.value
        parts = range(0, len(items.ids), TOGETHER)
        searches = [Search(items.part(a, min(a + TOGETHER, len(items.ids))), size, best) for a in parts]
        for batch in batches:
            for start in range(0, batch.num_rows, BUCKET):
                part = batch.slice(start, BUCKET)
                lists = part.column("terms")
                bounds = lists.offsets.to_numpy().astype(np.int64)
                inside = slice(bounds[0], bounds[-1])
                doc = np.repeat(np.arange(part.num_rows), np.diff(bounds))
                term = lists.values.to_numpy()[inside].astype(np.int64)
                impact = part.column("impacts")
                ends = impact.offsets.to_numpy()
                x = impact.values.to_numpy()[ends[0] : ends[-1]].astype(np.int64)
                length = part.column("length").to_numpy()
                for one in searches:
                    one.add(part.column("doc_id"), doc, term, x, length)
        for one in searches:
            item, score, known, number = one.kept
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(one.items.ids, pa.int64()).take(pa.array(item)),
                    pa.array(number, mask=known == 0),
                    pa.array(score),
                ],
                ["item_id", "doc_id", "score"],
            )

    return ordered.mapInArrow(run, "item_id long, doc_id long, score long")


def _ranked(rows: DataFrame, best: int) -> DataFrame:
    order = [F.desc("score"), F.asc_nulls_first("doc_id")]
    return top_per_group(rows, ["item_id"], order, best, salt_on=["doc_id"])


def _block(docs: DataFrame, terms: list[tuple], best: int) -> DataFrame:
    """(item_id, doc_id, score, rank) of a block of items, one pass over the texts."""
    hashes = np.array([t[1] for t in terms], np.int64).view(np.uint64)
    vocabulary = np.unique(hashes)
    held = written(vectors(docs, vocabulary), "vectors")
    n_docs, n_terms = held.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    # a row per term of the block at most
    found = dict(held.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
    items = weigh(terms, vocabulary, found, n_docs)
    schema = "item_id long, doc_id long, score long, rank int"
    if not items.ids:
        return docs.sparkSession.createDataFrame([], schema)
    ordered = written(impacts(held, n_docs, n_terms), "by-length")
    size = len(vocabulary)
    cut = ordered.agg(F.percentile_approx("length", 1 - SEED_SHARE)).first()[0]
    seeds = written(_ranked(search(ordered.where(F.col("length") >= cut), items, size, best), best), "seeds")
    # a row per item of the block
    reached = {r.item_id: r.score for r in seeds.where(F.col("rank") == best).collect()}
    items.least = np.array([max(1, reached.get(i, 1)) for i in items.ids], np.int64)
    reach = float(np.min(items.least / (items.lengths * SLACK)))
    rest = ordered.where((F.col("length") < cut) & (F.col("length") >= reach))
    rows = search(rest, items, size, best).unionByName(seeds.drop("rank"))
    return written(_ranked(rows, best).select("item_id", "doc_id", "score", "rank"), "ranked")


def rank(docs: DataFrame, items: DataFrame, best: int = BEST) -> DataFrame:
    """(item_id, rank, doc_id, score): the best documents of every item."""
    terms = written(item_terms(items), "item-terms")
    blocks = -(-terms.count() // BLOCK_TERMS)
    block = F.pmod(F.xxhash64("item_id"), F.lit(max(blocks, 1)))
    out = docs.sparkSession.createDataFrame([], "item_id long, doc_id long, score long, rank int")
    for k in range(blocks):
        rows = [tuple(r) for r in terms.where(block == k).collect()]
        if rows:
            out = out.unionByName(_block(docs, rows, best))
    return out.select("item_id", "rank", "doc_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL = r"""
WITH cut AS (
  SELECT 'd' AS kind, doc_id AS id, unnest(regexp_extract_all(translate(text,
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
  UNION ALL
  SELECT 'i', item_id, unnest(regexp_extract_all(translate(text,
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) FROM benchmark
), counted AS (
  SELECT kind, id, term, count(*) AS n FROM cut GROUP BY ALL
), docs AS (
  SELECT id, sum(n)::BIGINT AS n FROM counted WHERE kind = 'd' GROUP BY id
), totals AS (
  SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM docs
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM counted, totals WHERE kind = 'd' GROUP BY term
), sizes AS (
  SELECT id, 100 - 25 + ((25 * n * n_docs) // n_terms) AS m FROM docs, totals
), scored AS (
  SELECT i.id AS item_id, d.id AS doc_id,
         CAST(sum(i.n * w * ((1000000000 * d.n) // (1000 * d.n + 12 * m))) AS BIGINT) AS score
  FROM counted i JOIN weights USING (term)
       JOIN counted d ON d.term = i.term AND d.kind = 'd' JOIN sizes s ON s.id = d.id
  WHERE i.kind = 'i' GROUP BY i.id, d.id HAVING score > 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS r
  FROM scored
)
SELECT item_id, CAST(r AS INTEGER) AS rank, doc_id, score FROM ranked WHERE r <= 20
"""
