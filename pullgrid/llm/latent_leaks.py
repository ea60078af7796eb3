"""Benchmark decontamination by words that a match cannot lack.

Benchmark items are taken in blocks. For a block, all documents are read once to count
in how many of them each of its words occurs. A document holds an item if some stretch
of twice the item's length holds three quarters of its words in order (their longest
common subsequence), or three fifths if the item's answer, its last line or sentence, is
in or near the stretch too; so paraphrases count and shared topics do not.

Which stretches are compared follows from that: a match leaves out so many of the item's
places at most, so of the rarest places, that many and a quarter of the item more, it has
a quarter at least. All words of all documents are looked up among these; what has
too few within a stretch cannot match, and everything else is settled on the words.
However common an item or its words are, no match is lost. Nothing latent is searched: a
match is defined on the words, so a latent score could only add work or lose matches.

Defined results. Null or empty text, item or document: no match. Null ids stay null and
match like others. Repeated rows: found each, reported once per pair of ids. Items of
equal text: each reported. No documents or no items: no rows. Items of one word match
nothing. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pullgrid.llm.common import table
from pullgrid.llm.ragged import gather, offsets
from pullgrid.llm.slices import raw_bytes, text_slices
from pullgrid.llm.words import BLANK_OR_MARK, Words, words_of
from pullgrid.shipping import ship_package

BLOCK_ITEMS = 256  # items searched in one pass; their words bound what is broadcast
SLICE = 1_000_000  # bytes of text at once: what is made of them stays in the cache
COVERED = 0.75  # of an item's words, in order
COVERED_WITH_ANSWER = 0.6
ANSWER_COVERED = 0.75
LEAST_WORDS = 2
STRETCH = 2  # times an item's words: where its words are looked for
NEAR = 3  # times an item's words, before and after: where its answer may be
WHOLE = STRETCH + 2 * NEAR
HITS_OF = 4  # a quarter of an item's places: how many of its rarer ones are asked for
WINDOW = 1 << 16  # words of a text searched at once
HITS_AT_ONCE = 2_000_000


def item_words(texts: list[str | None]) -> Words:
    flat, ends = raw_bytes(pa.array(texts, pa.string()))
    return words_of(flat, ends, BLANK_OR_MARK)


def answer_of(text: str) -> str:
    """The last line of several, else the last sentence of several, else nothing."""
    for mark in ("\n", ". "):
        head, _, tail = text.strip().rstrip(".").rpartition(mark)
        if head and tail.strip():
            return tail
    return ""


@dataclass
class Items:
    ids: list
    words: list[np.ndarray]
    answers: list[np.ndarray]
    vocabulary: np.ndarray  # sorted word hashes

    @classmethod
    def of(cls, rows: list) -> Items:
        kept = [r for r in rows if r.text]
        cut = lambda w: [w.hashes[a:b] for a, b in zip(w.bounds[:-1], w.bounds[1:], strict=True)]
        words = cut(item_words([r.text for r in kept]))
        answers = cut(item_words([answer_of(r.text) for r in kept]))
        rows_ = [x for x in zip(kept, words, answers, strict=True) if len(x[1]) >= LEAST_WORDS]
        vocabulary = np.unique(np.concatenate([np.zeros(0, np.uint64), *(w for _, w, _ in rows_)]))
        return cls(
            [r.item_id for r, _, _ in rows_],
            [w for _, w, _ in rows_],
            [a for _, _, a in rows_],
            vocabulary,
        )


def terms(hashes: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    """Each word's place in the vocabulary, or -1."""
    at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    return np.where(vocabulary[at] == hashes, at, -1)


def _words_in(batch: pa.RecordBatch) -> Words:
    flat, ends = raw_bytes(batch.column("text"))
    return words_of(flat, ends, BLANK_OR_MARK)


def document_counts(docs: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """In how many documents each word occurs."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        counts, seen = np.zeros(len(own), np.int64), np.zeros(len(own), bool)
        for batch in text_slices(batches, most=SLICE):
            words = _words_in(batch)
            found = terms(words.hashes, own)
            for a, b in zip(words.bounds[:-1], words.bounds[1:], strict=True):
                here = found[a:b]
                seen[here[here >= 0]] = True
                counts += seen
                seen[:] = False
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["term", "n"])

    rows = (
        docs.select("text")
        .mapInArrow(run, "term long, n long")
        .groupBy("term")
        .agg(F.sum("n").alias("n"))
        .toArrow()  # a row per word of the block
    )
    counts = np.zeros(len(vocabulary), np.int64)
    counts[rows.column("term").to_numpy()] = rows.column("n").to_numpy()
    return counts


def window_size(n_words: int) -> int:
    """A power of two in whose half steps an item always lies whole."""
    return max(8, 1 << int(2 * n_words - 1).bit_length())


def windows(words: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, end) of windows of ``size`` words, half of it apart."""
    step, counts = size // 2, words.counts
    per_text = np.maximum(1, -(-(counts - step) // step)) * (counts > 0)
    text = np.repeat(np.arange(len(counts)), per_text)
    firsts = np.zeros(len(per_text) + 1, np.int64)
    np.cumsum(per_text, out=firsts[1:])
    k = np.arange(len(text)) - firsts[text]
    start = words.bounds[text] + k * step
    return text, start, np.minimum(start + size, words.bounds[text + 1])


# ---- search and check --------------------------------------------------------------------


def common_subsequence(words: np.ndarray, places: dict[int, int], n: int) -> int:
    """Length of the longest common subsequence; ``places``: bits of each item word's places."""
    return subsequence([hit for hit in map(places.get, words.tolist()) if hit], n)


def subsequence(hits: list[int], n: int) -> int:
    """The same, of words given by the bits of their places."""
    free = (1 << n) - 1
    full = free
    for hit in hits:
        taken = free & hit
        free = ((free + taken) | (free - taken)) & full
    return n - free.bit_count()


def places_of(words: np.ndarray) -> dict[int, int]:
    out: dict[int, int] = {}
    for k, word in enumerate(words.tolist()):
        out[word] = out.get(word, 0) | 1 << k
    return out


@dataclass
class Search:
    """What a task needs to search its documents for a block of items."""

    items: Items
    counts: np.ndarray  # in how many documents each word of the vocabulary occurs

    def __post_init__(self):
        self.sizes = np.array([len(w) for w in self.items.words], np.int64)
        self.places = [places_of(w) for w in self.items.words]
        self.answer_places = [places_of(a) for a in self.items.answers]
        # every stretch lies whole in one of these windows, with what is near it
        self.window = max(WINDOW, window_size(WHOLE * int(self.sizes.max())))
        self.needed = np.zeros(len(self.sizes), np.int64)
        self.hits = np.zeros(len(self.sizes), np.int64)
        told, item, weight = [], [], []
        for k, words in enumerate(self.items.words):
            own, n = terms(words, self.items.vocabulary), len(words)
            least = COVERED_WITH_ANSWER if len(self.items.answers[k]) else COVERED
            self.needed[k] = next(x for x in range(n + 1) if x / n >= least)
            missed = n - self.needed[k]
            self.hits[k] = min(self.needed[k], -(-n // HITS_OF))
            # a match misses ``missed`` places at most, so it has ``hits`` of these
            rare = own[np.argsort(self.counts[own], kind="stable")[: missed + self.hits[k]]]
            rare, places = np.unique(rare, return_counts=True)
            told.append(rare)
            item.append(np.full(len(rare), k))
            weight.append(places)
        told = np.concatenate(told)
        order = np.argsort(told, kind="stable")
        self.told_item = np.concatenate(item)[order]
        self.told_weight = np.concatenate(weight)[order]
        self.told_counts = np.bincount(told, minlength=len(self.counts))
        self.told_starts = offsets(self.told_counts)[:-1]

    def matches(self, words: Words) -> dict[tuple[int, int], float]:
        """{(text, item): share of the item's words covered} of what passes the checks."""
        found = terms(words.hashes, self.items.vocabulary)
        counts = np.where(found >= 0, self.told_counts[found], 0)
        text, starts, stops = windows(words, self.window)
        held = offsets(counts)
        held = np.cumsum(held[stops] - held[starts])
        out: dict[tuple[int, int], float] = {}
        first = 0
        while first < len(text):
            before = held[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(held, before + HITS_AT_ONCE, "right")))
            group = slice(first, last)
            for w, i, low, high in self._regions(found, counts, starts[group], stops[group]):
                w += first
                self._settle(words.hashes, (low, high), (starts[w], stops[w]), int(text[w]), i, out)
            first = last
        return out

    def _regions(
        self, found: np.ndarray, counts: np.ndarray, starts: np.ndarray, stops: np.ndarray
    ) -> Iterator[tuple[int, int, int, int]]:
        """(window, item, first word, end) of what holds all stretches with enough rare words."""
        window = np.repeat(np.arange(len(starts)), stops - starts)
        at = gather(np.arange(len(found)), starts, stops - starts)
        used = np.flatnonzero(counts[at])
        window, at = window[used], at[used]
        n = counts[at]
        entry = gather(np.arange(len(self.told_item)), self.told_starts[found[at]], n)
        window, at, item = np.repeat(window, n), np.repeat(at, n), self.told_item[entry]
        base = (item * len(starts) + window) * (len(found) + 1)
        order = np.argsort(base + at)
        window, at, item, base = window[order], at[order], item[order], base[order]
        weights = offsets(self.told_weight[entry][order])
        reach = STRETCH * self.sizes[item]
        ends = np.searchsorted(base + at, base + np.minimum(at + reach, stops[window]))
        good = np.flatnonzero(weights[ends] - weights[:-1] >= self.hits[item])
        if not len(good):
            return
        window, at, item, base, reach = (x[good] for x in (window, at, item, base, reach))
        low = np.maximum(at - reach + 1, starts[window])
        high = np.minimum(at + reach, stops[window])
        new = np.ones(len(good), bool)
        new[1:] = (base[1:] != base[:-1]) | (low[1:] > high[:-1])
        heads = np.flatnonzero(new)
        tails = np.append(heads[1:], len(good)) - 1
        columns = (window[heads], item[heads], low[heads], high[tails])
        yield from zip(*(c.tolist() for c in columns), strict=True)

    def _settle(
        self, hashes: np.ndarray, region: tuple, window: tuple, text: int, item: int, out: dict
    ) -> None:
        """Score the stretches of a region: twice as many words as the item has, from any word on.

        Of long items the starts are taken together by 32nds of the item's length, and
        the stretch is longer by so much.
        """
        n, needed = int(self.sizes[item]), int(self.needed[item])
        best = out.get((text, item), 0.0)
        if best == 1:
            return
        get, whole = self.places[item].get, 0
        at, bits = [], []
        for k, word in enumerate(hashes[region[0] : region[1]].tolist(), int(region[0])):
            places = get(word)
            if places:
                at.append(k)
                bits.append(places)
                whole |= places
        if whole.bit_count() < needed:
            return
        step = max(1, n // 32)
        answer, end, a = len(self.items.answers[item]), 0, 0
        while a < len(at):
            start = at[a]
            stop = start + STRETCH * n + step - 1
            while end < len(at) and at[end] < stop:
                end += 1
            if end - a >= needed and min(n, end - a) / n > best:
                covered = subsequence(bits[a:end], n) / n
                if covered > best and (
                    covered >= COVERED
                    or (covered >= COVERED_WITH_ANSWER and answer and self._told(hashes, start, window, item))
                ):
                    out[text, item] = best = covered
                    if best == 1:
                        return
            a += 1
            while step > 1 and a < len(at) and at[a] < start + step:
                a += 1

    def _told(self, hashes: np.ndarray, start: int, window: tuple, item: int) -> bool:
        """Whether the item's answer is in or near the stretch."""
        n, answer = int(self.sizes[item]), len(self.items.answers[item])
        low, high = start - NEAR * n, start + (STRETCH + NEAR) * n
        near = hashes[max(int(window[0]), low) : min(int(window[1]), high)]
        return common_subsequence(near, self.answer_places[item], answer) >= ANSWER_COVERED * answer


def _search(docs: DataFrame, search: Search) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(search)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in text_slices(batches, most=SLICE):
            hits = own.matches(_words_in(batch))
            ids = batch.column("doc_id").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([ids[t] for t, _ in hits], pa.int64()),
                    pa.array([own.items.ids[i] for _, i in hits], pa.int64()),
                    pa.array(list(hits.values()), pa.float64()),
                ],
                ["doc_id", "item_id", "covered"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, item_id long, covered double"
    )


def leaks(docs: DataFrame, benchmark: DataFrame, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """(doc_id, item_id, covered): documents that hold a benchmark item, and how much of it."""
    ship_package(docs.sparkSession)
    numbered = benchmark.select("item_id", "text").where("text IS NOT NULL")
    blocks = max(1, -(-numbered.count() // block_items))
    found = None
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for b in range(blocks):
        items = Items.of(numbered.where(block == b).orderBy("item_id", "text").collect())
        if len(items.ids):
            part = _search(docs, Search(items, document_counts(docs, items.vocabulary)))
            found = part if found is None else found.unionByName(part)
    if found is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, covered double")
    return found.groupBy("doc_id", "item_id").agg(F.max("covered").alias("covered"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
