"""Ranking against scores of all pairs."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from .conftest import prose

from pullgrid.llm import norm_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lower)


def brute(docs, items, best):
    """(item, rank, doc, score) rows; items: id -> texts."""
    held = [(d, Counter(terms(t))) for d, t, *_ in docs]
    held = [(d, c) for d, c in held if c]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    out = Counter()
    for item, texts in items.items():
        asked = Counter(t for text in texts for t in terms(text))
        scored = []
        for doc, counts in held:
            m = 100 - 25 + (25 * sum(counts.values()) * n_docs) // n_terms
            score = sum(
                n * weight[t] * ((10**9 * counts[t]) // (1000 * counts[t] + 12 * m))
                for t, n in asked.items()
                if t in counts
            )
            if score > 0:
                scored.append((-score, doc is not None, doc or 0, doc))
        for rank, (score, _, _, doc) in enumerate(sorted(scored, key=lambda s: s[:3])[:best], 1):
            out[(item, rank, doc, -score)] += 1
    return out


def ranked(spark, docs, items, best):
    rows = [(i, t, 1, "x") for i, texts in items.items() for t in texts]
    asked = spark.createDataFrame(rows, "item_id long, text string, score int, term string")
    out = norm_search.rank(docs, asked, best)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    return Counter(tuple(r) for r in out.collect())


ODD_ITEMS = {
    1: ["alpha1 BETA2 one two tail 日本語"],
    2: [None],
    3: [""],
    4: ["  --- "],
    5: ["word of no document"],
    6: ["one ONE one two", "two three"],  # rows of one item
    None: ["one grüße"],
}


def test_odd_rows(spark, odd, odd_rows):
    items = ODD_ITEMS | {7: [prose(1, 60)], 8: [prose(12, 30) + " x" * 50]}
    assert ranked(spark, odd, items, 4) == brute(odd_rows, items, 4)


@pytest.mark.parametrize("bucket", [3, 64])
def test_matches_scores_of_all_pairs(spark, monkeypatch, bucket):
    """Skewed words, copies that tie, long and short documents, a passage in a third of them."""
    monkeypatch.setattr(norm_search, "BUCKET", bucket)
    monkeypatch.setattr(norm_search, "TOGETHER", 7)
    draw = random.Random(bucket)
    words = [f"w{k}" for k in range(400)]
    often = [1 / (k + 1) for k in range(400)]
    passage = " ".join(draw.choices(words[200:], k=30))
    docs = []
    for k in range(500):
        text = " ".join(draw.choices(words, often, k=draw.choice([1, 5, 30, 100, 800])))
        if k % 3 == 0:
            text = passage + " " + text
        docs.append((k, text if k % 7 else "w1 w2 w300", "en"))
    items = {k: [" ".join(draw.choices(words, often, k=draw.choice([1, 4, 40])))] for k in range(30)}
    items[50] = [passage]
    items[51] = ["w1 w2 w300"]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(6)
    assert ranked(spark, df, items, 5) == brute(docs, items, 5)


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(norm_search, "BLOCK_TERMS", 10)
    docs = [(k, prose(k % 20, 40), "en") for k in range(40)]
    items = {k: [" ".join(prose(k, 40).split()[3:9])] for k in range(8)}
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    assert ranked(spark, df, items, 3) == brute(docs, items, 3)


def test_bounds_let_every_good_pair_through_and_stop_others():
    rng = np.random.default_rng(5)
    size, n = 60, 200
    rows = [(k, int(t), int(c)) for k in range(20) for t, c in zip(rng.permutation(size)[:8], rng.integers(1, 3, 8))]
    vocabulary = np.arange(size, dtype=np.uint64)
    items = norm_search.weigh(rows, vocabulary, {t: int(rng.integers(1, 90)) for t in range(size)}, 100)
    dense = (rng.random((n, size)) < 0.2) * rng.integers(1, 10**6, (n, size))
    length = np.sqrt((dense.astype(float) ** 2).sum(1))
    order = np.argsort(-length)
    dense, length = dense[order], length[order]
    doc, term = np.nonzero(dense)
    x = dense[doc, term]
    query = np.zeros((20, size), np.int64)
    for k in range(20):
        part = slice(items.bounds[k], items.bounds[k + 1])
        query[k, items.terms[part]] = items.weights[part]
    exact = dense @ query.T
    items.least = np.sort(exact, axis=0)[-5]
    search = norm_search.Search(items, size, 5)
    row, item = search.survivors(doc, term, x, length)
    let = set(zip(row.tolist(), item.tolist()))
    good = {(d, i) for d in range(n) for i in range(20) if exact[d, i] >= items.least[i]}
    assert good <= let and len(let) < 0.6 * exact.size
    assert (search.scores(doc, term, x, row, item) == exact[row, item]).all()


def test_nothing(spark, nothing, odd):
    assert not ranked(spark, nothing, ODD_ITEMS, 4)
    asked = spark.createDataFrame([], "item_id long, text string")
    assert norm_search.rank(odd, asked).count() == 0


