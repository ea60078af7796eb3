from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from pullgrid.llm import ngram_join
from pullgrid.llm.components import components

from .conftest import frame, prose


def shingles(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4)))


def brute(rows):
    sets = [shingles(t) for _, t, *_ in rows]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if None in (rows[a][0], rows[b][0]) or not sets[a]:
                continue
            both = len(sets[a] & sets[b])
            if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    least = {}
    for (doc, *_), g in zip(rows, group, strict=True):
        if doc is not None:
            least[g] = min(doc, least.get(g, doc))
    return Counter(
        (doc, len(s), None if doc is None else least[g])
        for (doc, *_), s, g in zip(rows, sets, group, strict=True)
    )


def brute_links(rows):
    """(doc_id, links): other rows with a similar set; rows without an id or words have none."""
    sets = [shingles(t) if doc is not None else frozenset() for doc, t, *_ in rows]
    similar = lambda a, b: bool(a) and 100 * len(a & b) >= 75 * len(a | b)
    return Counter(
        (rows[a][0], sum(a != b and similar(sets[a], sets[b]) for b in range(len(rows))))
        for a in range(len(rows))
    )


def links_of(df):
    rows = ngram_join.jaccard_components(df, links=True).select("doc_id", "n_links").collect()
    return Counter(tuple(r) for r in rows)


def found(df):
    return Counter(tuple(r) for r in ngram_join.jaccard_components(df).collect())


def test_odd_rows_match_brute_force(odd, odd_rows):
    assert found(odd) == brute(odd_rows)
    assert links_of(odd) == brute_links(odd_rows)


def test_nothing(nothing):
    assert found(nothing) == Counter()
    assert links_of(nothing) == Counter()


@pytest.mark.parametrize("seed", [1, 2])
def test_random_edits_match_brute_force(spark, seed):
    """Chains of edited copies around the threshold, with a passage that many share."""
    draw, rows, passage = random.Random(seed), [], prose(90, 40)
    for family in range(6):
        words = prose(family + 20, draw.randint(30, 90)).split()
        for _ in range(12):
            for _ in range(draw.randint(0, 2)):
                words[draw.randrange(len(words))] = f"new{draw.random():.6f}"
            text = " ".join(words)
            rows.append((len(rows), f"{text} {passage}" if draw.random() < 0.3 else text, "en"))
    rows += [(len(rows) + k, f"{passage} {prose(200 + k, 60)}", "en") for k in range(20)]
    rows += [(len(rows) + k, rows[k % 9][1], "en") for k in range(30)]
    df = frame(spark, rows).repartition(4)
    assert found(df) == brute(rows)
    assert links_of(df) == brute_links(rows)


def test_a_crowded_key_is_told_to_its_rows_where_they_are(spark, monkeypatch):
    draw, rows = random.Random(3), []
    for family in range(3):
        words = prose(family + 70, 60).split()
        for _ in range(20):
            edited = [f"new{draw.random():.6f}" if draw.random() < 0.02 else w for w in words]
            rows.append((len(rows), " ".join(edited), "en"))
    df = frame(spark, rows)
    for crowd in (2, 1_000):  # all shared keys, and none
        monkeypatch.setattr(ngram_join, "CROWD", crowd)
        assert found(df) == brute(rows)


def test_links_between_families_are_found_by_the_product(spark, monkeypatch):
    """With every node a family of its own, the product alone must give the same components."""
    draw, rows = random.Random(5), []
    for family in range(4):
        words = prose(family + 40, 60).split()
        for _ in range(8):
            words[draw.randrange(len(words))] = f"new{draw.random():.6f}"
            rows.append((len(rows), " ".join(words), "en"))
    df = frame(spark, rows)
    alone = lambda sets: sets.selectExpr("node", "node AS family")
    monkeypatch.setattr(ngram_join, "families", alone)
    assert found(df) == brute(rows)
    assert links_of(df) == brute_links(rows)


def test_a_family_of_many_parts_gives_the_same_components(spark, monkeypatch):
    draw, rows, words = random.Random(8), [], prose(60, 50).split()
    for k in range(60):
        edited = [f"new{draw.random():.6f}" if draw.random() < 0.03 else w for w in words]
        rows.append((k, " ".join(edited), "en"))
    monkeypatch.setattr(ngram_join, "TILE_NODES", 7)
    monkeypatch.setattr(ngram_join, "DENSE_FROM", 3)
    monkeypatch.setattr(ngram_join, "DENSE_COLUMNS", 5)
    rows += [(60 + k, rows[k][1], "en") for k in range(5)]
    assert found(frame(spark, rows)) == brute(rows)
    assert links_of(frame(spark, rows)) == brute_links(rows)


def test_components_of_a_long_chain_and_a_star(spark):
    pairs = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 180)]
    links = spark.createDataFrame(pairs, "u long, v long")
    labels = dict(components(links).collect())
    assert all(labels[k] == 0 for k in range(61))
    assert all(labels[k] == 100 for k in range(100, 180))
