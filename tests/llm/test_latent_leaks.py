from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pullgrid.llm import latent_leaks as leaks_

from .conftest import frame, prose


def subsequence(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


@given(st.lists(st.integers(0, 4), max_size=30), st.lists(st.integers(0, 4), max_size=30))
def test_common_subsequence_is_exact(near, item):
    places = leaks_.places_of(np.array(item, np.int64))
    got = leaks_.common_subsequence(np.array(near, np.int64), places, len(item))
    assert got == subsequence(near, item)


@settings(deadline=None)
@given(st.lists(st.integers(0, 90), max_size=5), st.integers(1, 40), st.data())
def test_an_item_lies_whole_in_some_window(counts, n_item, data):
    bounds = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    words = leaks_.Words(np.zeros(bounds[-1], np.uint64), bounds, bounds, bounds)
    text, starts, stops = leaks_.windows(words, leaks_.window_size(n_item))
    for t, count in enumerate(counts):
        if count >= n_item:
            at = bounds[t] + data.draw(st.integers(0, count - n_item))
            assert any(
                x == t and a <= at and at + n_item <= b
                for x, a, b in zip(text, starts, stops, strict=True)
            )


@pytest.fixture(scope="module")
def planted(spark):
    """Clean documents; documents with an item: as it is, reworded, in capitals; near misses."""
    draw = random.Random(3)
    item = lambda k: prose(300 + k, 30).split()
    items = [(k, " ".join(item(k))) for k in range(12)] + [(12, None), (13, ""), (14, "single")]
    rows, want = [], set()
    for k in range(200):
        rows.append((k, prose(k, 80), "en"))
    for k in range(12):
        words = item(k)
        reworded = [f"other{draw.random():.5f}" if j % 7 == 3 else w for j, w in enumerate(words)]
        for d, inside in enumerate((words, reworded, [w.upper() + "," for w in words])):
            doc = 1000 + 10 * k + d
            rows.append((doc, f"{prose(doc, 50)}\n{' '.join(inside)} {prose(doc + 1, 33)}", "en"))
            want.add((doc, k))
        rows.append((1000 + 10 * k + 8, f"{prose(k, 50)} {' '.join(words[:12])} {prose(k, 9)}", "en"))
        rows.append((1000 + 10 * k + 9, " ".join(draw.sample(words, len(words))), "en"))
    return rows, items, want


def found(spark, rows, items, **args):
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = leaks_.leaks(frame(spark, rows).repartition(4), benchmark, **args).collect()
    assert len(got) == len({(r.doc_id, r.item_id) for r in got})
    return {(r.doc_id, r.item_id) for r in got}


def test_planted_items_are_found_and_clean_documents_left_alone(spark, planted):
    rows, items, want = planted
    assert found(spark, rows, items) == want


def test_items_in_several_blocks_give_the_same(spark, planted):
    rows, items, want = planted
    assert found(spark, rows, items, block_items=5) == want


def test_an_item_that_a_third_of_the_documents_hold_is_found(spark):
    item = prose(500, 25)
    rows = [(k, f"{prose(k, 40)} {item if k % 3 == 0 else ''} {prose(k + 1, 10)}", "en") for k in range(150)]
    assert found(spark, rows, [(1, item)]) == {(k, 1) for k in range(0, 150, 3)}


def brute(docs, items):
    """{(document, item): covered} by comparing each item with every stretch of every document."""
    out = {}
    for d, text in docs:
        words = text.split()
        for i, item, answer in items:
            n = len(item)
            if 10 * len([w for w in item if w in set(words)]) < 6 * n:
                continue
            for a in range(len(words)):
                covered = subsequence(words[a : a + 2 * n], item) / n
                told = answer and covered >= 0.6 and (
                    subsequence(words[max(0, a - 3 * n) : a + 5 * n], answer) >= 0.75 * len(answer)
                )
                if covered >= 0.75 or told:
                    out[d, i] = max(covered, out.get((d, i), 0))
    return out


def test_common_items_and_rewordings_match_brute_force(spark):
    """200 items, one of them in a third of all documents, copies in rare words, and reworded ones."""
    draw = random.Random(17)
    rare = lambda n: [f"rare{draw.randrange(10**9)}" for _ in range(n)]
    items = []
    for k in range(200):
        words = [f"w{draw.randrange(400)}" for _ in range(draw.choice((17, 20, 37)))]
        items.append((k, words, words[-5:] if k % 2 else []))
    rows = []
    for d in range(120):
        text = rare(draw.randint(100, 400))
        for k in draw.sample(range(1, 200), 2):
            copy, lost = list(items[k][1]), draw.choice((0, 0.2, 0.3, 0.4, 0.5))
            copy = [w for x in copy for w in (rare(2) if draw.random() < lost else [x])]
            at = draw.randrange(len(text))
            text[at:at] = copy
        if d % 3 == 0:
            text += items[0][1] + rare(draw.randint(0, 40))
        rows.append((d, " ".join(text), "en"))
    texts = [(k, " ".join(w) if not a else f"{' '.join(w[:-5])}\n{' '.join(a)}") for k, w, a in items]
    benchmark = spark.createDataFrame(texts, "item_id long, text string")
    got = leaks_.leaks(frame(spark, rows).repartition(4), benchmark).collect()
    want = brute([(d, t) for d, t, _ in rows], items)
    assert {(d, 0) for d in range(0, 120, 3)} <= set(want)
    assert {(r.doc_id, r.item_id): r.covered for r in got} == want


def test_odd_rows_and_nothing(spark, odd_rows, nothing):
    items = [(1, prose(1, 30)), (None, prose(12, 40)), (2, prose(1, 30))]
    got = found(spark, odd_rows, items)
    # document 6 holds the first words of many
    assert got == {(d, i) for d in (1, 2, 6, None) for i in (1, 2)} | {
        (d, None) for d in (6, 11, 12)
    }
    empty = spark.createDataFrame([], "item_id long, text string")
    assert leaks_.leaks(frame(spark, odd_rows), empty).count() == 0
    full = spark.createDataFrame(items, "item_id long, text string")
    assert leaks_.leaks(nothing, full).count() == 0
