from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from pullgrid.llm import packing


def check(patterns, counts, most):
    """Every piece is placed once and no sequence overflows; the number of sequences."""
    placed = Counter()
    for lengths, n in patterns:
        assert n > 0 and 0 < sum(lengths) <= most
        for length in lengths:
            placed[length] += n
    assert placed == Counter({k: v for k, v in counts.items() if v})
    return sum(n for _, n in patterns)


def fewest_possible(counts, most):
    """A bound no packing beats: lengths over half a sequence are alone, the rest fills their gaps."""
    best = 0
    for k in range(most // 2 + 1):
        alone = sum(c for n, c in counts.items() if n > most - k)
        halves = {n: c for n, c in counts.items() if most - k >= n > most / 2}
        small = sum(n * c for n, c in counts.items() if k <= n <= most / 2)
        room = sum((most - n) * c for n, c in halves.items())
        best = max(best, alone + sum(halves.values()) + max(0, -(-(small - room) // most)))
    return best


@pytest.mark.parametrize("seed", range(30))
def test_plans_are_whole_and_near_the_bound(seed):
    draw = random.Random(seed)
    most = draw.choice([8, 60, 1024])
    scale = draw.choice([1, 3, 1000, 10**10])
    lengths = draw.sample(range(1, most + 1), draw.randint(1, most))
    counts = {n: draw.randint(1, scale) for n in lengths}
    assert check(packing.plan(counts, most), counts, most) <= fewest_possible(counts, most) * 1.02 + 2


def exact(counts, share=0.0):
    return {tuple(sorted(p)) for p, _ in packing.exact_fills(packing.Available(counts, 1024), share)}


def test_exact_complements_of_one_two_and_three_lengths():
    assert exact({1000: 5, 24: 3, 20: 1}) == {(24, 1000)}
    assert exact({800: 4, 150: 2, 74: 9, 60: 1}) == {(74, 150, 800)}
    assert exact({700: 3, 200: 3, 61: 3, 63: 3, 62: 1}) == {(61, 63, 200, 700)}
    assert exact({900: 1, 62: 2}) == {(62, 62, 900)} and exact({900: 1, 62: 1}) == set()
    assert exact({256: 9}) == {(256, 256, 256, 256)}
    assert exact({1024: 2, 1023: 1}) == {(1024,)}
    # the longest length beside 800 must hold its share of the gap
    assert exact({800: 4, 150: 2, 74: 9, 60: 1}, 0.95) == set()
    # counts bound how often a combination is taken
    held = packing.Available({1000: 5, 24: 3}, 1024)
    assert list(packing.exact_fills(held, 0.0)) == [((1000, 24), 3)] and held.left[1000] == 2


def test_equal_lengths_share_sequences():
    assert packing.plan({512: 7}, 1024) == [((512, 512), 3), ((512,), 1)]
    assert check(packing.plan({341: 10}, 1024), {341: 10}, 1024) == 4
    assert check(packing.plan({1: 10**12}, 1024), {1: 10**12}, 1024) == -(-(10**12) // 1024)
    assert packing.plan({}, 1024) == []


def test_small_sets_match_the_best_there_is():
    """Brute force over all packings of a few pieces."""

    def fewest(left, bins, most):
        if not left:
            return len(bins)
        out = len(bins) + len(left)
        for i in range(len(bins)):
            if bins[i] + left[0] <= most:
                out = min(out, fewest(left[1:], bins[:i] + [bins[i] + left[0]] + bins[i + 1 :], most))
        return min(out, fewest(left[1:], [*bins, left[0]], most))

    draw, best, ours = random.Random(1), 0, 0
    for _ in range(60):
        pieces = sorted((draw.randint(1, 20) for _ in range(7)), reverse=True)
        best += fewest(pieces, [], 20)
        counts = Counter(pieces)
        ours += check(packing.plan(counts, 20), counts, 20)
    assert ours <= best * 1.03


def expected_pieces(tokenizer, rows, most):
    library, out = Tokenizer.from_file(tokenizer), Counter()
    for doc, text, *_ in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        first = len(ids) % most or most
        bounds = [0, *range(min(first, len(ids)), len(ids) + 1, most)]
        for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
            out[(doc, k, a, b - a, zlib.crc32(ids[a:b].tobytes()))] += 1
    return out


@pytest.mark.parametrize("most", [16, 1024])
def test_odd_documents(odd, odd_rows, tokenizer, most):
    pieces = packing.pieces_of(odd, tokenizer, most=most, with_ids=True)
    packed = packing.pack(pieces, most)
    rows = packed.collect()
    found = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert found == expected_pieces(tokenizer, odd_rows, most)
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [a for a, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= most
    total = sum(r.length for r in rows)
    assert len(held) <= -(-total // most) * 1.05 + 1
    known = {(r.doc_id, r.piece, r.ids_crc32) for r in rows}
    laid = packing.sequences(packed).collect()
    assert sorted(len(s.ids) for s in laid) == sorted(sum(n for _, n in p) for p in held.values())
    for s in laid:
        for p in s.parts:
            ids = np.array(s.ids[p.offset : p.offset + p.length], "<u4")
            assert (p.doc_id, p.piece, zlib.crc32(ids.tobytes())) in known


def test_a_length_may_hold_most_pieces(spark, tokenizer):
    df = spark.createDataFrame([(k, "same text") for k in range(3000)], "doc_id long, text string")
    rows = packing.pack(packing.pieces_of(df, tokenizer)).collect()
    assert len({(r.sequence_id, r.offset) for r in rows}) == 3000
    assert len({r.sequence_id for r in rows}) == -(-3000 // (1024 // rows[0].length))


def test_nothing(nothing, tokenizer):
    assert packing.pack(packing.pieces_of(nothing, tokenizer)).count() == 0
