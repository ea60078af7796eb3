"""The trie against a trie built by hand, turn by turn."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from pullgrid.llm import prefix_trie
from pullgrid.llm.runs import placed_in_runs

SCHEMA = "conv_id long, turn long, role string, text string, r1 long, block string, entries int, lead long"
COLUMNS = (
    "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
)


def conversations(spark, rows):
    full = [(*r, 1, "b", 2, 3) for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(5)


def brute_trie(sequences: dict[int, list[tuple[str, str]]]) -> Counter:
    nodes = defaultdict(list)
    for conv, turns in sequences.items():
        for depth in range(len(turns) + 1):
            nodes[tuple(turns[:depth])].append(conv)
    children = Counter(prefix[:-1] for prefix in nodes if prefix)
    leaves, saved = Counter(), Counter()
    for prefix, members in nodes.items():
        own = (len(members) - 1) * len(prefix[-1][1]) if prefix else 0
        for depth in range(len(prefix) + 1):
            leaves[prefix[:depth]] += prefix not in children
            saved[prefix[:depth]] += own
    out = Counter()
    for prefix, members in nodes.items():
        ends = sorted(c for c in members if len(sequences[c]) == len(prefix))
        digest = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        parent = min(nodes[prefix[:-1]]) if prefix else None
        out[
            (min(members), len(prefix), parent, len(members), children[prefix], leaves[prefix], saved[prefix], digest)
        ] += 1
    return out


def brute_rebuilt(rows) -> dict[int, list[tuple[str, str]]]:
    """Rows whose turns differ in each conversation."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, (role or "", text or "")))
    own = {c: [t[2] for t in sorted(held, key=lambda t: t[:2])] for c, held in turns.items()}
    out = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + mine[h:]
    return out


def found(df) -> Counter:
    return Counter(tuple(r) for r in df.select(*COLUMNS).collect())


def trie_of(spark, rows):
    turns = prefix_trie.turns_of(conversations(spark, rows))
    return prefix_trie.prefix_trie(*prefix_trie.rebuilt(turns))


def test_long_short_and_shared_conversations(spark):
    draw = random.Random(4)
    stem = [("user" if k % 2 == 0 else "bot", f"t{k}") for k in range(200)]
    rows = []
    for conv in range(1, 60):
        # paths leave the stem at many depths, some at the cuts, some never
        keep = draw.choice([0, 1, 5, 31, 32, 33, 63, 64, 65, 96, 127, 128, 160, 200])
        tail = draw.choice([0, 1, 2, 33, 70])
        own = [("user", f"own {draw.randrange(3)} {k}") for k in range(tail)]
        rows += [(conv, k, *t) for k, t in enumerate((stem[:keep] + own) or [("user", "alone")])]
    rows += [(conv, k, *t) for conv in (700, 701, 702, 799) for k, t in enumerate(stem[:9])]
    assert found(trie_of(spark, rows)) == brute_trie(brute_rebuilt(rows))


def test_one_conversation_may_hold_most_rows(spark):
    rows = [(3, k, "user", f"t{k}") for k in range(300)]
    rows += [(4, k, "user", f"t{k}") for k in range(250)]
    rows += [(k, 0, "user", "t0") for k in range(1000, 1100)]
    assert found(trie_of(spark, rows)) == brute_trie(brute_rebuilt(rows))


def test_odd_rows(spark):
    rows = [
        (1, 1, None, None),
        (1, 2, "", "x" * 5000),
        (2, None, "user", "first"),
        (2, -5, "user", "second"),
        (2, 9, "user", "third"),
        (2, 10, "user", "日本語 ü"),
        (-130, 0, "user", "below zero"),
        (-100, 0, "user", "host below zero"),
        (None, 0, "user", "of no conversation"),
        (None, None, None, None),
        (100, 0, "", ""),
        (101, 0, None, ""),
        (102, 0, "", None),
    ]
    expected = brute_rebuilt([(c, t, r, x) for c, t, r, x in rows])
    # c - c % 100 keeps the sign of c, as SQL does
    for c in (-130, -100):
        h = zlib.crc32(str(c).encode()) % 6
        own = {-130: [("user", "below zero")], -100: [("user", "host below zero")]}
        expected[c] = own[-100][:h] + own[c][h:]
    assert found(trie_of(spark, rows)) == brute_trie(expected)


def test_repeated_turns_all_count_in_one_order(spark):
    rows = [(10, 0, "user", t) for t in ("b", "a", "a", "c")] + [(11, 0, "user", t) for t in "acab"]
    turns = prefix_trie.turns_of(conversations(spark, rows))
    nodes = prefix_trie.prefix_trie(turns, prefix_trie.lengths_of(turns)).collect()
    assert sorted((r.depth, r.n_convs) for r in nodes) == [(d, 2) for d in range(5)]


def test_a_conversation_may_lose_all_its_turns(spark):
    bare = next(c for c in range(1, 99) if zlib.crc32(str(c).encode()) % 6 >= 2)
    rows = [(bare, 0, "user", "only turn")]
    assert found(trie_of(spark, rows)) == brute_trie({bare: []})


def test_nothing(spark):
    assert trie_of(spark, []).count() == 0


@pytest.mark.parametrize("rows", [1, 5000])
def test_places_in_runs_over_partitions(spark, rows):
    # a run of equal rows over all partitions, and single ones beside it
    held = [(1, 5, 0)] * rows + [(k, k, 0) for k in range(2, 50)]
    df = spark.createDataFrame(held, "run long, lead_by long, part long")
    out = placed_in_runs(df, ["run"], ["lead_by"], "lead_by", "runs").collect()
    assert sorted(r.at for r in out if r.run == 1) == list(range(rows))
    assert all(r.at == 0 and r.lead == r.run for r in out if r.run > 1)
    assert {r.lead for r in out if r.run == 1} == {5}
