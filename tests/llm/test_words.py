from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from pullgrid.llm.slices import raw_bytes
from pullgrid.llm.words import distinct_per_text, shingle_hashes, words_of

TEXTS = st.lists(st.none() | st.text(alphabet="aAbB éß\t\n\x0b\x1c　日", max_size=40), max_size=8)


def spelled(text):
    found = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    return [bytes(c + 32 if 65 <= c <= 90 else c for c in w) for w in found]


@settings(deadline=None)
@given(TEXTS)
def test_words_and_shingles_match_plain_python(texts):
    words = words_of(*raw_bytes(pa.array(texts, pa.string())))
    own = [spelled(t) for t in texts]
    assert words.counts.tolist() == [len(w) for w in own]
    flat = [w for ws in own for w in ws]
    assert len(set(flat)) == len(set(words.hashes.tolist()))
    assert dict(zip(flat, words.hashes.tolist(), strict=True)) == dict(
        reversed(list(zip(flat, words.hashes.tolist(), strict=True)))
    )
    hashes, ends = distinct_per_text(*shingle_hashes(words, 3))
    sets = [{tuple(w[k : k + 3]) for k in range(max(1, len(w) - 2))} if w else set() for w in own]
    assert np.diff(ends).tolist() == [len(s) for s in sets]
    for a in range(len(sets)):
        for b in range(a):
            mine = set(hashes[ends[a] : ends[a + 1]].tolist())
            other = set(hashes[ends[b] : ends[b + 1]].tolist())
            assert len(mine & other) == len(sets[a] & sets[b])


def test_long_words_differ_by_any_byte():
    texts = ["x" * 500, "x" * 499 + "y", "X" * 500, "y" + "x" * 499]
    hashes = words_of(*raw_bytes(pa.array(texts))).hashes.tolist()
    assert hashes[0] == hashes[2] and len(set(hashes)) == 3
