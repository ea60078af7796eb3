from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pullgrid.llm import bpe, token_files
from pullgrid.llm.pieces import PieceEncoder

ODD = "aA éß 's'll \t\n\x0b\x1c　 日本123٣😀!?=<|endoftext|>"


@pytest.fixture(scope="module")
def library(tokenizer):
    return Tokenizer.from_file(tokenizer)


def test_any_text_encodes_as_the_library_does(tokenizer, library):
    merging = bpe.merger(tokenizer)
    ours = PieceEncoder(merging.encode_pieces, merging.encode_whole, tuple(merging.special), 50)
    theirs = token_files.library_encoder(tokenizer)
    words = st.lists(st.sampled_from(["the", "aaaaaaa", " ", "  ", "\n", "<|endoftext|>", "it's", "x" * 60]))

    @settings(deadline=None, max_examples=300)
    @given(st.text(alphabet=ODD, max_size=40) | words.map(" ".join) | st.text(max_size=20))
    def same(text):
        want = library.encode(text, add_special_tokens=False).ids
        for encode in (ours, theirs):
            ids, counts = encode([text, None, text])
            assert ids.tolist() == want * 2 and counts.tolist() == [len(want), 0, len(want)]
        decoded = merging.decode(np.array(want, np.int64)).tobytes().decode()
        assert decoded == library.decode(want, skip_special_tokens=False)

    same()


@settings(deadline=None)
@given(st.lists(st.binary(max_size=6), unique=True, max_size=60), st.lists(st.binary(max_size=7), min_size=1))
def test_the_transducer_knows_its_words_and_no_others(words, asked):
    words = sorted(words)
    lengths = np.array([len(w) + 1 for w in words], np.int64)
    ids = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(w + b"!", np.uint8) for w in words)])
    lexicon = bpe.Lexicon(np.frombuffer(bpe.Lexicon.save(bpe.Lexicon.compile(words, ids, lengths)), np.int64))
    place = lexicon.find(words + asked)
    assert place.tolist() == [words.index(w) if w in words else -1 for w in words + asked]
    if words:
        flat, sizes = lexicon.outputs(place[: len(words)])
        assert sizes.tolist() == lengths.tolist() and flat.tolist() == ids.tolist()


def test_suffixes_are_shared():
    words = sorted(f"{a}{b}ing".encode() for a in "bcdfg" for b in "aeiou")
    arrays = bpe.Lexicon.compile(words, np.zeros(25, np.int64), np.ones(25, np.int64))
    assert len(arrays["edge_key"]) == 5 + 5 + 3


def digest(library, rows):
    out = Counter()
    for doc, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        out[
            doc,
            len(ids),
            hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest(),
        ] += 1
    return out


def test_odd_rows_match_the_library(odd, odd_rows, tokenizer, library):
    got = bpe.encode(odd, tokenizer, odd.columns, n_words=20)
    found = Counter(
        tuple(r) for r in got.select("row.doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    )
    assert found == digest(library, odd_rows)
    whole = bpe.encode(odd, tokenizer, ["doc_id"], output="ids").collect()
    assert Counter((r.row.doc_id, r.decoded) for r in whole) == Counter(
        (d, t or "") for d, t, *_ in odd_rows
    )


def test_nothing(nothing, tokenizer):
    assert bpe.encode(nothing, tokenizer, ["doc_id"]).count() == 0


def test_frequent_pieces_are_counted_over_all_rows(spark):
    df = spark.createDataFrame([("a b b",), ("b c\n c",), (None,), ("c c  c ",)], "text string").repartition(3)
    counts = lambda n: {tuple(r) for r in bpe.frequent_pieces(df, n).collect()}
    assert counts(10) == counts(2) == {("c", 4), ("b", 3)}
    assert counts(1) == {("c", 4)} and counts(0) == set()
