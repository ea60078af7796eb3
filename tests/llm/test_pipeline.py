from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from pullgrid.llm.common import table, written

from .conftest import frame, prose
from .test_line_dedup import brute as line_brute
from .test_ngram_join import brute as join_brute


@pytest.fixture(scope="module")
def steps(spark, sf):
    """The documents before every stage, and the last result."""
    docs = [table(spark, sf, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        docs.append(written(stage(spark, docs[-1], sf), name.replace(" ", "-")))
    return docs


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns(steps):
    for df in steps[1:-1]:
        assert df.dtypes == steps[0].dtypes


def test_quality_keeps_clean_documents(spark, sf, steps):
    before, after = rows(steps[0]), rows(steps[1])
    good = {r.doc_id for r in table(spark, sf, "labels").where("quality = 1").collect()}
    short = {k for k, r in before.items() if len((r.text or "").split()) < 20}
    assert set(after) < set(before) and all(after[k] == before[k] for k in after)
    assert len((good - short) & set(after)) >= 0.95 * len((good - short) & set(before))


def test_lines_go_where_brute_force_drops_them(steps):
    before, after = rows(steps[1]), rows(steps[2])
    assert set(before) == set(after)
    given = [(k, r.text, r.lang) for k, r in sorted(before.items())]
    want = {k: (lost, sha) for k, _, lost, sha in line_brute(given)}
    hashed = dict(steps[2].select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256)).collect())
    assert hashed == {k: sha for k, (_, sha) in want.items()}
    assert all(after[k].n_chars == len(after[k].text) for k, (lost, _) in want.items() if lost)


def test_one_of_each_group_stays(steps):
    before, after = rows(steps[2]), rows(steps[3])
    groups = join_brute([(k, r.text) for k, r in before.items()])
    assert set(after) == {doc for doc, _, least in groups if doc == least}


def test_no_benchmark_item_is_left(spark, sf, steps):
    items = [r.text for r in table(spark, sf, "benchmark").collect()]
    before, after = rows(steps[3]), rows(steps[4])
    holding = {k for k, r in before.items() if any(i in (r.text or "") for i in items)}
    assert set(after) == set(before) - holding


def test_encoding_is_the_library_s(steps, tokenizer):
    library = Tokenizer.from_file(tokenizer)
    before, after = rows(steps[4]), rows(steps[5])
    assert set(before) == set(after)
    for k, r in after.items():
        assert list(r.ids) == library.encode(before[k].text or "", add_special_tokens=False).ids


def test_run_gives_the_last_stage(spark, sf, steps):
    got = rows(corpus_pipeline.run(spark, sf))
    assert got == rows(steps[5])


def test_nothing_and_odd_rows(spark, sf, odd_rows):
    full = frame(spark, odd_rows, clashing=False).withColumns(
        {"source": F.lit("s"), "n_chars": F.char_length("text"), "kept": F.lit("clash")}
    )
    for docs in (full.limit(0), full):
        for name, stage in corpus_pipeline.STAGES:
            docs = written(stage(spark, docs, sf), name.replace(" ", "-"))
        assert docs.columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"]


def test_null_and_repeated_ids_lose_their_own_rows_only(spark, sf):
    """Copies and leaks go row by row, as brute force over numbered rows says."""
    item = next(r.text for r in table(spark, sf, "benchmark").collect() if len(r.text.split()) > 12)
    held = f"{prose(900, 30)} {item} {prose(901, 30)}"
    given = [
        (None, prose(1, 60)), (None, prose(1, 60)), (5, prose(1, 60)), (5, prose(2, 60)), (5, prose(2, 60)),
        (6, prose(2, 60)), (None, prose(3, 60)), (None, prose(3, 60) + " more"), (7, held), (7, prose(4, 60)),
        (None, held), (None, prose(5, 60)), (8, None), (8, ""), (None, None),
    ]
    docs = written(frame(spark, [(i, t, "en") for i, t in given], clashing=False), "given")
    after = corpus_pipeline.near_copies(spark, docs, sf).collect()
    least = {}
    for n, (_, _, group) in enumerate(sorted(join_brute([(n, t) for n, (_, t) in enumerate(given)]))):
        least.setdefault(group, []).append(n)
    first = lambda n: (given[n][0] is None, given[n][0] or 0)
    want = [given[min(group, key=first)][0] for group in least.values()]
    assert Counter(r.doc_id for r in after) == Counter(want)
    texts = Counter(r.text for r in after)
    assert texts[prose(1, 60)] == texts[prose(2, 60)] == 1
    kept = corpus_pipeline.leaks(spark, docs, sf)
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(
        row for row in given if item not in (row[1] or "")
    )
