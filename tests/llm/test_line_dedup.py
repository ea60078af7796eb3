from __future__ import annotations

import hashlib
from collections import Counter

from pyspark.sql import functions as F

from pullgrid.llm import line_dedup


def brute(rows):
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    first = {}
    for doc, text, *_ in rows:
        if doc is not None:
            for line in (text or "").split("\n"):
                first.setdefault(key(line), set()).add(doc)
    out = Counter()
    for doc, text, *_ in rows:
        lines = (text or "").split("\n")
        lost = [
            doc is not None and len(key(x)) >= 10 and len(first[key(x)]) > 1 and doc != min(first[key(x)])
            for x in lines
        ]
        kept = "\n".join(x for x, gone in zip(lines, lost, strict=True) if not gone)
        out[doc, len(lines), sum(lost), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


def digest(df):
    return Counter(
        tuple(r)
        for r in df.select(
            "row.doc_id",
            line_dedup.line_count(F.col("row.text")),
            "n_dropped",
            F.sha2("kept", 256),
        ).collect()
    )


def test_odd_rows_match_brute_force(odd, odd_rows):
    assert digest(line_dedup.dedup_lines(odd)) == brute(odd_rows)


def test_a_hot_line_is_cut_into_runs_and_keeps_one_owner(spark):
    rows = [(k, f"the very same line\nline of {k} alone\nThe very SAME line ", "en") for k in range(700)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    lines = line_dedup.line_hashes(df, 10)
    assert line_dedup._with_salt(lines).where("salt >= 0").count() >= 1400
    assert digest(line_dedup.dedup_lines(df)) == brute(rows)


def test_a_run_is_cut_by_its_length_whatever_its_share(spark, monkeypatch):
    """Every third line is the same, and no share of the lines counts as hot."""
    rows = [(k, f"the very same line\nline of {k} alone\nand another of {k}", "en") for k in range(400)]
    rows += [(None, "the very same line", "en")] * 200
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    monkeypatch.setattr(line_dedup, "HOT_SHARE", 1.0)
    monkeypatch.setattr(line_dedup, "RUN_LINES", 50)
    salted = line_dedup._with_salt(line_dedup.line_hashes(df, 10))
    runs = salted.groupBy("h1", "h2", "salt").count().where("count > 1").collect()
    assert len(runs) == 8 and max(r["count"] for r in runs) < 100
    assert digest(line_dedup.dedup_lines(df)) == brute(rows)
    # hot hashes beyond what is broadcast are joined by key
    monkeypatch.setattr(line_dedup, "BROADCAST_HASHES", 0)
    assert digest(line_dedup.dedup_lines(df)) == brute(rows)


def test_bitmaps_leave_out_words_in_which_nothing_is_dropped(spark):
    shared = "a line that both of them hold"
    long_doc = "\n".join([f"only here, number {k}" for k in range(200)] + [shared])
    df = spark.createDataFrame([(1, shared), (2, long_doc)], "doc_id long, text string")
    (found,) = line_dedup.keep_bitmaps(df).collect()
    assert (found.doc, found.n_dropped) == (2, 1)
    assert [(b.word, b.keep) for b in found.bitmap] == [(200 // 64, ~(1 << 200 % 64))]


def test_nothing(nothing):
    assert line_dedup.dedup_lines(nothing).count() == 0
