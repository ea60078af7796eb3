from __future__ import annotations

import re
from collections import Counter
from math import comb

import pytest
from pyspark.sql import functions as F

from pullgrid.llm import quality_rules as q

from .conftest import frame, prose


def counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    often = Counter(windows)
    covered = {k + j for k, w in enumerate(windows) if often[w] > 1 for j in range(8)}
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)),
        len(covered),
        failed,
    )


def test_base_counts_match_brute_force(spark, odd, odd_rows):
    repeating = " ".join(prose(3, 12) for _ in range(3)) + "\n" + prose(4, 30) + " " + prose(3, 9)
    rows = [*odd_rows, (50, repeating, "en"), (51, "a\n a\na\n\n\na \n#*$%&|<> <b>", "en")]
    got = q.features(frame(spark, rows), ["doc_id"]).select("row.doc_id", *q.COUNTS, "base_failed")
    want = Counter((d, *counts(t)) for d, t, _ in rows)
    assert Counter(tuple(r) for r in got.collect()) == want


@pytest.mark.parametrize("n, k, rate", [(100, 0, 0.05), (300, 7, 0.0125), (40, 3, 0.3), (5, 2, 0.01)])
def test_the_tail_is_exact(spark, n, k, rate):
    df = spark.createDataFrame([(n, k)], "n long, k long")
    (found,) = df.select(q.binomial_tail(F.col("n"), F.col("k"), rate)).first()
    tail = sum(comb(n, i) * rate**i * (1 - rate) ** (n - i) for i in range(k + 1))
    assert found == pytest.approx(1.0 if k >= n * rate else tail, rel=1e-9)


def labelled(spark, n_clean, n_loud, quality_of_loud):
    """Clean documents, and documents in capitals; both labelled."""
    rows = [(k, prose(k, 40), "en") for k in range(n_clean)]
    rows += [(n_clean + k, prose(k, 40).upper(), "en") for k in range(n_loud)]
    labels = [(k, 1) for k in range(n_clean)]
    labels += [(n_clean + k, quality_of_loud) for k in range(n_loud)]
    return frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int")


def rejected(docs, labels):
    return {r.row.doc_id for r in q.judge(docs, labels, ["doc_id"]).where("NOT kept").collect()}


def test_a_rule_that_good_documents_never_meet_is_admitted(spark):
    docs, labels = labelled(spark, 600, 20, 0)
    assert rejected(docs, labels) == set(range(600, 620))


def test_a_rule_that_would_reject_good_documents_is_not(spark):
    docs, labels = labelled(spark, 600, 40, 1)
    assert rejected(docs, labels) == set()


def test_too_few_labels_admit_nothing(spark):
    docs, labels = labelled(spark, 60, 20, 0)
    assert rejected(docs, labels) == set()


def test_repeated_rows_are_one_draw(spark):
    """Copies of a few labelled rows certify nothing; a document is lost if one of its rows is."""
    docs, labels = labelled(spark, 60, 20, 0)
    copies = docs.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(12)))).drop("copy")
    assert rejected(copies, labels) == set()
    # 600 good documents, each of which has a loud row as well
    docs, labels = labelled(spark, 600, 20, 0)
    loud = docs.where("doc_id < 600").withColumn("text", F.upper("text"))
    assert rejected(docs.unionByName(loud), labels) == set()


def test_odd_labels_and_nothing(spark, odd, nothing):
    labels = spark.createDataFrame(
        [(1, 1), (1, 0), (None, 1), (2, None), (9, 1), (9, 1)], "doc_id long, quality int"
    )
    judged = q.judge(odd, labels)
    assert judged.count() == odd.count()
    assert judged.select("row.*").columns == odd.columns
    assert q.judge(odd, labels.where("false")).count() == odd.count()
    assert q.judge(nothing, labels).count() == 0


def test_nothing_python_is_in_the_plan(spark, odd):
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    plan = q.judge(odd, labels)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
