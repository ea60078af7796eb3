from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import functions as F

from pullgrid.llm import secret_links as s

from .conftest import frame

HEX = "0123456789abcdef" * 3
KEY = "Ab1" + "Zz9/" * 9 + "q"


def brute(text, reach):
    """Base spans by the contract's own patterns, and weak ones by comparing all pairs."""
    text = text or ""
    words = r"(password|passwd|secret|token|api_?key)"
    base = [
        ("assign", *m.span())
        for m in re.finditer(
            rf"(?i:{words})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text, re.A
        )
        if len(m[2]) >= 8
    ]
    base += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    base += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    order = lambda x: (x[1], s.KINDS.index(x[0]))
    base.sort(key=order)
    weak = s.weak_spans(text, base)
    near = lambda a, b: a[1] - b[2] <= reach and b[1] - a[2] <= reach
    linked = [
        w
        for w in weak
        if any(s.ROLES[p[0]] in s.NEEDS[w[0]] and near(w, p) for p in base + weak if p != w)
    ]
    return base, sorted(base + linked, key=order)


TEXTS = [
    None,
    "",
    f'password = "hunter2hunter2" and TOKEN:abcdefgh, token=short, api_key: {HEX}',
    f"AKIA{'Q' * 16} x {KEY} at https://db.example.com/x",
    f"AKIA{'Q' * 16}" + " pad" * 120 + f" {KEY} https://far.example.com",
    f"user=alice {HEX} user_name: bob",
    "user=alice https://example.com nothing secret here",
    f"client_id: me {KEY}" + " z" * 90 + " https://edge.example.org",
    f"ſecret=abcdefghij passwd='{'a' * 7}' passwd='{'a' * 8}'",
    f"日本 user=al token={'t' * 9} 語 " * 30,
    "AKIA" + "A" * 11 + " AKIA" + "B" * 12,
]


def found(df, **args):
    out = s.find_secrets(df, ["doc_id"], **args).select("row.doc_id", s.spelled("base"), s.spelled("spans"))
    return Counter(tuple(r) for r in out.collect())


def spelled(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def test_spans_and_links_match_all_pairs(spark):
    rows = [(k, t, "en") for k, t in enumerate(TEXTS * 2)] + [(None, TEXTS[3], "en"), (0, TEXTS[5], "en")]
    for reach in (7, 200):
        want = Counter((d, *map(spelled, brute(t, reach))) for d, t, _ in rows)
        assert found(frame(spark, rows), reach=reach) == want


def test_odd_rows_and_nothing(odd, odd_rows, nothing):
    assert found(odd) == Counter((d, *map(spelled, brute(t, 200))) for d, t, _ in odd_rows)
    assert found(nothing) == Counter()


def test_weak_parts_alone_are_not_reported(spark):
    df = frame(spark, [(1, TEXTS[6], "en")])
    assert s.find_secrets(df).select(F.size("spans")).first()[0] == 0
