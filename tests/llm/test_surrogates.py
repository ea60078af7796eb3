from __future__ import annotations

import re
from collections import Counter

import pytest
from hypothesis import given
from hypothesis import strategies as st

from pullgrid.llm import surrogates as s

from .conftest import frame

KEY = "a key for tests"
TEXT = (
    "Write to Ann.Lee@Mail.example.com or ann.lee@mail.example.com, call +1 (319) 555-5132 or\n"
    "+1 319 555 5132, card 4799134681044206, valid 4111 1111 1111 1111, host 55.63.178.142.\n"
    "SSN 123-45-6789; IBAN DE44 5001 0517 5407 3249 31. Mr. John Smith, Mrs. Smith, Frau Müller,\n"
    "госпожа Анна Иванова. 12 345 items, 2019-2020, v1.2.3, 3.14159265, (a) 77."
)


def plain(text, key=KEY):
    return s.rewritten(text, key, lambda unit, value: 0)


def test_what_is_found():
    found = [(TEXT[a:b], kind) for a, b, kind in s.entities(TEXT)]
    assert Counter(k for _, k in found) == {
        "email": 2, "phone": 2, "card": 2, "ip": 1, "ssn": 1, "iban": 1, "name": 4,
    }
    assert ("Анна Иванова", "name") in found and ("John Smith", "name") in found


def test_nothing_private_is_left_and_the_rest_stays():
    new, _ = plain(TEXT)
    for a, b, _ in s.entities(TEXT):
        assert TEXT[a:b] not in new
    for stays in ("Write to ", "12 345 items, 2019-2020, v1.2.3, 3.14159265, (a) 77.", "Mrs. ", ".com"):
        assert stays in new


def test_format_type_and_coreference():
    new, _ = plain(TEXT)
    one, two = re.findall(r"\S+@\S+\.com", new)
    assert one.lower() == two and one[0].isupper() and one != two
    first, second = re.findall(r"\+1 \(\d{3}\) \d{3}-\d{4}|\+1 \d{3} \d{3} \d{4}", new)
    assert re.sub(r"\D", "", first) == re.sub(r"\D", "", second)
    card = re.search(r"valid (\d{4} \d{4} \d{4} \d{4})", new)[1]
    assert s.luhn(card.replace(" ", "")) and card != "4111 1111 1111 1111"
    assert all(int(x) < 256 for x in re.search(r"host ([\d.]+)\.", new)[1].split("."))
    assert re.search(r"IBAN DE\d\d \d{4} \d{4} \d{4} \d{4} \d\d", new)
    john, mrs = re.search(r"Mr\. (\w+) (\w+), Mrs\. (\w+)", new).group(1, 2), re.search(r"Mrs\. (\w+)", new)[1]
    assert john[0] in s.GIVEN["latin", "m"] and john[1] == mrs
    russian = re.search(r"госпожа (\w+) (\w+)", new)
    assert russian[1] in s.GIVEN["cyrillic", "f"] and s.script_of(russian[2]) == "cyrillic"


def test_the_key_matters_and_nothing_else():
    assert plain(TEXT) == plain(TEXT) and plain(TEXT)[0] != plain(TEXT, "another key")[0]


@pytest.mark.parametrize("n", [1, 2, 3])
def test_digits_are_permuted(n):
    numbers = [f"{k:0{n}d}" for k in range(10**n)]
    assert sorted(s.permuted(KEY, d, "x") for d in numbers) == numbers


def test_cards_phones_and_addresses_stay_distinct():
    cards = [f"{4000000000000000 + k}" for k in range(3000)]
    new = [s._card(KEY, c) for c in cards]
    assert len(set(new)) == 3000 and [s.luhn(c) for c in new] == [s.luhn(c) for c in cards]
    assert len({s._phone(KEY, f"1319555{k:04d}") for k in range(3000)}) == 3000
    assert len({s._ip(KEY, f"10.0.{k // 256}.{k % 256}") for k in range(3000)}) == 3000


@given(st.text(alphabet="ab1. @+-()\n\x00é4", max_size=60))
def test_any_text_keeps_what_is_no_entity(text):
    new, counts = plain(text)
    spans = s.entities(text)
    assert sum(counts.values()) == len(spans)
    if not spans:
        assert new == text


def test_a_long_word_with_an_at_sign_is_quick():
    assert plain("x" * 300_000 + "@" + "y" * 300_000)[1] == {}


def colliding(spark):
    """Two-letter local parts share a small space, so some must draw again."""
    names = [f"{a}{b}@x.org" for a in "abcdefghijklmnopqrst" for b in "abcdefghijklmnopqrst"]
    rows = [(k, f"{n} and {names[(k * 7) % 400]}", "en") for k, n in enumerate(names)]
    return names, frame(spark, rows).repartition(4)


@pytest.mark.parametrize("most", [100_000, 0])
def test_collisions_draw_again_until_all_are_distinct(spark, monkeypatch, most):
    monkeypatch.setattr(s, "BROADCAST_ROWS", most)
    names, docs = colliding(spark)
    again = s.redraws(docs, KEY)
    assert again.count() > 0
    rows = s.replace_pii(docs, KEY, ["doc_id"]).collect()
    mapped = {}
    for r in rows:
        one, two = r.rewritten.split(" and ")
        for old, new in ((names[r.row.doc_id], one), (names[(r.row.doc_id * 7) % 400], two)):
            assert mapped.setdefault(old, new) == new
    assert len(set(mapped.values())) == 400
    assert not set(mapped.values()) & set(names)


def test_odd_rows_and_nothing(odd, odd_rows, nothing):
    got = s.replace_pii(odd, KEY)
    assert Counter((r.row.doc_id, r.rewritten) for r in got.collect()) == Counter(
        (d, plain(t)[0] if t else t) for d, t, _ in odd_rows
    )
    assert got.select("row.*").columns == odd.columns
    assert s.replace_pii(nothing, KEY).count() == 0
