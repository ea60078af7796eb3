"""PII: detected entities receive keyed surrogates of the same kind and look.

Digits are permuted by a keyed Feistel cipher over numbers of the same length, so
distinct numbers stay distinct and keep their grouping; card numbers that pass their
checksum still do. Letters of addresses and names are drawn by a keyed hash from
letters of the same script and case; given names match the gender that the form of
address tells. A surrogate depends on the key and the entity alone, so every mention of
an entity in any document gets the same one, and a surname the same with or without
given names.

Letter surrogates can collide. All distinct entities are gathered by an aggregation,
and entities that share a surrogate, or whose surrogate is itself an entity of the
corpus, draw again, all but the least of those sharing, until none is left; the few
that drew again are broadcast behind a count, beyond which they are joined to their
documents. Texts are only rewritten in place and not moved, but for that case.

Defined results. Null text stays null, empty stays empty. Null ``doc_id`` and repeated
rows: rewritten like any other. Overlapping finds: the earlier, then the longer one. No
rows: no rows. Other columns pass through the operator whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pullgrid.llm.common import table, written
from pullgrid.llm.slices import text_slices
from pullgrid.shipping import ship_package

BROADCAST_ROWS = 100_000
MAX_DRAWS = 64
DEMO_KEY = "not a secret: replace it"

PHONE = re.compile(
    r"(?<![\w.+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{1,4}\)[ .-]?|(?<=\+)|(?<=[ .-])|(?<![0-9]))"
    r"[0-9]{2,4}(?:[ .-][0-9]{2,4}){1,4}(?![\w])(?!\.[0-9])"
)
PLUS_PHONE = re.compile(r"\+[0-9]{7,15}(?![0-9])")
CARD = re.compile(r"(?<![\w.])[0-9](?:[ -]?[0-9]){12,18}(?![\w])(?!\.[0-9])")
IP = re.compile(r"(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\w)(?!\.[0-9])")
SSN = re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])")
IBAN = re.compile(r"(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
LOCAL = re.compile(r"[\w.+-]{1,64}\Z")
DOMAIN = re.compile(r"[\w-]{1,63}(?:\.[\w-]{1,63})+")

# fixed values: forms of address before a name
MALE = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Don", "господин", "Господин")
FEMALE = (
    "Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Doña", "госпожа", "Госпожа",
)
EITHER = ("Dr", "Prof")
_CAPITAL = r"[A-ZÀ-ÖØ-ÞА-ЯЁ][a-zß-öø-ÿа-яё'’-]+"
NAME = re.compile(
    rf"(?<!\w)({'|'.join(MALE + FEMALE + EITHER)})\.? ({_CAPITAL}(?: {_CAPITAL}){{0,2}})"
)

# fixed values: given names by script and gender
GIVEN = {
    ("latin", "m"): "Adam Bruno Carl David Emil Felix Georg Hugo Ivan Jonas Karl Louis Martin Noel Oscar Paul Robin Simon Theo Victor".split(),
    ("latin", "f"): "Anna Berta Clara Diana Emma Flora Greta Helena Irene Julia Karla Laura Maria Nora Olga Paula Rosa Sara Tina Vera".split(),
    ("cyrillic", "m"): "Андрей Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим".split(),
    ("cyrillic", "f"): "Анна Вера Галина Дарья Елена Ирина Ксения Лидия Мария Нина".split(),
}
SYLLABLES = {
    "latin": [c + v for c in "bdfgklmnprstvz" for v in ("a", "e", "i", "o")],
    "cyrillic": [c + v for c in "бвгдзклмнпрст" for v in ("а", "е", "и", "о")],
}
LETTERS = {
    "latin": "abcdefghijklmnopqrstuvwxyz",
    "greek": "αβγδεζηθικλμνξοπρστυφχψω",
    "cyrillic": "абвгдежзиклмнопрстуфхцчшщэюя",
}
KINDS = ("email", "iban", "card", "ssn", "ip", "phone", "name")


def script_of(letter: str) -> str:
    if "Ͱ" <= letter <= "Ͽ":
        return "greek"
    return "cyrillic" if "Ѐ" <= letter <= "ӿ" else "latin"


# ---- detection --------------------------------------------------------------------------


def luhn(digits: str) -> bool:
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at = text.find("@")
    while at >= 0:
        local = LOCAL.search(text[max(0, at - 64) : at])
        domain = DOMAIN.match(text, at + 1)
        if local and domain and local[0].strip(".+-"):
            yield at - len(local[0]), domain.end()
        at = text.find("@", at + 1)


def entities(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the entities of a text, none overlapping."""
    found = []
    if "@" in text:
        found += [(a, b, "email") for a, b in _emails(text)]
    if re.search(r"[0-9][0-9. ()-]{5}", text):
        found += [(*m.span(), "iban") for m in IBAN.finditer(text)]
        for m in CARD.finditer(text):
            digits = re.sub(r"\D", "", m[0])
            if len(digits) == 16 or luhn(digits):
                found.append((*m.span(), "card"))
        found += [(*m.span(), "ssn") for m in SSN.finditer(text)]
        for pattern in (PHONE, PLUS_PHONE):
            for m in pattern.finditer(text):
                n = sum(c.isdigit() for c in m[0])
                if 9 <= n <= 15 or (n >= 7 and m[0][0] in "+("):
                    found.append((*m.span(), "phone"))
        for m in IP.finditer(text):
            if all(int(x) < 256 for x in m[0].split(".")):
                found.append((*m.span(), "ip"))
    found += [(*m.span(2), "name") for m in NAME.finditer(text)]
    found.sort(key=lambda e: (e[0], -e[1], KINDS.index(e[2])))
    kept, end = [], 0
    for e in found:
        if e[0] >= end:
            kept.append(e)
            end = e[1]
    return kept


# ---- surrogates ---------------------------------------------------------------------------


@lru_cache(maxsize=1 << 16)
def _draw(key: str, *about) -> int:
    told = "\x1f".join(map(str, about)).encode()
    return int.from_bytes(hashlib.blake2b(told, digest_size=16, key=key.encode()[:64]).digest())


def permuted(key: str, digits: str, about: str) -> str:
    """A keyed permutation of the numbers of this length."""
    n = len(digits)
    if n < 2:
        return str((int(digits) + _draw(key, about) % 10) % 10) if digits else digits
    left, right = n // 2, n - n // 2
    a, b = int(digits[:left]), int(digits[left:])
    for step in range(8):
        if step % 2:
            b = (b + _draw(key, about, n, step, a)) % 10**right
        else:
            a = (a + _draw(key, about, n, step, b)) % 10**left
    return f"{a:0{left}d}{b:0{right}d}"


def _redigit(shape: str, digits: str) -> str:
    new = iter(digits)
    return "".join(next(new) if c.isdigit() else c for c in shape)


def relettered(key: str, word: str, about: str) -> str:
    """Letters and digits of the same script, case and place."""
    out, drawn = [], 0
    for k, c in enumerate(word):
        if k % 16 == 0:
            drawn = _draw(key, about, k)
        if c.isdigit():
            out.append(str(drawn % 10))
        elif c.isalpha():
            pool = LETTERS[script_of(c)]
            new = pool[drawn % len(pool)]
            out.append(new.upper() if c.isupper() else new)
        else:
            out.append(c)
        drawn //= 37
    return "".join(out)


def _check_digit(digits: str) -> str:
    return next(d for d in "0123456789" if luhn(digits + d))


def _card(key: str, digits: str) -> str:
    if luhn(digits):
        body = permuted(key, digits[:-1], "card")
        return body + _check_digit(body)
    while True:  # walks the permutation's cycle, so it stays one to one
        digits = permuted(key, digits, "card")
        if not luhn(digits):
            return digits


def _phone(key: str, digits: str) -> str:
    kept = 1 if digits[0] in "17" else 2
    return digits[:kept] + permuted(key, digits[kept:], f"phone{kept}")


def _ip(key: str, octets: str) -> str:
    head, *rest = (int(x) for x in octets.split("."))
    low = (rest[0] << 16) | (rest[1] << 8) | rest[2]
    a, b = low >> 12, low & 0xFFF
    for step in range(8):
        if step % 2:
            b = (b + _draw(key, "ip", head, step, a)) % 4096
        else:
            a = (a + _draw(key, "ip", head, step, b)) % 4096
    low = a << 12 | b
    return f"{head}.{low >> 16}.{(low >> 8) & 255}.{low & 255}"


def _word_name(key: str, unit: str, value: str, gender: str, draw: int) -> str:
    script = "cyrillic" if script_of(value[0]) == "cyrillic" else "latin"
    drawn = _draw(key, unit, value, gender, draw)
    if unit == "given" and draw == 0:
        pool = GIVEN[script, gender if gender in "mf" else "mf"[drawn % 2]]
        return pool[(drawn >> 8) % len(pool)]
    pool, out = SYLLABLES[script], ""
    for _ in range(3 + (draw + 3) // 4):  # later draws are longer: there is always a free one
        out += pool[drawn % len(pool)]
        drawn //= len(pool)
    return out.capitalize()


def units(text: str, kind: str, gender: str) -> list[tuple[str, str]]:
    """(unit, canonical form) of the parts of an entity that get a surrogate each."""
    if kind == "email":
        return [("email", text.lower())]
    if kind == "name":
        words = text.split(" ")
        return [*((f"given {gender}", w) for w in words[:-1]), ("surname", words[-1])]
    if kind == "ip":
        return [("ip", ".".join(str(int(x)) for x in text.split(".")))]
    if kind == "iban":
        return [("iban", text.replace(" ", ""))]
    return [(kind, re.sub(r"[^0-9]", "", text))]


def surrogate(key: str, unit: str, value: str, draw: int) -> str:
    """The canonical form of a unit's surrogate in its draw."""
    if unit == "email":
        local, _, domain = value.rpartition("@")
        host, dot, top = domain.rpartition(".")
        # a host keeps one surrogate; the part before it is drawn again after a collision
        return f"{relettered(key, local, f'{value} {draw}')}@{relettered(key, host, host)}{dot}{top}"
    if unit == "card":
        return _card(key, value)
    if unit == "phone":
        return _phone(key, value)
    if unit == "ip":
        return _ip(key, value)
    if unit == "ssn":
        return permuted(key, value, "ssn")
    if unit == "iban":
        return value[:2] + relettered(key, value[2:], f"{value} {draw}")
    name, _, gender = unit.partition(" ")
    return _word_name(key, name, value, gender, draw)


DRAWN = ("email", "iban", "surname", "given m", "given f", "given ?")  # units that can collide


def rewritten(text: str, key: str, draw_of: Callable[[str, str], int]) -> tuple[str, dict[str, int]]:
    """The text with surrogates, and how many entities of each kind it had."""
    counts: dict[str, int] = {}
    out, end = [], 0
    for a, b, kind in entities(text):
        own = text[a:b]
        new = [surrogate(key, u, v, draw_of(u, v)) for u, v in units(own, kind, gender_at(text, a))]
        if kind == "email":
            shown = "".join(
                n.upper() if c.isupper() and n.isalpha() else n for c, n in zip(own, new[0], strict=True)
            )
        elif kind == "name":
            shown = " ".join(new)
        elif kind == "iban":
            left = iter(new[0])
            shown = "".join(c if c == " " else next(left) for c in own)
        else:
            shown = new[0] if kind == "ip" else _redigit(own, new[0])
        out += [text[end:a], shown]
        end = b
        counts[kind] = counts.get(kind, 0) + 1
    return ("".join([*out, text[end:]]) if out else text), counts


def gender_at(text: str, start: int) -> str:
    before = text[max(0, start - 12) : start].rstrip(". ").split(" ")[-1].split("\n")[-1]
    return "m" if before in MALE else "f" if before in FEMALE else "?"


# ---- over the corpus --------------------------------------------------------------------


def distinct_units(docs: DataFrame, key: str) -> DataFrame:
    """(unit, value) of every drawn surrogate the corpus needs, once each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            seen = {
                u
                for text in batch.column("text").to_pylist()
                if text
                for a, b, kind in entities(text)
                for u in units(text[a:b], kind, gender_at(text, a))
                if u[0] in DRAWN
            }
            yield pa.RecordBatch.from_pydict(
                {
                    "unit": pa.array([u for u, _ in seen], pa.string()),
                    "value": pa.array([v for _, v in seen], pa.string()),
                }
            )

    return docs.select("text").mapInArrow(run, "unit string, value string").distinct()


def _drawn(rows: DataFrame, key: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = [
                surrogate(key, r["unit"], r["value"], r["draw"]) for r in batch.to_pylist()
            ]
            yield batch.append_column("surrogate", pa.array(new, pa.string()))

    return rows.mapInArrow(run, "unit string, value string, draw int, surrogate string")


def redraws(docs: DataFrame, key: str) -> DataFrame:
    """(unit, value, draw) of the entities that had to draw again."""
    space = F.split("unit", " ")[0].alias("space")  # given names of any gender share a space
    taken = written(distinct_units(docs, key), "entities")
    real = taken.select(space, F.col("value").alias("surrogate")).distinct()
    current = written(_drawn(taken.withColumn("draw", F.lit(0)), key), "draws")
    for _ in range(MAX_DRAWS):
        named = current.withColumn("space", space)
        firsts = named.groupBy("space", "surrogate").agg(
            F.min(F.struct("draw", "unit", "value")).alias("first"), F.count("*").alias("n")
        )
        own = F.struct("draw", "unit", "value")
        shared = named.join(firsts.where("n > 1"), ["space", "surrogate"]).where(own != F.col("first"))
        real_too = named.join(real, ["space", "surrogate"], "left_semi")
        again = shared.select("unit", "value", "draw").unionByName(
            real_too.select("unit", "value", "draw")
        )
        again = written(again.distinct().withColumn("draw", F.col("draw") + 1), "redraws")
        if not again.head(1):
            return current.where("draw > 0").select("unit", "value", "draw")
        kept = current.join(again.select("unit", "value"), ["unit", "value"], "left_anti")
        current = written(kept.unionByName(_drawn(again, key)), "draws")
    raise RuntimeError(f"surrogates still collide after {MAX_DRAWS} draws")


OUT = ", ".join(f"n_{k} long" for k in KINDS) + ", rewritten string"


def replace_pii(docs: DataFrame, key: str, carried: list[str] | None = None) -> DataFrame:
    """(row, n_email, ..., rewritten) per document; ``row`` holds the carried columns."""
    ship_package(docs.sparkSession)
    again = redraws(docs, key)
    packed = docs.select(F.struct(*(carried or docs.columns)).alias("row"), "text")
    row_type = packed.schema["row"].dataType.simpleString()
    few = again.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    known = {(r.unit, r.value): r.draw for r in again.collect()} if few else {}
    if not few:
        packed = _with_own_redraws(packed, again)
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        everywhere = shared.value
        for batch in text_slices(batches):
            texts, counts = [], {k: [] for k in KINDS}
            own = batch.column("redraws").to_pylist() if "redraws" in batch.schema.names else None
            for k, text in enumerate(batch.column("text").to_pylist()):
                draws = everywhere if own is None else {
                    (d["unit"], d["value"]): d["draw"] for d in own[k] or ()
                }
                new, n = rewritten(text, key, lambda u, v: draws.get((u, v), 0)) if text else (text, {})  # noqa: B023
                texts.append(new)
                for kind in KINDS:
                    counts[kind].append(n.get(kind, 0))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    *(pa.array(counts[k], pa.int64()) for k in KINDS),
                    pa.array(texts, pa.string()),
                ],
                ["row", *(f"n_{k}" for k in KINDS), "rewritten"],
            )

    return packed.mapInArrow(run, f"row {row_type}, {OUT}")


def _with_own_redraws(packed: DataFrame, again: DataFrame) -> DataFrame:
    """Each text with the redraws of its own entities, where they are too many to broadcast."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            rows = {
                (h, *u)
                for h, text in zip(*(batch.column(c).to_pylist() for c in ("h", "text")), strict=True)
                for a, b, kind in entities(text or "")
                for u in units(text[a:b], kind, gender_at(text, a))
                if u[0] in DRAWN
            }
            columns = list(zip(*rows, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), *(pa.array(c, pa.string()) for c in columns[1:])],
                ["h", "unit", "value"],
            )

    hashed = packed.withColumn("h", F.xxhash64("text"))
    needed = hashed.select("h", "text").mapInArrow(run, "h long, unit string, value string")
    per_text = (
        needed.distinct()
        .join(again, ["unit", "value"])
        .groupBy("h")
        .agg(F.collect_list(F.struct("unit", "value", "draw")).alias("redraws"))
    )
    return hashed.join(per_text, "h", "left").drop("h")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    replaced = replace_pii(table(spark, sf_dir, "documents"), DEMO_KEY, ["doc_id"])
    return replaced.select(
        F.col("row.doc_id").alias("doc_id"),
        *(f"n_{k}" for k in KINDS),
        F.col("rewritten").alias("text"),
    )
