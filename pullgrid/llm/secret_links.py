"""Secret scan with multipart credential linking.

Base kinds (assignments, access ids, long hex) are reported wherever they stand. Weaker
parts (a user or client name, a bare 40-letter key, an endpoint) are reported only when
a complementary part lies within ``REACH`` code points: names and
endpoints need a secret, keys need an identifier. The link is an interval join over all documents:
parts are laid on a grid of ``REACH`` wide cells, what each cell holds is aggregated to
one interval per role before the join, and a weak part meets the cells around it. So a
text with many parts costs a few rows per part and never their pairs.

Defined results. Null or empty text: no spans, the hash of an empty string. Null
``doc_id`` and repeated rows: scanned each; equal rows share their links. No rows: no
rows. Other columns are carried if asked for, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pullgrid.llm.common import table, written
from pullgrid.llm.slices import text_slices
from pullgrid.shipping import ship_package

REACH = 200

# fixed patterns of the base kinds; letters of the keywords in either case
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")

# weak parts
NAME = re.compile(
    r"\b(?:user(?:_?name)?|login|account|client_?id|access_?key_?id|key_?id)"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9@._-]{3,})",
    re.IGNORECASE | re.ASCII,
)
KEY = re.compile(r"(?<![A-Za-z0-9+/=_.-])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_.-])")
ENDPOINT = re.compile(
    r"\b(?:https?|ftp|sftp|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[^\s\"'<>]+", re.ASCII
)
LONG_RUN = re.compile(r"[0-9A-Za-z+/]{32}")

KINDS = ("assign", "access", "hex", "name", "key", "endpoint")
ROLES = {
    "assign": "secret",
    "access": "identifier",
    "hex": "secret",
    "name": "identifier",
    "key": "secret",
    "endpoint": "endpoint",
}
NEEDS = {"name": ("secret",), "key": ("identifier",), "endpoint": ("secret",)}


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    if LONG_RUN.search(text):
        found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def weak_spans(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Weak parts that overlap no base span."""
    found = []
    if ":" in text or "=" in text:
        found += [("name", *m.span()) for m in NAME.finditer(text)]
    if "://" in text:
        found += [("endpoint", *m.span()) for m in ENDPOINT.finditer(text)]
    if LONG_RUN.search(text):
        mixed = lambda k: re.search("[0-9]", k) and re.search("[A-Z]", k) and re.search("[a-z]", k)
        found += [("key", *m.span()) for m in KEY.finditer(text) if mixed(m[0])]
    found.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    free, at = [], 0
    for span in found:
        while at < len(base) and base[at][2] <= span[1]:
            at += 1
        if at == len(base) or base[at][1] >= span[2]:
            free.append(span)
    return free


SPANS = "array<struct<kind:string,start:int,stop:int>>"
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))


def _as_rows(spans: list[tuple[str, int, int]]) -> list[dict]:
    return [{"kind": k, "start": a, "stop": b} for k, a, b in spans]


def scan(docs: DataFrame, carried: list[str]) -> DataFrame:
    """(row, key_id, key_text, base, weak) per document: spans of every whole text."""
    ship_package(docs.sparkSession)
    packed = docs.select(
        F.struct(*carried).alias("row"),
        F.col("doc_id").cast("string").alias("key_id"),
        F.xxhash64("text").alias("key_text"),
        "text",
    )
    row_type = packed.schema["row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            base, weak = [], []
            for text in batch.column("text").to_pylist():
                strong = base_spans(text or "")
                base.append(_as_rows(strong))
                weak.append(_as_rows(weak_spans(text or "", strong)))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("row", "key_id", "key_text")),
                    pa.array(base, _SPAN_TYPE),
                    pa.array(weak, _SPAN_TYPE),
                ],
                ["row", "key_id", "key_text", "base", "weak"],
            )

    return packed.mapInArrow(
        run, f"row {row_type}, key_id string, key_text long, base {SPANS}, weak {SPANS}"
    )


def linked_spans(scanned: DataFrame, reach: int = REACH) -> DataFrame:
    """(key_id, key_text, linked): weak parts that a complementary part is near to."""
    role = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    needs = F.create_map(
        *[x for k, v in NEEDS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))]
    )
    cells = lambda a, b: F.explode(F.sequence(F.floor(a / reach), F.floor(b / reach)))
    key = ("key_id", "key_text")
    with_weak = scanned.where(F.size("weak") > 0).dropDuplicates(list(key))
    parts = with_weak.select(*key, F.explode(F.concat("base", "weak")).alias("p"))
    held = (
        parts.select(*key, role[F.col("p.kind")].alias("role"), "p.start", "p.stop")
        .select("*", cells(F.col("start"), F.col("stop")).alias("cell"))
        .groupBy(*key, "cell", "role")
        .agg(F.min("start").alias("low"), F.max("stop").alias("high"))
    )
    asking = with_weak.select(*key, F.explode("weak").alias("p")).select(
        *key,
        "p",
        F.explode(needs[F.col("p.kind")]).alias("role"),
        (F.col("p.start") - reach).alias("from"),
        (F.col("p.stop") + reach).alias("to"),
    )
    asking = asking.select("*", cells(F.greatest("from", F.lit(0)), F.col("to")).alias("cell"))
    met = asking.alias("a").join(
        held.alias("h"),
        F.col("a.key_id").eqNullSafe(F.col("h.key_id"))
        & (F.col("a.key_text") == F.col("h.key_text"))
        & (F.col("a.cell") == F.col("h.cell"))
        & (F.col("a.role") == F.col("h.role"))
        & (F.col("high") >= F.col("from"))
        & (F.col("low") <= F.col("to")),
        "left_semi",
    )
    return met.groupBy(*key).agg(F.collect_set("p").alias("linked"))


def find_secrets(
    docs: DataFrame, carried: list[str] | None = None, reach: int = REACH
) -> DataFrame:
    """(row, base, spans): base spans and all spans, by start, then kind."""
    scanned = written(scan(docs, carried or docs.columns), "secrets")
    linked = linked_spans(scanned, reach).withColumnsRenamed(
        {"key_id": "linked_id", "key_text": "linked_text"}
    )
    same = F.col("key_id").eqNullSafe(F.col("linked_id")) & (
        F.col("key_text") == F.col("linked_text")
    )
    rank = F.create_map(*[x for n, k in enumerate(KINDS) for x in (F.lit(k), F.lit(n))])
    by_start = F.array_sort(
        F.transform(
            F.concat("base", F.coalesce("linked", F.array().cast(SPANS))),
            lambda s: F.struct(s["start"], rank[s["kind"]].alias("rank"), s["kind"], s["stop"]),
        )
    )
    spans = F.transform(
        by_start, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"))
    )
    return scanned.join(linked, same, "left").select("row", "base", spans.alias("spans"))


def spelled(spans: str) -> Column:
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"), ["doc_id"])
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(spelled("base"), 256).alias("base_sha256"),
        spelled("spans").alias("spans"),
    )
