"""Quality rules with risk-controlled cutoffs.

Base counts are taken from every whole text with SQL functions. For each stratum
(language) and rule a fixed ladder of cutoffs, lenient to strict, is tested on all
labelled documents: a good document that a cutoff rejects is a false rejection.
A cutoff is admitted when the exact binomial probability of seeing so few false
rejections, were the true rate above the rule's share of the allowed risk, is at
most the level left after Bonferroni correction over all strata and rules; a ladder
is walked in fixed sequence and stops at its first failure, so it needs no further
correction. The strictest admitted cutoff holds. With the chosen confidence, no
stratum then loses more than ``risk`` of its good documents to the rules together.

Features are computed once and written to the shared folder; the labels meet the
narrow features, never the texts. What is broadcast is one row per stratum and rule
(strata are grouped by language; a stratum without labels admits no cutoff).

Defined results. Null or blank text: no words, so ``base_failed``. Null language: a
stratum of its own. Null ``doc_id``: judged like any other, never matched to a
label. Labels repeated for a document: good if all of them are. Null labels are
ignored. Repeated rows are judged each; rows of one ``doc_id`` are one draw of the holdout,
rejected if any of them is: copies of a row say nothing new about the rate.
No labels: only the base rules reject. No rows: no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pullgrid.llm.common import BLANKS, table, written

RISK = 0.05  # of good documents in a stratum, over all rules
LEVEL = 0.05  # one minus the confidence, over all strata and rules
WINDOW = 8
BROADCAST_STRATA = 10_000

# rule: (numerator, denominator, cutoffs in per mille, lenient to strict)
RULES = {
    "symbols": ("n_symbols", "word_chars", (500, 300, 200, 150, 100, 70, 50, 30, 20, 10)),
    "dup_lines": ("n_dup_lines", "n_lines", (900, 700, 500, 400, 300, 200, 150, 100)),
    "repeats": ("n_repeat_words", "n_words", (250, 200, 150, 100, 70, 50, 30)),
    "capitals": ("n_capitals", "word_chars", (900, 700, 500, 400, 300, 200, 150)),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _shifted(hashes: Column, by: int) -> Column:
    """Hash of element i with element i + by, for all i that have both."""
    n = F.size(hashes) - by
    return F.zip_with(
        F.slice(hashes, F.lit(1), n),
        F.slice(hashes, F.lit(1 + by), n),
        lambda a, b: F.xxhash64(a, b),
    )


def features(docs: DataFrame, carried: list[str]) -> DataFrame:
    """(row, stratum, counts, base_failed); ``row`` holds the carried columns."""
    base = docs.select(
        F.struct(*carried).alias("row"),
        F.coalesce("lang", F.lit("")).alias("stratum"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    solid = F.translate("text", BLANKS, "")
    words = F.filter(F.split("text", f"[{BLANKS}]+", -1), lambda w: w != "")
    counted = base.select(
        "row",
        "stratum",
        F.char_length(solid).cast("long").alias("word_chars"),
        (F.char_length("text") - F.char_length(F.translate("text", "#*$%&|<>", "")))
        .cast("long")
        .alias("n_symbols"),
        (F.char_length("text") - F.char_length(F.regexp_replace("text", "[A-Z]+", "")))
        .cast("long")
        .alias("n_capitals"),
        F.filter(F.split("text", "\n", -1), lambda x: F.trim(x, F.lit(BLANKS)) != "").alias("lines"),
        F.transform(words, lambda w: F.xxhash64(w)).alias("h1"),
    )
    windowed = counted.select(
        "*",
        F.size("h1").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("h1") >= WINDOW, _shifted(_shifted(_shifted(F.col("h1"), 1), 2), 4)).alias("h8"),
    ).drop("lines", "h1")
    # most texts repeat no window; only the others sort theirs
    ordered = F.when(
        F.size(F.array_distinct("h8")) < F.size("h8"),
        F.array_sort(F.transform("h8", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    )
    sorted_ = windowed.withColumn("ordered", ordered).drop("h8")
    same = lambda k, x: F.coalesce(F.get("ordered", k)["h"] == x["h"], F.lit(False))
    starts = F.array_sort(
        F.transform(
            F.filter("ordered", lambda x, k: same(k - 1, x) | same(k + 1, x)), lambda x: x["i"]
        )
    )
    started = sorted_.withColumn("starts", starts).drop("ordered")
    gaps = F.transform(
        "starts",
        lambda x, k: F.least(F.coalesce(F.get("starts", k + 1) - x, F.lit(WINDOW)), F.lit(WINDOW)),
    )
    covered = F.aggregate(gaps, F.lit(0).cast("long"), lambda total, x: total + x)
    repeated = F.coalesce(covered, F.lit(0)).cast("long")
    return (
        started.withColumn("n_repeat_words", repeated)
        .drop("starts")
        .withColumn("base_failed", base_failed())
    )


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def _rejects(rule: str, cutoff: Column) -> Column:
    above, below, _ = RULES[rule]
    return 1000 * F.col(above) > cutoff * F.col(below)


def binomial_tail(n: Column, k: Column, rate: float) -> Column:
    """P(Bin(n, rate) <= k), exactly, by its terms in logarithms; 1 where k is above the mean."""
    log = F.log(F.lit(rate / (1 - rate)))
    first = n * F.log(F.lit(1 - rate))
    step = lambda acc, i: F.struct(
        (acc["term"] + F.log((n - i + 1) / i) + log).alias("term"),
        (acc["total"] + F.exp(acc["term"] + F.log((n - i + 1) / i) + log)).alias("total"),
    )
    start = F.struct(first.alias("term"), F.exp(first).alias("total"))
    terms = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(
        F.array().cast("array<bigint>")
    )
    tail = F.aggregate(terms, start, step, lambda acc: acc["total"])
    return F.when(k >= n * rate, F.lit(1.0)).otherwise(tail)


def cutoffs(counted: DataFrame, labels: DataFrame, risk: float, level: float) -> DataFrame:
    """(stratum, symbols, dup_lines, ...): the strictest admitted cutoff per rule, or null."""
    good = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy(F.col("doc_id").alias("label_id"))
        .agg(F.min("quality").alias("quality"))
        .where("quality = 1")
    )
    held = counted.where("NOT base_failed").join(
        good, F.col("row.doc_id") == F.col("label_id"), "semi"
    )
    ladder = [(r, s, c) for r, (_, _, cs) in RULES.items() for s, c in enumerate(cs)]
    # a bit per cutoff that rejects; one draw per document, whatever rows it has
    bits = [F.when(_rejects(r, F.lit(c)), F.lit(1 << k)).otherwise(F.lit(0)) for k, (r, _, c) in enumerate(ladder)]
    mask = reduce(Column.bitwiseOR, [b.cast("long") for b in bits])
    draws = held.groupBy("stratum", F.col("row.doc_id").alias("doc_id")).agg(F.bit_or(mask).alias("lost"))
    lost = [F.sum(F.getbit("lost", F.lit(k)).cast("long")).alias(f"{r}_{s}") for k, (r, s, _) in enumerate(ladder)]
    seen = draws.groupBy("stratum").agg(F.count("*").alias("n"), *lost)
    # one row per stratum: small enough for a window over all of them
    strata = F.count("*").over(Window.partitionBy(F.lit(0)))
    seen = seen.withColumn("family", strata * len(RULES))
    steps = F.array(
        *[
            F.struct(
                F.lit(r).alias("rule"),
                F.lit(s).alias("step"),
                F.lit(c).alias("cutoff"),
                F.col(f"{r}_{s}").alias("k"),
            )
            for r, s, c in ladder
        ]
    )
    tests = seen.select("stratum", "n", "family", F.explode(steps).alias("s"))
    tests = tests.select("stratum", "n", "family", "s.*")
    p = binomial_tail(F.col("n"), F.col("k"), risk / len(RULES))
    failed = tests.withColumn("fails", (p > level / F.col("family")).cast("int"))
    walk = Window.partitionBy("stratum", "rule").orderBy("step")
    admitted = failed.withColumn("failures", F.sum("fails").over(walk)).where("failures = 0")
    return (
        admitted.groupBy("stratum")
        .pivot("rule", list(RULES))
        .agg(F.min("cutoff"))
    )


def judge(
    docs: DataFrame,
    labels: DataFrame,
    carried: list[str] | None = None,
    risk: float = RISK,
    level: float = LEVEL,
) -> DataFrame:
    """(row, counts, base_failed, kept) per document; ``carried``: columns of ``row``, all by default."""
    counted = written(features(docs, carried or docs.columns), "counts")
    chosen = written(cutoffs(counted, labels, risk, level), "cutoffs")
    chosen = chosen.withColumnRenamed("stratum", "chosen")
    # a stratum appears only with hundreds of good labels; languages are few, but this is checked
    if chosen.count() <= BROADCAST_STRATA:
        chosen = F.broadcast(chosen)
    rejected = F.lit(False)
    for rule in RULES:
        rejected = rejected | F.coalesce(_rejects(rule, F.col(rule)), F.lit(False))
    return (
        counted.join(chosen, F.col("stratum") == F.col("chosen"), "left")
        .withColumn("kept", ~(F.col("base_failed") | rejected))
        .select("row", *COUNTS, "base_failed", "kept")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    judged = judge(docs.select("doc_id", "lang", "text"), labels, ["doc_id"])
    return judged.select(F.col("row.doc_id").alias("doc_id"), *COUNTS, "base_failed", "kept")


_LADDER = ", ".join(
    f"('{rule}', {step}, {cutoff}, n_{rule}_{step})"
    for rule, (_, _, cs) in RULES.items()
    for step, cutoff in enumerate(cs)
)
_LOST = ", ".join(
    f"count(*) FILTER (l_{rule}_{step}) AS n_{rule}_{step}"
    for rule, (_, _, cs) in RULES.items()
    for step in range(len(cs))
)
_FLAGS = ", ".join(
    f"bool_or(1000 * {above} > {cutoff} * {below}) AS l_{rule}_{step}"
    for rule, (above, below, cs) in RULES.items()
    for step, cutoff in enumerate(cs)
)
_REJECTED = " OR ".join(
    f"coalesce(1000 * {above} > {rule} * {below}, false)" for rule, (above, below, _) in RULES.items()
)
_CHOSEN = ", ".join(f"min(cutoff) FILTER (rule = '{rule}') AS {rule}" for rule in RULES)
_RATE = RISK / len(RULES)
SQL = f"""
WITH split AS (
  SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT *, list_transform(range(1, len(words) - 6), lambda i: array_to_string(words[i:i + 7], ' ')) AS w8
  FROM split
), spread AS (
  SELECT doc_id, unnest(w8) AS w, unnest(range(len(w8))) AS pos FROM windows
), counted_windows AS (
  SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, w) AS n FROM spread
), gaps AS (
  SELECT doc_id, least(8, coalesce(lead(pos) OVER (PARTITION BY doc_id ORDER BY pos) - pos, 8)) AS gap
  FROM counted_windows WHERE n > 1
), repeats AS (SELECT doc_id, sum(gap)::BIGINT AS n_repeat_words FROM gaps GROUP BY doc_id),
counted AS (
  SELECT doc_id, stratum, len(words)::BIGINT AS n_words,
         length(array_to_string(words, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         length(regexp_replace(text, '[^A-Z]', '', 'g'))::BIGINT AS n_capitals,
         len(lines)::BIGINT AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM windows LEFT JOIN repeats USING (doc_id)
), judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted
), held AS (
  SELECT * FROM judged WHERE NOT base_failed AND doc_id IN (
    SELECT doc_id FROM labels WHERE quality IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1)
), draws AS (SELECT stratum, doc_id, {_FLAGS} FROM held GROUP BY stratum, doc_id),
seen AS (SELECT stratum, count(*) AS n, {_LOST} FROM draws GROUP BY stratum),
tests AS (
  SELECT stratum, n, t.rule, t.step, t.cutoff, t.k, (SELECT count(*) FROM seen) * {len(RULES)} AS family
  FROM seen, LATERAL (VALUES {_LADDER}) AS t(rule, step, cutoff, k)
), tails AS (
  SELECT *, CASE WHEN k >= n * {_RATE}::DOUBLE THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1),
    lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({_RATE}::DOUBLE)
             + (n - i) * ln(1 - {_RATE}::DOUBLE)))) END AS p FROM tests
), walked AS (
  SELECT *, sum((p > {LEVEL}::DOUBLE / family)::INT)
            OVER (PARTITION BY stratum, rule ORDER BY step) AS failures FROM tails
), chosen AS (SELECT stratum, {_CHOSEN} FROM walked WHERE failures = 0 GROUP BY stratum)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR {_REJECTED}) AS kept
FROM judged LEFT JOIN chosen USING (stratum)
"""
