"""Chat formatting: roles of transcript lines by a hidden Markov model.

A transcript's lines emit a speaker mark, a length class and whether they ask. Hidden
states are a role and whether the line begins a turn. The model is counted from a
bounded sample of labelled conversations. Lines are dealt to tasks by ranges of their
order and cut there into segments of ``SEGMENT`` lines, so a transcript of any length
spreads over tasks, whatever its ids and turn numbers. Each segment becomes the best
score from any state before it to any state at its end (a max-plus matrix), a pass over
the matrices of a transcript settles the states at the segments' edges, and every
segment then finds its own path between them. The path is the best one of the whole
transcript. Turns are numbered by a running sum over segments and rendered canonically.

Defined results. Null or empty text: one empty line. Null ``conv_id``: one transcript of
its own. Null turns come first. Repeated rows: repeated lines, ordered by text. Unknown
or null roles are not trained on. No rows: no rows; no labelled rows: a model in which
only speaker marks count. Other columns are ignored.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pullgrid.llm.common import partitions, table, written
from pullgrid.shipping import ship_package

ROLES = ("system", "user", "assistant")
STATES = 2 * len(ROLES)  # 2r: role r begins a turn; 2r + 1: it goes on
SEGMENT = 64  # lines at most
SEGMENT_CHARS = 1_000_000  # no further line once a segment has so many
TRAIN_CONVERSATIONS = 20_000

# words before a colon or bracket that name a speaker
SPEAKERS = {
    "system": "system|instructions?",
    "user": "user|human|question|q|me|customer",
    "assistant": "assistant|ai|bot|answer|a|model|agent",
}
MARKS = ("none", "quote", *ROLES)
SYMBOLS = len(MARKS) * 3 * 2


def _mark_pattern(words: str) -> str:
    return rf"(?i)^\s*(?:#+ *|\*\*|\[|<\|?)?(?:{words})(?:\*\*|\]|\|?>)? *(?::(?:\*\*)?|(?<=[\]>*])) *"


def symbol(line: Column) -> Column:
    """What a line emits: mark, length class, whether it ends in a question mark."""
    mark = F.when(line.rlike(r"^\s*>"), 1)
    for n, role in enumerate(ROLES):
        mark = mark.when(line.rlike(_mark_pattern(SPEAKERS[role])), n + 2)
    mark = mark.otherwise(0)
    length = F.when(F.char_length(line) < 60, 0).when(F.char_length(line) < 240, 1).otherwise(2)
    asks = F.when(line.rlike(r"\?\s*$"), 1).otherwise(0)
    return ((mark * 3 + length) * 2 + asks).cast("int")


def unmarked(line: Column) -> Column:
    words = "|".join(SPEAKERS.values())
    return F.regexp_replace(F.regexp_replace(line, r"^\s*> ?", ""), _mark_pattern(words), "")


# ---- the model --------------------------------------------------------------------------


def train(labelled: DataFrame, n_conversations: int = TRAIN_CONVERSATIONS) -> dict:
    """Log probabilities of starts, steps and symbols, from about ``n_conversations``.

    ``labelled``: (conv_id, turn, tie, pos, line, role); pos 0 begins a turn.
    """
    total = max(1, labelled.select("conv_id").distinct().count())
    share = int(1_000_000 * min(1.0, n_conversations / total))
    sample = labelled.where(
        (F.pmod(F.xxhash64("conv_id"), F.lit(1_000_000)) < share) & F.col("role").isin(*ROLES)
    )
    role = F.array_position(F.array(*map(F.lit, ROLES)), F.col("role")) - 1
    state = (role * 2 + (F.col("pos") > 0).cast("int")).cast("int")
    told = sample.select("conv_id", "turn", "tie", "pos", state.alias("state"), symbol(F.col("line")).alias("symbol"))
    before = F.lag("state", 1, -1).over(
        Window.partitionBy("conv_id").orderBy("turn", "tie", "pos")
    )
    counts = (
        told.withColumn("before", before).groupBy("before", "state", "symbol").count().collect()
    )  # (states + 1) x states x symbols rows at most
    starts, steps = np.zeros(STATES), np.zeros((STATES, STATES))
    emits = np.zeros((STATES, SYMBOLS))
    for row in counts:
        emits[row.state, row.symbol] += row["count"]
        if row.before < 0:
            starts[row.state] += row["count"]
        else:
            steps[row.before, row.state] += row["count"]
    # marks of a role speak for its beginning before anything is counted
    for r in range(len(ROLES)):
        emits[2 * r].reshape(len(MARKS), 6)[2 + r] += 1.0
    allowed = np.zeros((STATES, STATES), bool)
    allowed[:, ::2] = True
    for r in range(len(ROLES)):
        allowed[[2 * r, 2 * r + 1], 2 * r + 1] = True
    begins = np.arange(STATES) % 2 == 0
    with np.errstate(divide="ignore"):
        start = np.where(begins, starts + 0.1, 0)
        step = np.where(allowed, steps + 0.1, 0)
        return {
            "start": np.log(start / start.sum()),
            "step": np.log(step / step.sum(1, keepdims=True)),
            "emit": np.log((emits + 0.1) / (emits + 0.1).sum(1, keepdims=True)),
        }


# ---- Viterbi in segments ---------------------------------------------------------------


def segment_matrix(model: dict, symbols: np.ndarray) -> np.ndarray:
    """Best score from each state before the segment (last row: none before) to each at its end."""
    emit = model["emit"][:, symbols]
    best = np.vstack([model["step"], model["start"]]) + emit[:, 0]
    for k in range(1, len(symbols)):
        best = (best[:, :, None] + model["step"][None]).max(1) + emit[:, k]
    return best


def segment_path(model: dict, symbols: np.ndarray, before: int, last: int) -> np.ndarray:
    """The best states of a segment between the state before it (-1: none) and its last."""
    emit = model["emit"][:, symbols]
    best = (model["start"] if before < 0 else model["step"][before]) + emit[:, 0]
    back = np.zeros((len(symbols), STATES), np.int64)
    for k in range(1, len(symbols)):
        options = best[:, None] + model["step"]
        back[k] = options.argmax(0)
        best = options.max(0) + emit[:, k]
    path = np.empty(len(symbols), np.int64)
    path[-1] = last
    for k in range(len(symbols) - 1, 0, -1):
        path[k - 1] = back[k, path[k]]
    return path


def edges(matrices: Iterable[np.ndarray]) -> list[tuple[int, int]]:
    """(state before, last state) of each segment on the best path through all."""
    best, back = None, bytearray()  # six bytes a segment
    for m in matrices:
        if best is None:
            best = m[STATES]
            continue
        options = best[:, None] + m[:STATES]
        back += options.argmax(0).astype(np.uint8).tobytes()
        best = options.max(0)
    lasts = [int(best.argmax())]
    for at in range(len(back) - STATES, -1, -STATES):
        lasts.append(back[at + lasts[-1]])
    lasts.reverse()
    return list(zip([-1, *lasts[:-1]], lasts, strict=True))


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[object, Iterator[dict]]]:
    rows = (row for batch in batches for row in batch.to_pylist())
    yield from groupby(rows, key=lambda r: r[key])


def _cut(rows: Iterator[dict]) -> Iterator[list[dict]]:
    """Consecutive rows in segments."""
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += len(row["line"])
        if len(held) >= SEGMENT or chars >= SEGMENT_CHARS:
            yield held
            held, chars = [], 0
    if held:
        yield held


def recover_turns(lines: DataFrame, model: dict) -> DataFrame:
    """(conv_id, turn, role, text) of the recovered turns.

    ``lines``: (conv_id, turn, tie, pos, line), where turn, tie and pos only order the lines.
    """
    ship_package(lines.sparkSession)
    n, spark = partitions(lines.sparkSession), lines.sparkSession
    shared = spark.sparkContext.broadcast(model)
    order = ["conv_id", "turn", "tie", "pos"]
    dealt = lines.select(*order, "line").repartitionByRange(n, *order).sortWithinPartitions(*order)
    placed = dealt.select(
        "conv_id", symbol(F.col("line")).alias("symbol"), "line", unmarked(F.col("line")).alias("bare")
    )

    def to_matrix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = TaskContext.get().partitionId() << 32  # ranges are numbered in their order
        for conv, rows in _groups(batches, "conv_id"):
            for cut in _cut(rows):
                symbols = np.array([r["symbol"] for r in cut])
                yield pa.RecordBatch.from_pydict(
                    {
                        "conv_id": pa.array([conv], pa.int64()),
                        "segment": pa.array([segment], pa.int64()),
                        "symbols": pa.array([symbols.tolist()], pa.list_(pa.int32())),
                        "lines": pa.array([[r["line"] for r in cut]], pa.list_(pa.string())),
                        "bare": pa.array([[r["bare"] for r in cut]], pa.list_(pa.string())),
                        "matrix": [segment_matrix(shared.value, symbols).ravel().tolist()],
                    }
                )
                segment += 1

    segments = written(
        placed.mapInArrow(
            to_matrix,
            "conv_id long, segment long, symbols array<int>, lines array<string>, "
            "bare array<string>, matrix array<double>",
        ),
        "segments",
    )

    def to_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for conv, rows in _groups(batches, "conv_id"):
            numbers = array("q")

            def matrices(rows=rows, numbers=numbers) -> Iterator[np.ndarray]:
                for r in rows:
                    numbers.append(r["segment"])
                    yield np.array(r["matrix"]).reshape(STATES + 1, STATES)

            found = edges(matrices())
            yield pa.RecordBatch.from_pydict(
                {
                    "conv": pa.array([conv] * len(numbers), pa.int64()),
                    "seg": pa.array(np.array(numbers), pa.int64()),
                    "before": pa.array([b for b, _ in found], pa.int32()),
                    "last": pa.array([a for _, a in found], pa.int32()),
                }
            )

    settled = (
        segments.select("conv_id", "segment", "matrix")
        .repartition(n, "conv_id")
        .sortWithinPartitions("conv_id", "segment")
        .mapInArrow(to_edges, "conv long, seg long, before int, last int")
    )
    met = segments.drop("matrix").join(
        settled, F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("segment") == F.col("seg"))
    )

    def to_turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {k: [] for k in ("conv_id", "segment", "number", "role", "text")}
            for r in batch.to_pylist():
                path = segment_path(shared.value, np.array(r["symbols"]), r["before"], r["last"])
                numbers = np.cumsum(path % 2 == 0)
                for number in np.unique(numbers).tolist():
                    own = np.flatnonzero(numbers == number).tolist()
                    first = own[0] if path[own[0]] % 2 == 0 else None
                    out["conv_id"].append(r["conv_id"])
                    out["segment"].append(r["segment"])
                    out["number"].append(number)
                    out["role"].append(ROLES[path[own[0]] // 2])
                    out["text"].append(
                        "\n".join((r["bare"] if k == first else r["lines"])[k] for k in own)
                    )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(v, pa.int64() if k in ("conv_id", "segment", "number") else pa.string())
                    for k, v in out.items()
                ],
                list(out),
            )

    parts = written(
        met.select("conv_id", "segment", "symbols", "lines", "bare", "before", "last").mapInArrow(
            to_turns, "conv_id long, segment long, number long, role string, text string"
        ),
        "turns",
    )
    before = Window.partitionBy("c").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (
        parts.groupBy(F.col("conv_id").alias("c"), F.col("segment").alias("s"))
        .agg(F.max("number").alias("n"))
        .select("c", "s", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    )
    whole = parts.join(
        firsts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("segment") == F.col("s"))
    ).withColumn("turn", F.col("first") + F.col("number") - 1)
    pieces = F.array_sort(F.collect_list(F.struct("segment", "text")))
    return whole.groupBy("conv_id", "turn", "role").agg(
        F.array_join(F.transform(pieces, lambda p: p["text"]), "\n").alias("text")
    )


def rendered(role: str, text: str) -> Column:
    """The canonical form of a turn."""
    return F.concat(F.lit("<|"), F.col(role), F.lit("|>\n"), F.trim(F.col(text)), F.lit("\n<|end|>\n"))


# ---- over the conversations table ------------------------------------------------------


def marked_lines(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, tie, pos, line, role): the table as transcripts in mixed styles.

    A conversation's style and the turns that lack their mark follow from hashes.
    """
    role = F.coalesce("role", F.lit("user"))
    style = F.pmod(F.xxhash64("conv_id"), F.lit(5))
    mark = (
        F.when(style == 0, F.concat(F.initcap(role), F.lit(": ")))
        .when(style == 1, F.concat(F.lit("### "), F.initcap(role), F.lit(": ")))
        .when(style == 2, F.concat(F.lit("["), role, F.lit("] ")))
        .when(style == 3, F.concat(F.lit("**"), F.initcap(role), F.lit("**: ")))
        .otherwise(F.when(role == "user", "> ").otherwise(F.concat(F.upper(role), F.lit(": "))))
    )
    lacks = F.pmod(F.xxhash64("conv_id", "turn", F.lit("lacks")), F.lit(12)) == 0
    lines = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.xxhash64("text").alias("tie"),
        "role",
        F.when(lacks, "").otherwise(mark).alias("mark"),
        F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("pos", "own"),
    )
    line = F.when(F.col("pos") == 0, F.concat("mark", "own")).otherwise(F.col("own"))
    return lines.select("conv_id", "turn", "tie", "pos", line.alias("line"), "role")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = marked_lines(table(spark, sf_dir, "conversations"))
    turns = recover_turns(lines.drop("role"), train(lines))
    return turns.select("conv_id", "turn", "role", rendered("role", "text").alias("rendered"))
