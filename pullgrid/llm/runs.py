"""Places of rows in runs that may be long, on a table range-partitioned over many tasks.

A run is the rows that agree in some columns of numbers. The table is sorted by run and
order over all partitions, so a run is a stretch of it, and a long one covers many
partitions. Each partition counts along its own rows; what a partition's first run
already has in earlier ones is summed from one row per partition. Nothing gathers a run.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pullgrid.llm.common import partitions, written

TIE, PART = "__tie", "__part"


def in_ranges(rows: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Rows sorted by the keys over all partitions; any number of equal rows spreads too."""
    marked = rows.withColumn(TIE, F.monotonically_increasing_id())
    ranged = marked.repartitionByRange(partitions(rows.sparkSession), *keys, TIE)
    return ranged.sortWithinPartitions(*keys, TIE).drop(TIE)


def run_starts(columns: Sequence[np.ndarray], before: tuple | None) -> np.ndarray:
    """Whether each row begins a run; ``before``: the run's columns in the row ahead."""
    new = np.zeros(len(columns[0]), bool)
    for values in columns:
        new[1:] |= values[1:] != values[:-1]
    new[0] = before is None or tuple(int(c[0]) for c in columns) != before
    return new


def _count_along(run: Sequence[str], lead: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, seen, first = TaskContext.get().partitionId(), None, 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [batch.column(c).to_numpy(zero_copy_only=False) for c in run]
            values = batch.column(lead).to_numpy(zero_copy_only=False)
            new = run_starts(keys, before)
            at = np.arange(batch.num_rows)
            start = np.maximum.accumulate(np.where(new, at, -1))
            place = np.where(start < 0, at + seen, at - start)
            leads = np.where(start < 0, first, values[np.maximum(start, 0)])
            before = tuple(int(k[-1]) for k in keys)
            seen, first = int(place[-1]) + 1, int(leads[-1])
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(np.full(batch.num_rows, part, np.int32)),
                    pa.array(place.astype(np.int64)),
                    pa.array(leads.astype(np.int64)),
                ],
                [*batch.schema.names, PART, "at", "lead"],
            )

    return count


def placed_in_runs(
    rows: DataFrame, run: Sequence[str], order: Sequence[str], lead: str, name: str
) -> DataFrame:
    """The rows plus ``at``, the place in the run from 0, and ``lead``, a column of its first row.

    Columns of ``run`` and ``lead`` are numbers without nulls; ``lead`` does not fall along a run.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    counted = in_ranges(rows, [*run, *order]).mapInArrow(
        _count_along(run, lead), f"{schema}, {PART} int, at long, lead long"
    )
    local = written(counted, name)
    # the last run of a partition goes on in the next; one row per partition each
    last = F.max(F.struct(*run, (F.col("at") + 1).alias("n"), "lead")).alias("last")
    tails = local.groupBy(PART).agg(last).select(PART, "last.*", F.lit(1).alias("kind"))
    head = F.min(F.struct(*run)).alias("head")
    heads = local.groupBy(PART).agg(head).select(
        PART, "head.*", F.lit(0).alias("n"), F.lit(None).cast("long").alias("lead"), F.lit(0).alias("kind")
    )
    ahead = Window.partitionBy(*run).orderBy(PART, "kind").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        heads.unionByName(tails)
        .select(*run, PART, "kind", F.sum("n").over(ahead).alias("ahead"), F.min("lead").over(ahead).alias("led"))
        .where("kind = 0 AND ahead > 0")
        .drop("kind")
    )
    met = local.join(F.broadcast(carried), [*run, PART], "left")
    return met.select(
        *rows.columns,
        (F.col("at") + F.coalesce("ahead", F.lit(0))).alias("at"),
        F.coalesce("led", "lead").alias("lead"),
    )
