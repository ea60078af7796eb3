"""Work items -> response bodies, in tasks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pullgrid.functions.decode import decode_permissive, decode_strict, first_violation
from pullgrid.functions.keys import pull_url, repo_error
from pullgrid.functions.schema import PULL_REQUEST_SCHEMA, plain_schema
from pullgrid.shipping import ship_package
from pullgrid.sources.transport import HttpsEndpoint, is_mirror

_ANSWER = plain_schema(
    status=T.IntegerType(), attempts=T.IntegerType(), body=T.StringType()
)


def is_success(status: Column) -> Column:
    return status.between(200, 299)


def mirror_table(spark, endpoint: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{endpoint.rstrip('/')}/{table}")


def _fetch_mirror(items: DataFrame, endpoint: str, by_version: bool, few: bool) -> DataFrame:
    """One equi-join against the mirror; unmatched items are 404.

    Without a version, an item gets the newest body of its URL, as a request would: which
    one that is is settled on two columns, before any body moves. The items of a partition
    are hashed and the bodies stream past them: a body is shuffled once, never sorted (that
    spills several times its size) and never broadcast. With ``few`` items their keys are
    sent to the bodies, and those that nobody asks for are not shuffled.
    """
    details = mirror_table(items.sparkSession, endpoint, "details")
    if by_version and "version" in items.columns:
        asked = items.withColumn("__at", F.col("version"))
    else:
        urls = items.select(F.col("url").alias("__url")).distinct()
        order = F.struct(F.try_to_timestamp("version"), "version")
        newest = (
            details.select(F.col("url").alias("__url"), "version")
            .join(urls, "__url", "left_semi")
            .groupBy("__url")
            .agg(F.max_by("version", order).alias("__at"))
        )
        asked = items.join(newest, F.col("url") == F.col("__url"), "left").drop("__url")
    found = details.select(
        F.col("url").alias("__url"),
        F.col("version").alias("__held"),
        F.col("status").alias("__status"),
        F.col("body").alias("__body"),
    )
    if few:
        keys = asked.select(F.col("url").alias("__url"), F.col("__at").alias("__held")).distinct()
        found = found.join(F.broadcast(keys), ["__url", "__held"], "left_semi")
    same = (F.col("url") == F.col("__url")) & (F.col("__at") == F.col("__held"))
    return asked.hint("shuffle_hash").join(found, same, "left").select(
        *[F.col(f"`{c}`") for c in items.columns],
        F.coalesce("__status", F.lit(404)).alias("status"),
        F.lit(1).alias("attempts"),
        F.col("__body").alias("body"),
    )


def fetch_placed(items: DataFrame, endpoint: str, width: int) -> DataFrame:
    """``fetch`` by version from a mirror, in ``width`` partitions by id, for rows that are kept by id.

    A body names its pull request, so it is sent to the id's partition before it is known
    who asks: one shuffle brings it to its request and to its place. The id only says
    where to meet; address and version decide, as in ``fetch``. An item whose answer names
    no id, or another one, is not met there: its status is null, and ``fetch`` can tell.
    """
    named = F.expr("try_cast(get_json_object(body, '$.id') AS BIGINT)").alias("__own")
    # behind a generator, so that a body is looked at once
    details = mirror_table(items.sparkSession, endpoint, "details").select(
        F.col("url").alias("__url"),
        F.col("version").alias("__held"),
        F.col("status").alias("__status"),
        F.col("body").alias("__body"),
        F.inline(F.array(F.struct(named))),
    )
    found = details.where("__own IS NOT NULL").repartition(width, "__own")
    asked = items.repartition(width, "id").hint("shuffle_hash")
    # no join keys beside the id, so that both sides stay where they are
    same = F.array_contains(F.array("__url"), F.col("url")) & F.array_contains(F.array("__held"), F.col("version"))
    return asked.join(found, (F.col("id") == F.col("__own")) & same, "left").select(
        *[F.col(f"`{c}`") for c in items.columns],
        F.col("__status").alias("status"),
        F.lit(1).alias("attempts"),
        F.col("__body").alias("body"),
    )


def task_share(budget: int | None, tasks: int, task: int) -> int | None:
    """The requests that one of some tasks may make, of what all together may."""
    if budget is None:
        return None
    return budget // tasks + (1 if task < budget % tasks else 0)


def _fetch_https(
    items: DataFrame,
    endpoint: str,
    token: str | None,
    retries: int,
    parallelism: int,
    budget: int | None,
) -> DataFrame:
    """One request per row, spread evenly so a large repository is no hot task.

    A budget is dealt to the tasks; rows beyond a task's share come back ``UNASKED``.
    """
    ship_package(items.sparkSession)
    spread = items.repartition(parallelism, "url") if budget is None else items.repartition(parallelism)

    def get(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        client = HttpsEndpoint(endpoint, token, retries, task_share(budget, parallelism, task))
        for batch in batches:
            # small steps: a lost task repeats little, and nothing is buffered whole
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                answers = client.get_all(part.column("url").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns,
                        pa.array([a.status for a in answers], pa.int32()),
                        pa.array([a.attempts for a in answers], pa.int32()),
                        pa.array([a.body for a in answers], pa.string()),
                    ],
                    names=[*part.schema.names, "status", "attempts", "body"],
                )

    schema = T.StructType([*spread.schema.fields, *_ANSWER.fields])
    return spread.mapInArrow(get, schema)


def fetch(
    items: DataFrame,
    endpoint: str,
    token: str | None = None,
    retries: int = 2,
    parallelism: int | None = None,
    budget: int | None = None,
    by_version: bool = True,
    few: bool = False,
) -> DataFrame:
    """Add ``status``, ``attempts`` and ``body`` to rows with a ``url``.

    ``budget``: requests that all tasks together may make; a mirror asks nobody.
    ``by_version``: a mirror answers for the ``version`` of a row, where there is one.
    ``few``: there are so few rows that their keys may be sent to all tasks.
    """
    if is_mirror(endpoint):
        return _fetch_mirror(items, endpoint, by_version, few)
    width = parallelism or items.sparkSession.sparkContext.defaultParallelism
    return _fetch_https(items, endpoint, token, retries, width, budget)


def request_failure(status: Column, body: Column) -> Column:
    return F.concat(
        F.lit("Request failed with code "), status, F.lit(": "), F.coalesce(body, F.lit(""))
    )


def bodies_or_fail(responses: DataFrame) -> DataFrame:
    """Gate ``body`` on a 2xx status; the first other status fails the job."""
    failed = F.raise_error(request_failure(F.col("status"), F.col("body")))
    return responses.withColumn(
        "body", F.when(is_success(F.col("status")), F.col("body")).otherwise(failed)
    )


def judged(responses: DataFrame, schema: T.StructType = PULL_REQUEST_SCHEMA) -> DataFrame:
    """Responses plus ``outcome`` ('ok' or 'failed'), ``reason``, and the decoded ``row``."""
    keep = responses.columns
    looked = decode_permissive(responses, "body", schema, keep)
    got = is_success(F.col("status"))
    reason = F.when(~got, F.concat(F.lit("HTTP_"), F.col("status"))).when(
        F.size("violations") > 0, F.expr(first_violation("violations"))
    )
    return looked.select(
        *[F.col(f"`{c}`") for c in keep],
        F.when(reason.isNull(), F.lit("ok")).otherwise(F.lit("failed")).alias("outcome"),
        reason.alias("reason"),
        F.when(reason.isNull(), F.col("row")).alias("row"),
    )


def point_lookup(
    keys: DataFrame,
    endpoint: str,
    base: str,
    token: str | None = None,
    retries: int = 2,
) -> DataFrame:
    """(full_name, number) -> status and decoded row; an unknown key has status 404."""
    bad_number = F.concat(F.lit("Negative pull request number "), F.col("number"))
    error = F.coalesce(
        repo_error(F.col("full_name")), F.when(F.col("number") < 0, bad_number)
    )
    url = F.when(error.isNull(), pull_url(base, F.col("full_name"), F.col("number"))).otherwise(
        F.raise_error(F.concat(F.lit("Invalid key: "), error))
    )
    asked = keys.select("full_name", "number", url.alias("url"))
    return judged(fetch(asked, endpoint, token, retries))


def decode_responses(
    responses: DataFrame, keep: list[str], schema: T.StructType = PULL_REQUEST_SCHEMA
) -> DataFrame:
    """Typed rows of all responses; a failed request or a bad body fails the job."""
    return decode_strict(bodies_or_fail(responses), "body", schema, keep)
