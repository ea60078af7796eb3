"""Repositories -> pages -> work items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pullgrid.functions.decode import (
    MALFORMED,
    REQUIRED_NULL,
    decode_permissive,
    decode_strict,
    is_whole,
)
from pullgrid.functions.keys import MAX_PAGE_SIZE, cache_key, repo_error, version_date
from pullgrid.functions.schema import LISTING_SCHEMA
from pullgrid.operators.fetch import bodies_or_fail, fetch, mirror_table
from pullgrid.operators.ranking import newest_per_key, top_per_group
from pullgrid.sources.transport import is_mirror

NOT_ARRAY = "NOT_ARRAY"


def page_plan(
    repos: DataFrame, max_page_size: int = MAX_PAGE_SIZE, batch: str = "batch"
) -> DataFrame:
    """(full_name, batch) -> one row per listing request.

    ``per_page`` is the same on every page of a repository, so pages never
    overlap; ``rows_wanted`` says how many rows of the page belong to the batch.
    """
    if max_page_size <= 0:
        raise ValueError(f"a page of {max_page_size} rows holds nothing")
    size = F.col(batch)
    message = F.concat(F.lit("no repository has a batch of "), F.coalesce(size.cast("string"), F.lit("null")))
    checked = F.when(size > 0, size).otherwise(F.raise_error(message).cast("long"))
    name_error = repo_error(F.col("full_name"))
    named = F.when(name_error.isNull(), F.col("full_name")).otherwise(
        F.raise_error(F.concat(F.lit("Invalid repository: "), name_error))
    )
    wanted = F.col("__n") - (F.col("page") - 1) * max_page_size
    return (
        repos.select(named.alias("full_name"), checked.cast("long").alias("__n"))
        .withColumn(
            "page",
            F.explode(F.sequence(F.lit(1), F.ceil(F.col("__n") / max_page_size).cast("int"))),
        )
        .select(
            "full_name",
            "page",
            F.least(F.col("__n"), F.lit(max_page_size)).cast("int").alias("per_page"),
            F.least(wanted, F.lit(max_page_size)).cast("int").alias("rows_wanted"),
        )
    )


def list_pages(
    plan: DataFrame,
    endpoint: str,
    token: str | None = None,
    retries: int = 2,
    parallelism: int | None = None,
) -> DataFrame:
    """Send every planned listing request: adds ``status``, ``attempts`` and ``body``."""
    if not is_mirror(endpoint):
        query = F.format_string("/pulls?per_page=%d&page=%d", F.col("per_page"), F.col("page"))
        base = F.lit(f"{endpoint.rstrip('/')}/repos/")
        asked = plan.withColumn("url", F.concat(base, "full_name", query))
        return fetch(asked, endpoint, token, retries, parallelism).drop("url")
    stored = mirror_table(plan.sparkSession, endpoint, "pages").select(
        F.concat_ws("/", "owner", "repo").alias("full_name"),
        "page",
        F.col("status").alias("__status"),
        F.col("body").alias("__body"),
    )
    # past the last page the answer is an empty list; without a first page there is no repository
    empty = F.when(F.col("page") == 1, F.lit(404)).otherwise(F.lit(200))
    # a shuffle on (repository, page) spreads the decoding that follows; pages stream past the
    # plan's rows, unsorted
    return plan.hint("shuffle_hash").join(stored, ["full_name", "page"], "left").select(
        *plan.columns,
        F.coalesce("__status", empty).alias("status"),
        F.lit(1).alias("attempts"),
        F.coalesce("__body", F.lit("[]")).alias("body"),
    )


def _elements(pages: DataFrame, strict: bool) -> DataFrame:
    """(full_name, page, per_page, rows_wanted, body) -> one JSON text per listed element."""
    whole = F.when(F.expr(is_whole("body")), F.col("body"))
    elements = F.try_variant_get(F.try_parse_json(whole), "$", "array<variant>")
    keep = ["full_name", "page", "per_page", "rows_wanted"]
    parsed = pages.select(*keep, F.inline(F.array(F.struct(elements.alias("__items")))))
    if strict:
        where = F.concat(F.lit(" in page "), F.col("page"), F.lit(" of "), F.col("full_name"))
        failed = F.raise_error(F.concat(F.lit(f"Invalid listing: {NOT_ARRAY}"), where))
        items = F.when(F.col("__items").isNotNull(), F.col("__items")).otherwise(
            failed.cast("array<variant>")
        )
    else:
        items = F.coalesce(F.col("__items"), F.array(F.lit(None).cast("variant")))
    exploded = parsed.select(*keep, F.posexplode(items).alias("__pos", "__item"))
    # rows past the batch are neither decoded nor checked
    return exploded.where(F.col("__pos") < F.col("rows_wanted")).select(
        "full_name",
        "page",
        ((F.col("page") - 1) * F.col("per_page") + F.col("__pos") + 1).cast("long").alias("rank"),
        F.to_json("__item").alias("__text"),
    )


def _dates_missing(updated_at: Column, created_at: Column) -> Column:
    return updated_at.isNull() & created_at.isNull()


def decode_listing(pages: DataFrame) -> DataFrame:
    """Listing answers -> work items; one bad status, page or element fails the job."""
    rows = decode_strict(
        _elements(bodies_or_fail(pages), strict=True), "__text", LISTING_SCHEMA, ["full_name", "rank"]
    )
    missing = _dates_missing(F.col("updated_at"), F.col("created_at"))
    dated = F.when(
        missing, F.raise_error(F.lit(f"Invalid body: {REQUIRED_NULL} created_at"))
    ).otherwise(version_date(F.col("updated_at"), F.col("created_at")))
    return work_items(rows, dated)


def reject_listing(pages: DataFrame) -> DataFrame:
    """The listing elements ``decode_listing`` would fail on: (full_name, page, rank, rule, field)."""
    looked = decode_permissive(
        _elements(pages, strict=False), "__text", LISTING_SCHEMA, ["full_name", "page", "rank"]
    )
    undated = F.array(
        F.struct(F.lit(REQUIRED_NULL).alias("rule"), F.lit("created_at").alias("field"))
    )
    missing = _dates_missing(F.col("row.updated_at"), F.col("row.created_at"))
    problems = F.when(F.col("row").isNotNull() & missing, undated).otherwise(F.col("violations"))
    found = looked.select("full_name", "page", "rank", F.inline(problems))
    # a page that is no array has one element without text
    rule = F.when(F.col("rule") == MALFORMED, F.lit(NOT_ARRAY)).otherwise(F.col("rule"))
    return found.withColumn("rule", rule)


def work_items(listing: DataFrame, version: Column | None = None) -> DataFrame:
    """Add the version date and the cache key to listed rows."""
    if version is None:
        version = version_date(F.col("updated_at"), F.col("created_at"))
    return listing.withColumn("version", version).withColumn(
        "cache_key", cache_key(F.col("id"), F.col("version"))
    )


def newest_version() -> list[Column]:
    """Sort order of versions by the instant they name; offsets may differ."""
    return [F.try_to_timestamp("version").desc(), F.desc("version")]


def list_top_batch(listing: DataFrame, batch: int) -> DataFrame:
    """The newest ``batch`` rows of every repository, ranked newest first."""
    order = [F.desc("created_at"), F.desc("id")]
    return top_per_group(listing, ["full_name"], order, batch, salt_on=["id"])


def dedup_listing(listing: DataFrame) -> DataFrame:
    """One row per (id, number), the newest version, from overlapping pages."""
    return newest_per_key(listing, ["id", "number"], newest_version())
