"""Version dates, cache keys, request URLs and name checks as expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the request contract.
MAX_PAGE_SIZE = 100
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def version_date(updated_at: Column, created_at: Column) -> Column:
    """A pull request that was never updated is versioned by its creation date."""
    return F.coalesce(updated_at, created_at)


def cache_key(id: Column, version: Column) -> Column:
    return F.concat(F.lit("pr-"), id, F.lit("-"), F.translate(version, ": ", "=="), F.lit(".cache"))


def repo_error(full_name: Column) -> Column:
    """Why ``owner/name`` cannot be requested, or null."""
    parts = F.split(full_name, "/", -1)
    return (
        F.when(full_name.isNull() | (F.size(parts) < 2), F.lit("repository is not owner/name"))
        .when(F.size(parts) > 2, F.lit("name contains '/' which alters the URL"))
        .when(
            (F.trim(F.get(parts, F.lit(0))) == "") | (F.trim(F.get(parts, F.lit(1))) == ""),
            F.lit("owner or name is empty"),
        )
    )


def pull_url(base: str, full_name: Column, number: Column) -> Column:
    return F.concat(F.lit(f"{base}/repos/"), full_name, F.lit("/pulls/"), number)
