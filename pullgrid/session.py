"""Data source registration, and the table and view on top of it."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from pullgrid.folders import shared_dir
from pullgrid.functions.decode import decode_strict
from pullgrid.functions.schema import PULL_REQUEST_SCHEMA
from pullgrid.shipping import ship_package
from pullgrid.sources.pull_requests import PUSHDOWN, PullRequestBodySource


def register(spark: SparkSession) -> None:
    """Make ``format("pull_requests")`` and ``USING pull_requests`` available, and bodies alone."""
    ship_package(spark)
    pushdown = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false") == "true"
    # workers have no session, so its defaults travel with the class
    attributes = {"default_partitions": spark.sparkContext.defaultParallelism}
    if spark.conf.get("spark.checkpoint.dir", None):
        attributes["default_cache_dir"] = f"{shared_dir(spark)}/pull-requests-cache"
    elif not spark.sparkContext.master.startswith("local"):
        # executors share no folder of their own: the option must name one
        attributes["default_cache_dir"] = None
    # the process that plans a stream does not see shipped files, so the source
    # travels by value
    package = sys.modules[__package__]
    cloudpickle.register_pickle_by_value(package)
    try:
        for base, reader in PUSHDOWN.items():
            own = attributes | ({"reader_class": reader} if pushdown else {})
            spark.dataSource.register(type(f"Session{base.__name__}", (base,), own))
    finally:
        cloudpickle.unregister_pickle_by_value(package)


def pull_requests(spark: SparkSession, **options) -> DataFrame:
    """The table of pull requests, decoded by Spark: the source hands over text only.

    The options of ``format("pull_requests")``. Columns that are not read are not built.
    """
    register(spark)
    bodies = spark.read.format(PullRequestBodySource.name()).options(**options).load()
    # tasks that list and fetch are few; decoding takes what they return as it comes
    return decode_strict(bodies.select("body"), "body", PULL_REQUEST_SCHEMA)


def create_view(spark: SparkSession, name: str, **options) -> None:
    """A temporary SQL view of ``pull_requests``."""
    pull_requests(spark, **options).createOrReplaceTempView(name)
