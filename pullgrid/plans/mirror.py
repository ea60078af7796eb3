"""An offline mirror of a code host, derived by Spark from the driver's tables.

One pull request per order, one repository per nation. The mirror stands in for
the host's API so that every operator can run, and be checked, without network.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pullgrid.functions.keys import MAX_PAGE_SIZE, cache_key, pull_url, version_date
from pullgrid.operators.cache import write_cache
from pullgrid.operators.ranking import rank_in_group
from pullgrid.folders import PACKED, scratch_dir
from pullgrid.shipping import ship_package
from pullgrid.sources.storage import open_dir
from pullgrid.streaming.log import record_tick

HOST = "https://api.example.test"
FIRST_ID = 2147480000
TICKS = 4
ROWS_PER_FILE = 30_000
FACTS = [
    "k", "owner", "repo", "n_nationkey", "o_orderdate", "o_orderstatus", "o_orderpriority", "c_name", "c_custkey"
]
PAGED = ["k", "owner", "repo", "o_orderdate"]
COUNTS = ["commits", "additions", "deletions", "changed_files", "comments"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def iso(stamp: Column) -> Column:
    """Zone-free timestamp -> text in UTC, whatever the session time zone."""
    return F.concat(F.translate(stamp.cast("string"), " ", "T"), F.lit("Z"))


def repos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(full_name, batch) of every repository, with the keys it is made from."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    owner = F.translate("r_name", " ", "-")
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        "n_nationkey",
        owner.alias("owner"),
        F.col("n_name").alias("repo"),
        F.concat(owner, F.lit("/"), F.col("n_name")).alias("full_name"),
        (1 + (F.col("n_nationkey") * 41) % 1000).alias("batch"),
    )


def _facts_with(orders: DataFrame, spark: SparkSession, sf_dir: str, more: list[str]) -> DataFrame:
    """The few columns that names and texts are made of, for rows of ``orders``, and ``more`` of its own."""
    customer = table(spark, sf_dir, "customer")
    return (
        orders.join(customer, orders["o_custkey"] == customer["c_custkey"])
        .join(repos(spark, sf_dir).drop("batch", "full_name"), F.col("c_nationkey") == F.col("n_nationkey"))
        .withColumn("k", F.col("o_orderkey"))
        .select(*FACTS, *more)
    )


def _named(rows: DataFrame) -> DataFrame:
    """Rows of facts with what can be said of them: names, addresses, dates as text."""
    k = F.col("k")
    updated = F.when(
        k % 7 != 0, F.col("o_orderdate") + F.make_dt_interval((k % 90).cast("int"))
    )
    number = (k + 1).cast("int")
    full_name = F.concat("owner", F.lit("/"), "repo")
    version_ts = version_date(updated, F.col("o_orderdate"))
    names = {
        "id": FIRST_ID + k,
        "number": number,
        "full_name": full_name,
        "url": pull_url(HOST, full_name, number),
        "created_at": iso(F.col("o_orderdate")),
        "updated_at": iso(updated),
        "version_ts": version_ts,
        "version": iso(version_ts),
    }
    # those that rows were sorted by are there already
    return rows.select("*", *[made.alias(name) for name, made in names.items() if name not in rows.columns])


def identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a listing knows of every pull request (no line items are read)."""
    return _named(_facts_with(table(spark, sf_dir, "orders"), spark, sf_dir, []))


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identities(spark, sf_dir).select(
        "k", "full_name", "id", "number", "url", "updated_at", "created_at", "version"
    )


def ranked_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listing with its newest-first rank in each repository."""
    return rank_in_group(
        listing(spark, sf_dir),
        ["full_name"],
        F.col("created_at"),
        [F.desc("created_at"), F.desc("id")],
    )


def _first_of(column: str) -> Column:
    """1 where an order's line is the first of its value: one sort of lines that are together."""
    before = F.lag(column).over(Window.partitionBy("l_orderkey").orderBy(column))
    return (F.col(column).isNotNull() & ~F.col(column).eqNullSafe(before)).cast("int")


def _counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of every pull request, and the counts of its line items."""
    returned = F.when(F.col("l_returnflag") == "R", F.col("l_quantity"))
    # moved once by order, and never multiplied: distinct counts would do both
    stats = (
        table(spark, sf_dir, "lineitem")
        .select("l_orderkey", "l_quantity", returned.alias("returned"), "l_partkey", "l_suppkey")
        .repartition("l_orderkey")
        .withColumn("new_part", _first_of("l_partkey"))
        .withColumn("new_supplier", _first_of("l_suppkey"))
        .groupBy(F.col("l_orderkey").alias("__k"))
        .agg(
            F.count(F.lit(1)).alias("commits"),
            F.sum("l_quantity").alias("additions"),
            F.sum("returned").alias("deletions"),
            F.sum("new_part").alias("changed_files"),
            F.sum("new_supplier").alias("comments"),
        )
    )
    whole = [F.coalesce(name, F.lit(0)).cast("int").alias(name) for name in COUNTS]
    orders = table(spark, sf_dir, "orders")
    met = orders.join(stats, F.col("o_orderkey") == F.col("__k"), "left").drop("__k")
    return _facts_with(met, spark, sf_dir, COUNTS).select(*FACTS, *whole)


def pulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All fields of every pull request."""
    return _named(_counted(spark, sf_dir))


def pull_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts and counts, joined once for all mirrors. They lie by repository, in files so small
    that a task which makes bodies of some of them sorts their rows in memory."""

    def build(root: str) -> None:
        rows = _counted(spark, sf_dir).hint("rebalance", "owner", "repo")
        placed = rows.sortWithinPartitions("owner", "repo", "k")
        placed.write.options(**PACKED, maxRecordsPerFile=ROWS_PER_FILE).parquet(root)

    return spark.read.parquet(_once(spark, sf_dir, "pulls", build))


def body_json(k: Column, updated_at: Column) -> Column:
    """The detail body of a pull request; nulls are kept as JSON nulls."""
    closed = F.col("o_orderstatus") == "F"
    merged = closed & (k % 2 == 0)
    closed_at = iso(F.col("o_orderdate") + F.make_dt_interval(F.lit(30)))
    repo_url = F.concat(F.lit(f"{HOST}/repos/"), F.col("full_name"))
    user_url = F.concat(F.lit(f"{HOST}/users/"), F.col("c_custkey"))
    html = F.lit(".html")
    return F.to_json(
        F.struct(
            "id",
            "url",
            F.concat("url", html).alias("html_url"),
            F.concat("url", F.lit(".diff")).alias("diff_url"),
            F.concat("url", F.lit(".patch")).alias("patch_url"),
            "number",
            F.when(closed, F.lit("closed")).otherwise(F.lit("open")).alias("state"),
            F.col("o_orderpriority").alias("title"),
            F.when(k % 10 != 0, F.concat(F.lit("order "), k)).alias("body"),
            "created_at",
            updated_at.alias("updated_at"),
            F.when(closed, closed_at).alias("closed_at"),
            F.when(merged, closed_at).alias("merged_at"),
            F.struct(
                F.lit("master").alias("ref"),
                F.md5(k.cast("string")).alias("sha"),
                F.struct(
                    F.col("n_nationkey").alias("id"),
                    F.col("repo").alias("name"),
                    "full_name",
                    F.lit(None).cast("string").alias("description"),
                    (F.col("n_nationkey") % 2 == 1).alias("private"),
                    repo_url.alias("url"),
                    F.concat(repo_url, html).alias("html_url"),
                ).alias("repo"),
            ).alias("base"),
            F.struct(
                F.col("c_name").alias("login"),
                F.col("c_custkey").alias("id"),
                user_url.alias("url"),
                F.concat(user_url, html).alias("html_url"),
            ).alias("user"),
            merged.alias("merged"),
            F.when(k % 3 != 0, k % 2 == 0).alias("mergeable"),
            "comments",
            "commits",
            "additions",
            "deletions",
            "changed_files",
        ),
        {"ignoreNullFields": "false"},
    )


def answers_of(rows: DataFrame) -> DataFrame:
    """The answers for rows of ``pulls``."""
    return rows.select(
        "owner",
        "repo",
        "k",
        "id",
        "url",
        "version",
        F.lit(200).alias("status"),
        body_json(F.col("k"), F.col("updated_at")).alias("body"),
    )


def details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the host answers for every pull request URL."""
    return answers_of(pulls(spark, sf_dir))


def faulty_answers_of(rows: DataFrame) -> DataFrame:
    """The same answers with one mutation by ``k % 11``."""
    body, case = F.col("body"), F.col("k") % 11

    def swap(pattern: str, text: str) -> Column:
        return F.regexp_replace(body, pattern, text)

    broken = (
        F.when(case == 0, swap(r'"commits":[0-9]+,', ""))
        .when(case == 1, swap(r'"merged":(true|false)', '"merged":null'))
        .when(case == 2, swap(r'"title":"[^"]*"', '"title":5'))
        .when(case == 3, swap(r'"additions":[0-9]+', '"additions":"12"'))
        .when(case == 4, swap(r'"additions":[0-9]+', '"additions":4294967297'))
        .when(
            case == 5, swap(r'"created_at":"[^"]*"', '"created_at":"2016-10-19T12:30:51.123Z"')
        )
        .when(case == 6, swap(r'"user":\{[^}]*\}', '"user":null'))
        .when(case == 7, F.substring(body, 1, 20))
        .when(case == 8, F.lit('{"message":"Not Found"}'))
        .when(case == 9, F.lit("[]"))
        .otherwise(body)
    )
    status = F.when(case == 8, 404).otherwise(200)
    return answers_of(rows).withColumns({"status": status, "body": broken})


def faulty_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return faulty_answers_of(pulls(spark, sf_dir))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing pages of 100, newest first, as JSON arrays."""
    element = F.struct("rank", "id", "number", "url", "updated_at", "created_at")
    page = F.ceil(F.col("rank") / MAX_PAGE_SIZE).cast("int").alias("page")
    # at most 100 elements in each group, whose texts are made where they are gathered
    grouped = (
        _named(_ranked(spark, sf_dir, PAGED).select("*", page).repartition("owner", "repo", "page"))
        .groupBy("owner", "repo", "page")
        .agg(F.array_sort(F.collect_list(element)).alias("items"))
    )
    body = F.to_json(
        F.transform("items", lambda x: x.dropFields("rank")), {"ignoreNullFields": "false"}
    )
    return grouped.select("owner", "repo", "page", F.lit(200).alias("status"), body.alias("body"))


def _ranked(spark: SparkSession, sf_dir: str, columns: list[str]) -> DataFrame:
    """Columns of the facts with the newest-first rank of ``ranked_listing``."""
    # joined already if there is a mirror with bodies
    held = _BUILT.get((spark.sparkContext.applicationId, sf_dir, "pulls"))
    facts = spark.read.parquet(held) if held else _facts_with(table(spark, sf_dir, "orders"), spark, sf_dir, [])
    dated = facts.select(*columns, iso(F.col("o_orderdate")).alias("created_at"))
    order = [F.desc("created_at"), F.desc("k")]
    return rank_in_group(dated, ["owner", "repo"], F.col("created_at"), order).drop("created_at")


def _at_ticks(ids: DataFrame) -> DataFrame:
    """Rows of ``identities`` at every tick 1..4, under the version they then have."""
    steps = F.explode(F.sequence(F.lit(1), F.lit(TICKS))).alias("tick")
    late = F.col("k") % 4
    shift = F.when(F.col("tick") - 1 >= late, late).otherwise(F.lit(0)).cast("int")
    moved = F.when(shift > 0, iso(F.col("version_ts") + F.make_dt_interval(shift)))
    return ids.select("*", steps).withColumn("shift", shift).withColumn(
        "updated_at", F.coalesce(moved, F.col("updated_at"))
    ).withColumn("version", version_date(F.col("updated_at"), F.col("created_at")))


def tick_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pull request at every tick 1..4, under the version it then has."""
    return _at_ticks(identities(spark, sf_dir))


def _shifts(last_only: bool) -> Column:
    """The versions of a pull request that are listed at some tick, or the last one."""
    late = (F.col("k") % 4).cast("int")
    # version 0, and the late one unless it is the same
    held = F.array(late) if last_only else F.array_distinct(F.array(F.lit(0), late))
    return F.explode(held).alias("shift")


def _shifted(rows: DataFrame) -> DataFrame:
    """Rows of ``pulls`` with a ``shift``, under the version that it makes."""
    moved = F.when(
        F.col("shift") > 0, iso(F.col("version_ts") + F.make_dt_interval(F.col("shift")))
    )
    at = rows.withColumn("updated_at", F.coalesce(moved, F.col("updated_at")))
    return at.withColumn("version", version_date(F.col("updated_at"), F.col("created_at")))


def tick_pulls(spark: SparkSession, sf_dir: str, last_only: bool = False) -> DataFrame:
    """``pulls`` under every version that is listed at some tick, or under the last one."""
    return _shifted(pulls(spark, sf_dir).select("*", _shifts(last_only)))


def tick_answers_of(rows: DataFrame) -> DataFrame:
    return answers_of(rows).drop("k", "id")


def tick_details(spark: SparkSession, sf_dir: str, last_only: bool = False) -> DataFrame:
    """What the host answers for those versions."""
    return tick_answers_of(tick_pulls(spark, sf_dir, last_only))


def ranked_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a listing is made of with its newest-first rank, ranked once for all ticks. The rows
    lie by repository and rank."""

    def build(root: str) -> None:
        rows = _ranked(spark, sf_dir, PAGED).hint("rebalance", "owner", "repo")
        rows.sortWithinPartitions("owner", "repo", "rank").write.options(**PACKED).parquet(root)

    return _named(spark.read.parquet(_once(spark, sf_dir, "ranked", build)))


def listed_at(spark: SparkSession, sf_dir: str, tick: int) -> DataFrame:
    """The whole listing at a tick, ranked."""
    return _at_ticks(ranked_identities(spark, sf_dir)).where(F.col("tick") == tick)


def torn_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, body) with what parsers pass over: text behind the document, and repeated keys."""
    body, case = F.col("body"), F.col("k") % 5
    torn = (
        F.when(case == 0, F.concat(body, F.lit(" junk")))
        .when(case == 1, F.concat(body, F.lit(","), body))
        .when(case == 2, F.replace(body, F.lit('"ref":'), F.lit('"ref":"other","ref":')))
        .when(case == 3, F.replace(body, F.lit('"number":'), F.lit('"number":0,"number":')))
        .otherwise(F.concat(F.lit("\n "), body, F.lit("\t\n")))
    )
    return details(spark, sf_dir).select("id", torn.alias("body"))


def faulty_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing answers with one fault per element by ``k % 7``; second pages are no arrays."""
    case = F.col("k") % 7
    number = F.when(case != 0, F.col("number"))
    fields = [
        ("id", F.when(case == 1, F.concat(F.lit('"'), "id", F.lit('"'))).otherwise(F.col("id").cast("string"))),
        ("number", F.when(case == 2, F.lit("4294967297")).otherwise(number.cast("string"))),
        ("url", F.when(case == 3, F.lit("null")).otherwise(F.to_json(F.struct("url")).substr(F.lit(8), F.length("url") + 2))),
        *[
            (c, F.when((case == 4) | F.col(c).isNull(), F.lit("null")).otherwise(F.concat(F.lit('"'), c, F.lit('"'))))
            for c in ("created_at", "updated_at")
        ],
    ]
    # a missing value leaves its key out
    members = [F.concat(F.lit(f'"{name}":'), value) for name, value in fields]
    element = F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))
    page = F.ceil(F.col("rank") / MAX_PAGE_SIZE).cast("int")
    grouped = (
        ranked_listing(spark, sf_dir)
        .groupBy("full_name", page.alias("page"))
        .agg(F.array_sort(F.collect_list(F.struct("rank", element.alias("text")))).alias("items"))
    )
    array = F.concat(F.lit("["), F.array_join(F.transform("items", lambda x: x["text"]), ","), F.lit("]"))
    return grouped.select(
        "full_name",
        "page",
        F.lit(MAX_PAGE_SIZE).alias("per_page"),
        F.lit(MAX_PAGE_SIZE).alias("rows_wanted"),
        F.when(F.col("page") == 2, F.lit('{"message":"busy"}')).otherwise(array).alias("body"),
    )


def entry_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(name, body) of one text entry per supplier, as older caches kept them."""
    k, day = F.col("s_suppkey"), F.make_dt_interval((F.col("s_suppkey") % 400).cast("int"))
    start = F.lit("2016-01-01 00:00:00").cast("timestamp_ntz")
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    places = nation.join(region, nation["n_regionkey"] == region["r_regionkey"])
    number = (k + 1).cast("int")
    rows = (
        table(spark, sf_dir, "supplier")
        .join(places, F.col("s_nationkey") == F.col("n_nationkey"))
        .withColumns(
            {
                "k": k,
                "id": FIRST_ID + k,
                "number": number,
                "full_name": F.concat(F.translate("r_name", " ", "-"), F.lit("/"), "n_name"),
                "repo": F.col("n_name"),
                "o_orderdate": start + day,
                "o_orderstatus": F.lit("F"),
                "o_orderpriority": F.col("s_name"),
                "c_name": F.col("s_name"),
                "c_custkey": k,
                "created_at": iso(start + day),
            }
        )
        .withColumn("url", pull_url(HOST, F.col("full_name"), number))
        .withColumns({c: F.lit(1) for c in ("comments", "commits", "additions", "deletions", "changed_files")})
    )
    body = body_json(k, F.lit(None).cast("string"))
    return rows.select(cache_key(F.col("id"), F.col("created_at")).alias("name"), body.alias("body"))


def prior_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cache rows: a third current, a third one day stale, a third absent."""
    return prior_answers_of(prior_pulls(spark, sf_dir))


def prior_pulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``pulls`` that the prior cache holds, under the version it holds."""
    return _as_held(pulls(spark, sf_dir))


def _as_held(rows: DataFrame) -> DataFrame:
    k, day = F.col("k"), F.make_dt_interval(F.lit(1))
    version = F.when(k % 3 == 0, F.col("version_ts")).otherwise(F.col("version_ts") - day)
    return rows.where(k % 3 != 2).withColumn("version", iso(version))


def prior_answers_of(rows: DataFrame) -> DataFrame:
    return rows.select(
        "id",
        "version",
        body_json(F.col("k"), F.col("updated_at")).alias("body"),
        F.lit(0).cast("long").alias("fetched_ms"),
        F.lit(200).alias("status"),
        F.lit(None).cast("string").alias("reason"),
        F.lit("ok").alias("outcome"),
    )


def _write(df: DataFrame, path: str, sort: list[str]) -> None:
    """One directory per repository; large repositories are split over many files."""
    placed = df.hint("rebalance", "owner", "repo").sortWithinPartitions("owner", "repo", *sort)
    placed.write.mode("error").options(**PACKED).partitionBy("owner", "repo").parquet(path)


def _write_details(
    spark: SparkSession,
    sf_dir: str,
    root: str,
    answers: Callable[[DataFrame], DataFrame],
    shift: Column | None = None,
) -> None:
    """The answers of a host, one directory per repository.

    The table of pull requests lies by repository already: a task sorts the facts of its
    rows, and ``answers`` makes names and texts where they are written, so that they are
    neither shuffled nor sorted.
    """
    facts = pull_table(spark, sf_dir)
    rows = facts if shift is None else facts.select("*", shift)
    placed = rows.sortWithinPartitions("owner", "repo", "k", *[] if shift is None else ["shift"])
    made = _named(placed) if shift is None else _shifted(_named(placed))
    answers(made).write.mode("error").options(**PACKED).partitionBy("owner", "repo").parquet(f"{root}/details")


_BUILT: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, build) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _BUILT:
        root = scratch_dir(spark, name)
        build(root)
        _BUILT[key] = root
    return _BUILT[key]


def host_mirror(spark: SparkSession, sf_dir: str) -> str:
    """Endpoint whose answers are all good."""

    def build(root: str) -> None:
        # first: the pages are made of the same facts
        _write_details(spark, sf_dir, root, answers_of)
        _write(pages(spark, sf_dir), f"{root}/pages", ["page"])

    return _once(spark, sf_dir, "mirror", build)


def faulty_mirror(spark: SparkSession, sf_dir: str) -> str:
    """Endpoint with one fault per answer, ten kinds of them."""

    def build(root: str) -> None:
        _write_details(spark, sf_dir, root, faulty_answers_of)

    return _once(spark, sf_dir, "faulty", build)


def tick_mirror(spark: SparkSession, sf_dir: str) -> str:
    """Endpoint that knows every version listed at some tick."""

    def build(root: str) -> None:
        _write_details(spark, sf_dir, root, tick_answers_of, _shifts(last_only=False))

    return _once(spark, sf_dir, "ticks", build)


def moved_mirror(spark: SparkSession, sf_dir: str) -> str:
    """Endpoint that knows the last version only."""

    def build(root: str) -> None:
        _write_details(spark, sf_dir, root, tick_answers_of, _shifts(last_only=True))

    return _once(spark, sf_dir, "moved", build)


def gap_log(spark: SparkSession, sf_dir: str) -> str:
    """Listing log in which every pull request with 1 <= k % 6 <= 4 is missing at one tick."""

    def build(root: str) -> None:
        for tick in range(1, TICKS + 1):
            record_tick(listed_at(spark, sf_dir, tick).where(F.col("k") % 6 != tick), root, tick, placed=True)

    return _once(spark, sf_dir, "gap-log", build)


def entry_files(spark: SparkSession, sf_dir: str) -> str:
    """A folder of text entries, written by tasks."""

    def build(root: str) -> None:
        def write(batches):
            fs, path = open_dir(root)
            fs.create_dir(path, recursive=True)
            for batch in batches:
                for name, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    with fs.open_output_stream(f"{path}/{name}") as out:
                        out.write(body.encode())
                yield batch.select(["name"])

        ship_package(spark)
        entry_rows(spark, sf_dir).mapInArrow(write, "name string").count()

    return _once(spark, sf_dir, "entries", build)


def tick_log(spark: SparkSession, sf_dir: str) -> str:
    """Listing log with one complete snapshot per tick."""

    def build(root: str) -> None:
        for tick in range(1, TICKS + 1):
            record_tick(listed_at(spark, sf_dir, tick), root, tick, placed=True)

    return _once(spark, sf_dir, "log", build)


def _write_prior(spark: SparkSession, sf_dir: str, root: str) -> None:
    """The prior cache: facts are moved to their buckets, texts made where they are written."""
    facts = pull_table(spark, sf_dir)
    held = _as_held(_named(facts)).select(*facts.columns, "id", "version")
    write_cache(held, root, lambda rows: prior_answers_of(_named(rows)))


def warm_cache(spark: SparkSession, sf_dir: str) -> str:
    """The prior cache, for reading."""
    return _once(spark, sf_dir, "cache", lambda root: _write_prior(spark, sf_dir, root))


_SPARE: dict[tuple[str, str], list[str]] = {}


def spare_caches(spark: SparkSession, sf_dir: str, copies: int = 2) -> None:
    """Copies of the prior cache made ahead, so that making them is no part of a query."""
    held = _SPARE.setdefault((spark.sparkContext.applicationId, sf_dir), [])
    held += [_cache_copy(spark, sf_dir) for _ in range(copies)]


def _cache_copy(spark: SparkSession, sf_dir: str) -> str:
    # made again from the facts: a copy would move the bodies
    root = scratch_dir(spark, "cache-copy")
    _write_prior(spark, sf_dir, root)
    return root


def fresh_cache(spark: SparkSession, sf_dir: str) -> str:
    """A copy of the prior cache that may be appended to."""
    held = _SPARE.get((spark.sparkContext.applicationId, sf_dir))
    return held.pop() if held else _cache_copy(spark, sf_dir)
