"""``spark.read`` / ``spark.readStream`` / SQL ``USING`` for ``pull_requests``.

This is the fetch edge: one read covers the newest ``batch`` pull requests of each
named repository, or all of them. Tasks list their own pages.
"""

from __future__ import annotations

import operator
import time
import warnings
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from datetime import UTC, datetime
from itertools import islice

import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)

from pullgrid.functions.decode import REQUIRED_NULL
from pullgrid.functions.schema import LISTING_SCHEMA, PULL_REQUEST_SCHEMA, plain_schema
from pullgrid.operators.slicing import slice_bounds
from pullgrid.sources.cached_bodies import CachedBodies
from pullgrid.sources.listing_log import (
    Segment,
    begin_tick,
    check_identity,
    finish_tick,
    last_tick,
    list_walk,
    open_walks,
    plan_tick,
    read_segments,
)
from pullgrid.sources.options import DEFAULT_CACHE_DIR, Options, Walk, parse
from pullgrid.sources.rows import StrictDecoder, arrow_schema
from pullgrid.sources.storage import check_cache_dir
from pullgrid.sources.transport import Item, ListingPage, connect, is_mirror, succeeded

# Rows decoded, cached and handed to Spark at a time.
CHUNK = 2048

Work = tuple[str, str, int, Item]

# What the host answered for each listed item, as text.
BODY_SCHEMA = plain_schema(
    full_name=T.StringType(),
    rank=T.LongType(),
    id=T.LongType(),
    number=T.IntegerType(),
    url=T.StringType(),
    version=T.StringType(),
    body=T.StringType(),
)


@dataclass
class WalksPartition(InputPartition):
    """Walks through listing pages, for the task to make."""

    walks: list[Walk]


@dataclass
class LogPartition(InputPartition):
    """A slice of one complete tick of the listing log."""

    tick: int
    segments: list[Segment]


@dataclass
class ListPartition(InputPartition):
    """Some of the walks of a tick that is not complete, for the task to list and log."""

    tick: int
    walks: list[tuple[int, Walk]]
    of: int


def list_page(options: Options, user: str, repo: str, page: int) -> tuple[list, bool]:
    """((rank, item) of one listing page, cut at the batch; whether it was the last page)."""
    client = options.client or connect(options.endpoint, options.token, options.retries)
    answer = client.page(ListingPage(user, repo, options.per_page, page))
    if not succeeded(answer.status):
        raise RuntimeError(f"Request failed with code {answer.status}: {answer.body}")
    decoder = StrictDecoder(LISTING_SCHEMA)
    elements = decoder.parse(answer.body)
    if not isinstance(elements, list):
        raise RuntimeError(f"Invalid listing: NOT_ARRAY in page {page} of {user}/{repo}")
    short = len(elements) < options.per_page
    ahead = (page - 1) * options.per_page
    if options.batch is not None:
        # a page may hold more rows than this batch asks for
        elements = elements[: max(0, min(options.per_page, options.batch - ahead))]
    items = []
    for position, element in enumerate(elements):
        row, found = decoder.document(element)
        version = row and (row["updated_at"] or row["created_at"])
        if row is not None and version is None:
            found = [(REQUIRED_NULL, "created_at")]
        if found:
            raise RuntimeError(f"Invalid listing element {element}: {' '.join(found[0])}")
        item = Item(row["id"], row["number"], row["url"], version, row["created_at"], row["updated_at"])
        items.append((ahead + position + 1, item))
    return items, short


def walk_pages(options: Options, walk: Walk) -> Iterator[tuple[int, Item]]:
    """(rank, item) of a walk's pages, until the last wanted or the first short one."""
    options = replace(options, client=connect(options.endpoint, options.token, options.retries))
    page = walk.first
    while walk.last is None or page <= walk.last:
        items, short = list_page(options, walk.user, walk.repo, page)
        yield from items
        if short:
            return
        page += walk.step


def warn_without_token(options: Options) -> None:
    if options.token is None and not is_mirror(options.endpoint):
        warnings.warn(
            "no 'token' option: the host serves anonymous readers few requests an hour",
            stacklevel=2,
        )


class _Fetcher:
    """Items -> (full name, rank, item, body) of valid bodies, through the cache."""

    def __init__(self, options: Options):
        self.options = options
        self.decoder = StrictDecoder(PULL_REQUEST_SCHEMA)
        self.client = connect(options.endpoint, options.token, options.retries)
        self.cache = CachedBodies(options.cache_dir)

    def _fetch(self, user: str, repo: str, missing: list[Item]) -> tuple[dict, str | None]:
        """(bodies of valid answers, the first failure); what was fetched is kept either way.

        A host that has moved on since the listing answers with a newer version: the body
        is kept under the version it carries, beside the one that was listed.
        """
        good, bad, bodies, failure = [], [], {}, None
        now = int(time.time() * 1000)
        answers = self.client.details(user, repo, missing)
        for item, answer in zip(missing, answers, strict=True):
            reason, version = None, item.version
            if not succeeded(answer.status):
                reason = f"HTTP_{answer.status}"
                failure = failure or f"Request failed with code {answer.status}: {answer.body}"
            else:
                document, found = self.decoder.checked(answer.body)
                if found:
                    reason = " ".join(found[0]).strip()
                    failure = failure or f"Invalid body: {reason}"
                else:
                    version = document["updated_at"] or document["created_at"] or version
                    bodies[item] = answer.body
            entry = {
                "id": item.id,
                "version": version,
                "listed": item.version,
                "body": answer.body,
                "fetched_ms": now,
                "status": answer.status,
                "reason": reason,
            }
            (good if reason is None else bad).append(entry)
        # before rows are handed out, and before a failure is raised
        self.cache.keep("ok", good)
        self.cache.keep("failed", bad)
        return bodies, failure

    def _chunk(self, part: list[Work]) -> list[tuple[str, int, Item, str]]:
        cached = self.cache.find([(item.id, item.version) for *_, item in part])
        by_repo: dict[tuple[str, str], list[Item]] = {}
        fetched: dict[Item, str] = {}
        for user, repo, _, item in part:
            if (item.id, item.version) not in cached:
                by_repo.setdefault((user, repo), []).append(item)
        for (user, repo), missing in by_repo.items():
            bodies, failure = self._fetch(user, repo, list(dict.fromkeys(missing)))
            fetched |= bodies
            if failure and self.options.mode == "FAILFAST":
                raise RuntimeError(failure)
        out = []
        for user, repo, rank, item in part:
            body = cached.get((item.id, item.version)) or fetched.get(item)
            if body is not None:
                out.append((f"{user}/{repo}", rank, item, body))
        return out

    def chunks(self, work: Iterator[Work]) -> Iterator[list[tuple[str, int, Item, str]]]:
        work = iter(work)
        while window := list(islice(work, self.client.window)):
            window = self.client.arranged(window)
            for start in range(0, len(window), CHUNK):
                yield self._chunk(window[start : start + CHUNK])

    def typed(self, work: Iterator[Work], schema: T.StructType, **constants) -> Iterator[pa.RecordBatch]:
        """Decoded rows."""
        shape = arrow_schema(schema)
        for part in self.chunks(work):
            rows = []
            for *_, body in part:
                row, found = self.decoder.body(body)
                if row is not None:
                    rows.append(row | constants)
                elif self.options.mode == "FAILFAST":
                    raise RuntimeError(f"Invalid body: {' '.join(found[0]).strip()}")
            yield pa.RecordBatch.from_pylist(rows, schema=shape)

    def texts(self, work: Iterator[Work]) -> Iterator[pa.RecordBatch]:
        """Bodies as text, for Spark to decode."""
        shape = arrow_schema(BODY_SCHEMA)
        for part in self.chunks(work):
            names, ranks, items, bodies = zip(*part, strict=True) if part else ((), (), (), ())
            columns = [names, ranks, *([getattr(i, c) for i in items] for c in BODY_SCHEMA.names[2:6]), bodies]
            arrays = [pa.array(c, f.type) for c, f in zip(columns, shape, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=shape)


class PullRequestReader(DataSourceReader):
    def __init__(self, options: Options):
        self.options = options
        self._conditions: list[Callable[[Item], bool]] = []

    def _selected(self, item: Item) -> bool:
        return all(holds(item) for holds in self._conditions)

    def partitions(self) -> list[InputPartition]:
        options = self.options
        check_cache_dir(options.cache_dir)
        warn_without_token(options)
        walks = options.walks
        bounds = slice_bounds(len(walks), min(len(walks), options.partitions))
        return [WalksPartition(walks[low:high]) for low, high in bounds]

    def _work(self, partition: WalksPartition) -> Iterator[Work]:
        for walk in partition.walks:
            for rank, item in walk_pages(self.options, walk):
                if self._selected(item):
                    yield walk.user, walk.repo, rank, item

    def read(self, partition) -> Iterator[pa.RecordBatch]:
        if partition is not None:
            yield from _Fetcher(self.options).typed(self._work(partition), PULL_REQUEST_SCHEMA)


class BodyReader(PullRequestReader):
    """The same rows as the host's own text, with what the listing says of them."""

    def read(self, partition) -> Iterator[pa.RecordBatch]:
        if partition is not None:
            yield from _Fetcher(self.options).texts(self._work(partition))


_RANGES = {
    GreaterThan: operator.gt,
    GreaterThanOrEqual: operator.ge,
    LessThan: operator.lt,
    LessThanOrEqual: operator.le,
}
_DATES = ("created_at", "updated_at")


def _instant(text: str | None) -> datetime | None:
    if text is None:
        return None
    stamp = datetime.fromisoformat(text)
    return stamp if stamp.tzinfo else stamp.replace(tzinfo=UTC)


def _condition(asked: Filter) -> Callable[[Item], bool] | None:
    """What a filter says of a listed item; none if the listing does not know."""
    column = asked.attribute[0] if len(getattr(asked, "attribute", ())) == 1 else None
    if column in ("id", "number", "url") and isinstance(asked, (EqualTo, In)):
        values = {asked.value} if isinstance(asked, EqualTo) else set(asked.value)
        return lambda item: getattr(item, column) in values
    compare = _RANGES.get(type(asked))
    if compare is None or column not in ("id", "number", *_DATES):
        return None
    bound = asked.value
    if column not in _DATES:
        return lambda item: compare(getattr(item, column), bound)
    if not isinstance(bound, datetime):
        return None
    # a naive time is one of the process, as Spark hands it over
    bound = bound.astimezone(UTC)

    def holds(item: Item) -> bool:
        stamp = _instant(getattr(item, column))
        return stamp is not None and compare(stamp, bound)

    return holds


class _Pushdown:
    """Drops unwanted items before they cost a request. Spark filters again.

    Dates are those of the listing, which is what a read is of: a pull request that changes
    between its listing and its request is selected as it was listed.
    """

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for asked in filters:
            holds = _condition(asked)
            if holds is not None:
                self._conditions.append(holds)
            yield asked


class PushdownReader(_Pushdown, PullRequestReader):
    pass


class PushdownBodyReader(_Pushdown, BodyReader):
    pass


class PullRequestStreamReader(DataSourceStreamReader):
    """Emits the whole listing at every tick, replayable from the listing log."""

    def __init__(self, options: Options, schema: T.StructType):
        self.options = options
        self.schema = schema

    def initialOffset(self) -> dict:
        start = self.options.starting_tick
        if start is None:
            # a new query begins with the current listing, not with old ones
            start = max(last_tick(self.options.listing_dir)[0] - 1, 0)
        return {"tick": start}

    def latestOffset(self) -> dict:
        """The newest tick; a new one is only begun here, its pages are left to tasks."""
        options = self.options
        tick, age = last_tick(options.listing_dir)
        if age >= options.poll_seconds:
            check_identity(options.listing_dir, options.identity)
            warn_without_token(options)
            tick += 1
            begin_tick(options.listing_dir, tick, options.walks)
        return {"tick": tick}

    def _planned(self, tick: int) -> list[InputPartition]:
        options = self.options
        walks = open_walks(options.listing_dir, tick)
        if walks is None:
            slices = plan_tick(options.listing_dir, tick, options.partitions)
            return [LogPartition(tick, segments) for segments in slices]
        numbered = list(enumerate(walks))
        bounds = slice_bounds(len(walks), min(len(walks), options.partitions))
        return [ListPartition(tick, numbered[low:high], len(walks)) for low, high in bounds]

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        if end["tick"] > start["tick"]:
            check_cache_dir(self.options.cache_dir)
        return [p for tick in range(start["tick"] + 1, end["tick"] + 1) for p in self._planned(tick)]

    def _logged(self, partition: ListPartition) -> Iterator[pa.RecordBatch]:
        """Rows of some walks, listed and logged here unless an earlier attempt has."""
        log_dir = self.options.listing_dir
        for number, walk in partition.walks:
            rows = (
                {"full_name": f"{walk.user}/{walk.repo}", "rank": rank}
                | {c: getattr(item, c) for c in ("id", "number", "url", "version")}
                for rank, item in walk_pages(self.options, walk)
            )
            yield from list_walk(log_dir, partition.tick, number, rows)
        finish_tick(log_dir, partition.tick, partition.of)

    def _work(self, partition) -> Iterator[Work]:
        if isinstance(partition, ListPartition):
            batches = self._logged(partition)
        else:
            batches = read_segments(self.options.listing_dir, partition.segments)
        for batch in batches:
            for row in batch.to_pylist():
                user, repo = row["full_name"].split("/")
                yield user, repo, row["rank"], Item(row["id"], row["number"], row["url"], row["version"])

    def read(self, partition) -> Iterator[pa.RecordBatch]:
        if partition is not None:
            constants = {"tick": partition.tick} if self.options.include_tick else {}
            yield from _Fetcher(self.options).typed(self._work(partition), self.schema, **constants)

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass


class PullRequestSource(DataSource):
    default_partitions = 8
    default_cache_dir = DEFAULT_CACHE_DIR
    reader_class = PullRequestReader

    def __init__(self, options):
        super().__init__(options)
        self.config = parse(options, self.default_partitions, self.default_cache_dir)

    @classmethod
    def name(cls) -> str:
        return "pull_requests"

    def schema(self) -> T.StructType:
        fields = list(PULL_REQUEST_SCHEMA.fields)
        if self.config.include_tick:
            fields.append(T.StructField("tick", T.LongType(), False))
        return T.StructType(fields)

    def _declared(self, schema: T.StructType) -> T.StructType:
        def shape(s):
            return [(f.name, f.dataType.simpleString()) for f in s.fields]

        if shape(schema) != shape(self.schema()):
            raise ValueError(f"User-defined schema is not supported for provider {self.name()}")
        return self.schema()

    def reader(self, schema: T.StructType) -> DataSourceReader:
        self._declared(schema)
        if self.config.include_tick:
            raise ValueError("Option 'includeTick' is for streams")
        return self.reader_class(self.config)

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return PullRequestStreamReader(self.config, self._declared(schema))


class PullRequestBodySource(PullRequestSource):
    """Bodies as text: ``pullgrid.pull_requests`` decodes them in Spark."""

    reader_class = BodyReader

    @classmethod
    def name(cls) -> str:
        return "pull_request_bodies"

    def schema(self) -> T.StructType:
        return BODY_SCHEMA

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        raise ValueError(f"{self.name()} cannot be read as a stream")


# readers that take filters; Spark must have filter pushdown on
PUSHDOWN = {PullRequestSource: PushdownReader, PullRequestBodySource: PushdownBodyReader}
