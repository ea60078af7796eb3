"""The two places a pull request can come from: a code host, or a mirror of one.

Both answer the same two questions inside a task: a listing page, and the
bodies of some listed items. Nothing here runs outside a Spark task.
"""

from __future__ import annotations

import http.client
import threading
import time
from collections.abc import Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from email.utils import parsedate_to_datetime
from typing import NamedTuple
from urllib.parse import quote, urlsplit

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow.fs import FileSelector, FileType

from pullgrid.sources.storage import open_dir

# The host's API root and the statuses that are worth a retry.
DEFAULT_ENDPOINT = "https://api.github.com"
RETRYABLE = (429, 500, 502, 503, 504)
# Status given to a request that got no answer at all, and to one that was never made.
NO_ANSWER = 599
UNASKED = 0
# Requests of one task under way together, and the longest wait a task sits out (seconds).
AT_ONCE = 8
MAX_WAIT = 900.0
# Repositories of a mirror that a task holds open, and pages whose places it settles together.
OPEN_REPOSITORIES = 4
PAGES_AHEAD = 1 << 14


class Response(NamedTuple):
    status: int
    body: str | None
    attempts: int


class Item(NamedTuple):
    """One listed pull request: what to fetch and which version was listed."""

    id: int
    number: int
    url: str
    version: str
    created_at: str | None = None
    updated_at: str | None = None


def _segment(name: str) -> str:
    """A name as one segment of a path; what would add or drop a segment is refused."""
    if name.count("/") or quote(name, safe="") in ("", ".", ".."):
        raise ValueError(f"{name!r} is no single path segment")
    return name


class ListingPage(NamedTuple):
    """A listing request, checked when its address is asked for."""

    user: str
    repo: str
    per_page: int
    page: int

    def path(self) -> str:
        if min(self.per_page, self.page) < 1:
            raise ValueError(f"page {self.page} of {self.per_page} rows does not exist")
        owner, name = _segment(self.user), _segment(self.repo)
        return f"/repos/{owner}/{name}/pulls?per_page={self.per_page}&page={self.page}"


def detail_path(user: str, repo: str, number: int) -> str:
    if number < 0:
        raise ValueError(f"no pull request has the number {number}")
    return f"/repos/{_segment(user)}/{_segment(repo)}/pulls/{number}"


def request_headers(token: str | None) -> dict[str, str]:
    return {"Authorization": f"token {token}"} if token is not None else {}


def succeeded(status: int) -> bool:
    return 200 <= status < 300


def seconds_to_wait(headers: Mapping[str, str], now: float) -> float | None:
    """What the host asks for: Retry-After as seconds or a date, else the end of a used-up quota."""
    told = headers.get("Retry-After")
    if told and told.strip().isdigit():
        return float(told)
    if told:
        try:
            return max(0.0, parsedate_to_datetime(told).timestamp() - now)
        except ValueError:
            return None
    if headers.get("X-RateLimit-Remaining") == "0" and headers.get("X-RateLimit-Reset", "").isdigit():
        return max(0.0, float(headers["X-RateLimit-Reset"]) - now)
    return None


class Allowance:
    """A number of requests that several threads may make together; none: any number."""

    def __init__(self, requests: int | None):
        self.left = requests
        self._lock = threading.Lock()

    def take(self) -> bool:
        if self.left is None:
            return True
        with self._lock:
            if not self.left:
                return False
            self.left -= 1
            return True


class HttpsEndpoint:
    """GET over kept connections, a few at a time, with bounded retries.

    Redirects count as failures. The token goes to the endpoint's own host only. A wait
    the host asks for is kept; one beyond ``MAX_WAIT`` ends the task with an error.
    Threads and their connections are kept as long as the endpoint. ``allowance``: the
    requests it may make in all, retries included; what is beyond is not asked.
    """

    # items that a task lists before it asks for their bodies
    window = 2048

    def __init__(
        self,
        base: str,
        token: str | None = None,
        retries: int = 2,
        allowance: int | None = None,
        timeout: float = 30,
    ):
        self.base = base.rstrip("/")
        self._token = token
        self.retries = retries
        self.timeout = timeout
        self.allowance = allowance
        self._start()

    def _start(self) -> None:
        self._kept = threading.local()  # connections of each thread
        self._pool = None
        self._allowed = Allowance(self.allowance)

    def __repr__(self) -> str:
        shown = "*****" if self._token is not None else None
        return f"HttpsEndpoint(base={self.base}, token={shown}, retries={self.retries})"

    def __getstate__(self) -> dict:
        own = ("_kept", "_pool", "_allowed")
        return {k: v for k, v in self.__dict__.items() if k not in own}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ |= state
        self._start()

    def _connection(self, scheme: str, host: str):
        held = self._kept.__dict__
        if (scheme, host) not in held:
            kind = http.client.HTTPSConnection if scheme == "https" else http.client.HTTPConnection
            held[scheme, host] = kind(host, timeout=self.timeout)
        return held[scheme, host]

    def headers_for(self, host: str) -> dict[str, str]:
        own = {"User-Agent": "pullgrid", "Accept": "application/json"}
        same = host == urlsplit(self.base).netloc
        return own | request_headers(self._token if same else None)

    def _once(self, url: str) -> tuple[int, str | None, float | None]:
        """(status, body or None if it is not UTF-8, seconds to wait or None)."""
        at = urlsplit(url)
        connection = self._connection(at.scheme, at.netloc)
        try:
            target = at.path + (f"?{at.query}" if at.query else "")
            connection.request("GET", target, headers=self.headers_for(at.netloc))
            answer = connection.getresponse()
            raw = answer.read()
        except (OSError, http.client.HTTPException) as error:
            connection.close()
            return NO_ANSWER, str(error), None
        try:
            body = raw.decode("utf-8")
        except UnicodeDecodeError:
            body = None
        return answer.status, body, seconds_to_wait(answer.headers, time.time())

    def get(self, url: str) -> Response:
        for attempt in range(self.retries + 1):
            if not self._allowed.take():
                # also behind a busy answer: whoever has requests left may ask again
                return Response(UNASKED, None, attempt)
            status, body, wait = self._once(url)
            limited = status == 403 and wait is not None
            again = limited or status in RETRYABLE or status == NO_ANSWER
            if not again or attempt == self.retries:
                return Response(status, body, attempt + 1)
            if wait is not None and wait > MAX_WAIT:
                raise RuntimeError(f"the host asks to wait {wait:.0f} s before the next request")
            time.sleep(2.0**attempt if wait is None else wait)
        raise AssertionError("unreachable")

    def get_all(self, urls: list[str]) -> list[Response]:
        """Answers in the order of the URLs, ``AT_ONCE`` requests at a time."""
        if len(urls) < 2:
            return [self.get(url) for url in urls]
        if self._pool is None:
            self._pool = ThreadPoolExecutor(AT_ONCE)
        return list(self._pool.map(self.get, urls))

    def page(self, asked: ListingPage) -> Response:
        return self.get(self.base + asked.path())

    def arranged(self, work: list[tuple]) -> list[tuple]:
        return work

    def details(self, user: str, repo: str, items: Iterable[Item]) -> Iterator[Response]:
        yield from self.get_all([item.url for item in items])


class MirrorRows:
    """Answers in the files of one repository, found by their place: (file, row).

    Places are told by a pass over key columns. Bodies are read along the files, so asking
    in the order of places reads each of them once, whatever the row groups are.
    """

    def __init__(self, fs, path: str, keys: list[str], rows_at_once: int):
        found = fs.get_file_info(FileSelector(path))
        self.fs, self.keys, self.rows_at_once = fs, keys, rows_at_once
        self.files = sorted(
            f.path for f in found if f.type == FileType.File and not f.base_name.startswith((".", "_"))
        )
        self.asked: set[tuple] = set()
        self.places: dict[tuple, tuple[int, int]] = {}
        self._readers: dict[int, tuple[int, Iterator, pa.RecordBatch | None]] = {}
        self._sources: dict[int, pq.ParquetFile] = {}

    def _source(self, file: int) -> pq.ParquetFile:
        if file not in self._sources:
            self._sources[file] = pq.ParquetFile(self.fs.open_input_file(self.files[file]))
        return self._sources[file]

    def find(self, wanted: Iterable[tuple]) -> None:
        """Settle the places of some keys; those of earlier ones are forgotten."""
        self.asked, self.places = set(wanted), {}
        if not self.asked:
            return
        wanted = self.asked
        kind = pa.int32() if isinstance(next(iter(wanted))[0], int) else pa.string()
        heads = pa.array({key[0] for key in wanted}, kind)
        for file in range(len(self.files)):
            ahead = 0
            for batch in self._source(file).iter_batches(1 << 16, columns=self.keys, use_threads=False):
                rows = pc.indices_nonzero(pc.is_in(batch.column(self.keys[0]), value_set=heads))
                columns = [batch.column(c).take(rows).to_pylist() for c in self.keys]
                for row, *key in zip(rows.to_pylist(), *columns, strict=True):
                    if tuple(key) in wanted:
                        self.places[tuple(key)] = (file, ahead + row)
                ahead += batch.num_rows

    def _from(self, file: int, row: int) -> tuple[int, Iterator, None]:
        """A reader of a file that begins with the row group of a row."""
        source, first, group = self._source(file), 0, 0
        while first + source.metadata.row_group(group).num_rows <= row:
            first, group = first + source.metadata.row_group(group).num_rows, group + 1
        groups = list(range(group, source.metadata.num_row_groups))
        batches = source.iter_batches(
            self.rows_at_once, row_groups=groups, columns=["status", "body"], use_threads=False
        )
        return first, batches, None

    def _same_group(self, file: int, one: int, other: int) -> bool:
        end = 0
        for group in range(self._source(file).metadata.num_row_groups):
            end += self._source(file).metadata.row_group(group).num_rows
            if one < end:
                return other < end
        return False

    def answers(self, keys: Iterable[tuple]) -> dict[tuple, Response]:
        """The answers for keys whose places are settled."""
        there = sorted((self.places[key], key) for key in set(keys) if key in self.places)
        out, picked = {}, []

        def pick() -> None:
            # what was asked of one batch, taken together
            if picked:
                some = batch.take(pa.array([row for row, _ in picked]))
                columns = (some.column(c).to_pylist() for c in ("status", "body"))
                for (_, key), status, body in zip(picked, *columns, strict=True):
                    out[key] = Response(status, body, 1)
                picked.clear()

        current = batch = None
        for (file, row), key in there:
            if file != current or row >= first + batch.num_rows:
                pick()
                first, batches, batch = self._readers.get(file) or self._from(file, row)
                behind = batch is not None and row >= first + batch.num_rows
                if row < first or (behind and not self._same_group(file, first + batch.num_rows, row)):
                    first, batches, batch = self._from(file, row)
                while batch is None or row >= first + batch.num_rows:
                    first += batch.num_rows if batch is not None else 0
                    batch = next(batches)
                self._readers[file], current = (first, batches, batch), file
            picked.append((row - first, key))
        pick()
        return out


class MirrorEndpoint:
    """Parquet tables ``pages`` and ``details``, laid out like the host's URL space."""

    # items that a task lists before it asks for their bodies: each time it reads its
    # repository once, in the order of the files
    window = 1 << 17

    def __init__(self, root: str):
        self.root = root.rstrip("/")
        self._open: dict[tuple, MirrorRows | None] = {}

    def _rows(self, table: str, user: str, repo: str) -> MirrorRows | None:
        key = (table, _segment(user), _segment(repo))
        if key not in self._open:
            directory = f"{self.root}/{table}/owner={quote(user)}/repo={quote(repo)}"
            fs, path = open_dir(directory)
            there = fs.get_file_info(path).type == FileType.Directory
            keys, at_once = (["page"], 64) if table == "pages" else (["url", "version"], 2048)
            # a task that goes on to other repositories lets go of the first
            while len(self._open) >= OPEN_REPOSITORIES:
                del self._open[next(iter(self._open))]
            self._open[key] = MirrorRows(fs, path, keys, at_once) if there else None
        return self._open[key]

    def page(self, asked: ListingPage) -> Response:
        asked.path()
        found = self._rows("pages", asked.user, asked.repo)
        if found is None:
            return Response(404, '{"message":"Not Found"}', 1)
        if (asked.page,) not in found.asked:
            # this page and those a walk will ask for next
            found.find((asked.page + k,) for k in range(PAGES_AHEAD))
        return found.answers([(asked.page,)]).get((asked.page,), Response(200, "[]", 1))

    def arranged(self, work: list[tuple]) -> list[tuple]:
        """(user, repo, rank, item) rows in the order in which their bodies lie."""
        by_repo: dict[tuple[str, str], list[tuple]] = {}
        for row in work:
            by_repo.setdefault(row[:2], []).append(row)
        out = []
        for (user, repo), rows in by_repo.items():
            found = self._rows("details", user, repo)
            if found is not None:
                found.find((row[3].url, row[3].version) for row in rows)
                nowhere = (-1, -1)
                rows.sort(key=lambda row: found.places.get((row[3].url, row[3].version), nowhere))
            out += rows
        return out

    def details(self, user: str, repo: str, items: Iterable[Item]) -> Iterator[Response]:
        items = list(items)
        if not items:
            return
        found, keys = self._rows("details", user, repo), [(item.url, item.version) for item in items]
        if found is not None and not found.asked.issuperset(keys):
            found.find(keys)
        rows = {} if found is None else found.answers(keys)
        for key in keys:
            yield rows.get(key) or Response(404, '{"message":"Not Found"}', 1)


def is_mirror(endpoint: str) -> bool:
    return not endpoint.startswith(("http://", "https://"))


def connect(endpoint: str, token: str | None = None, retries: int = 2):
    if is_mirror(endpoint):
        return MirrorEndpoint(endpoint)
    return HttpsEndpoint(endpoint, token, retries)
