from __future__ import annotations

import pytest

from pullgrid.sources import transport
from pullgrid.sources.transport import (
    HttpsEndpoint,
    Item,
    ListingPage,
    detail_path,
    request_headers,
    seconds_to_wait,
)

BASE = "https://host.test"


def test_listing_request():
    path = ListingPage("user", "repo", 7, 2).path()
    assert path == "/repos/user/repo/pulls?per_page=7&page=2"


@pytest.mark.parametrize(
    "bad",
    [
        ("", "r", 10, 1),
        ("u", "", 10, 1),
        ("a/b", "r", 10, 1),
        ("u", "/r", 10, 1),
        ("u", "r", 0, 1),
        ("u", "r", 10, 0),
    ],
)
def test_listing_request_checks(bad):
    with pytest.raises(ValueError):
        ListingPage(*bad).path()


def test_detail_request():
    assert detail_path("user", "repo", 12345) == "/repos/user/repo/pulls/12345"
    for bad in [("", "r", 1), ("u", "", 1), ("a/b", "r", 1), ("u", "a/b", 1), ("u", "r", -1)]:
        with pytest.raises(ValueError):
            detail_path(*bad)


def test_token_header():
    assert request_headers("abc123") == {"Authorization": "token abc123"}
    assert request_headers(None) == {}
    assert "abc123" not in repr(HttpsEndpoint(BASE, "abc123"))


@pytest.fixture
def client(monkeypatch):
    """An https client whose answers are scripted; nothing is opened."""

    def make(answers, retries=2):
        endpoint = HttpsEndpoint(BASE, "secret", retries)
        asked, slept = [], []
        script = iter(answers)

        def once(url):
            asked.append(url)
            return next(script)

        monkeypatch.setattr(endpoint, "_once", once)
        monkeypatch.setattr(transport.time, "sleep", slept.append)
        return endpoint, asked, slept

    return make


def test_retry_until_good(client):
    endpoint, asked, slept = client([(503, "x", None), (429, "x", 7.0), (200, "ok", None)])
    assert endpoint.get("u") == (200, "ok", 3)
    assert asked == ["u", "u", "u"]
    assert slept == [1.0, 7.0]


def test_retries_are_bounded(client):
    endpoint, asked, _ = client([(500, "x", None)] * 5, retries=1)
    assert endpoint.get("u") == (500, "x", 2)
    assert len(asked) == 2


@pytest.mark.parametrize("status", [302, 400, 404])
def test_final_statuses_are_not_retried(client, status):
    endpoint, asked, _ = client([(status, "x", None)])
    assert endpoint.get("u") == (status, "x", 1)
    assert len(asked) == 1


def test_pages_and_details_ask_the_right_urls(client):
    endpoint, asked, _ = client([(200, "[]", None), (200, "{}", None)])
    endpoint.page(ListingPage("user", "repo", 5, 2))
    item = Item(1, 2, f"{BASE}/x", "v")
    assert list(endpoint.details("user", "repo", [item])) == [(200, "{}", 1)]
    assert asked == [f"{BASE}/repos/user/repo/pulls?per_page=5&page=2", f"{BASE}/x"]


def test_what_the_host_asks_to_wait():
    assert seconds_to_wait({"Retry-After": "7"}, 0) == 7
    assert seconds_to_wait({"Retry-After": "Wed, 21 Oct 2015 07:28:00 GMT"}, 1445412470.0) == 10
    quota = {"X-RateLimit-Remaining": "0", "X-RateLimit-Reset": "130"}
    assert seconds_to_wait(quota, 100) == 30
    assert seconds_to_wait(quota | {"X-RateLimit-Remaining": "3"}, 100) is None
    assert seconds_to_wait({"Retry-After": "soon"}, 0) is None


def test_a_long_wait_is_kept_or_ends_the_task(client):
    endpoint, _, slept = client([(429, "x", 600.0), (200, "ok", None)])
    assert endpoint.get("u").status == 200 and slept == [600.0]
    endpoint, asked, _ = client([(429, "x", 3600.0), (200, "ok", None)])
    with pytest.raises(RuntimeError, match="wait 3600 s"):
        endpoint.get("u")
    assert len(asked) == 1


def test_a_used_up_quota_is_waited_for_and_other_refusals_are_final(client):
    endpoint, _, slept = client([(403, "x", 30.0), (200, "ok", None)])
    assert endpoint.get("u").status == 200 and slept == [30.0]
    endpoint, asked, _ = client([(403, "x", None)])
    assert endpoint.get("u").status == 403 and len(asked) == 1


def test_the_token_stays_with_its_host():
    endpoint = HttpsEndpoint(BASE, "secret")
    assert endpoint.headers_for("host.test")["Authorization"] == "token secret"
    assert "Authorization" not in endpoint.headers_for("elsewhere.test")


def test_answers_keep_their_order(monkeypatch):
    endpoint = HttpsEndpoint(BASE)
    monkeypatch.setattr(endpoint, "_once", lambda url: (200, url, None))
    urls = [f"{BASE}/{k}" for k in range(40)]
    assert [a.body for a in endpoint.get_all(urls)] == urls


def test_https_fetch_runs_in_tasks(spark):
    """No network here: every request ends as NO_ANSWER, and is reported as such."""
    from pullgrid.operators.fetch import fetch

    rows = spark.range(3).selectExpr("id", "concat('https://127.0.0.1:1/', id) AS url")
    answers = fetch(rows, "https://127.0.0.1:1", "tok", retries=0, parallelism=2).collect()
    assert {(r["id"], r["status"], r["attempts"]) for r in answers} == {
        (i, transport.NO_ANSWER, 1) for i in range(3)
    }


def test_an_allowance_is_never_exceeded(client):
    endpoint, asked, _ = client([(503, "x", None)] * 9, retries=2)
    endpoint.allowance = 4
    endpoint._start()
    answers = endpoint.get_all(["a", "b", "c"])
    assert len(asked) == 4
    assert sum(a.attempts for a in answers) == 4
    assert {a.status for a in answers} <= {503, transport.UNASKED}


def test_threads_are_kept_and_do_not_travel(monkeypatch):
    import pickle

    endpoint = HttpsEndpoint(BASE, "secret", allowance=100)
    monkeypatch.setattr(HttpsEndpoint, "_once", lambda self, url: (200, url, None))
    endpoint.get_all(["a", "b"])
    pool = endpoint._pool
    endpoint.get_all(["c", "d"])
    assert endpoint._pool is pool
    there = pickle.loads(pickle.dumps(endpoint))
    assert there._pool is None and there._allowed.left == 100


def test_shares_of_a_budget():
    from pullgrid.operators.fetch import task_share

    for budget, tasks in ((10, 3), (2, 8), (0, 4), (64, 8)):
        shares = [task_share(budget, tasks, t) for t in range(tasks)]
        assert sum(shares) == budget and max(shares) - min(shares) <= 1
    assert task_share(None, 3, 0) is None


SCRIPT = """
import pathlib, uuid
from pullgrid.sources import transport

def once(self, url):
    # every request leaves a mark; each third item fails once with a retryable status
    folder = pathlib.Path({folder!r})
    number = int(url.rsplit("/", 1)[1])
    earlier = len(list(folder.glob(f"{{number}}-*")))
    (folder / f"{{number}}-{{uuid.uuid4().hex}}").touch()
    if number % 3 == 0 and not earlier:
        return 503, "busy", 0.0
    return 200, (pathlib.Path({bodies!r}) / str(number)).read_text(), None

transport.HttpsEndpoint._once = once
"""


@pytest.mark.parametrize("budget", [0, 1, 7, 25, 200])
def test_all_tasks_together_keep_to_a_budget(spark, sf, tmp_path, monkeypatch, budget):
    """Scripted answers in the workers: requests are counted as files."""
    from pyspark.sql import functions as F

    from pullgrid.operators import cache, fetch
    from pullgrid.plans import mirror

    folder, bodies = tmp_path / "asked", tmp_path / "bodies"
    folder.mkdir()
    bodies.mkdir()
    rows = mirror.details(spark, sf).where("k < 120").select("k", "id", "version", "body").collect()
    for r in rows:
        (bodies / str(r["k"])).write_text(r["body"])
    script = SCRIPT.format(folder=str(folder), bodies=str(bodies))
    made = fetch.HttpsEndpoint

    def scripted(*args, **kwargs):
        exec(script, {})
        return made(*args, **kwargs)

    monkeypatch.setattr(fetch, "HttpsEndpoint", scripted)
    items = spark.createDataFrame(
        [(f"https://host.test/{r['k']}", r["id"], r["version"]) for r in rows],
        "url string, id long, version string",
    )
    held = str(tmp_path / "cache")
    counts = cache.fetch_misses(items, "https://host.test", held, budget=budget, retries=2)
    asked = len(list(folder.iterdir()))
    assert counts["requests"] == asked <= budget
    assert counts["fetched"] + counts["unasked"] == len(rows)
    good = cache.read_cache(spark, held)
    assert good.count() == counts["fetched"] - counts["failed"]
    needed = len(rows) + sum(r["k"] % 3 == 0 for r in rows)
    if budget >= needed:
        assert counts == {"fetched": len(rows), "failed": 0, "requests": needed, "unasked": 0}
    else:
        assert asked == budget and counts["failed"] == 0
    assert good.where(F.col("version") != F.col("listed")).count() == 0


def test_a_task_reads_a_repository_of_a_mirror_once(spark, tmp_path, monkeypatch):
    """However many pages and chunks it asks for, in whatever order."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    from pullgrid.sources import transport

    rows = [{"url": f"u{k}", "version": f"v{k % 2}", "status": 200, "body": f"b{k}"} for k in range(5000)]
    details, pages = (tmp_path / t / "owner=o" / "repo=r" for t in ("details", "pages"))
    for folder in (details, pages):
        folder.mkdir(parents=True)
    for part in range(2):
        pq.write_table(pa.Table.from_pylist(rows[part::2]), details / f"part-{part}.parquet", row_group_size=700)
        listed = [{"page": n, "status": 200, "body": f"p{n}"} for n in range(1 + part, 300, 2)]
        table = pa.Table.from_pylist(listed).cast(
            pa.schema([("page", pa.int32()), ("status", pa.int32()), ("body", pa.string())])
        )
        pq.write_table(table, pages / f"part-{part}.parquet")
    read = []
    iterate = pq.ParquetFile.iter_batches

    def counted(self, *args, **kwargs):
        read.append(kwargs["columns"])
        return iterate(self, *args, **kwargs)

    monkeypatch.setattr(pq.ParquetFile, "iter_batches", counted)
    endpoint = transport.connect(str(tmp_path))
    got = [endpoint.page(transport.ListingPage("o", "r", 100, n)).body for n in range(1, 302)]
    assert got == [f"p{n}" for n in range(1, 300)] + ["[]", "[]"]
    assert len(read) == 4  # two files: places, and pages
    read.clear()
    items = [transport.Item(k, k, f"u{k * 7 % 5000}", f"v{k * 7 % 2}") for k in range(5000)]
    absent = [transport.Item(-1, 0, "none", "v0"), transport.Item(-2, 0, "u1", "v0")]
    work = endpoint.arranged([("o", "r", 1, item) for item in items + absent])
    for start in range(0, len(work), 64):
        some = [item for *_, item in work[start : start + 64]]
        for item, answer in zip(some, endpoint.details("o", "r", some), strict=True):
            assert answer.body == (f"b{item.url[1:]}" if item.id >= 0 else '{"message":"Not Found"}')
    assert len(read) == 4
    # without an order told before, each question is answered by itself
    picked = [items[4999], absent[0], items[0], items[17]]
    assert [a.status for a in endpoint.details("o", "r", picked)] == [200, 404, 200, 200]
    assert [a.status for a in endpoint.details("o", "none", picked)] == [404] * 4
