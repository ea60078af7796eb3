from __future__ import annotations

import pytest

from pullgrid.sources.options import parse
from pullgrid.sources.storage import check_cache_dir


def test_defaults():
    options = parse({}, 8)
    assert options.repos == (("apache", "spark"),)
    assert options.batch == 25
    assert options.token is None
    assert options.mode == "FAILFAST"
    assert options.partitions == 8


def test_names_are_trimmed():
    assert parse({"user": " abc ", "repo": " DEF "}, 1).repos == (("abc", "DEF"),)


@pytest.mark.parametrize("key", ["user", "repo"])
@pytest.mark.parametrize("value", ["", "  "])
def test_blank_names(key, value):
    with pytest.raises(ValueError, match=f"option '{key}' is blank"):
        parse({key: value}, 1)


def test_slash_is_caught_with_the_options():
    with pytest.raises(ValueError, match="without '/'"):
        parse({"user": "a/b"}, 1)


@pytest.mark.parametrize("value", ["", "abc", "  ", " 12", "1_0", "1.5"])
def test_invalid_batch(value):
    with pytest.raises(ValueError, match="neither a number nor"):
        parse({"batch": value}, 1)


@pytest.mark.parametrize("value", ["0", "1001", "-1"])
def test_batch_out_of_bound(value):
    with pytest.raises(ValueError, match=f"option 'batch' is {value}, outside"):
        parse({"batch": value}, 1)


@pytest.mark.parametrize(("batch", "per_page", "pages"), [(1, 1, 1), (100, 100, 1), (245, 100, 3)])
@pytest.mark.parametrize("partitions", [1, 2, 8])
def test_walks_meet_every_page_once(batch, per_page, pages, partitions):
    options = parse({"batch": str(batch), "repos": "a/b,c/d"}, partitions)
    assert options.per_page == per_page
    for repo in ("b", "d"):
        met = [
            page
            for w in options.walks
            if w.repo == repo
            for page in range(w.first, w.last + 1, w.step)
        ]
        assert sorted(met) == list(range(1, pages + 1))


def test_a_whole_repository_is_dealt_to_all_tasks():
    options = parse({"batch": "all", "repos": "a/b,c/d"}, 7)
    assert options.batch is None and options.per_page == 100
    own = [w for w in options.walks if w.repo == "b"]
    assert [(w.first, w.step, w.last) for w in own] == [(k, 4, None) for k in range(1, 5)]


def test_different_polls_never_share_a_log():
    def log(**options):
        return parse(options, 1).listing_dir

    many = "a/1,a/2,a/3,a/4"
    assert log(repos=f"{many},a/5") != log(repos=f"{many},z/9")
    assert log(repos="a-b/c") != log(repos="a/b-c")
    assert log(repos="a/b", endpoint="/x") != log(repos="a/b", endpoint="/y")
    assert log(repos="a/b", batch="7") != log(repos="a/b", batch="all")
    assert log(repos="a/b,c/d") == log(repos="c/d,a/b")


def test_token_is_not_shown():
    options = parse({"token": "abc123"}, 1)
    assert options.token == "abc123"
    assert "abc123" not in repr(options)


def test_repos_list():
    options = parse({"repos": "a/b, c/d"}, 1)
    assert options.repos == (("a", "b"), ("c", "d"))
    with pytest.raises(ValueError, match="owner/name"):
        parse({"repos": "a/b/c"}, 1)
    with pytest.raises(ValueError, match="twice"):
        parse({"repos": "a/b,a/b"}, 1)
    with pytest.raises(ValueError, match="either"):
        parse({"repos": "a/b", "user": "c"}, 1)


@pytest.mark.parametrize(
    ("key", "value"),
    [("mode", "DROP"), ("numPartitions", "0"), ("retries", "x"), ("pollInterval", "-1")],
)
def test_other_options(key, value):
    with pytest.raises(ValueError):
        parse({key: value}, 1)


def test_cache_dir_is_created_and_qualified(tmp_path):
    path = tmp_path / "a" / "cache"
    assert check_cache_dir(str(path)) == f"file:{path}"
    assert check_cache_dir(f"file:{path}") == f"file:{path}"
    assert path.stat().st_mode & 0o777 == 0o777


def test_cache_dir_must_be_a_directory(tmp_path):
    path = tmp_path / "file"
    path.write_text("x")
    with pytest.raises(ValueError, match="is not a directory"):
        check_cache_dir(str(path))


def test_cache_dir_needs_read_and_write(tmp_path, monkeypatch):
    """The system is asked about the caller's rights; whoever runs this may have all of them."""
    monkeypatch.setattr("os.access", lambda path, mode: False)
    with pytest.raises(ValueError, match="no right to read and write"):
        check_cache_dir(str(tmp_path))
