"""Options of the ``pull_requests`` source, checked before anything is planned."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from hashlib import sha256
from typing import NamedTuple

from pullgrid.functions.keys import MAX_PAGE_SIZE
from pullgrid.sources.transport import DEFAULT_ENDPOINT

# Fixed values of the option contract.
DEFAULT_USER = "apache"
DEFAULT_REPO = "spark"
DEFAULT_BATCH = 25
MIN_BATCH, MAX_BATCH = 1, 1000
POLL_SECONDS = 59.0
ALL = "all"
DEFAULT_CACHE_DIR = "file:/tmp/.pull-requests-cache"

MODES = ("FAILFAST", "PERMISSIVE")


class Walk(NamedTuple):
    """Pages first, first + step, ... of a repository, up to the last or the first short one."""

    user: str
    repo: str
    first: int
    step: int
    last: int | None


@dataclass(frozen=True)
class Options:
    repos: tuple[tuple[str, str], ...]
    batch: int | None  # None: all
    cache_dir: str
    endpoint: str
    mode: str
    partitions: int
    retries: int
    listing_dir: str
    poll_seconds: float
    starting_tick: int | None
    include_tick: bool
    identity: str  # of a poll: endpoint, batch and repositories
    token: str | None = field(default=None, repr=False)
    # what a walk has connected, so that its pages share it
    client: object = field(default=None, repr=False, compare=False)

    @property
    def per_page(self) -> int:
        """One page size for all pages, so that pages never overlap."""
        return MAX_PAGE_SIZE if self.batch is None else min(self.batch, MAX_PAGE_SIZE)

    @property
    def walks(self) -> list[Walk]:
        """Every task's way through the pages; together they meet each page once.

        The number of pages of a whole repository is not known, so its pages are dealt
        to as many walks as there are tasks for it, and each ends at its first short page.
        """
        share = -(-self.partitions // len(self.repos))
        count = share if self.batch is None else -(-self.batch // MAX_PAGE_SIZE)
        step = max(1, min(share, count))
        return [
            Walk(user, repo, first + 1, step, self.batch and count)
            for first in range(step)
            for user, repo in self.repos
        ]


def _name(options: Mapping[str, str], key: str, default: str, meaning: str) -> str:
    if key not in options:
        return default
    value = options[key].strip()
    if not value:
        raise ValueError(f"option '{key}' is blank; leave it out for {meaning} {default!r}")
    return value


def _repos(options: Mapping[str, str]) -> tuple[tuple[str, str], ...]:
    if "repos" not in options:
        user = _name(options, "user", DEFAULT_USER, "the owner")
        repo = _name(options, "repo", DEFAULT_REPO, "the repository")
        for key, value in (("user", user), ("repo", repo)):
            if "/" in value:
                raise ValueError(f"option '{key}' is one name, without '/': {value!r}")
        return ((user, repo),)
    if "user" in options or "repo" in options:
        raise ValueError("Give either 'repos' or 'user' and 'repo'")
    pairs = []
    for text in options["repos"].split(","):
        parts = [p.strip() for p in text.split("/")]
        if len(parts) != 2 or not all(parts):
            raise ValueError(f"Expected owner/name in 'repos' option, found '{text.strip()}'")
        pairs.append((parts[0], parts[1]))
    if len(set(pairs)) != len(pairs):
        raise ValueError("'repos' option names a repository twice")
    return tuple(pairs)


def _batch(options: Mapping[str, str]) -> int | None:
    if "batch" not in options:
        return DEFAULT_BATCH
    text = options["batch"]
    if text == ALL:
        return None
    try:
        # like a plain integer literal: no surrounding blanks, no underscores
        if text != text.strip() or "_" in text:
            raise ValueError(text)
        size = int(text)
    except ValueError as error:
        raise ValueError(f"option 'batch' is {text!r}, neither a number nor {ALL!r}") from error
    if not MIN_BATCH <= size <= MAX_BATCH:
        raise ValueError(f"option 'batch' is {size}, outside {MIN_BATCH} to {MAX_BATCH}")
    return size


def batch_text(batch: int | None) -> str:
    return ALL if batch is None else str(batch)


def _number(options: Mapping[str, str], key: str, default, kind, least):
    if key not in options:
        return default
    try:
        value = kind(options[key])
    except ValueError as error:
        raise ValueError(f"Invalid value {options[key]} for option '{key}'") from error
    if value < least:
        raise ValueError(f"Option '{key}' must be at least {least}, found {value}")
    return value


def parse(
    options: Mapping[str, str],
    default_partitions: int,
    default_cache_dir: str | None = DEFAULT_CACHE_DIR,
) -> Options:
    repos = _repos(options)
    batch = _batch(options)
    mode = options["mode"].strip().upper() if "mode" in options else MODES[0]
    if mode not in MODES:
        raise ValueError(f"Option 'mode' must be one of {', '.join(MODES)}, found {mode}")
    cache_dir = options["cacheDir"] if "cacheDir" in options else default_cache_dir
    if cache_dir is None:
        raise ValueError(
            "set spark.checkpoint.dir or option 'cacheDir' to a folder that all executors share"
        )
    endpoint = options["endpoint"] if "endpoint" in options else DEFAULT_ENDPOINT
    identity = "\n".join([endpoint, batch_text(batch), *sorted(f"{u}/{r}" for u, r in repos)])
    default_listing = f"{(default_cache_dir or cache_dir).rstrip('/')}-listing/{sha256(identity.encode()).hexdigest()}"
    return Options(
        repos=repos,
        batch=batch,
        token=options["token"] if "token" in options else None,
        cache_dir=cache_dir,
        endpoint=endpoint,
        identity=identity,
        mode=mode,
        partitions=_number(options, "numPartitions", default_partitions, int, 1),
        retries=_number(options, "retries", 2, int, 0),
        listing_dir=options["listingDir"] if "listingDir" in options else default_listing,
        poll_seconds=_number(options, "pollInterval", POLL_SECONDS, float, 0),
        starting_tick=_number(options, "startingTick", None, int, 0),
        include_tick=("includeTick" in options and options["includeTick"].lower() == "true"),
    )
