"""The pull-request table schema and the type set the strict decoder accepts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import types as T

_S, _I, _L, _B, _TS = (
    T.StringType(),
    T.IntegerType(),
    T.LongType(),
    T.BooleanType(),
    T.TimestampType(),
)


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(*f) for f in fields])


# Field names, order, types and nullability of the table. Ids are
# BIGINT because they are join and cache keys and outgrow 32 bits.
PULL_REQUEST_SCHEMA = _struct(
    ("id", _L, False),
    ("url", _S, True),
    ("html_url", _S, True),
    ("diff_url", _S, True),
    ("patch_url", _S, True),
    ("number", _I, False),
    ("state", _S, True),
    ("title", _S, True),
    ("body", _S, True),
    ("created_at", _TS, True),
    ("updated_at", _TS, True),
    ("closed_at", _TS, True),
    ("merged_at", _TS, True),
    (
        "base",
        _struct(
            ("ref", _S, True),
            ("sha", _S, True),
            (
                "repo",
                _struct(
                    ("id", _L, False),
                    ("name", _S, True),
                    ("full_name", _S, True),
                    ("description", _S, True),
                    ("private", _B, False),
                    ("url", _S, True),
                    ("html_url", _S, True),
                ),
                True,
            ),
        ),
        True,
    ),
    (
        "user",
        _struct(
            ("login", _S, True),
            ("id", _L, False),
            ("url", _S, True),
            ("html_url", _S, True),
        ),
        True,
    ),
    ("merged", _B, False),
    # null means the host has not computed it yet
    ("mergeable", _B, True),
    ("comments", _I, False),
    ("commits", _I, False),
    ("additions", _I, False),
    ("deletions", _I, False),
    ("changed_files", _I, False),
)

# One element of a listing page.
LISTING_SCHEMA = _struct(
    ("id", _L, False),
    ("number", _I, False),
    ("url", _S, False),
    ("updated_at", _S, True),
    ("created_at", _S, True),
)


def plain_schema(**columns: T.DataType) -> T.StructType:
    """A flat schema of nullable columns."""
    return _struct(*[(name, dtype, True) for name, dtype in columns.items()])


_LEAF_TYPES = (
    T.IntegerType,
    T.LongType,
    T.BooleanType,
    T.DoubleType,
    T.StringType,
    T.TimestampType,
)


@dataclass(frozen=True)
class Node:
    """One field of a schema, addressed by its path from the root."""

    path: tuple[str, ...]
    type: T.DataType
    required: bool

    @property
    def name(self) -> str:
        return ".".join(self.path)

    @property
    def parent(self) -> tuple[str, ...]:
        return self.path[:-1]


def nodes(schema: T.StructType, prefix: tuple[str, ...] = ()) -> Iterator[Node]:
    """Every field, structs before their children, in schema order."""
    for field in schema.fields:
        path = (*prefix, field.name)
        yield Node(path, field.dataType, not field.nullable)
        if isinstance(field.dataType, T.StructType):
            yield from nodes(field.dataType, path)


def check_supported(schema: T.StructType) -> None:
    """Reject a schema the decoder has no rules for, once, before any row is read."""
    for node in nodes(schema):
        if not isinstance(node.type, (*_LEAF_TYPES, T.StructType)):
            raise ValueError(
                f"Unsupported data type {node.type.simpleString()} for JSON parsing "
                f"in field {node.name}"
            )
