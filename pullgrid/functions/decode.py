"""Strict JSON text -> typed nested columns, as Catalyst expressions.

Each body is parsed once by type, and scanned for what parsers pass over: text behind the
document and repeated keys. Required integers and booleans are parsed by type;
fields whose null is legal, and all text, are parsed as variants, because only
a variant keeps apart an absent key, a JSON null and a value of another type.
A row that passes this cheap check is valid. Any other row is looked at again,
field by field, to decide whether it is valid after all (a null nested object
is) and which rules it breaks.

The expressions are written as SQL text: a schema of 34 fields is a few strings
for the driver to hand over, instead of thousands of column objects.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pullgrid.functions.schema import Node, check_supported, nodes

MALFORMED = "MALFORMED"
TRAILING_TEXT = "TRAILING_TEXT"
REPEATED_KEY = "REPEATED_KEY"
NOT_OBJECT = "NOT_OBJECT"
MISSING_KEY = "MISSING_KEY"
REQUIRED_NULL = "REQUIRED_NULL"
WRONG_TYPE = "WRONG_TYPE"
OVERFLOW = "OVERFLOW"
BAD_TIMESTAMP = "BAD_TIMESTAMP"

# Fixed value: seconds resolution, and an offset that is Z, +hh, +hhmm or +hh:mm.
TIMESTAMP_TEXT = (
    r"(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}"
    r"(Z|[+-][0-9]{2}(:?[0-9]{2})?)"
)
# Integers beyond 64 bits are decimals of scale 0 in a variant.
_BIG_INTEGER = r"^DECIMAL\((19|2[0-9]|3[0-9]),0\)$"
_NUMBER = r"BIGINT|DOUBLE|DECIMAL\([0-9]+,[0-9]+\)"

_VIOLATIONS = "array<struct<rule:string,field:string>>"
_NONE = f"cast(array() AS {_VIOLATIONS})"
_CORRUPT = "__corrupt"
# The same dialect as parse_json: no single quotes, no NaN.
_JSON_OPTIONS = {
    "columnNameOfCorruptRecord": _CORRUPT,
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
}


def _text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _name(value: str) -> str:
    return "`" + value.replace("`", "``") + "`"


_TIMESTAMP_LINE = _text(rf"^{TIMESTAMP_TEXT}\z")


def _is_struct(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.StructType)


def _parsed_by_type(node: Node) -> bool:
    return node.required and isinstance(node.type, (T.IntegerType, T.LongType, T.BooleanType))


def _raw_schema(schema: T.StructType) -> T.StructType:
    fields = []
    for field in schema.fields:
        node = Node((field.name,), field.dataType, not field.nullable)
        if _is_struct(field.dataType):
            kind = _raw_schema(field.dataType)
        else:
            kind = field.dataType if _parsed_by_type(node) else T.VariantType()
        fields.append(T.StructField(field.name, kind))
    return T.StructType(fields)


def _raw(node: Node) -> str:
    return ".".join(["__raw", *map(_name, node.path)])


def _value(node: Node) -> str:
    raw = _raw(node)
    if _parsed_by_type(node):
        return raw
    if isinstance(node.type, T.TimestampType):
        text = f"try_cast({raw} AS STRING)"
        return (
            f"CASE WHEN {text} RLIKE {_TIMESTAMP_LINE} THEN try_cast({text} AS TIMESTAMP) END"
        )
    return f"try_cast({raw} AS {node.type.simpleString()})"


def is_whole(body: str) -> str:
    """Whether a text is one JSON document and nothing else.

    Parsers stop behind the first document. Text behind it would have to go on an array, or
    close it, for the first scan to end well, and go on an object, or close it, for the
    second: no text does both. Scans skip values without building them.
    """
    one = f"coalesce(json_array_length(concat('[', {body}, ']')) = 1, false)"
    alone = f"""coalesce(json_object_keys(concat('{{"v":', {body}, '}}')) = array('v'), false)"""
    return f"({one} AND {alone})"


def _is_json(body: str) -> str:
    """Whether a text begins with an object in the strict dialect, whatever its fields."""
    options = ", ".join(f"{_text(k)}, {_text(v)}" for k, v in _JSON_OPTIONS.items())
    return f"(from_json({body}, '{_CORRUPT} STRING', map({options})).{_CORRUPT} IS NULL)"


def _looks_valid(all_nodes: Sequence[Node]) -> str:
    """True only for valid bodies; false means "look closer"."""
    # a variant refuses an object with a repeated key, however deep
    whole = [is_whole("__body"), "try_parse_json(__body) IS NOT NULL"]
    kinds, expected, tests = [], [], [f"__raw.{_CORRUPT} IS NULL", *whole]
    for node in all_nodes:
        if _is_struct(node.type) or _parsed_by_type(node):
            tests.append(f"{_raw(node)} IS NOT NULL")
            continue
        kind = {
            T.IntegerType: "BIGINT",
            T.LongType: "BIGINT",
            T.BooleanType: "BOOLEAN",
            T.DoubleType: _NUMBER,
        }.get(type(node.type), "STRING")
        kinds.append(f"schema_of_variant({_raw(node)})")
        expected.append(f"({kind})" if node.required else f"({kind}|VOID)")
        if isinstance(node.type, (T.IntegerType, T.TimestampType)):
            # out of range, or not a timestamp
            tests.append(f"({kinds[-1]} = 'VOID' OR ({_value(node)}) IS NOT NULL)")
    if kinds:
        # absent keys leave a gap, so one pattern covers presence and types
        pattern = _text("^" + ",".join(expected) + "$")
        tests.append(f"concat_ws(',', {', '.join(kinds)}) RLIKE {pattern}")
    return f"coalesce({' AND '.join(tests)}, false)"


def _bind(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, which is evaluated once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


_RULE = f"""CASE
  WHEN b.kind IS NULL THEN '{MISSING_KEY}'
  WHEN b.kind = 'VOID' THEN CASE WHEN f.required THEN '{REQUIRED_NULL}' END
  WHEN f.want = 'struct' THEN
    CASE WHEN NOT startswith(b.kind, 'OBJECT<') THEN '{WRONG_TYPE}' END
  WHEN f.want IN ('int', 'bigint') THEN CASE
    WHEN b.kind RLIKE {_text(_BIG_INTEGER)} THEN '{OVERFLOW}'
    WHEN b.kind <> 'BIGINT' THEN '{WRONG_TYPE}'
    WHEN f.want = 'int' AND try_cast(b.value AS INT) IS NULL THEN '{OVERFLOW}' END
  WHEN f.want = 'boolean' THEN CASE WHEN b.kind <> 'BOOLEAN' THEN '{WRONG_TYPE}' END
  WHEN f.want = 'double' THEN
    CASE WHEN NOT b.kind RLIKE {_text(f"^({_NUMBER})$")} THEN '{WRONG_TYPE}' END
  WHEN b.kind <> 'STRING' THEN '{WRONG_TYPE}'
  WHEN f.want = 'timestamp' AND (
    NOT try_cast(b.value AS STRING) RLIKE {_TIMESTAMP_LINE}
    OR try_cast(try_cast(b.value AS STRING) AS TIMESTAMP) IS NULL) THEN '{BAD_TIMESTAMP}'
END"""


def _fields_rules(members: str, fields: Sequence[T.StructField], prefix: str) -> str:
    """(rule or null, field) of some fields of an object given as a map."""
    table = ", ".join(
        f"named_struct('key', {_text(f.name)}, 'name', {_text(prefix + f.name)}, "
        f"'want', '{'struct' if _is_struct(f.dataType) else f.dataType.simpleString()}', "
        f"'required', {'false' if f.nullable else 'true'})"
        for f in fields
    )
    value = f"try_element_at({members}, f.key)"
    bound = f"named_struct('value', {value}, 'kind', schema_of_variant({value}))"
    return (
        f"transform(array({table}), f -> "
        f"named_struct('rule', {_bind(bound, 'b', _RULE)}, 'field', f.name))"
    )


def _object_rules(doc: str, schema: T.StructType, prefix: str = "", depth: int = 0) -> str:
    """(rule or null, field) of all fields below an object, in schema order."""
    members = f"m{depth}"
    parts, run = [], []
    for field in schema.fields:
        run.append(field)
        if _is_struct(field.dataType):
            parts.append(_fields_rules(members, run, prefix))
            run = []
            child = f"try_element_at({members}, {_text(field.name)})"
            # a missing, null or mistyped object is reported once, at the object
            below = _object_rules(child, field.dataType, f"{prefix}{field.name}.", depth + 1)
            inside = f"startswith(schema_of_variant({child}), 'OBJECT<')"
            parts.append(f"CASE WHEN {inside} THEN {below} ELSE {_NONE} END")
    if run:
        parts.append(_fields_rules(members, run, prefix))
    value = f"try_variant_get({doc}, '$', 'map<string,variant>')"
    return _bind(value, members, f"concat({', '.join(parts)})")


def _close_look(body: str, schema: T.StructType) -> str:
    """Every (rule, field) a body breaks, from its full variant."""

    def alone(rule: str) -> str:
        return f"array(named_struct('rule', '{rule}', 'field', ''))"

    whole = f"""CASE
      WHEN doc IS NULL AND {is_whole(body)} AND {_is_json(body)} THEN {alone(REPEATED_KEY)}
      WHEN doc IS NULL THEN {alone(MALFORMED)}
      WHEN NOT {is_whole(body)} THEN {alone(TRAILING_TEXT)}
      WHEN NOT startswith(schema_of_variant(doc), 'OBJECT<') THEN {alone(NOT_OBJECT)}
      ELSE filter({_object_rules("doc", schema)}, x -> x.rule IS NOT NULL) END"""
    return f"cast({_bind(f'try_parse_json({body})', 'doc', whole)} AS {_VIOLATIONS})"


def _fence(df: DataFrame, column: Column | str, name: str) -> DataFrame:
    """Append one column behind a one-row generator.

    Filters and projections are never copied below a generator whose output
    they read, so what is computed here is computed once per row however the
    result is used. Filters on carried columns still reach the scan.
    """
    value = F.expr(column) if isinstance(column, str) else column
    return df.select("*", F.inline(F.array(F.struct(value.alias(name)))))


def _analysed(
    df: DataFrame, body: str, schema: T.StructType, keep: Sequence[str]
) -> tuple[DataFrame, list[Node], str]:
    """``keep``, one ``__v<i>`` column per leaf, ``__v<i>`` presence per struct, violations."""
    check_supported(schema)
    all_nodes = list(nodes(schema))
    raw_schema = _raw_schema(schema).add(_CORRUPT, T.StringType())
    kept = [_name(c) for c in keep]
    parsed = _fence(
        df.selectExpr(*kept, f"{_name(body)} AS __body"),
        F.from_json("__body", raw_schema, _JSON_OPTIONS),
        "__raw",
    )
    values = [
        f"{_raw(n)} IS NOT NULL" if _is_struct(n.type) else _value(n) for n in all_nodes
    ]
    staged = parsed.selectExpr(
        *kept,
        "__body",
        f"{_looks_valid(all_nodes)} AS __clean",
        *[f"{v} AS __v{i}" for i, v in enumerate(values)],
    )
    violations = f"CASE WHEN __clean THEN {_NONE} ELSE {_close_look('__body', schema)} END"
    return staged, all_nodes, violations


def _build(schema: T.StructType, all_nodes: Sequence[Node]) -> dict[str, str]:
    """Expression of every top-level field over the staged columns."""
    index = {n.path: i for i, n in enumerate(all_nodes)}

    def field(f: T.StructField, path: tuple[str, ...]) -> str:
        column = f"__v{index[path]}"
        if not _is_struct(f.dataType):
            return column
        inner = ", ".join(
            f"{_text(x.name)}, {field(x, (*path, x.name))}" for x in f.dataType.fields
        )
        return f"CASE WHEN {column} THEN named_struct({inner}) END"

    return {f.name: field(f, (f.name,)) for f in schema.fields}


def first_violation(violations: str) -> str:
    """SQL text: "RULE field" of the first violation."""
    return f"rtrim(concat_ws(' ', get({violations}, 0).rule, get({violations}, 0).field))"


def decode_leaves(
    df: DataFrame, body: str, schema: T.StructType, keep: Sequence[str] = ()
) -> DataFrame:
    """``keep`` columns plus checked flat columns for ``assemble``.

    For rows that are shuffled or sorted between decoding and use: flat columns
    move much faster than nested ones, and unused ones are pruned on the way.
    """
    staged, all_nodes, violations = _analysed(df, body, schema, keep)
    verdict = f"""CASE WHEN size(bad) = 0 THEN true ELSE
        cast(raise_error(concat('Invalid body: ', {first_violation("bad")})) AS BOOLEAN) END"""
    ok = f"CASE WHEN __clean THEN true ELSE {_bind(violations, 'bad', verdict)} END"
    leaves = [f"__v{i}" for i in range(len(all_nodes))]
    return _fence(staged, ok, "__ok").selectExpr(*[_name(c) for c in keep], "__ok", *leaves)


def checked_leaves(
    df: DataFrame, body: str, schema: T.StructType, keep: Sequence[str] = ()
) -> DataFrame:
    """Like ``decode_leaves``, but ``__ok`` is false where a body breaks a rule."""
    staged, all_nodes, violations = _analysed(df, body, schema, keep)
    ok = f"CASE WHEN __clean THEN true ELSE size({violations}) = 0 END"
    leaves = [f"__v{i}" for i in range(len(all_nodes))]
    return _fence(staged, ok, "__ok").selectExpr(*[_name(c) for c in keep], "__ok", *leaves)


def assemble(df: DataFrame, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns plus the typed fields, from ``decode_leaves`` columns."""
    # every field reads the check, so no filter on a field can run ahead of it
    fields = [
        f"CASE WHEN __ok THEN {value} END AS {_name(name)}"
        for name, value in _build(schema, list(nodes(schema))).items()
    ]
    return df.selectExpr(*[_name(c) for c in keep], *fields)


def decode_strict(
    df: DataFrame, body: str, schema: T.StructType, keep: Sequence[str] = ()
) -> DataFrame:
    """``keep`` columns plus the typed fields; the first bad body fails the job."""
    return assemble(decode_leaves(df, body, schema, keep), schema, keep)


def decode_violations(
    df: DataFrame, body: str, schema: T.StructType, keep: Sequence[str] = ()
) -> DataFrame:
    """``keep`` columns plus ``violations``: every (rule, field) a body breaks."""
    staged, _, violations = _analysed(df, body, schema, keep)
    checked = _fence(staged, violations, "violations")
    return checked.selectExpr(*[_name(c) for c in keep], "violations")


def decode_permissive(
    df: DataFrame, body: str, schema: T.StructType, keep: Sequence[str] = ()
) -> DataFrame:
    """``keep``, ``violations``, and a ``row`` struct that is null on a bad body."""
    staged, all_nodes, violations = _analysed(df, body, schema, keep)
    checked = _fence(staged, violations, "violations")
    inner = ", ".join(f"{_text(n)}, {v}" for n, v in _build(schema, all_nodes).items())
    row = f"CASE WHEN size(violations) = 0 THEN named_struct({inner}) END AS row"
    return checked.selectExpr(*[_name(c) for c in keep], "violations", row)
