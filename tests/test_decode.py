"""Both decoders against fixed cases and against each other."""

from __future__ import annotations

import json
from datetime import UTC, datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from pullgrid.functions.decode import decode_permissive, decode_strict
from pullgrid.functions.schema import PULL_REQUEST_SCHEMA, check_supported
from pullgrid.sources.rows import StrictDecoder


def schema(*fields):
    return T.StructType([T.StructField(*f) for f in fields])


INT, LONG, BOOL, DOUBLE, STR, TS = (
    T.IntegerType(),
    T.LongType(),
    T.BooleanType(),
    T.DoubleType(),
    T.StringType(),
    T.TimestampType(),
)


def by_spark(spark, bodies, shape):
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, b string")
    rows = {r["i"]: r for r in decode_permissive(df, "b", shape, ["i"]).collect()}

    def row(r):
        return None if r["row"] is None else r["row"].asDict(recursive=True)

    return [
        (row(rows[i]), [(v["rule"], v["field"]) for v in rows[i]["violations"]])
        for i in range(len(bodies))
    ]


def by_python(bodies, shape):
    decoder = StrictDecoder(shape)

    def naive(value):
        if isinstance(value, datetime):
            return value.astimezone(UTC).replace(tzinfo=None)
        if isinstance(value, dict):
            return {k: naive(v) for k, v in value.items()}
        return value

    return [(naive(row), found) for row, found in map(decoder.body, bodies)]


def both(spark, bodies, shape):
    one, two = by_spark(spark, bodies, shape), by_python(bodies, shape)
    assert one == two
    return one


def test_primitive_row(spark):
    shape = schema(("a", INT), ("b", BOOL), ("c", DOUBLE), ("d", LONG), ("e", STR))
    body = '{"a":12,"b":false,"c":1.2,"d":10,"e":"abc"}'
    assert both(spark, [body], shape) == [
        ({"a": 12, "b": False, "c": 1.2, "d": 10, "e": "abc"}, [])
    ]


def test_nested_row_with_dotted_names(spark):
    c = schema(("c.a", STR), ("c.b", INT), ("c.c", BOOL))
    e = schema(("e.a", STR), ("e.b", INT), ("e.c", DOUBLE))
    shape = schema(("a", INT), ("b", BOOL), ("c", c), ("d", STR), ("e", e))
    value = {
        "a": 12,
        "b": True,
        "c": {"c.a": "a", "c.b": 1, "c.c": False},
        "d": "d",
        "e": {"e.a": "e", "e.b": 2, "e.c": 0.3},
    }
    assert both(spark, [json.dumps(value)], shape) == [(value, [])]


def test_only_declared_fields(spark):
    shape = schema(("a", INT), ("e", STR))
    body = '{"a":12,"b":false,"c":1.2,"d":10,"e":"abc"}'
    assert both(spark, [body], shape) == [({"a": 12, "e": "abc"}, [])]


def test_missing_key_fails_even_if_nullable(spark):
    found = both(spark, ['{"c":12}'], schema(("a", INT)))
    assert found == [(None, [("MISSING_KEY", "a")])]


def test_timestamps(spark):
    shape = schema(("a", TS), ("b", TS))
    good = both(spark, ['{"a":"2016-10-19T12:30:51Z","b":null}'], shape)
    assert good == [({"a": datetime(2016, 10, 19, 12, 30, 51), "b": None}, [])]
    texts = {
        "2016-10-19T12:30:51+02:00": datetime(2016, 10, 19, 10, 30, 51),
        "2016-10-19T12:30:51-0230": datetime(2016, 10, 19, 15, 0, 51),
        "2016-10-19T12:30:51+02": datetime(2016, 10, 19, 10, 30, 51),
        "2016-10-19T12:30:51.123Z": None,
        "2016-10-19T12:30:51": None,
        "2016-10-19T12:30:51Zjunk": None,
        "2016-10-19T12:30:51Z\n": None,
        "2016-13-19T12:30:51Z": None,
        "2016-02-30T12:30:51Z": None,
        "2016-10-19T24:00:00Z": None,
        "2016-10-19T23:59:60Z": None,
        "2016-10-19T12:30:51+19:00": None,
        "2016-10-19T12:30:51+17:60": None,
        "2016-10-19T12:30:51+1760": None,
        "0000-10-19T12:30:51Z": None,
        "2016-10-19 12:30:51Z": None,
        "": None,
    }
    shape = schema(("a", TS))
    found = both(spark, [json.dumps({"a": t}) for t in texts], shape)
    for (row, problems), wanted in zip(found, texts.values(), strict=True):
        if wanted is None:
            assert (row, problems) == (None, [("BAD_TIMESTAMP", "a")])
        else:
            assert (row, problems) == ({"a": wanted}, [])


def test_unsupported_type():
    with pytest.raises(ValueError, match="Unsupported data type date"):
        check_supported(schema(("a", T.DateType())))
    with pytest.raises(ValueError, match="a.b"):
        check_supported(schema(("a", schema(("b", T.ArrayType(STR))))))


def test_null_rules(spark):
    shape = schema(("a", STR, True), ("b", BOOL, False))
    assert both(spark, ['{"a":null,"b":null}'], shape) == [(None, [("REQUIRED_NULL", "b")])]
    assert both(spark, ['{"a":null,"b":true}'], shape) == [({"a": None, "b": True}, [])]
    numbers = schema(("a", INT, False), ("s", schema(("x", STR, False)), False))
    assert both(spark, ['{"a":null,"s":null}'], numbers) == [
        (None, [("REQUIRED_NULL", "a"), ("REQUIRED_NULL", "s")])
    ]


def test_null_object_is_allowed(spark):
    shape = schema(("a", INT, False), ("s", schema(("x", STR, False))))
    assert both(spark, ['{"a":1,"s":null}'], shape) == [({"a": 1, "s": None}, [])]


def test_bodies_that_are_no_object(spark):
    bodies = ["", None, "{", '{"a":1', "nul", "{'a':1}", '{"a":NaN}', '{"a":01}', '{"a":1,}']
    assert both(spark, bodies, schema(("a", INT))) == [(None, [("MALFORMED", "")])] * len(bodies)
    bodies = ["[]", "null", "5", '"a"', '[{"a":1}]']
    assert both(spark, bodies, schema(("a", INT))) == [(None, [("NOT_OBJECT", "")])] * len(bodies)


def test_text_behind_a_document(spark):
    torn = [' {"a":1} junk', '{"a":1}{"a":2}', '{"a":1},{"a":2}', '{"a":1}] x', '{"a":1}} x', '{"a":1}] [{}',
            '{"a":1},"w":{}', '{"a":1}}, {"v":{"a":1}', '[1] 2']
    assert both(spark, torn, schema(("a", INT))) == [(None, [("TRAILING_TEXT", "")])] * len(torn)
    assert both(spark, [' \t\r\n{"a":1} \t\r\n'], schema(("a", INT))) == [({"a": 1}, [])]


def test_repeated_keys(spark):
    shape = schema(("a", INT), ("s", schema(("x", STR)), True))
    twice = ['{"a":1,"a":1,"s":null}', '{"a":1,"s":{"x":"p","x":"p"}}', '{"a":1,"s":null,"z":[{"q":1,"q":2}]}']
    assert both(spark, twice, shape) == [(None, [("REPEATED_KEY", "")])] * 3
    # equal keys of different objects are no repetition
    assert both(spark, ['{"a":1,"s":{"x":"a","a":2}}'], shape) == [({"a": 1, "s": {"x": "a"}}, [])]


@pytest.mark.parametrize(
    ("value", "rule"),
    [
        ("2147483648", "OVERFLOW"),
        ("-2147483649", "OVERFLOW"),
        ("12345678901234567890", "OVERFLOW"),
        ("1.0", "WRONG_TYPE"),
        ("1.5", "WRONG_TYPE"),
        ("1e3", "WRONG_TYPE"),
        ('"1"', "WRONG_TYPE"),
        ("true", "WRONG_TYPE"),
        ("[]", "WRONG_TYPE"),
        ("{}", "WRONG_TYPE"),
    ],
)
@pytest.mark.parametrize("required", [True, False])
def test_integers(spark, value, rule, required):
    shape = schema(("a", INT, not required))
    assert both(spark, [f'{{"a":{value}}}'], shape) == [(None, [(rule, "a")])]


def test_text_is_never_made_from_other_types(spark):
    bodies = [f'{{"a":{v}}}' for v in ("5", "true", "{}", "[1]", "1.5")]
    assert both(spark, bodies, schema(("a", STR))) == [(None, [("WRONG_TYPE", "a")])] * 5


def test_every_violation_in_schema_order(spark):
    shape = schema(
        ("a", INT, False), ("s", schema(("x", STR), ("y", LONG, False))), ("t", TS), ("d", DOUBLE)
    )
    body = '{"a":"1","s":{"y":null},"t":5,"d":"x"}'
    assert both(spark, [body], shape)[0][1] == [
        ("WRONG_TYPE", "a"),
        ("MISSING_KEY", "s.x"),
        ("REQUIRED_NULL", "s.y"),
        ("WRONG_TYPE", "t"),
        ("WRONG_TYPE", "d"),
    ]


def test_failfast_fails_whatever_is_read(spark):
    df = spark.createDataFrame([('{"a":1,"b":"x"}',), ('{"a":1,"b":5}',)], "body string")
    rows = decode_strict(df, "body", schema(("a", INT, False), ("b", STR)))
    for query in (rows, rows.select("a"), rows.where("a > 5"), rows.where("b IS NULL")):
        with pytest.raises(Exception, match="Invalid body: WRONG_TYPE b"):
            query.collect()


def test_one_parse_per_body_and_pushdown(spark, tmp_path):
    df = spark.createDataFrame([(1, '{"a":1}')], "k int, body string")
    df.write.parquet(str(tmp_path / "t"))
    rows = decode_strict(spark.read.parquet(str(tmp_path / "t")), "body", schema(("a", INT)), ["k"])
    plan = rows.where("a > 0 AND k > 0").select("a")._jdf.queryExecution().executedPlan().toString()
    # once per body; the other one is for rows that break a rule
    assert plan.count("from_json") == 2 and plan.count("ELSE (size(CASE") <= 1
    assert plan.index("from_json(StructField(a") > 0
    assert "GreaterThan(k,0)" in plan


ATOMS = st.one_of(
    st.none(),
    st.booleans(),
    st.integers(-(10**20), 10**20),
    st.floats(allow_nan=False, allow_infinity=False, width=32),
    st.sampled_from(["", "x", "1", "2016-10-19T12:30:51Z", "2016-10-19T25:30:51Z", "é中"]),
    st.just([]),
)
OBJECTS = st.dictionaries(st.sampled_from(["p", "q", "z"]), ATOMS)
DOCUMENTS = st.dictionaries(
    st.sampled_from(["a", "b", "c", "d", "e", "f", "s", "u"]), st.one_of(ATOMS, OBJECTS)
)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(DOCUMENTS, min_size=150, max_size=250))
def test_decoders_agree_on_random_documents(spark, documents):
    shape = schema(
        ("a", INT, False),
        ("b", LONG),
        ("c", BOOL, False),
        ("d", STR),
        ("e", TS),
        ("f", DOUBLE),
        ("s", schema(("p", INT), ("q", STR, False))),
        ("u", schema(("z", BOOL)), False),
    )
    complete = [
        {"a": 1, "b": None, "c": True, "d": "x", "e": None, "f": 1, "s": None, "u": {"z": None}}
        | d
        for d in documents
    ]
    both(spark, [json.dumps(d) for d in documents + complete], shape)


def test_decoders_agree_on_the_faulty_mirror(spark, sf):
    from pullgrid.plans import mirror

    bodies = [r["body"] for r in mirror.faulty_details(spark, sf).select("body").collect()]
    found = both(spark, bodies, PULL_REQUEST_SCHEMA)
    assert sum(row is not None for row, _ in found) == 272


def test_decoding_what_was_decoded(spark, sf):
    """to_json(decode(x)) decodes to the same rows."""
    from pyspark.sql import functions as F

    from pullgrid.plans import mirror

    bodies = mirror.details(spark, sf).select("body")
    once = decode_strict(bodies, "body", PULL_REQUEST_SCHEMA)
    options = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ssXXX"}
    text = once.select(F.to_json(F.struct("*"), options).alias("body"))
    twice = decode_strict(text, "body", PULL_REQUEST_SCHEMA)
    assert once.exceptAll(twice).count() == 0
    assert twice.count() == 1500
