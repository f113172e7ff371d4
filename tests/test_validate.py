"""Validation rules, JSON strictness, and batches."""

import json

import pytest
from pyspark.sql import functions as F

from eventide.operators import validate as val
from eventide.schemas import USER_EVENT

GOOD = {
    "id": "e1",
    "user_id": "user-001",
    "session_id": "s1",
    "event_type": "click",
    "page": "/",
    "duration_ms": 1,
}
TEXT = json.dumps(GOOD)


def put(**changes):
    return json.dumps({**GOOD, **changes}, ensure_ascii=False)


def without(name):
    return json.dumps({k: v for k, v in GOOD.items() if k != name})


ALLOWED = "(allowed: click, page_view, purchase, login, logout, search)"
BAD_USER = "user_id: contains invalid characters (allowed: a-z A-Z 0-9 _ -)"

# The rules, one changed field at a time: (changes, expected errors).
RULES = [
    ({}, []),
    ({"id": ""}, ["id: must not be empty"]),
    ({"id": "a" * 36}, []),
    ({"id": "a" * 37}, ["id: length 37 exceeds 36 chars"]),
    ({"id": "é" * 18}, []),
    ({"id": "é" * 19}, ["id: length 38 exceeds 36 chars"]),
    ({"user_id": ""}, ["user_id: must not be empty"]),
    ({"user_id": "a b"}, [BAD_USER]),
    ({"user_id": "abc\n"}, [BAD_USER]),
    ({"user_id": "A_z-9"}, []),
    ({"session_id": ""}, ["session_id: must not be empty"]),
    ({"session_id": "s" * 40}, ["session_id: length 40 exceeds 36 chars"]),
    ({"event_type": "error"}, [f"event_type: 'error' is not valid {ALLOWED}"]),
    ({"event_type": "Click"}, [f"event_type: 'Click' is not valid {ALLOWED}"]),
    ({"page": ""}, ["page: '' must start with '/'"]),
    ({"page": "catalog"}, ["page: 'catalog' must start with '/'"]),
    ({"duration_ms": -0.01}, ["duration_ms: -0.01 must be >= 0"]),
    ({"duration_ms": 0}, []),
    ({"duration_ms": 300000}, []),
    ({"duration_ms": 300000.01}, ["duration_ms: 300000.01 exceeds max 300000 ms (5 minutes)"]),
    ({"duration_ms": 300000.125}, ["duration_ms: 300000.12 exceeds max 300000 ms (5 minutes)"]),
    (
        {"id": "", "page": "x", "duration_ms": -1},
        [
            "id: must not be empty",
            "page: 'x' must start with '/'",
            "duration_ms: -1.00 must be >= 0",
        ],
    ),
]

# Records and the start of their single parse error; None for a good record.
PARSE = [
    (TEXT, None),
    ("  " + TEXT + "\n", None),
    (put(extra={"a": [1, {"b": None}]}), None),
    ('{"x":1,"x":2,' + TEXT[1:], None),
    (put(duration_ms=1e3), None),
    ('["e1","user-001","s1","click","/",1]', None),
    (TEXT[:-1], "invalid event"),
    (TEXT + " trailing", "invalid event"),
    (TEXT + "]", "invalid event"),
    (TEXT + "} x", "invalid event"),
    (TEXT + "," + TEXT, "invalid event"),
    (TEXT + ',{"_end":1}', "invalid event"),
    ("", "invalid event"),
    ("null", "invalid event"),
    ("7", "invalid event"),
    ('"text"', "invalid event"),
    ("[]", "invalid event"),
    ('["e1","user-001","s1","click","/"]', "invalid event"),
    (TEXT.replace('"', "'"), "invalid event"),
    (put(duration_ms=float("nan")), "invalid event"),
    (put(duration_ms=1).replace(": 1}", ": 01}"), "invalid event"),
    (without("id"), "missing field `id`"),
    (without("duration_ms"), "missing field `duration_ms`"),
    ("{}", "missing field `id`"),
    (put(page=None), "invalid type: null, expected a string"),
    (put(user_id=5), "invalid type: integer `5`, expected a string"),
    (put(user_id=True), "invalid type: boolean `true`, expected a string"),
    (put(user_id=[1]), "invalid type: sequence, expected a string"),
    (put(user_id={"a": 1}), "invalid type: map, expected a string"),
    (put(duration_ms="1"), 'invalid type: string "1", expected f64'),
    (put(duration_ms=None), "invalid type: null, expected f64"),
    (TEXT.replace(": 1}", ": 1e400}"), "invalid type"),
    ('{"id":"first",' + TEXT[1:], "duplicate field `id`"),
    (TEXT.replace('"id"', '"ID"'), "missing field `id`"),
]


def verdicts(spark, texts, check, column):
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, f"n int, {column} string")
    return check(df).orderBy("n").collect()


def test_typed_rules(spark):
    rows = [
        tuple({**GOOD, **c, "duration_ms": float({**GOOD, **c}["duration_ms"])}.values())
        + (None, None)
        for c, _ in RULES
    ]
    df = spark.createDataFrame(rows, USER_EVENT).withColumn("n", F.monotonically_increasing_id())
    got = val.validate_events(df).orderBy("n").collect()
    assert [r.errors for r in got] == [e for _, e in RULES]
    assert [r.is_valid for r in got] == [not e for _, e in RULES]


def test_json_rules(spark):
    got = verdicts(spark, [put(**c) for c, _ in RULES], val.validate_json_events, "value")
    assert [r.errors for r in got] == [e for _, e in RULES]


def test_json_parsing(spark):
    got = verdicts(spark, [t for t, _ in PARSE], val.validate_json_events, "value")
    for row, (text, problem) in zip(got, PARSE, strict=True):
        if problem is None:
            assert row.is_valid and row.errors == [], text
        else:
            assert not row.is_valid and len(row.errors) == 1, text
            assert row.errors[0].startswith(f"JSON parse error: {problem}"), text


def test_first_wrong_field_in_text_order_is_named(spark):
    text = '{"duration_ms":"x","user_id":5}'
    row = verdicts(spark, [text], val.validate_json_events, "value")[0]
    assert row.errors == ['JSON parse error: invalid type: string "x", expected f64']


def test_verdict_as_text(spark):
    df = spark.createDataFrame([(put(page="x"),)], "value string")
    row = val.verdict_json(val.validate_json_events(df)).first()
    assert json.loads(row.verdict) == {
        "is_valid": False,
        "errors": ["page: 'x' must start with '/'"],
    }


def test_null_record_is_invalid(spark):
    row = verdicts(spark, [None], val.validate_json_events, "value")[0]
    assert not row.is_valid


def test_filter_on_verdict_keeps_rows_whole(spark):
    df = spark.createDataFrame([(t,) for t, _ in PARSE], "value string")
    good = val.validate_json_events(df).filter("is_valid")
    assert good.count() == sum(p is None for _, p in PARSE)


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("[]", []),
        (f"[{TEXT},{put(page='x')}]", [[], ["page: 'x' must start with '/'"]]),
        ("{}", ["JSON parse error: invalid batch"]),
        ("[" + TEXT, ["JSON parse error: invalid batch"]),
        (f"[{TEXT}] x", ["JSON parse error: invalid batch"]),
        ("", ["JSON parse error: invalid batch"]),
        ("null", ["JSON parse error: invalid batch"]),
        (
            f"[{TEXT},7,null,{put(id=5)}]",
            [
                [],
                ["JSON parse error: invalid type: integer `7`, expected struct EventData"],
                ["JSON parse error: invalid type: null, expected struct EventData"],
                ["JSON parse error: invalid type: integer `5`, expected a string"],
            ],
        ),
        ("[null]", ["JSON parse error: invalid type: null, expected struct EventData"]),
        ('[["e1","u","s","click","/",1],["e1"]]', [[], ["JSON parse error: invalid length 1, "
            "expected struct EventData with 6 elements"]]),
        # Fields of a parsed object are visited by name.
        (
            f"[{put(user_id=5, duration_ms='x')}]",
            ['JSON parse error: invalid type: string "x", expected f64'],
        ),
        # In a batch the last of several equal keys counts.
        ('[{"id":"",' + TEXT[1:] + "]", [[]]),
        ('[1,{"id":"",' + TEXT[1:] + "]", [
            ["JSON parse error: invalid type: integer `1`, expected struct EventData"], []]),
    ],
)
def test_batches(spark, text, expected):
    expected = [e if isinstance(e, list) else [e] for e in expected]
    df = spark.createDataFrame([(1, text)], "batch int, events string")
    got = val.validate_batch(df).orderBy("pos").collect()
    assert [r.pos for r in got] == list(range(len(expected)))
    assert [r.errors for r in got] == expected
    assert [r.is_valid for r in got] == [not e for e in expected]


def test_windows_gate(spark):
    averages = [0.0, 300000.0, 300000.01, -1.0, None, float("nan"), float("inf")]
    df = spark.createDataFrame([(a,) for a in averages], "avg_duration_ms double")
    got = [r.is_valid for r in val.validate_windows(df).collect()]
    assert got == [True, True, False, False, False, False, False]


def test_summary(spark):
    rows = [tuple({**GOOD, **c, "duration_ms": 1.0}.values()) + (None, None) for c in (
        {}, {"id": ""}, {"id": "", "page": "x"})]
    df = spark.createDataFrame(rows, USER_EVENT)
    got = {r.rule: r.n for r in val.validation_summary(val.validate_events(df)).collect()}
    assert got == {"valid": 1, "invalid": 2, "id": 2, "page": 1}


def test_sql_function(spark):
    val.register_sql_functions(spark)
    row = spark.sql("SELECT event_errors('e', 'u u', 's', 'click', '/', 1D) AS e").first()
    assert row.e == [BAD_USER]
