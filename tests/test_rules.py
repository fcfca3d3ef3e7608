"""Expressions against plain Python."""

import hashlib
import json
from pathlib import PurePosixPath

import hypothesis.strategies as st
from conftest import plan_of
from hypothesis import HealthCheck, given, settings
from pyspark.sql import functions as F

from docenrich.functions import paths, replies, retry
from docenrich.operators import attempts
from docenrich.operators.filters import drop_empty_reply

SLOW = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def resolved(statuses, limit=5):
    """attempts, http_status, waited_s, outcome of one call, by the retry loop."""
    waited = 0.0
    for number, status in enumerate(statuses, start=1):
        if status == 200:
            return number, 200, waited, "success"
        if status is not None and status != 429:
            return number, status, waited, "api_failure"
        if number == limit:
            return number, None, waited, "api_failure"
        waited += 1.5**number
    return len(statuses), None, waited, "open"


LOGS = st.lists(
    st.lists(st.sampled_from([200, 429, 429, 429, None, None, 500]), min_size=1, max_size=9),
    min_size=1,
    max_size=40,
)


@SLOW
@given(LOGS)
def test_resolve_attempts_is_the_retry_loop(spark, logs):
    rows = [(c, n, s) for c, log in enumerate(logs) for n, s in enumerate(log)]
    log = spark.createDataFrame(rows, "call int, at int, http_status int").repartition(3)
    result = attempts.resolve_attempts(log, ["call"], ["at"])
    got = {r.call: (r.attempts, r.http_status, r.waited_s, r.outcome) for r in result.collect()}
    assert got == {c: resolved(log) for c, log in enumerate(logs)}


def test_endless_calls_are_cut_before_the_shuffle(spark):
    log = spark.range(1000).selectExpr("id % 2 call", "id at", "429 http_status")
    plan = plan_of(attempts.resolve_attempts(log, ["call"], ["at"]))
    shuffle = plan.index("Exchange hashpartitioning")
    assert plan.index("Final") < shuffle < plan.index("Partial")
    assert plan.count("Exchange") == 1


PATHS = st.lists(
    st.text(st.characters(codec="utf-8", exclude_characters="\x00\n"), min_size=1, max_size=30),
    min_size=1,
    max_size=60,
)


@SLOW
@given(PATHS)
def test_keys(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "p string")
    for row in df.select("p", paths.key_md5(F.col("p")).alias("k")).collect():
        assert row.k == hashlib.md5(row.p.encode()).hexdigest() + ".json"


def test_stem_key(spark):
    names = ["/a/x.pdf", "/b.c/x.tar.pdf", "/a/.pdf", "/a/none", "x.docx", "/a.b/c"]
    df = spark.createDataFrame([(n,) for n in names], "p string")
    got = {r.p: r.k for r in df.select("p", paths.key_stem(F.col("p")).alias("k")).collect()}
    assert got == {n: PurePosixPath(n).stem + ".json" for n in names}


def test_path_join_and_plain_path(spark):
    df = spark.createDataFrame([("/a/", "b"), ("/a", "b")], "folder string, name string")
    joined = df.select(paths.path_join(F.col("folder"), F.col("name")).alias("p")).collect()
    assert {r.p for r in joined} == {"/a/b"}
    uris = spark.createDataFrame([("file:/a/b",), ("file:///a/b",), ("s3://x/a",)], "u string")
    plain = uris.select(paths.plain_path(F.col("u")).alias("p")).collect()
    assert [r.p for r in plain] == ["/a/b", "/a/b", "s3://x/a"]


def test_waits(spark):
    row = spark.range(1).select(retry.backoff_schedule().alias("s")).first()
    assert row.s == [1.5, 2.25, 3.375, 5.0625, 7.59375]
    waits = spark.createDataFrame([(w,) for w in row.s], "w double")
    labels = [r.t for r in waits.select(retry.format_wait(F.col("w")).alias("t")).collect()]
    assert labels == [f"{w:.1f}" for w in row.s]


def test_empty_replies(spark):
    import json

    bodies = ["{}", "{ }", "[]", "[ ]", "0", "0.0", "-0", "0e5", '""', "false", "null", " null ",
              '{"a":null}', "[0]", "1", "-1", "0.5", '"x"', "true", '" "']
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    kept = {r.body for r in drop_empty_reply(df).collect()}
    assert kept == {b for b in bodies if json.loads(b)}


def test_reply_kinds(spark):
    kinds = {"{}": "object", " {\"a\":1} ": "object", "null": "null", " null ": "null",
             "[1]": "other", "5": "other", '"null"': "other", "{": "malformed", "": "malformed",
             None: None, '{"a":1,"a":2}': "object"}
    df = spark.createDataFrame([(b,) for b in kinds], "body string")
    got = {r.body: r.k for r in df.select("body", replies.reply_kind(F.col("body")).alias("k")).collect()}
    assert got == kinds


def test_payload_keeps_an_explicit_null(spark):
    df = spark.createDataFrame([(None,), ('a"\n',)], "t string")
    got = [r.p for r in df.select(replies.request_payload(F.col("t")).alias("p")).collect()]
    assert got == ['{"text":null}', '{"text":"a\\"\\n"}']


def strict(body):
    """What the standard library makes of a body, NaN and Infinity apart."""
    def refuse(name):
        raise ValueError(name)

    try:
        value = json.loads(body, parse_constant=refuse)
    except ValueError:
        return replies.MALFORMED
    if value is None:
        return replies.NULL
    return replies.OBJECT if isinstance(value, dict) else replies.OTHER


BODIES = [
    '{"type":"A"}', ' \t\r\n{"type":"A"}\n', '{"type":"A"} junk', '{"type":"A"}{"type":"B"}',
    "{'type':'A'}", '{"type":"A\nB"}', "\tnull\n", '{"type": NaN}', "NaN", "-Infinity", "", " ",
    "[1]", "[1],[2]", "1,2", '{"a":1}],[{"b":2}', '{"a":1},"x":{"b":2}', "1},{2", "01", "1.", "-",
    '"x"', '"x', "true", "tru", "nul", "null null", '{"a":1,}', "[1,]", '{"a":1,"a":2}', "{}", "[]",
    '{"a" 1}', "{a:1}", "/* c */ {}", "\u00a0{}", "\ufeff{}", '{"a":{"b":[1,{"c":null}]}}', "1e5",
    '{"a":"\\u00e9"}', '{"a":"\\x"}', "{", "}", "]", "[", '"', "{}}", "[]]", "0", "+1", ".5",
]


def test_bodies_are_judged_by_the_standard(spark):
    rows = spark.createDataFrame([(b,) for b in BODIES], "body string")
    got = rows.select("body", replies.reply_kind(F.col("body")).alias("kind")).collect()
    assert {r.body: r.kind for r in got} == {b: strict(b) for b in BODIES}


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet='{}[]:,"\'01-.eE \t\nantrulfs\\', max_size=12), max_size=60))
def test_any_body_is_judged_by_the_standard(spark, bodies):
    rows = spark.createDataFrame([(b,) for b in bodies], "body string")
    got = rows.select("body", replies.reply_kind(F.col("body")).alias("kind")).collect()
    assert {r.body: r.kind for r in got} == {b: strict(b) for b in bodies}
