import json
import uuid

import pytest

from docenrich.operators.enrich import CallRules, ask, enrich, enrich_from_replies
from docenrich.operators.shape import shape_flags, shape_ledger, shape_minimal, shape_status

GOOD = '{"type":"A","jurisdiction":"US"}'
SCRIPTS = {
    # name: (script, calls, waits, outcome, body)
    "ok": ([(200, GOOD)], 1, [], "success", GOOD),
    "busy": ([(429, "")] * 2 + [(200, GOOD)], 3, [1.5, 2.25], "success", GOOD),
    "too_busy": ([(429, "")] * 6, 5, [1.5, 2.25, 3.375, 5.0625], "api_failure", None),
    "refused": ([(500, "x")] * 2, 1, [], "api_failure", None),
    "down": ([ConnectionError("no")] * 6, 5, [1.5, 2.25, 3.375, 5.0625], "api_failure", None),
    "late": ([TimeoutError("t"), (200, GOOD)], 2, [1.5], "success", GOOD),
    "garbled": ([(200, "{")] * 6, 5, [1.5, 2.25, 3.375, 5.0625], "api_failure", None),
    "null": ([(200, "null")] * 2, 1, [], "api_failure", "null"),
    "array": ([(200, "[1]")] * 2, 1, [], "error", "[1]"),
    "empty": ([(200, "{}")], 1, [], "success", "{}"),
    "broken": ([ValueError("bug")] * 2, 1, [], "error", None),
}


class Scripted:
    """Plays the script a text names, and leaves a marker file for each call."""

    def __init__(self, folder):
        self.folder = folder
        self.played = {}

    def __call__(self, payload):
        text = payload["text"]
        step = self.played.get(text, 0)
        self.played[text] = step + 1
        if self.folder:
            with open(f"{self.folder}/{text}-{uuid.uuid4().hex}", "w"):
                pass
        action = SCRIPTS[text][0][step]
        if isinstance(action, Exception):
            raise action
        return action


@pytest.mark.parametrize("name", SCRIPTS)
def test_attempts_and_waits(name):
    script, calls, waits, _, body = SCRIPTS[name]
    asked = []
    client = Scripted(None)
    reply = ask(client, name, CallRules(sleep=asked.append))
    assert asked == waits
    assert (reply["attempts"], client.played[name]) == (calls, calls)
    assert reply["waited_s"] == sum(waits)
    assert reply["body"] == body


def no_sleep(seconds):
    pass


def test_one_call_series_per_row_and_outcomes(spark, tmp_path):
    folder = str(tmp_path)
    docs = spark.createDataFrame(
        [(f"/{n}.pdf", n, i) for i, n in enumerate(SCRIPTS)] + [("/x.txt", None, 99)],
        "file_path string, text string, extra int",
    )
    rules = CallRules(sleep=no_sleep)
    rows = enrich(docs, lambda: Scripted(folder), rules=rules).collect()
    by_name = {r.file_path.strip("/").split(".")[0]: r for r in rows}
    for i, (name, (_, calls, _, outcome, body)) in enumerate(SCRIPTS.items()):
        row = by_name[name]
        assert (row.outcome, row.attempts, row.body, row.extra) == (outcome, calls, body, i)
        assert len(list(tmp_path.glob(f"{name}-*"))) == calls
    assert by_name["x"].outcome == "extraction_failure"
    assert by_name["x"].attempts == 0
    assert by_name["broken"].error == "bug"
    assert by_name["refused"].error.startswith("status 500")
    assert "text" not in rows[0].__fields__


def test_settled_rows_are_kept_but_not_asked_about(spark, tmp_path):
    folder = str(tmp_path)
    docs = spark.createDataFrame(
        [("/a.pdf", "ok", "extraction_failure", "why")],
        "file_path string, text string, outcome string, error string",
    )
    row = enrich(docs, lambda: Scripted(folder)).first()
    assert (row.outcome, row.error, row.attempts) == ("extraction_failure", "why", 0)
    assert not list(tmp_path.iterdir())


def test_many_rows_in_one_partition_keep_their_answers(spark):
    def echo():
        return lambda payload: (200, json.dumps({"type": payload["text"]}))

    docs = spark.range(0, 2500, 1, 1).selectExpr("concat('/', id, '.pdf') file_path", "id",
                                                 "cast(id as string) text")
    rows = enrich(docs, echo, max_workers=7).collect()
    assert len(rows) == 2500
    assert all(json.loads(r.body)["type"] == str(r.id) for r in rows)


def test_client_is_built_and_closed_once_per_partition(spark, tmp_path):
    folder = str(tmp_path)

    class Client:
        def __init__(self):
            open(f"{folder}/built-{uuid.uuid4().hex}", "w").close()

        def __call__(self, payload):
            return 200, "{}"

        def close(self):
            open(f"{folder}/closed-{uuid.uuid4().hex}", "w").close()

    docs = spark.range(0, 100, 1, 3).selectExpr("concat(id, '.pdf') file_path", "'t' text")
    enrich(docs, Client).write.format("noop").mode("overwrite").save()
    assert len(list(tmp_path.glob("built-*"))) == 3
    assert len(list(tmp_path.glob("closed-*"))) == 3


def test_any_status_takes_every_json_body():
    rules = CallRules(field="input", max_attempts=1, any_status=True)
    assert ask(lambda p: (500, '{"why": 1}'), "t", rules)["body"] == '{"why": 1}'
    assert ask(lambda p: (500, "oops"), "t", rules)["body"] is None
    assert ask(lambda p: (200, json.dumps(p)), "t", rules)["body"] == '{"input": "t"}'


REPLIES = [
    # body, outcome, type, jurisdiction
    (GOOD, "success", "A", "US"),
    ("{}", "success", "Unknown Type", "Unknown Jurisdiction"),
    ('{"type":null}', "success", None, "Unknown Jurisdiction"),
    ('{"type":5}', "success", "5", "Unknown Jurisdiction"),
    ('{"type":{"a":1}}', "success", '{"a":1}', "Unknown Jurisdiction"),
    ('{"type":"a","type":"b"}', "success", "b", "Unknown Jurisdiction"),
    ("null", "api_failure", "Unknown Type", "Unknown Jurisdiction"),
    (None, "api_failure", "Unknown Type", "Unknown Jurisdiction"),
    ('{"type"', "api_failure", "Unknown Type", "Unknown Jurisdiction"),
    ("", "api_failure", "Unknown Type", "Unknown Jurisdiction"),
    ("[1]", "error", "Unknown Type", "Unknown Jurisdiction"),
    ('"x"', "error", "Unknown Type", "Unknown Jurisdiction"),
    ("7", "error", "Unknown Type", "Unknown Jurisdiction"),
]


def test_replies_and_layouts(spark):
    stored = spark.createDataFrame(
        [(f"/{i}.pdf", r[0]) for i, r in enumerate(REPLIES)], "file_path string, body string"
    )
    rows = enrich_from_replies(stored.select("file_path"), stored)
    outcome = {r.file_path: r.outcome for r in rows.collect()}
    status = {r.filepath: r for r in shape_status(rows).collect()}
    ledger = {r.filepath: r.status for r in shape_ledger(rows).collect()}
    flags = {r.filepath: (r.extraction_failure, r.api_failure) for r in shape_flags(rows).collect()}
    minimal = {r.filepath for r in shape_minimal(rows).collect()}
    for i, (_, expected, kind, place) in enumerate(REPLIES):
        path = f"/{i}.pdf"
        assert outcome[path] == expected
        assert (status[path].type, status[path].jurisdiction) == (kind, place)
        assert status[path].status == ("success" if expected == "success" else "error")
        assert ledger[path] == expected
        assert flags[path] == {
            "success": ("no", "no"), "api_failure": ("no", "yes"), "error": ("yes", "yes"),
        }[expected]
        assert (path in minimal) == (expected == "success")


def test_repeated_replies_do_not_multiply_files(spark):
    from conftest import plan_of

    files = spark.createDataFrame([("/a.pdf",), ("/a.pdf",), ("/b.pdf",)], "file_path string")
    stored = spark.createDataFrame(
        [("/a.pdf", '{"type":"new"}', 2), ("/a.pdf", '{"type":"old"}', 1), ("/a.pdf", None, 0),
         (None, "{}", 9)],
        "file_path string, body string, at int",
    )
    rows = sorted(tuple(r) for r in enrich_from_replies(files, stored, "at").collect())
    assert rows == [("/a.pdf", '{"type":"new"}', "success")] * 2 + [("/b.pdf", None, "api_failure")]
    assert enrich_from_replies(files, stored).count() == 3
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = plan_of(enrich_from_replies(files, stored))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # the join reuses the partitioning of the reduced replies
    assert plan.count("Exchange hashpartitioning") == 2
