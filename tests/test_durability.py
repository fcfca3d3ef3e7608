"""Replies outlive the task and the driver; runs that go on at once keep apart."""

import json
import os
import subprocess
import sys
import threading
import time
import uuid

import pytest
from conftest import ROOT

from docenrich import cluster
from docenrich.operators.enrich import CallRules
from docenrich.operators.extract import PAGES, Extractor
from docenrich.plans import runs
from docenrich.sinks import runs_log
from docenrich.sinks.journal import Journal, drop_old_journals, journal_folder, journalled_replies
from docenrich.sinks.tables import append_ledger
from docenrich.sources.ledger import read_ledger_table

EXTRACTORS = {".pdf": Extractor(lambda content: [content.decode()], PAGES)}
RULES = CallRules(sleep=lambda seconds: None)
REPLY = {"http_status": 200, "body": '{"type":"x"}', "attempts": 1, "waited_s": 0.0, "crashed": False, "call_error": None}


class Counting:
    """Leaves a mark for each call, named by the text; refuses texts with ``bad``."""

    def __init__(self, folder):
        self.folder = folder

    def __call__(self, payload):
        text = next(iter(payload.values())).split("\n\n")[-2].strip()
        open(f"{self.folder}/{text}--{uuid.uuid4().hex}", "w").close()
        if "bad" in text:
            return 500, "refused"
        return 200, json.dumps({"type": "memo", "jurisdiction": "US"})


@pytest.fixture
def job(tmp_path):
    for name in ("root", "calls"):
        (tmp_path / name).mkdir()
    for i in range(12):
        (tmp_path / "root" / f"{i}.pdf").write_text(f"bad{i}" if i == 5 else f"doc{i}")
    return tmp_path


def calls(job):
    found = {}
    for name in os.listdir(job / "calls"):
        found[name.split("--")[0]] = found.get(name.split("--")[0], 0) + 1
    return found


def status_run(spark, job, **options):
    folder = str(job / "calls")
    return runs.run_status(
        spark, str(job / "root"), str(job / "ledger"), lambda: Counting(folder), EXTRACTORS, RULES,
        num_partitions=2, **options,
    )


def test_a_journal_gives_back_what_was_settled(tmp_path):
    first = Journal(str(tmp_path / "j"), 3)
    for i in range(5):
        first.add(f"/ä{i}\0ff.pdf", REPLY | {"attempts": i})
    first.close()
    part = next((tmp_path / "j" / "part-000003").iterdir())
    # the last line is cut off, one is no object, one has no end mark
    part.write_bytes(part.read_bytes()[:-9] + b'\n[1]\n{"file_path": "/z"}\n')
    again = Journal(str(tmp_path / "j"), 3)
    assert {p: r["attempts"] for p, r in again.known.items()} == {f"/ä{i}\0ff.pdf": i for i in range(4)}
    assert again.known["/ä0\0ff.pdf"] == REPLY | {"attempts": 0}
    assert Journal(str(tmp_path / "j"), 2).known == {}


def test_a_run_after_a_lost_driver_asks_only_about_the_rest(spark, job, monkeypatch):
    def breaks_before_the_commit(df, folder, run):
        df.write.format("noop").mode("append").save()
        raise RuntimeError("driver lost")

    monkeypatch.setattr(runs, "append_ledger", breaks_before_the_commit)
    with pytest.raises(RuntimeError):
        status_run(spark, job)
    assert sorted(calls(job).values()) == [1] * 12
    assert read_ledger_table(spark, str(job / "ledger")).count() == 0
    monkeypatch.setattr(runs, "append_ledger", append_ledger)
    rows = {os.path.basename(r.filepath): r.status for r in status_run(spark, job).collect()}
    assert len(rows) == 12 and rows.pop("5.pdf") == "error" and set(rows.values()) == {"success"}
    # a failed call is made again, as after any run
    assert calls(job) == {f"doc{i}": 1 for i in range(12) if i != 5} | {"bad5": 2}
    assert [os.path.basename(r.filepath) for r in status_run(spark, job).collect()] == ["5.pdf"]
    assert {r.type for r in read_ledger_table(spark, str(job / "ledger")).where("status = 'success'").collect()} == {"memo"}


def test_journals_go_when_the_ledger_has_the_replies(spark, job):
    status_run(spark, job, waves=2)
    assert journalled_replies(spark, str(job / "ledger")).count() == 0
    folder = journal_folder(str(job / "ledger"), "abandoned", "wave-000000")
    journal = Journal(folder, 0)
    journal.add("/a.pdf", REPLY)
    journal.close()
    drop_old_journals(spark, str(job / "ledger"), time.time() - 3600)
    assert [r.file_path for r in journalled_replies(spark, str(job / "ledger")).collect()] == ["/a.pdf"]
    drop_old_journals(spark, str(job / "ledger"), time.time() + 3600)
    assert not os.path.exists(folder)


def test_a_manifest_is_created_once(spark, tmp_path):
    path = str(tmp_path / "x" / "m.json")
    made = []
    threads = [
        threading.Thread(target=lambda i=i: made.append(cluster.create_once(spark, path, b"%d" % i))) for i in range(16)
    ]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(made) == [False] * 15 + [True]
    assert os.listdir(tmp_path / "x") == ["m.json"]
    assert cluster.read_small(spark, path) in {b"%d" % i for i in range(16)}


def test_claims_follow_the_rows_of_an_older_ledger(spark, job):
    settled = spark.createDataFrame([("/a.pdf", "success", "{}")], "file_path string, outcome string, body string")
    append_ledger(settled, str(job / "ledger"), 7)
    claimed = [runs_log.claim_run(spark, str(job / "ledger")).seq for _ in range(2)]
    assert claimed == [8, 9] and runs_log.claimed_runs(spark, str(job / "ledger")) == [8, 9]
    assert [r.run_id for r in read_ledger_table(spark, str(job / "ledger")).collect()] == [None]


def test_runs_at_once_never_share_rows(spark, job):
    results, problems = {}, []

    def go(name):
        try:
            results[name] = sorted(os.path.basename(r.filepath) for r in status_run(spark, job).collect())
        except Exception as problem:  # noqa: BLE001 - told below
            problems.append(problem)

    threads = [threading.Thread(target=go, args=(i,)) for i in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert problems == []
    table = read_ledger_table(spark, str(job / "ledger")).collect()
    by_run = {}
    for r in table:
        by_run.setdefault((r.run_seq, r.run_id), []).append(os.path.basename(r.filepath))
    assert len({seq for seq, _ in by_run}) == len({name for _, name in by_run}) == len(by_run)
    assert sorted(map(sorted, by_run.values())) == sorted(v for v in results.values() if v)
    assert {r.filepath for r in table} == {str(job / "root" / f"{i}.pdf") for i in range(12)}


WORKER = """
import json, os, sys, uuid
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from docenrich.operators.extract import PAGES, Extractor
from docenrich.plans.runs import run_status
from docenrich.sources.ledger import read_ledger_table

folder = {folder!r}
spark = (
    SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "2")
    .config("spark.checkpoint.dir", folder + "/shared").getOrCreate()
)

def build():
    settled = []
    def answer(payload):
        text = payload["text"].split("\\n\\n")[-2].strip()
        if len(settled) == 7 and not os.path.exists(folder + "/died"):
            open(folder + "/died", "w").close()
            os._exit(1)
        open(folder + "/calls/" + text + "--" + uuid.uuid4().hex, "w").close()
        settled.append(text)
        return 200, json.dumps({{"type": "memo", "jurisdiction": "US"}})
    return answer

extractors = {{".pdf": Extractor(lambda content: [content.decode()], PAGES)}}
run_status(spark, folder + "/root", folder + "/ledger", build, extractors, num_partitions=2, max_workers=1)
print("RESULT " + json.dumps(sorted(r.filepath for r in read_ledger_table(spark, folder + "/ledger").collect())))
"""


def test_a_killed_worker_repeats_no_settled_reply(job):
    names = [str(job / "root" / f"{i}.pdf") for i in range(12, 40)]
    for i, name in enumerate(names, 12):
        with open(name, "w") as handle:
            handle.write(f"doc{i}")
    done = subprocess.run(
        [sys.executable, "-c", WORKER.format(root=ROOT, folder=str(job))],
        capture_output=True, text=True, timeout=180, env=os.environ | {"PYTHONPATH": ""},
    )
    result = [x for x in done.stdout.splitlines() if x.startswith("RESULT ")]
    assert result, done.stderr[-3000:]
    assert os.path.exists(job / "died")
    assert len(json.loads(result[0].removeprefix("RESULT "))) == 40
    # without the journal the seven replies before the worker died would be asked for again
    assert len(calls(job)) == 40 and set(calls(job).values()) == {1}
